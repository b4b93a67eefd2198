"""Pipeline over ``documents``: language ID, line dedup, SimHash near-dedup,
mixing to target weights, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes
each result as Parquet in the shared folder and hands the next stage what it
reads there. All but the last return the columns of ``documents``. No SQL
expresses the stages (a classifier, fingerprints, a tokenizer): ``ORACLE_SQL``
is None, and ``tests/llm/test_pipeline.py`` compares every stage with a
brute-force version.

Rows without a doc_id, null or empty texts and null sources are handled as
the operators state; a document without any words leaves at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import langid, linededup, mixing, sentencepiece, simhash
from shoplens.llm.common import Run
from shoplens.llm.queries import tokenizer_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID, learned from the rows that name their language: documents whose language is undetermined go."""
    model = langid.train(docs)
    known = langid.identify(docs.select(*COLUMNS), model, lang_out="_lang", score_out="_score")
    return known.filter(F.col("_lang") != langid.UNDETERMINED).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that an earlier line equals, or nearly, leave their text; documents left without a word go."""
    return linededup.without_repeated_lines(docs, COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (3-word shingles, 3 bits): one document of each group stays, the one of the smallest id."""
    return simhash.keep_first(docs, COLUMNS, shingle=3, bits=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: 5, 2, 1 by source, 150 % of all words, at most twice a source."""
    return mixing.repeat_documents(docs, COLUMNS, weights=(5, 2, 1), share=1.5, most=2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: the ids of every text, with begin and end."""
    out = sentencepiece.encode(docs.select(*COLUMNS), tokenizer_model(), out="ids")
    return out.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    files = Run(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = files.stage(stage(spark, docs, sf_dir), name)
    return docs
