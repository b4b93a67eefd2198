"""M7–M9: predictions by a join equal those of the fitted pipeline, and
DuckDB recomputes them from the two stored tables."""

import random

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from shoplens.operators import models as M
from shoplens.operators import scoring as S
from shoplens.plans import catalog
from shoplens.sinks import write_results
from shoplens.sources.files import read_results

SF = "/root/testdata/sf0.01"


def fitted(train, **kw):
    tokens = M.PipelineModel(stages=M.token_stages()).transform(train)
    return Pipeline(stages=M.model_stages(**kw)).fit(tokens)


def predictions(df):
    return {r["doc_id"]: int(r["prediction"]) for r in df.collect()}


@pytest.mark.parametrize("use_idf,num_features", [(True, 10_000), (False, 1_000)])
def test_all_test_predictions_are_recomputed_in_sql(spark, tmp, use_idf, num_features):
    sample = M.sample_split(catalog.clean_reviews(spark, SF), key="doc_id", fractions=catalog.FIXTURE_SAMPLE)
    sample.select("doc_id", "review_clean", "sentiment_label", "split").write.parquet(f"{tmp}/sample")
    sample = spark.read.parquet(f"{tmp}/sample")
    train, test = (sample.filter(F.col("split") == s) for s in ("train", "test"))
    model = fitted(train, use_idf=use_idf, num_features=num_features)
    want = predictions(model.transform(M.PipelineModel(stages=M.token_stages()).transform(test)))

    # The model is stored, and applied from the store.
    write_results(S.model_table(spark, model), f"{tmp}/store", "classifier")
    table = read_results(spark, f"{tmp}/store", "classifier").drop("analysis")
    got = S.score_texts(test, table, "doc_id", num_features)
    assert predictions(got) == want and len(want) > 50 and got.filter("margin < 0").count() == 0

    S.text_terms(test, "doc_id", num_features).write.parquet(f"{tmp}/terms")
    table.write.parquet(f"{tmp}/model")
    con = duckdb.connect()
    rows = con.execute(f"""
        with t as (select * from '{tmp}/terms/*.parquet'), m as (select * from '{tmp}/model/*.parquet'),
        d as (select doc_id from '{tmp}/sample/*.parquet' where split = 'test'),
        s as (select d.doc_id, i.class, i.weight + coalesce((select sum(t.count * m.weight) from t join m using (feature)
              where t.doc_id = d.doc_id and m.class = i.class), 0) as margin from d, m i where i.feature = -1)
        select doc_id, arg_max(class, margin) from s group by doc_id""").fetchall()
    assert dict(rows) == want


def test_two_classes_and_texts_without_words(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["good", "fine"] if i % 2 else ["bad", "poor"], k=5)), i % 2) for i in range(60)]
    train = spark.createDataFrame(rows, "doc_id long, review_clean string, sentiment_label int")
    model = fitted(train, min_doc_freq=1)
    table = S.model_table(spark, model)
    texts = spark.createDataFrame([(1, "good fine"), (2, "bad"), (3, ""), (4, "unheard")], "doc_id long, review_clean string")
    want = predictions(model.transform(M.PipelineModel(stages=M.token_stages()).transform(texts)))
    assert predictions(S.score_texts(texts, table, "doc_id")) == want and want[1] == 1 and want[2] == 0
    assert S.score_texts(texts.limit(0), table, "doc_id").count() == 0
    # A text without words has one term, the empty word, as the fit counts it.
    assert S.text_terms(texts, "doc_id").filter("doc_id = 3").count() == 1
