"""The operators over their whole tables: one query op<N>_<name> each, with
production parameters, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ctw, fingerprints, langid, licenses, linededup, merkle, mixing, quality, resampling, secrets, sentencepiece, simhash, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_model() -> str:
    """Model file of the public 32k BPE vocabulary, as installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows whose crc32(doc_id) mod 3 is not 1, predicts all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = F.crc32(F.col("doc_id").cast("string")) % 3
    model = langid.train(docs.filter(part != 1))
    return langid.identify(docs.select("doc_id", "text", F.coalesce(part == 1, F.lit(False)).alias("held_out")),
                           model).select("doc_id", "held_out", "lang_pred", "score")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 5, 2, 1 by source, 150 % of all words, at most 2 times a source."""
    return (mixing.mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
            .select("doc_id", "size", "source_size", "target", "taken"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingles, containment of 0.8 or more."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and what they decode to, as digests."""
    t = sentencepiece.round_trip(table(spark, sf_dir, "documents"), tokenizer_model())
    return t.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, links at 3 or fewer differing bits."""
    return (simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, bits=3)
            .select("doc_id", "fingerprint", "component_id"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the isolation forest, its limit set on ``labels``."""
    return (quality.quality_filter(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page to an archive and back; equal payloads of any size revisit."""
    return warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0, columns=[
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal lines, and lines of 20 characters or more within one edit."""
    return linededup.dedup_lines(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of all documents, judged by a forest trained on findings
    that the documents' own assignments label."""
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingles, one hash in 2."""
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 8 per language, then over the languages; a third of the
    documents is presented with its text lower-cased."""
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    shown = F.when(third, merkle.ascii_lower(F.col("text"))).otherwise(F.col("text"))
    rows = merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang",
                           presented={"text": shown})
    return merkle.verify(rows).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from rows whose crc32(doc_id) mod 5 is not 1, scores all."""
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return (ctw.score_texts(table(spark, sf_dir, "documents"), held)
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single words in 10,000 buckets; 10 % of the documents of 20 words or more."""
    return (resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10,
                                least_words=20, grams=1, buckets=10_000, seed="2024")
            .select("doc_id", "n_features", "weight", "score", "rank"))


#: Base 32 of a SHA-1: eight groups of five hex digits, four letters each.
_BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  cast((cast('0x' || substr({hex}, cast(5 * (i // 4) + 1 as int), 5) as bigint) >> cast(5 * (3 - i % 4) as int)) & 31 as int) + 1, 1) for i in range(0, 32)], '')"""

WARC_SQL = f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
q as (select *, max(page_id) over (partition by html) as last from p)
select page_id, cast(strlen(html) as bigint) as payload_bytes, {_BASE32.format(hex="hex")} as payload_digest,
       case when page_id < last then 'revisit' else 'response' end as record_type,
       case when page_id < last then last end as refers_to
from q"""


#: CRC-32 of a word's bytes, a bit at a time: {word} is a string.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
  list_transform(range(1, strlen({word}) + 1), lambda i: cast('0x' || substr(hex({word}), cast(2 * i - 1 as int), 2) as bigint))),
  lambda acc, x: list_reduce(list_prepend(xor(acc, x), range(8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)))"""

_UPPER, _LOWER = merkle.UPPER, merkle.LOWER


def merkle_sql(levels: int = 8, fanout: int = 8) -> str:
    """The manifest by windows, one level after the other: groups of up to
    fanout ** levels leaves."""
    def digest(text: str) -> str:
        fields = [f"coalesce(strlen(cast({f} as varchar)) || ':' || cast({f} as varchar), '-')"
                  for f in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(fields)})"

    def climb(name: str, leaves: str, key: str) -> list[str]:
        # Nodes of level k: (key, pos, h); a run's nodes before and after each one.
        out, last = [f"{name}0 as ({leaves})"], f"{name}0"
        for k in range(1, levels + 1):
            run = f"partition by {key}, pos // {fanout}"
            out.append(f"""{name}s{k} as (select *, case when n > 1 then coalesce(string_agg(h, '') over ({run} order by pos rows between unbounded preceding and 1 preceding), '') end as l,
  case when n > 1 then coalesce(string_agg(h, '') over ({run} order by pos rows between 1 following and unbounded following), '') end as r
  from (select *, count(*) over (partition by {key}) as n from {last}))""")
            out.append(f"""{name}{k} as (select {key}, pos // {fanout} as pos, case when max(n) > 1 then sha256(string_agg(h, '' order by pos)) else max(h) end as h
  from {name}s{k} group by {key}, pos // {fanout})""")
            last = f"{name}{k}"
        return out

    def walk(name: str, key: str, start: str) -> tuple[str, list[tuple[str, str]]]:
        joins = [f"join {name}s{k} on {name}s{k}.{key} is not distinct from {start}.{key} and {name}s{k}.pos = {start}.pos // {fanout ** (k - 1)}"
                 for k in range(1, levels + 1)]
        return "\n".join(joins), [(f"{name}s{k}.l", f"{name}s{k}.r") for k in range(1, levels + 1)]

    low = f"translate(text, '{_UPPER}', '{_LOWER}')"
    third = _CRC32.format(word="cast(doc_id as varchar)") + " % 3 = 0"
    g_joins, g_steps = walk("g", "lang", "d")
    t_joins, t_steps = walk("t", "one", "t0")
    steps = g_steps + t_steps
    folds = [f"f{k + 1} as (select * replace (case when l{k} is null then shown else sha256(l{k} || shown || r{k}) end as shown) from {f'f{k}' if k else 'walked'})"
             for k in range(len(steps))]
    last = f"f{len(steps)}"
    cols = ", ".join(f"{a} as l{k}, {b} as r{k}" for k, (a, b) in enumerate(steps))
    sibs = " || ".join(f"coalesce({a} || {b}, '')" for a, b in steps)
    ctes = [f"""docs as (select doc_id, lang, row_number() over (partition by lang order by doc_id) - 1 as pos, {digest('text')} as h,
  case when {third} then {digest(low)} else {digest('text')} end as shown from documents)""",
            *climb("g", "select lang, pos, h from docs", "lang"),
            *climb("t", f"select 1 as one, row_number() over (order by lang nulls first) - 1 as pos, h, lang from g{levels}", "one"),
            f"""walked as (select d.doc_id, d.h as leaf, t0.h as subroot, (select h from t{levels}) as root, sha256({sibs}) as proof_sha256, d.shown, {cols}
from docs d {g_joins}
join t0 on t0.lang is not distinct from d.lang {t_joins})""", *folds]
    return ("with " + ",\n".join(ctes) + f"\nselect doc_id, leaf, subroot, root, proof_sha256, shown as folded_root, "
            f"shown = root as verified from {last}")


RESAMPLING_SQL = f"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark),
u as (select doc_id, unnest(w) as word from d),
words as materialized (select word, {_CRC32.format(word="word")} % 10000 as bucket
  from (select word from u union select word from b)),
s as (select bucket, count(*) as s from u join words using (word) group by bucket),
t as (select bucket, count(*) as t from b join words using (word) group by bucket),
gains as (select r.range as bucket, cast(floor(1000 * ln(((coalesce(t, 0) + 1)::double * ((select sum(s) from s) + 10000)::double)
    / ((coalesce(s, 0) + 1)::double * ((select coalesce(sum(t), 0) from t) + 10000)::double))) as bigint) as gain
  from range(10000) r left join s on s.bucket = r.range left join t on t.bucket = r.range),
weights as (select doc_id, cast(sum(gain) as bigint) as weight from u join words using (word) join gains using (bucket) group by doc_id),
scored as (select doc_id, cast(len(w) as bigint) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) + 0.5::double)
      / 4294967296::double))) as bigint) as score
  from d left join weights using (doc_id)),
ranked as (select *, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20)
select doc_id, n_features, weight, score, cast(case when place <= 10 * n // 100 then place end as bigint) as rank from ranked
union all select doc_id, n_features, weight, score, null from scored where n_features < 20"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_language_id, op2_mix_sources, op3_license_scan, op4_sentencepiece, op5_simhash, op6_quality_rules, op7_warc,
        op8_line_dedup, op9_secret_scan, op10_fingerprints, op11_merkle_manifest,
        op12_lm_scoring, op13_importance_resampling)}

ORACLE_SQL: dict[str, str] = {
    "op2_mix_sources": mixing.MIX_SQL.format(docs="documents"),
    "op7_warc": WARC_SQL,
    "op11_merkle_manifest": merkle_sql(),
    "op13_importance_resampling": RESAMPLING_SQL,
}
