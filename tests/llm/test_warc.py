"""WARC: exact round trip, framing and digests."""

import base64
import gzip
import hashlib
import io

import pytest

from shoplens.llm import queries as Q
from shoplens.llm import warc as W
from shoplens.llm.common import Run

from . import cases

SF = "/root/testdata/sf0.001"
PAGES = [(1, "http://a/1", "same page"), (2, "http://a/2\r\nWARC-Type: evil\n", "same page"), (3, None, "other"),
         (4, "u", None), (5, "u", ""), (None, "n", "same page"), (None, "n", "alone"), (7, "é ü", "é\r\n\r\n" * 3),
         (7, "é ü", "é\r\n\r\n" * 3), (8, "big", "x<y>" * 300_000), (-1, "neg", "other")]


def pages(spark, rows=PAGES):
    from pyspark.sql import functions as F

    return (spark.createDataFrame(rows, "page_id long, url string, html string")
            .withColumn("same", F.lit("clash")).withColumn("refers_to", F.lit("clash")).withColumn("payload", F.lit(1)))


def expected(rows, least=0):
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        to = last.get(html or "")
        revisit = len(raw) >= least and to is not None and (i is None or i < to)
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 6])
def test_round_trip(spark, least):
    got = W.round_trip(pages(spark), least, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    assert cases.rows(got) == expected(PAGES, least)
    assert W.round_trip(pages(spark, PAGES[:0])).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in cases.table(SF, "pages")[["page_id", "url", "html"]].itertuples(index=False)]
    assert cases.rows(Q.op7_warc(spark, SF)) == expected(rows)


def test_payloads_come_back(spark, monkeypatch):
    monkeypatch.setattr(W, "ARCHIVE", 300)
    run = Run(spark, "warc-test")
    manifest, folder = W.write_archives(pages(spark).repartition(3), run)
    got = W.read_archives(manifest, folder).collect()
    assert manifest.count() > 3
    texts = {r["page_id"]: bytes(r["payload"]).decode() for r in got if r["payload"] is not None}
    assert texts[8] == PAGES[9][2] and texts[5] == "" and texts[2] == "same page" and 1 not in texts
    urls = {r["page_id"]: r["url"] for r in got}
    assert urls[2] == "http://a/2%0D%0AWARC-Type: evil%0A" and urls[3] is None and urls[7] == "é ü"


class Slow(io.BytesIO):
    def read(self, n=-1):
        return super().read(min(n, 3))


def test_reader_frames_and_checks():
    records = [W.make_record(1, "u", b"abc" * 1000, None), W.make_record(2, "u", b"abc" * 1000, 1),
               W.make_record(None, None, b"", None)]
    archive = b"".join(records)
    assert gzip.decompress(records[0]).startswith(b"WARC/1.1\r\n")
    read = list(W.read_records(Slow(archive)))
    assert [(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in read] == [
        (1, "response", None, 3000), (2, "revisit", 1, 3000), (None, "response", None, 0)]
    with pytest.raises(ValueError, match="ends within"):
        list(W.read_records(io.BytesIO(archive[:len(records[0]) - 9])))
    plain = gzip.decompress(records[0])
    for bad, why in ((plain.replace(b"abcabc", b"abcabd", 1), "digest"), (plain[:-4], "longer|shorter"),
                     (plain + b"x", "longer"), (b"HTTP/1.1\r\n", "version")):
        with pytest.raises(ValueError, match=why):
            list(W.read_records(io.BytesIO(gzip.compress(bad))))
    head, _, rest = plain.partition(b"\r\n\r\n")
    for n in (10, 99999):
        wrong = head[:head.rindex(b" ") + 1] + str(n).encode() + b"\r\n\r\n" + rest
        with pytest.raises(ValueError):
            list(W.read_records(io.BytesIO(gzip.compress(wrong))))


def test_every_archive_is_read_by_a_task_of_its_own(spark):
    from pyspark.sql import functions as F
    from shoplens.llm.common import Run

    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("http://a/").alias("url"),
                                    F.concat(F.sha2(F.col("id").cast("string"), 512), F.repeat(F.lit("x"), 50)).alias("html"))
    manifest, folder = W.write_archives(pages.repartition(6, "page_id"), Run(spark, "warc-test"), 0, "page_id", "url", "html")
    n = manifest.count()
    tasks = W.read_archives(manifest, folder).withColumn("task", F.spark_partition_id())
    assert n > 2 and tasks.select("task").distinct().count() == n and tasks.count() == 400
