"""Document fingerprints against brute force."""

import base64
import hashlib
import struct

import numpy as np
import xxhash

from shoplens.llm import fingerprints as L
from shoplens.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.001"


def plain_sketch(text, size=5, scale=L.SCALE):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    grams = {" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    h = {xxhash.xxh64_intdigest(g.encode(), 42) >> 32 for g in grams}
    return {x for x in h if x < (1 << 32) // scale} | ({min(h)} if h else set())


def plain_likeness(a, b):
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return len(small & large) / len(small) if small else float(not large)


def expected(rows):
    """rows: (doc_id, text, text's hash)."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    out = []
    for k, (i, text, _) in enumerate(order):
        text, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        a, b, c = plain_sketch(text), plain_sketch(edited), plain_sketch(nxt)
        show = lambda s: base64.b64encode(b"".join(struct.pack(">I", x) for x in sorted(s))).decode()
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), show(a), show(b), plain_likeness(a, b),
                    plain_likeness(a, c)))
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark):
    d = cases.table(SF, "documents")
    assert cases.rows(Q.op10_fingerprints(spark, SF)) == expected([(int(i), t, 0) for i, t in zip(d["doc_id"], d["text"])])


def test_edges_and_ranges(spark):
    from pyspark.sql import functions as F

    docs = cases.documents(spark)
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    want = expected([(r[0], r[1], hashes[r[1]]) for r in cases.ROWS])
    for n in (1, 2, 7, 40):
        assert cases.rows(L.compare_with_next(docs, ranges=n)) == want
    assert L.compare_with_next(cases.documents(spark, [])).count() == 0
    alone = cases.rows(L.compare_with_next(cases.documents(spark, [(1, "a b c d", None, None, 0)])))
    assert alone[0][-1] == 1.0 and alone == expected([(1, "a b c d", 0)])


def test_large_ids_and_many_ties(spark):
    rows = [(2 ** 62 + i // 2, f"text number {i} of some", None, None, 0) for i in range(60)]
    from pyspark.sql import functions as F

    docs = cases.documents(spark, rows)
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    assert cases.rows(L.compare_with_next(docs, ranges=9)) == expected([(r[0], r[1], hashes[r[1]]) for r in rows])


def test_hot_ids_and_missing_ids_fall_into_many_ranges(spark):
    from pyspark.sql import functions as F

    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text number {i} of some", None, None, 0) for i in range(600)]
    docs = cases.documents(spark, rows)
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    assert cases.rows(L.compare_with_next(docs, ranges=12)) == expected([(r[0], r[1], hashes[r[1]]) for r in rows])
    named = docs.select(F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("number"),
                        F.xxhash64("text").alias("body"), F.octet_length("text").cast("long").alias("bytes"))
    sizes = [r["count"] for r in L._with_range(named, 12)[0].groupBy("range").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 100


def test_a_range_is_the_bounds_at_or_before_a_document():
    bounds = L.Bounds(np.array([3, 5, 5, 5, 9]), np.array([0, -4, 0, 4, 2]), np.array([1, 8]))
    keys = sorted([(False, 3, 0), (False, 5, -4), (False, 5, 0), (False, 5, 4), (False, 9, 2), (True, 0, 1), (True, 0, 8)])
    docs = [(void, number, body) for void in (False, True) for number in ((0,) if void else range(1, 12)) for body in range(-6, 10)]
    got = bounds.place(*(np.array(x) for x in zip(*docs)))
    assert got.tolist() == [sum(k <= d for k in keys) for d in docs]
    none = L.Bounds(*(np.empty(0, np.int64) for _ in range(3)))
    assert none.place(np.array([False, True]), np.array([1, 0]), np.array([2, 3])).tolist() == [0, 0]


def test_sketch_is_under_half_of_its_text():
    d = cases.table("/root/testdata/sf0.01", "documents")["text"].tolist()
    written = [L.to_text(L.sketch(t)) for t in d]
    assert sum(map(len, written)) < 0.5 * sum(len((t or "").encode()) for t in d)
    assert all(np.array_equal(L.from_text(w), L.sketch(t)) for w, t in zip(written[:200], d))


def test_sketches_merge_and_estimate_containment():
    words = [f"w{i}" for i in range(40_000)]
    whole, part = L.sketch(" ".join(words)), L.sketch(" ".join(words[5000:15_000]))
    assert L.containment(part, whole) > 0.999 and abs(L.containment(whole, part) - 0.25) < 0.04
    a, b = L.sketch(" ".join(words[:20_000])), L.sketch(" ".join(words[19_996:]))
    assert np.array_equal(L.merge(a, b), whole)  # the second begins where no shingle is left out
    tiny, other = L.sketch("one two"), L.sketch("three")
    assert len(tiny) == 1 and len(L.merge(tiny, other)) >= 1
    assert L.likeness(L.sketch(""), L.sketch(None)) == 1.0 and L.likeness(L.sketch(""), tiny) == 0.0


def test_likeness_of_short_texts_is_near_the_exact_containment():
    d = cases.table("/root/testdata/sf0.01", "documents").sort_values("doc_id")["text"].tolist()
    whole = lambda t: {" ".join(t.split()[i:i + 5]) for i in range(max(1, len(t.split()) - 4))}
    errors = []
    for text, following in zip(d, d[1:]):
        if 50 <= len(text.split()) <= 100:
            edited = L.edited_text(text, following)
            errors.append(abs(L.likeness(L.sketch(text), L.sketch(edited)) - plain_likeness(whole(text), whole(edited))))
    assert len(errors) > 50 and np.quantile(errors, 0.95) < 0.2 and max(errors) < 0.4
