"""Line dedup against brute force."""

import random

import numpy as np
import pytest

from shoplens.llm import linededup as L
from shoplens.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def plain(docs, least=L.MIN_CHARS):
    """{(position of row): dropped lines}; docs: (doc_id, text, text's hash)."""
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0] or 0, docs[k][2]))
    first, long = {}, {}
    for k in order:
        for i, line in enumerate((docs[k][1] or "").split("\n") if docs[k][1] is not None else []):
            if line.strip(SPACE) and line not in first:
                first[line] = ((docs[k][0] is None, docs[k][0] or 0, docs[k][2]), i)
                if len(line) >= least:
                    long.setdefault(len(line), []).append(line)
    near = {a for n, lines in long.items() for a in lines for m in (n - 1, n, n + 1) for b in long.get(m, [])
            if first[b] < first[a] and within_one(a, b)}
    out = []
    for d in docs:
        key = (d[0] is None, d[0] or 0, d[2])
        out.append([i for i, line in enumerate(d[1].split("\n")) if line.strip(SPACE)
                    and (line in near or first[line] < (key, i))] if d[1] is not None else [])
    return out


def check(spark, docs):
    from pyspark.sql import functions as F

    found = cases.documents(spark, docs)
    hashes = {r["text"]: r["h"] for r in found.select("text", F.xxhash64("text").alias("h")).collect()}
    given = [(r[0], r[1], hashes[r[1]]) for r in docs]
    want = sorted(((g[0], None if g[1] is None else g[1].count("\n") + 1, len(p), p)
                   for g, p in zip(given, plain(given))), key=repr)
    got = sorted(((r[0], r[1], r[2], list(r[3])) for r in L.dedup_lines(found).collect()), key=repr)
    assert got == want


def test_edges(spark):
    check(spark, cases.ROWS)
    assert L.dedup_lines(cases.documents(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_edits(spark, seed):
    rng = random.Random(seed)
    alphabet = "abcdé😀 "
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(15, 70))) for _ in range(40)] + ["a" * 30, "ab" * 20]
    base += [base[0][:40].ljust(40, "z") + "".join(rng.choice(alphabet) for _ in range(12)) for _ in range(6)]

    def edit(s):
        for _ in range(rng.choice([0, 1, 1, 1, 2])):
            p, kind = rng.randint(0, len(s)), rng.choice("idr")
            s = s[:p] + (rng.choice(alphabet) if kind != "d" else "") + s[p + (kind != "i"):]
        return s

    docs = [(rng.choice([i, i, i, None, 3]), "\n".join(edit(rng.choice(base)) for _ in range(rng.randint(1, 6))), "en", "a", 0)
            for i in range(120)]
    check(spark, docs)


def test_query_equals_brute_force(spark):
    d = cases.table(SF, "documents")
    want = {int(i): p for i, p in zip(d["doc_id"], plain([(int(i), t, 0) for i, t in zip(d["doc_id"], d["text"])]))}
    got = {r["doc_id"]: list(r["dropped"]) for r in Q.op8_line_dedup(spark, SF).collect()}
    assert got == want and any(want.values())


def test_variants_are_hashes_of_shorter_lines():
    line = "a line with ünïcode 😀 letters"
    powers = L._powers(64)
    whole, p, v = L.variants(line, True, True, powers)
    assert list(p) == list(range(len(line)))
    for i, h in zip(p, v):
        assert int(h) == L.variants(line[:i] + line[i + 1:], True, True, powers)[0]
    assert len(L.variants(line, False, True, powers)[1]) < len(line)
    assert v.dtype == np.uint64 and whole != int(v[0])


def test_texts_lose_their_lines(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    got = L.without_repeated_lines(cases.documents(spark), columns)
    assert got.columns == columns
    by = {r["doc_id"]: r for r in got.filter("doc_id is not null").collect()}
    assert by[10]["text"] == "a line of twenty letters\nshort\n\n\na line of twenty lettres" and by[10]["n_chars"] == 57
    assert not {2, 3, 4, 5, 11, 12} & set(by)  # wordless, or nothing of their own
    assert by[8]["text"] == cases.LONG
