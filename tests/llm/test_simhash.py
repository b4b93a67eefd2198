"""SimHash near-dedup against brute force."""

import random

import numpy as np
import pytest
import xxhash

from shoplens.llm import queries as Q
from shoplens.llm import simhash as S
from shoplens.llm.common import Run, connected_components

from . import cases

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, size=3):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits):
    """Smallest id within reach, by comparing all."""
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_equals_the_plain_one():
    for t in [r[1] for r in cases.ROWS] + list(cases.table(SF, "documents")["text"][:40]):
        assert S.fingerprint(t) % (1 << 64) == plain_fingerprint(t), t


@pytest.mark.parametrize("bits", [0, 1, 3, 4])
def test_links_equal_brute_force(spark, bits):
    rng = random.Random(bits)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(250):  # chains of near neighbours, and a dense cloud
        f = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 4)):
            f ^= 1 << b
        fps.append(f)
    fps = sorted(set(fps))
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    run = Run(spark, "test")
    for block in (S.BLOCK, 7):  # long lists in blocks find the same
        links = S.near_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, run, block)
        got = {r["node"]: r["root"] for r in connected_components(links, run).collect()}
        expect = plain_components(fps, bits)
        groups = {}
        for f, e in zip(signed, expect):
            groups.setdefault(e, []).append(f)
        assert {f: min(g) for g in groups.values() if len(g) > 1 for f in g} == got


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 300), (300, 100)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges, Run(spark, "test")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}


def test_query_equals_brute_force(spark):
    d = cases.table(SF, "documents")
    fps = [plain_fingerprint(t) for t in d["text"]]
    where = plain_components(fps, 3)
    lowest = {}
    for i, w in zip(d["doc_id"], where):
        lowest[w] = min(lowest.get(w, i), i)
    expect = sorted((int(i), f"{f:016x}", int(lowest[w])) for i, f, w in zip(d["doc_id"], fps, where))
    assert [tuple(r) for r in Q.op5_simhash(spark, SF).orderBy("doc_id").collect()] == expect


def test_edges(spark):
    got = cases.rows(S.simhash_groups(cases.documents(spark)).select("doc_id", "fingerprint", "component_id"))
    assert len(got) == len(cases.ROWS)
    by_id = {r[0]: r for r in got if r[0] is not None}
    assert by_id[2][2] == 1 and by_id[3] == (3, "0" * 16, 3) and by_id[5][2] == 3
    assert {r[2] for r in got if r[0] is None} == {None, 3}  # a nameless group has no id
    kept = S.keep_first(cases.documents(spark), ["doc_id", "text", "lang", "source", "n_chars"]).collect()
    # Id 9 stands over two texts, each of a group of its own; of the repeated row one stays.
    assert sorted(r["doc_id"] or 0 for r in kept).count(9) == 2 and 2 not in {r["doc_id"] for r in kept}
    assert sum(r["doc_id"] is None for r in kept) == 1
    assert S.simhash_groups(cases.documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        S.near_fingerprints(spark.createDataFrame([], "fp long"), 8, Run(spark, "test"))


def test_every_group_keeps_one_row_where_ids_repeat(spark):
    a, b = "one text that stands alone in its group of words", "another text that two documents with other ids share here"
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for first, second in ((a, b), (b, a)):
        rows = [(5, first, "en", "a", 1), (5, second, "en", "a", 1), (7, second, "en", "a", 1), (None, first, "en", "a", 1)]
        kept = S.keep_first(cases.documents(spark, rows), columns).collect()
        assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted([(5, a), (5, b)])
