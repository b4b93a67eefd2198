"""Language ID: held-out accuracy, the kernel by hand, edges."""

import numpy as np
import pytest

from shoplens.llm import langid as L
from shoplens.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.01"


def plain_grams(text, order):
    s = " " + "".join(c if c.isalpha() else " " for c in (text or "").lower()) + " "
    while "  " in s:
        s = s.replace("  ", " ")
    if not s.strip():
        return set()
    return {s[i:i + n] for n in range(1, order + 1) for i in range(len(s) - n + 1)} - {" "}


def packed(gram):
    out = 0
    for c in gram:
        out = out << 21 | (1 if c == " " else ord(c) + 2)
    return out


def test_grams_equal_the_plain_ones(monkeypatch):
    letters = L.letter_table()
    texts = [r[1] for r in cases.ROWS] + ["a", "..", "é 1a", "İstanbul"]
    for piece in (L.PIECE, 7):
        monkeypatch.setattr(L, "PIECE", piece)
        for t in texts:
            assert set(L.grams(t, 3, letters).tolist()) == {packed(g) for g in plain_grams(t, 3)}, t


def test_scores_equal_the_kernel_by_hand():
    letters = L.letter_table()
    texts = ["the cat and the dog", "le chat et le chien", "der hund und die katze", "the dog was here", "le chien est ici"]
    labels = ["en", "fr", "de", "en", "fr"]
    m = L.fit([L.grams(t, 3, letters) for t in texts], labels, 3, landmarks=15)
    sets = [plain_grams(t, 3) for t in texts]
    order = [i for i in range(5)]  # every text is a landmark
    for t in texts + ["and the", "katze"]:
        g = plain_grams(t, 3)
        k = np.array([len(g & sets[i]) / np.sqrt(len(g) * len(sets[i])) for i in order])
        out = k @ m.weights
        names, scores = m.predict([t], letters, m.presence.astype(np.float32))
        assert names == [m.languages[out.argmax()]] and np.isclose(scores[0], np.clip((out.max() + 1) / 2, 0, 1), atol=1e-5)
    assert [m.predict([t], letters, m.presence.astype(np.float32))[0][0] for t in texts] == labels


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in Q.op1_language_id(spark, SF).collect()}
    d = cases.table(SF, "documents")
    import zlib

    held = [i for i in d["doc_id"] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sorted(i for i, r in got.items() if r["held_out"]) == held and len(got) == len(d)
    truth = dict(zip(d["doc_id"], d["lang"]))
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_predictions_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, other = (L.identify(docs, L.train(docs.repartition(n))).select("doc_id", "lang_pred", "score") for n in (1, 5))
    a, b = ({r[0]: r for r in x.collect()} for x in (one, other))
    assert all(a[i][1] == b[i][1] and abs(a[i][2] - b[i][2]) < 1e-4 for i in a)


def test_edges(spark):
    docs = cases.documents(spark)
    m = L.train(docs)
    got = L.identify(docs, m)
    assert sorted(got.columns) == sorted(docs.columns)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    assert by[3] == by[4] == by[5] == by[6] == ("und", 0.0) and by[7][0] == "fr" and by[8][0] == "en"
    none = L.train(cases.documents(spark, [(1, "text", None, None, 0)]))
    assert none.languages == []
    assert [r["lang_pred"] for r in L.identify(docs.limit(3), none).collect()] == ["und"] * 3
    assert L.identify(cases.documents(spark, []), m).count() == 0


def test_more_labels_than_landmarks_are_refused(spark):
    rows = [(i, f"some words of {chr(97 + i)}", f"label {i}", "a", 0) for i in range(7)]
    docs = cases.documents(spark, rows)
    assert len(L.train(docs, landmarks=7).sizes) == 7
    with pytest.raises(ValueError, match="landmarks"):
        L.train(docs, landmarks=6)
    with pytest.raises(ValueError, match="landmarks"):
        L.fit([np.array([1])] * 3, ["a", "b", "c"], 1, landmarks=2)
