"""SentencePiece against the library, text by text."""

import hashlib
import random
import struct

import pytest

from shoplens.llm import queries as Q
from shoplens.llm import sentencepiece as S

from . import cases

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer_model())


def expected(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    packed = b"".join(struct.pack("<I", i) for i in ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_query_equals_the_library(spark, library):
    d = cases.table(SF, "documents")
    got = {r[0]: tuple(r)[1:] for r in Q.op4_sentencepiece(spark, SF).collect()}
    assert got == {i: expected(library, t) for i, t in zip(d["doc_id"], d["text"])}


def test_random_strings(library, monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab  \n\t▁é日😀<>s/x0 the ") for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += ["", " ", "  ", "▁", "a ", "<s>", "\x00", "ab " * 5000, "x" * 5000, " " * 3000, None]
    for portion, memory in ((S.PORTION, S.MEMORY), (40, 30)):  # also in small portions, with little memory
        monkeypatch.setattr(S, "PORTION", portion)
        monkeypatch.setattr(S, "MEMORY", memory)
        v = S.Vocabulary(Q.tokenizer_model())
        for t, ids in zip(texts, v.encode(texts)):
            want = library.encode(t or "", add_bos=True, add_eos=True)
            assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, t


def test_list_and_heap_agendas_agree(monkeypatch, library):
    monkeypatch.setattr(S, "SHORT", 0)
    v = S.Vocabulary(Q.tokenizer_model())
    words = cases.table(SF, "documents")["text"].str.split().explode().dropna().unique()[:4000]
    assert [v.merge("▁" + w) for w in words] == library.encode(list(words))


def test_a_wrong_merge_fails(monkeypatch):
    v = S.Vocabulary(Q.tokenizer_model())
    v.cost = {}
    with pytest.raises(ValueError, match="library"):
        list(v.encode(["the time"]))


def test_edges(spark, library):
    docs = cases.documents(spark)
    out = S.encode(docs, Q.tokenizer_model(), out="ids")
    assert len(out.columns) == len(docs.columns)  # the clashing column is replaced
    back = S.decode(out, Q.tokenizer_model()).select("text", "ids", "decoded").collect()
    assert len(back) == len(cases.ROWS)
    for r in back:
        assert list(r["ids"]) == library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert r["decoded"] == library.decode(list(r["ids"]))
    assert S.round_trip(cases.documents(spark, []), Q.tokenizer_model()).count() == 0
