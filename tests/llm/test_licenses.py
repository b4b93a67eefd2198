"""License scans against brute force containment."""

import math
import random
import re

from shoplens.llm import licenses as L
from shoplens.llm import queries as Q

from . import cases

SF = "/root/testdata/sf0.01"


def grams(text, size=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]


def held(text, template, share=0.8):
    """Best containment over all windows that the operator's step allows to be as long as its window."""
    t, g = set(grams(template)), grams(text)
    window = len(t) + max(1, len(t) // 4) - 1
    best = max((len(t & set(g[i:i + window])) for i in range(max(1, len(g) - window + 1))), default=0) / len(t)
    return best if best >= share else None


def test_query_finds_all_notices(spark):
    d = cases.table(SF, "documents")
    want = {(int(i), name) for i, t in zip(d["doc_id"], d["text"]) for name, x in L.TEMPLATES.items() if held(t, x)}
    got = Q.op3_license_scan(spark, SF).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == want and len(want) > 10
    texts = dict(zip(d["doc_id"], d["text"]))
    for r in got:
        near = grams(texts[r["doc_id"]])[r["first_word"]:r["first_word"] + 2 * len(set(grams(L.TEMPLATES[r["license"]])))]
        assert set(near) & set(grams(L.TEMPLATES[r["license"]])) and r["containment"] >= 0.8


def test_edited_notices():
    rng = random.Random(3)
    known = L.Templates(L.TEMPLATES, 0.8, 5)
    filler = [f"word{i}" for i in range(400)]
    for name, text in L.TEMPLATES.items():
        for kind in ("same", "one word", "half"):
            words = re.findall(r"[^\W_]+", text)
            if kind == "one word":
                words[rng.choice([0, len(words) - 1])] = "changed"
            elif kind == "half":
                words = words[:len(words) // 2]
            at = rng.randint(0, 300)
            doc = " ".join(filler[:at] + words + filler[at:])
            got = {k: c for k, c, _ in known.find(doc)}
            want = held(doc, text)
            if want is None:
                assert name not in got, (name, kind)
            else:
                assert name in got, (name, kind)


def test_bands_find_sufficient_windows():
    known = L.Templates(L.TEMPLATES, 0.8, 5)
    for n, step, window, bands, names in known.classes:
        need = math.ceil(0.8 * n)
        assert window >= n and 1 - (1 - (need / (window + n - need)) ** 2) ** bands >= 0.99999 and names


def test_portions(monkeypatch):
    doc = "filler words " * 50 + L.TEMPLATES["MIT-header"] + " more words" * 50 + " " + L.TEMPLATES["MIT"]
    known = L.Templates(L.TEMPLATES, 0.8, 5)
    want = known.find(doc)
    monkeypatch.setattr(L, "PORTION", 17)
    assert [x[:2] for x in known.find(doc)] == [x[:2] for x in want] and {x[0] for x in want} == {"MIT", "MIT-header"}


def test_edges(spark):
    rows = list(cases.ROWS) + [(50, "x " + L.TEMPLATES["CC-BY-NC-4.0"].upper(), None, None, 0)] * 2
    got = cases.rows(L.scan_licenses(cases.documents(spark, rows)))
    assert got == [(50, "CC-BY-NC-4.0", 1.0, 1)] * 2
    assert L.scan_licenses(cases.documents(spark, [])).count() == 0
