"""License scans: MinHash bands over text windows, verified by containment.

Texts are taken as words of letters and digits in lower case; a template is
the set of its five-word shingles. Windows a little longer than a template
overlap so that any occurrence lies whole within one of them. Each window has
MinHash values; bands of two rows retrieve the templates that agree in any
band, with as many bands as find a window with the least sufficient share of
the template with probability 0.99999. Retrieved templates are verified: the
exact share of their shingles that the window holds must reach 0.8.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, col

# Notices by which works state their licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
        "to this work"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"),
    "MIT": "Released under the MIT License.",
    "MIT-header": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_WORDS = re.compile(r"[^\W_]+")
#: Shingles of a text that are worked on at once.
PORTION = 200_000


def shingles(text: str | None, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order (none if there are fewer)."""
    words = _WORDS.findall(text.lower()) if text else []
    joined = " ".join(words).encode("utf-8", "surrogatepass")
    if len(words) < size:
        return np.empty(0, np.uint64)
    ends = np.cumsum([len(w.encode("utf-8", "surrogatepass")) + 1 for w in words] if not text.isascii()
                     else np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b]) for a, b in zip(starts, ends[size - 1:].tolist())], np.uint64)


class Templates:
    """Templates by the number of their shingles, with the window, the step
    and the bands that suit that number."""

    ROWS, FOUND = 2, 0.99999

    def __init__(self, texts: Mapping[str, str], share: float, size: int, seed: int = 42) -> None:
        self.share, self.size = share, size
        self.sets = {name: np.unique(shingles(t, size)) for name, t in sorted(texts.items())}
        if any(not len(s) for s in self.sets.values()):
            raise ValueError(f"a template has fewer than {size} words")
        rng = np.random.default_rng(seed)
        self.classes: list[tuple] = []  # shingles, step, window, bands, names
        for n in sorted({len(s) for s in self.sets.values()}):
            step = max(1, n // 4)
            window = n + step - 1
            need = math.ceil(share * n)
            likeness = need / (window + n - need)  # the least Jaccard likeness of a sufficient window
            miss = 1 - likeness ** self.ROWS
            bands = 1 if miss <= 0 else math.ceil(math.log(1 - self.FOUND) / math.log(miss))
            self.classes.append((n, step, window, bands, [k for k, s in self.sets.items() if len(s) == n]))
        many = self.ROWS * max(c[3] for c in self.classes)
        self.multiply = rng.integers(1, 1 << 63, many, np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 63, many, np.uint64)
        self.keys = {n: np.stack([self._bands(self._permuted(self.sets[k]).min(axis=1, keepdims=True), bands)[:, 0]
                                  for k in names], axis=1) for n, _, _, bands, names in self.classes}

    def _permuted(self, hashes: np.ndarray) -> np.ndarray:
        return ((self.multiply[:, None] * hashes[None, :] + self.add[:, None]) >> np.uint64(32)).astype(np.uint32)

    def _bands(self, least: np.ndarray, bands: int) -> np.ndarray:
        least = least[:self.ROWS * bands].astype(np.uint64)
        return (least[0::2] << np.uint64(32)) | least[1::2]

    def find(self, text: str | None) -> list[tuple[str, float, int]]:
        """(name, best containment, first shingle of the first sufficient
        window) of each template that the text holds."""
        h = shingles(text, self.size)
        best: dict[str, list] = {}
        longest = max(c[2] for c in self.classes)
        for at in range(0, max(0, len(h)), PORTION):
            part = h[at:at + PORTION + longest]  # windows that begin in the portion are whole
            self._find_in(part, at, best)
        return [(k, v[0], v[1]) for k, v in sorted(best.items())]

    def _find_in(self, h: np.ndarray, at: int, best: dict[str, list]) -> None:
        level, width = self._permuted(h), 1  # least of each run of ``width`` shingles
        for n, step, window, bands, names in self.classes:
            window = min(window, len(h))
            rows = self.ROWS * bands
            while 2 * width <= window:
                level = np.minimum(level[:, :-width], level[:, width:])
                width *= 2
            if width > window:
                continue
            low = level[:rows, :len(h) - window + 1]
            high = level[:rows, window - width:window - width + low.shape[1]]
            starts = np.arange(0, low.shape[1], step)
            if starts[-1] != low.shape[1] - 1:
                starts = np.append(starts, low.shape[1] - 1)  # the last window ends with the text
            found = self._bands(np.minimum(low[:, starts], high[:, starts]), bands)
            for t, name in enumerate(names):
                for w in starts[(found == self.keys[n][:, t:t + 1]).any(axis=0)].tolist():
                    held = float(np.isin(self.sets[name], h[w:w + window]).mean())
                    if held >= self.share and held > best.get(name, [0.0])[0]:
                        best[name] = [held, best.get(name, [0, at + w])[1]]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] | None = None, share: float = 0.8, size: int = 5,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` and template it holds: doc_id, license
    (the template's name), containment (share of the template's shingles in
    the best window, at least ``share``) and first_word (number, from 0, of
    the first word of the first window that suffices).

    Null and empty texts, and those of fewer than ``size`` words, hold none.
    Equal rows get equal rows; extra columns are ignored; an empty table gives
    no rows."""
    bound_batches(docs.sparkSession)
    known = Templates(TEMPLATES if templates is None else templates, share, size)

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"license": k, "containment": c, "first_word": w} for k, c, w in known.find(t)]
                             for t in texts], dtype=object)

    found = F.pandas_udf(of, "array<struct<license:string,containment:double,first_word:long>>")
    return (docs.select(col(id_col).alias("doc_id"), F.explode(found(col(text_col))).alias("f"))
            .select("doc_id", "f.*"))
