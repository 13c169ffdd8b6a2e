"""License scans by patience alignment against templates.

Text and template are compared as words (lower case, without outer punctuation).
For a coverage of ``min_coverage`` at least one of a few template positions must be
matched (pigeonhole), those with the longest words; only places of such words are
looked at, so no match is lost and most texts end at one pattern search. Around
each place a window of three template lengths is aligned: equal ends first, then
anchors on words that occur once in both, the longest increasing run of anchors,
and the gaps between them in the same way. The matched words inside the densest
stretch of 1.5 template lengths give the coverage.

One row per place found: doc_id, license, start and end (code points), matched,
template_words, coverage. Whole texts are scanned; places are disjoint per template.
Null and empty texts give no rows, repeated rows give their rows again, null keys
stay null, other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wayloom.llm.common import documents

# fixed values: license notices in their usual wording
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "mit": "Released under the MIT License.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                      "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                      "the License, or (at your option) any later version.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
}
_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")


def tokens(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions of ``a`` and ``b``, rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: i for i, w in enumerate(a[a0:a1], a0) if once_a[w] == 1}
        pairs = [(where[w], j) for j, w in enumerate(b[b0:b1], b0) if once_b[w] == 1 and w in where]
        x, y = a0, b0
        for i, j in rising(pairs):
            out.append((i, j))
            todo.append((x, i, y, j))
            x, y = i + 1, j + 1
        if (x, y) != (a0, b0):
            todo.append((x, a1, y, b1))
    return sorted(out)


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run rising in the first part, of pairs that rise in the second."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for n, (i, _) in enumerate(pairs):
        k = bisect_left(tops, i)
        before.append(at[k - 1] if k else -1)
        if k == len(tops):
            tops.append(i)
            at.append(n)
        else:
            tops[k], at[k] = i, n
    out = []
    n = at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


class Scanner:
    """Templates with their signature words and one search pattern for all of them."""

    def __init__(self, templates: dict[str, str], min_coverage: float):
        self.min = min_coverage
        self.templates = {k: [w for w, _, _ in tokens(t)] for k, t in templates.items()}
        self.signs = {}
        for k, t in self.templates.items():
            spare = int(len(t) * (1 - min_coverage) + 1e-9) + 1
            self.signs[k] = {t[i] for i in sorted(range(len(t)), key=lambda i: (-len(t[i]), i))[:spare]}
        parts = sorted(set().union(*self.signs.values())) if self.signs else []
        self.pattern = re.compile("|".join(map(re.escape, parts)) or r"(?!)", re.IGNORECASE)

    def scan(self, text: str) -> list[tuple[str, int, int, int, int, float]]:
        if not self.pattern.search(text):
            return []
        toks = tokens(text)
        text_words = [w for w, _, _ in toks]
        out = []
        for name, template in self.templates.items():
            n, signs, done = len(template), self.signs[name], -1
            for hit, word in enumerate(text_words):
                if hit <= done or word not in signs:
                    continue
                a = max(done + 1, hit - n - n // 2)
                pairs = align(text_words[a: hit + n + n // 2 + 1], template)
                best = densest([a + i for i, _ in pairs], n + n // 2)
                if best and len(best) >= self.min * n and best[0] <= hit <= best[-1]:
                    out.append((name, toks[best[0]][1], toks[best[-1]][2], len(best), n, len(best) / n))
                    done = best[-1]
        return sorted(out, key=lambda r: (r[1], r[0]))


def densest(at: list[int], width: int) -> list[int]:
    """Most positions that fit into ``width`` words; the first such stretch."""
    best: list[int] = []
    lo = 0
    for hi in range(len(at)):
        while at[hi] - at[lo] >= width:
            lo += 1
        if hi - lo + 1 > len(best):
            best = at[lo: hi + 1]
    return best


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, min_coverage: float = 0.75,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    known = dict(TEMPLATES if templates is None else templates)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, license string, start long, `end` long, matched long, template_words long, coverage double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known, min_coverage)
        for b in batches:
            at, rows = [], []
            for i in range(b.num_rows):
                t = b.column(1)[i].as_py()
                found = scanner.scan(t) if t else []
                at += [i] * len(found)
                rows += found
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64()))] +
                                             [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "license", "start", "end", "matched", "template_words", "coverage"])

    return docs.select(key, text).mapInArrow(run, schema)


def op9_patience_licenses(spark, sf_dir):
    return scan_licenses(documents(spark, sf_dir))
