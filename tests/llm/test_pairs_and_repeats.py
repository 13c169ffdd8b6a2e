"""Near copies, repeated strings and nearest vectors against brute force."""

import hashlib
import math
import random

import pytest

from tests.llm.data import documents, prose, texts
from wayloom.llm import jaccard, suffix_dedup, topk
from wayloom.llm.components import components


def sets_of(text):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i: i + 5]) for i in range(len(w) - 4)}


def classes(rows):
    s = [(i, sets_of(t)) for i, t in rows]
    root = {i: i for i, _ in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(s)):
        for b in range(a):
            both = len(s[a][1] & s[b][1])
            if both and 100 * both >= 75 * len(s[a][1] | s[b][1]):
                x, y = sorted((find(s[a][0]), find(s[b][0])))
                root[y] = x
    return {i: (len(x), find(i)) for i, x in s}


@pytest.mark.parametrize("short,extra", [(48, 256), (2, 256), (2, 0)])
def test_jaccard_join(spark, short, extra):
    rows = list(enumerate(texts()))
    g = random.Random(5)
    base = prose(9, 80).split()
    for k in range(60):  # near copies that chain, and texts that share one passage only
        w = list(base)
        for _ in range(g.randrange(6)):
            w[g.randrange(len(w))] = f"edit{g.randrange(40)}"
        rows.append((100 + k, " ".join(w)))
        rows.append((300 + k, prose(500 + k, 60) + " " + " ".join(base[:30])))
    df = documents(spark, [(i, t, None, None, None) for i, t in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard.near_duplicates(df, short=short, hot_extra=extra, hot_factor=1.0, cells=1 << 14).collect()}
    assert got == classes(rows)


def test_jaccard_empty_and_repeated(spark):
    assert jaccard.near_duplicates(documents(spark, [])).count() == 0
    rows = [(7, prose(1, 30), None, None, None)] * 3 + [(None, prose(1, 30), None, None, None), (3, None, None, None, None), (None, None, None, None, None)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(documents(spark, rows)).collect())
    assert got == [(False, 3, 0, 3), (False, 7, 26, 7), (False, 7, 26, 7), (False, 7, 26, 7), (True, 0, 0, None), (True, 0, 26, 7)]


def test_list_pairs_skip_loses_nothing():
    import numpy as np
    g = np.random.default_rng(1)
    n = np.sort(g.integers(1, 400, 300))
    pos = (g.random(300) * n * 0.25).astype(int)
    a, b = jaccard.list_pairs(n, pos, 75)
    rest = n - pos
    want = {(i, j) for i in range(300) for j in range(i + 1, 300)
            if n[j] * 75 <= 100 * n[i] and min(rest[i], rest[j]) * 175 >= 75 * (n[i] + n[j])}
    assert set(zip(a.tolist(), b.tolist())) == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (200, 200)]
    got = {r.id: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 103: 100, 101: 100}


def removed(rows, length=400):
    seen, twice = set(), set()
    for _, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p: p + length]
            (twice if w in seen else seen).add(w)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone, end = bytearray(len(b)), 0
        for p in range(len(b) - length + 1):
            if b[p: p + length] in twice:
                gone[max(p, end): p + length] = b"\1" * (p + length - max(p, end))
                end = p + length
        spans = sum(1 for q in range(len(b)) if gone[q] and (q == 0 or not gone[q - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, c in zip(b, gone) if not c)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [4096, 2])
def test_suffix_removal(spark, hot):
    g = random.Random(3)
    passage = "".join(g.choice("abcdefgh ") for _ in range(470))
    rows = list(enumerate(texts()))
    rows += [(100 + k, prose(700 + k, g.randrange(30)) + passage[g.randrange(35): 470 - g.randrange(35)] + prose(900 + k, g.randrange(30)))
             for k in range(24)]
    rows += [(200, "é" * 300), (201, "é" * 199), (202, "x" * 400 + "y" * 200 + "x" * 400), (None, prose(1, 160)), (3, "q")]
    got = suffix_dedup.remove_repeats(documents(spark, [(i, t, None, None, None) for i, t in rows]), hot=hot).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == removed(rows)


def test_suffix_removal_empty_and_kept_text(spark):
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0
    a = prose(1, 200)
    got = suffix_dedup.remove_repeats(documents(spark, [(1, "head " * 3 + a, None, None, None), (2, a + " tail", None, None, None)]), keep_text=True)
    assert {r.doc_id: bytes(r.kept) for r in got.collect()} == {1: b"head head head ", 2: b" tail"}


def test_loser_tree_merges_and_keeps_prefixes():
    g = random.Random(2)
    runs = [sorted(bytes(g.choice(b"ab") for _ in range(40)) for _ in range(g.randrange(1, 30))) for _ in range(5)] + [[]]
    opened = [suffix_dedup.opened(*suffix_dedup.front_coded(r), 40) for r in runs]
    got = list(suffix_dedup.merge(opened))
    assert [s for _, _, s in got] == sorted(s for r in runs for s in r)
    for (_, _, a), (_, h, b) in zip(got, got[1:]):
        assert h == suffix_dedup.lcp(a, b, 0)


def test_both_ways_to_resolve_a_gram_agree():
    g = random.Random(9)
    common = bytes(g.choice(b"ab") for _ in range(128))
    for _ in range(30):
        group, strings = [], set()
        for _ in range(g.randrange(2, 30)):
            t = bytearray(common)
            for _ in range(g.randrange(5)):
                t[g.choice([*range(30), *range(70, 128)])] = 99
            left, right = g.randrange(20, 65), g.randrange(33, 65)
            strings.add((bytes(t[64: 64 + right]).ljust(64, b"\0") + bytes(t[64 - left: 64][::-1]).ljust(64, b"\0"), left, right))
        for s, left, right in sorted(strings):
            head = suffix_dedup.lcp(group[-1].s, s, 0) if group else 0
            group.append(suffix_dedup.Suffix(s, left, right, range(g.randrange(1, 3)), head))
        a, b = (suffix_dedup.repeated(group, 64, n) for n in (99, 0))
        full = [{o for x, y in spans for o in range(x, y + 1)} for spans in a]
        assert full == [{o for x, y in spans for o in range(x, y + 1)} for spans in b]


def test_anchors_follow_content():
    g = random.Random(4)
    t = bytes(g.choice(b"abcd") for _ in range(3000))
    for cut in (0, 137, 900):
        at, lo, hi, _ = suffix_dedup.anchors(t[cut:], 400)
        of = {p: int(a) + cut for a, x, y in zip(at, lo, hi) for p in range(int(x) + cut, int(y) + cut + 1)}
        full = suffix_dedup.anchors(t, 400)
        want = {p: int(a) for a, x, y in zip(*full[:3]) for p in range(int(x), int(y) + 1)}
        assert all(want[p] == a for p, a in of.items()) and len(of) == len(t) - cut - 399


VECTORS = [(i, [random.Random(i).gauss(0, 1) * (1 + i % 7) for _ in range(8)]) for i in range(300)]


def nearest(rows, k=5):
    v = [(i, [math.floor(256 * c) for c in x]) for i, x in rows
         if i is not None and x is not None and all(c is not None and math.isfinite(c) for c in x)]
    out = []
    for i, q in v:
        if i % 50 == 0:
            s = sorted(((-sum(a * b for a, b in zip(q, x)), j) for j, x in v if j != i and len(x) == len(q)))[:k]
            out += [(i, r + 1, j, -d) for r, (d, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("block,probe", [(4096, 2048), (16, 20), (7, 0)])
def test_top_k(spark, block, probe):
    rows = VECTORS + [(1000, None), (1050, [1.0, None] * 4), (1100, [float("nan")] * 8), (1150, [float("inf")] * 8), (1200, [1.0, 2.0]),
                      (1201, [3.0, 1.0]), (1250, [0.0] * 8), (1300, [1e7] * 8), (1301, [-1e7] * 8), (None, [1.0] * 8)]
    rows += [(2000 + i, [2.0] * 8) for i in range(12)]  # ties
    table = topk.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    got = topk.top_k(table, table.where("id % 50 = 0"), probe=probe, block_rows=block, query_rows=4).collect()
    assert sorted(tuple(r) for r in got) == nearest(rows)


def test_top_k_empty_and_few(spark):
    none = topk.usable(spark.createDataFrame([], "vec_id long, embedding array<double>"))
    assert topk.top_k(none, none).count() == 0
    two = topk.usable(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>"))
    assert [tuple(r) for r in topk.top_k(two, two.where("id = 0")).collect()] == [(0, 1, 1, 256 * 512)]
