"""Perfect hash and exact duplicates against plain versions."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, prose, texts
from wayloom.llm import exact


def digests(n, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (n, 32), dtype=np.uint8)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 60000])
def test_hash_is_minimal_and_perfect(n):
    d = digests(n)
    h = exact.MinimalHash.build(d)
    assert sorted(h.slots(d).tolist()) == list(range(n))
    again = exact.MinimalHash.opened(h.packed())
    assert (again.slots(d) == h.slots(d)).all() and again.left == h.left
    other = again.slots(digests(500, 1))
    assert ((other >= -1) & (other < max(n, 1))).all()
    if n > 100:
        assert sum(map(len, h.tables)) < 5 * n and not h.left


def test_digests_alike_in_the_hashed_words_go_by_all_bytes():
    d = digests(40)
    d[:20, 8:24] = 7  # the same two words
    h = exact.MinimalHash.build(d)
    assert len(h.left) == 20 and sorted(h.slots(d).tolist()) == list(range(40))
    d2 = d[:5].copy()
    d2[:, 30] ^= 1
    assert (exact.MinimalHash.opened(h.packed()).slots(d2) == -1).all()


def plain(rows):
    out, by = {}, {}
    for at, (i, t, *_) in enumerate(rows):
        t = t or ""
        norm = t.translate({ord(c): None for c in exact.BLANKS}).encode()
        by.setdefault(hashlib.sha256(norm).hexdigest(), []).append((-len(t), i is None, i, at))
    for sha, group in by.items():
        best = min(group, key=lambda g: (g[0], g[1], g[2] or 0))
        for g in group:
            out.setdefault((g[2], sha), []).append((best[2], len(group), g[3] == best[3]))
    return out


@pytest.mark.parametrize("historic", ["odd", "none", "all", "null"])
@pytest.mark.parametrize("hot", [1024, 2])
def test_groups_are_those_of_a_plain_version(spark, historic, hot):
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts())]
    rows += [(100 + i, " ".join(prose(1, 160).split()) + " " * (i % 3), "en", "s", None) for i in range(40)]
    rows += [(200, "a b\tc\x0bd", None, None, 1), (201, "ab cd", None, None, 1), (200, "a b\tc\x0bd", None, None, 1), (None, "abcd", None, None, 1),
             (None, "", None, None, 1), (202, "a b", None, None, 1), (203, "a\u0085b", None, None, 1), (204, "ab", None, None, 1)]
    flag = {"odd": F.col("doc_id") % 2 == 1, "none": F.lit(False), "all": F.lit(True), "null": F.lit(None).cast("boolean")}[historic]
    got = {}
    out = exact.deduplicate(documents(spark, rows), flag, part_size=8, hot=hot)
    for r in out.collect():
        got.setdefault((r.doc_id, r.text_sha256), []).append((r.keep_id, r.group_size, r.kept))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in plain(rows).items()}


def test_known_marks_texts_of_historical_rows(spark):
    rows = [(1, "a b", None, None, 1), (2, "ab", None, None, 1), (3, "c", None, None, 1), (4, "d", None, None, 1)]
    got = {r.doc_id: r.known for r in exact.deduplicate(documents(spark, rows), F.col("doc_id").isin(1, 4)).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True}


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert exact.op13_perfect_hash(spark, str(tmp_path)).collect() == []
