"""Texts above one segment of window starts."""

import random

import numpy as np

from tests.llm.data import documents
from wayloom.llm import suffix_dedup


def border_case() -> tuple[str, str, int]:
    """A text of over 1 MiB, and another that shares only the gram of an anchor at a segment border."""
    g = random.Random(12)
    while True:
        long = "".join(g.choices("abcdefgh", k=(1 << 20) + 5000))
        near = suffix_dedup.anchors(long[suffix_dedup.SEGMENT - 3000: suffix_dedup.SEGMENT + 3000].encode(), 400)
        for p, lo, hi, _ in zip(*near, strict=True):
            if lo < 3000 <= hi:  # one anchor for the window starts on both sides
                p = int(p) + suffix_dedup.SEGMENT - 3000
                other = "".join(g.choices("ijklmnop", k=600)) + long[p: p + suffix_dedup.GRAM] + "".join(g.choices("ijklmnop", k=600))
                if 600 in suffix_dedup.anchors(other.encode(), 400)[0]:
                    return long, other, p


def test_a_border_anchor_is_one_place(spark):
    long, other, p = border_case()
    pos, lo, hi, _ = suffix_dedup.anchors(long.encode(), 400)
    assert (np.diff(pos) > 0).all() and p in pos
    assert lo[0] == 0 and (lo[1:] == hi[:-1] + 1).all() and hi[-1] == len(long) - 400
    rows = [(1, long, None, None, None), (2, other, None, None, None)]
    got = suffix_dedup.remove_repeats(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans) for r in got} == {1: (0, 0), 2: (0, 0)}
