"""Runs against a plain search of every period, on strings with few letters and on awkward tables."""

import hashlib
import random

import numpy as np
import pytest

from tests.llm.data import documents, prose
from wayloom.llm import runs as R


def plain(x, shortest=6, exponent=4):
    """Every maximal stretch per period, without those that have a smaller period."""
    out, n = [], len(x)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, exponent * q):
                s, e = i, j + q
                if not any(all(x[k] == x[k + d] for k in range(s, e - d)) for d in range(1, q)):
                    out.append((s, e - s, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(x):
    x = np.array(x, np.int64)
    return R.runs_of(x, R.live_stretches(x, np.zeros(1, np.int64)))


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_those_of_a_plain_search(seed):
    g = random.Random(seed)
    for _ in range(150):
        n, k = g.randint(0, 120), g.randint(1, 4)
        x = [g.randrange(k) for _ in range(n)]
        for _ in range(g.randint(0, 3)):
            p, a = g.randint(1, 15), g.randint(0, 60)
            unit = [g.randrange(k + 2) for _ in range(p)]
            x[a:a] = (unit * 12)[: g.randint(p, 8 * p)]
        assert found(x) == plain(x), x
        whole = np.array(x, np.int64)  # without the live stretches
        assert R.runs_of(whole, [(0, len(x))] if len(x) else []) == plain(x)


def test_long_periods_one_word_and_fibonacci():
    g = random.Random(9)
    unit = [g.randrange(10**6) for _ in range(3000)]
    assert found((unit * 5)[:14000]) == [(0, 14000, 3000)]
    assert found([1] * 50000 + [2] * 5 + [1] * 6) == [(0, 50000, 1), (50005, 6, 1)]
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert found(b) == plain(b) == []
    assert found(b[:144] * 4 + [7]) == plain(b[:144] * 4 + [7])


def test_grammar_derives_its_input():
    g = random.Random(3)
    for _ in range(50):
        x = [g.randrange(3) for _ in range(g.randint(1, 200))]
        rules, rest = R.repair(x)
        assert [i for s, n in rest for i in range(s, s + n)] == list(range(len(x)))
        for cut, size, at in rules:
            assert 0 < cut < size and len(at) > 1 and len({tuple(x[i: i + size]) for i in at}) == 1


def test_query_on_awkward_rows(spark, tmp_path):
    texts = [None, "", " \t ", "a " * 6, "a a a a a", "x " + "to be or not " * 4, prose(1, 400) * 4, (prose(2, 30) + "\n") * 5 + prose(3, 50),
             "ä b ß " * 7, "ha ha " * 9, prose(4, 9000) + " end" * 40, "A a " * 10]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts * 12)] + [(None, "b " * 8, None, None, 1)] * 2
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in R.op11_repair_runs(spark, str(tmp_path)).collect():
        assert got.setdefault(r.doc_id, r) == r
    assert set(got) == {r[0] for r in rows}
    for i, t, *_ in rows:
        w = R.repeat_tail(i, (t or "").encode().split())
        number = {v: k for k, v in enumerate(dict.fromkeys(w))}
        want = plain([number[v] for v in w]) if len(w) < 3000 else R.runs_of(np.array([number[v] for v in w]), [(0, len(w))])
        drop = {k for s, n, q in want for k in range(s + q, s + n)}
        sha = lambda b: hashlib.sha256(b).hexdigest()
        r = got[i]
        best = min(want, key=lambda v: (-v[1], v[0], v[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in want).encode())
        assert r.collapsed_sha256 == sha(b" ".join(v for k, v in enumerate(w) if k not in drop))


def test_altered_words_follow_the_contract():
    import zlib
    for i in range(400):
        w = [b"%d" % k for k in range(1 + i % 57)]
        h = zlib.crc32(str(i).encode())
        a, want = h // 10 % len(w), list(w)
        p = 1 + (len(w) - a) // (3 + h // 10 % 8)
        if h % 10 == 0:
            want = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        assert R.repeat_tail(i, w) == want


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert R.op11_repair_runs(spark, str(tmp_path)).collect() == []
