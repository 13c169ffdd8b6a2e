"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of consecutive words with smallest period ``q`` that no neighbouring
word extends, of at least ``max(shortest, exponent * q)`` words (``exponent`` 4 or more).
Per text:

* *Live stretches.* All word pairs inside a run occur at least ``exponent - 1`` times in
  their text. Stretches of words whose pairs do, long enough for a run, are kept; most
  texts have none. This only saves work: no run leaves its stretch.
* *Grammar.* Re-Pair on the word ids of the stretches: the most frequent pair becomes a
  new symbol until no pair repeats (the older pair first on ties, which keeps
  derivations shallow). What is left over is joined pairwise into a balanced tree.
* *Boundaries.* Every symbol, and every tree node, is looked at once, at its first place:
  a run over the border between its two parts has two periods on one side of it, so
  a period is a candidate if the words next to the border, and then the fingerprints of
  two neighbouring periods, agree. Candidates are extended word by word, so a
  fingerprint decides nothing by itself.
* *Places.* A symbol's runs are moved to all places that it derives; intervals of one
  period that share a period's length are united, which leaves the maximal ones.

A text is worked on by itself, so there is no shuffle and no group; memory follows the
longest text (candidates are tested ``CHUNK`` at a time). Null or empty texts have no
runs and collapse to the empty string; repeated rows come out alike; keys may be null;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import as_bytes, documents

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
Run = tuple[int, int, int]  # start, length, period


class _Ids(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def live_stretches(ids: np.ndarray, first: np.ndarray, shortest: int = 6, exponent: int = 4,
                   passes: int = 3) -> list[tuple[int, int]]:
    """Stretches [start, end) that may hold runs; texts lie end to end in ``ids`` and start at ``first``."""
    n = len(ids)
    if n < shortest:
        return []
    text = np.zeros(n, np.uint64)
    text[first[first < n]] = 1
    begins = text[1:] == 1
    text = np.cumsum(text).astype(np.uint64)
    x = ids.astype(np.uint64)
    # equal pairs have equal keys; two pairs with one key only make a stretch look livelier
    pair = (x[:-1] * np.uint64(_BASE) + x[1:]) * np.uint64(0xD6E8FEB86659FD93) + text[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    at = np.flatnonzero(~begins)
    for _ in range(passes):
        _, inverse, count = np.unique(pair[at], return_inverse=True, return_counts=True)
        kept = at[count[inverse] >= exponent - 1]
        cut = np.flatnonzero(np.r_[True, np.diff(kept) != 1]) if len(kept) else np.zeros(0, np.int64)
        size = np.diff(np.r_[cut, len(kept)])
        good = np.repeat(size >= shortest - 1, size)
        if good.sum() == len(at):
            break
        at = kept[good]
    if not len(at):
        return []
    cut = np.flatnonzero(np.r_[True, np.diff(at) != 1])
    ends = np.r_[cut[1:], len(at)] - 1
    return list(zip(at[cut].tolist(), (at[ends] + 2).tolist(), strict=True))


def repair(seq: list[int]) -> tuple[list[tuple[int, int, list[int]]], list[tuple[int, int]]]:
    """Rules as (size of the left part, size, places) and the rest as (start, size), both in words.

    Symbols below zero are separators; each occurs once.
    """
    n = len(seq)
    sym, size = list(seq), [1] * n
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    count = Counter(zip(seq, seq[1:]))  # noqa: B905
    where: dict[tuple[int, int], list[int]] = {}
    for i, p in enumerate(zip(seq, seq[1:])):  # noqa: B905
        if count[p] > 1:
            where.setdefault(p, []).append(i)
    heap = [(-count[p], k, p) for k, p in enumerate(where)]
    heapq.heapify(heap)
    order, fresh, rules = len(heap), max(seq, default=0) + 1, []
    gone = -1 - n  # below every separator
    while heap:
        c, _, pair = heapq.heappop(heap)
        now = count.get(pair, 0)
        if now != -c:
            if now > 1:
                heapq.heappush(heap, (-now, order, pair))
                order += 1
            continue
        a, b = pair
        places, last = [], -1
        for i in where.pop(pair):
            if i >= last and sym[i] == a and after[i] < n and sym[after[i]] == b:
                places.append(i)
                last = after[i] + 1 if a == b else i
        del count[pair]
        if len(places) < 2:
            continue
        rules.append((size[places[0]], size[places[0]] + size[after[places[0]]], places))
        made: dict[tuple[int, int], list[int]] = {}
        for i in places:
            j = after[i]
            left, right = before[i], after[j]
            if left >= 0:
                old = (sym[left], a)
                if old in count:
                    count[old] -= 1
            if right < n:
                old = (b, sym[right])
                if old in count:
                    count[old] -= 1
                before[right] = i
            sym[i], sym[j] = fresh, gone
            size[i] += size[j]
            after[i] = right
        for i in places:
            left, right = before[i], after[i]
            if left >= 0 and sym[left] != fresh:
                made.setdefault((sym[left], fresh), []).append(left)
            if right < n:
                made.setdefault((fresh, sym[right]), []).append(i)
        for p, at in made.items():
            if len(at) > 1:
                count[p], where[p] = len(at), at
                heapq.heappush(heap, (-len(at), order, p))
                order += 1
        fresh += 1
    rest, i = [], 0
    while i < n:
        rest.append((i, size[i]))
        i = after[i]
    return rules, rest


def _tree(parts: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(start, border, end) of the nodes of a balanced tree over neighbouring parts."""
    ends = [(s, s + n) for s, n in parts]
    while len(ends) > 1:
        up = []
        for k in range(0, len(ends) - 1, 2):
            (s, m), (_, e) = ends[k], ends[k + 1]
            yield s, m, e
            up.append((s, e))
        if len(ends) % 2:
            up.append(ends[-1])
        ends = up


def _agree(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading values of two slices of one length agree."""
    at, step, n = 0, 64, len(x)
    while at < n:
        d = np.flatnonzero(x[at: at + step] != y[at: at + step])
        if len(d):
            return at + int(d[0])
        at += step
        step *= 4
    return n


def _squares(x: np.ndarray, nodes: np.ndarray, exponent: int) -> Iterator[tuple[int, int, int]]:
    """(node, period, start of two equal neighbouring periods at the node's border), by node and period."""
    n = len(x)
    up = np.full(n + 1, _BASE, np.uint64)
    up[0] = 1
    up = np.multiply.accumulate(up)
    mixed = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    p = np.zeros(n + 1, np.uint64)
    np.cumsum((mixed ^ (mixed >> np.uint64(29))) * up[:n], out=p[1:])
    s, m, e = nodes.T
    most = (e - s) // exponent
    right, left = np.minimum((e - m) // 2, most), np.minimum((m - s) // 2, most)
    edges = np.cumsum(right + left)
    lo = 0
    while lo < len(nodes):
        base = edges[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(edges, base + CHUNK, side="right")))
        found = []
        for side, many in ((0, right[lo:hi]), (1, left[lo:hi])):
            node = np.repeat(np.arange(lo, hi), many)
            q = np.arange(len(node)) - np.repeat(np.cumsum(many) - many, many) + 1
            b = m[node] if side == 0 else m[node] - q  # two periods lie to the right, or to the left, of the border
            near = x[b] == x[b + q] if side == 0 else x[m[node] - 1] == x[b - 1]
            node, q, b = node[near], q[near], b[near]
            first = b if side == 0 else b - q
            same = (p[first + q] - p[first]) * up[q] == p[first + 2 * q] - p[first + q]
            found.append(np.stack([node[same], q[same], first[same]], axis=1))
        got = np.concatenate(found)
        yield from map(tuple, got[np.lexsort((got[:, 2], got[:, 1], got[:, 0]))].tolist())
        lo = hi


def runs_of(x: np.ndarray, stretches: list[tuple[int, int]], shortest: int = 6, exponent: int = 4) -> list[Run]:
    """All runs inside the stretches of ``x``, by start, then period."""
    if exponent < 4:
        raise ValueError("exponent must be 4 or more: a run has two periods on one side of every border")
    if not stretches:
        return []
    parts, origin = [], []
    for k, (a, b) in enumerate(stretches):
        parts += [x[a:b], [-1 - k]]
        origin += [np.arange(a, b), [-1]]
    y, origin = np.concatenate(parts).astype(np.int64), np.concatenate(origin)
    rules, rest = repair(y.tolist())
    nodes, places = [], []
    for cut, size, at in rules:
        if size >= shortest:
            nodes.append((at[0], at[0] + cut, at[0] + size))
            places.append(np.array(at))
    line: list[tuple[int, int]] = []
    for part in rest:
        if y[part[0]] >= 0:
            line.append(part)
            continue
        for node in _tree(line):
            if node[2] - node[0] >= shortest:
                nodes.append(node)
                places.append(np.array(node[:1]))
        line = []
    if not nodes:
        return []
    found: dict[int, list[tuple[np.ndarray, int]]] = {}
    here, last = [], -1
    for k, q, b in _squares(y, np.array(nodes, np.int64), exponent):
        s, m, e = nodes[k]
        if k != last:
            here, last = [], k
        if any(lo <= b and b + 2 * q <= hi for lo, hi in here):
            continue  # inside a run of a smaller period, of which q is a multiple
        on = _agree(y[b: e - q], y[b + q: e])
        if on < q:
            continue  # fingerprints agree, words do not
        lo = b - _agree(y[s:b][::-1], y[s + q: b + q][::-1])
        hi = b + on + q
        here.append((lo, hi))
        if lo < m < hi and hi - lo >= max(shortest, exponent * q):
            found.setdefault(q, []).append((places[k] + (lo - s), hi - lo))
    out = []
    for q, got in found.items():
        start = np.concatenate([a for a, _ in got])
        end = start + np.concatenate([np.full(len(a), n) for a, n in got])
        by = np.argsort(start, kind="stable")
        start, end = start[by], np.maximum.accumulate(end[by])
        new = np.flatnonzero(np.r_[True, start[1:] > end[:-1] - q])
        last_of = np.r_[new[1:], len(start)] - 1
        out += [(int(origin[a]), int(b - a), q) for a, b in zip(start[new], end[last_of], strict=True)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, shortest: int = 6, exponent: int = 4, key: str = "doc_id", text: str = "text",
                  altered: Callable[[object, list[bytes]], list[bytes]] | None = None, batch_words: int = 1 << 20) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period), collapsed: one row per row of ``docs``.

    ``altered`` may change the words of a text (key, words) before anything else.
    """
    kind = docs.schema[key].dataType.simpleString()
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(keys: pa.Array, lists: list[list[bytes]]) -> pa.RecordBatch:
            ids = _Ids()
            x = np.fromiter((ids[w] for ws in lists for w in ws), np.int64, sum(map(len, lists)))
            first = np.cumsum([0, *map(len, lists)])
            by_text: dict[int, list[tuple[int, int]]] = {}
            for a, b in live_stretches(x, first[:-1], shortest, exponent):
                t = int(np.searchsorted(first, a, side="right")) - 1
                by_text.setdefault(t, []).append((a - int(first[t]), b - int(first[t])))
            runs, out = [], []
            for t, ws in enumerate(lists):
                got = runs_of(x[first[t]: first[t + 1]], by_text[t], shortest, exponent) if t in by_text else []
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in got])
                out.append(b" ".join(kept_words(ws, got)))
            return pa.RecordBatch.from_arrays([keys, pa.array(runs, pa.list_(item)), pa.array(out, pa.binary()).cast(pa.string())],
                                              names=["doc_id", "runs", "collapsed"])

        for b in batches:
            names = b.column(0).to_pylist()
            held, since, size = [], 0, 0
            for i, t in enumerate(as_bytes(b.column(1))):
                ws = t.split() if t else []
                held.append(altered(names[i], ws) if altered else ws)
                size += len(held[-1])
                if size >= batch_words or i == b.num_rows - 1:
                    yield finished(b.column(0).slice(since, len(held)), held)
                    held, since, size = [], i + 1, 0

    return docs.select(key, text).mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def repeat_tail(key: object, words: list[bytes]) -> list[bytes]:
    """The contract's change: for a tenth of the keys the words from some place on repeat; a null key changes nothing."""
    n, h = len(words), 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a: a + p] * (-(-(n - a) // p)))[: n - a]


def op11_repair_runs(spark, sf_dir):
    found = periodic_runs(documents(spark, sf_dir), altered=repeat_tail)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.n").alias("length"),
        (-F.col("best.p")).alias("period"), F.expr("1000 * best.n div -best.p").alias("exponent_milli"),
        sha(listed).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
