"""Removal of repeated strings by a common-prefix-aware distributed merge sort of suffixes.

Every string of ``length`` bytes that also starts elsewhere is removed, texts being
UTF-8 bytes. Sorting all suffixes would move each byte ``length`` times, so sorted are
the suffixes at *anchors*: the leftmost smallest hash of a 32-byte gram inside each
window of ``length`` bytes. Equal windows have their anchor at the same offset, so two
equal windows always show as two anchors whose right context agrees for ``r`` bytes and
whose left context for ``l`` bytes, with ``l + r >= length``. Anchors whose gram hash
occurs once in the corpus cannot take part and are not exchanged.

An anchor's string is its right context followed by its left context backwards. Each
task sorts its strings and sends one front-coded run per range of gram hashes (shared
prefix lengths and the remaining bytes only). The receiver merges runs with a loser
tree that keeps each candidate's common prefix with the last output: unequal prefix
lengths decide a match without looking at bytes, equal ones are compared from there
on. Suffixes of one gram leave the tree side by side, and from the common prefixes of
neighbours follow the windows that occur twice; many strings of one gram are compared
window by window. A gram with more than ``hot`` anchors never meets in one task: its
windows are dealt out by a 128-bit fingerprint instead. A task sends each distinct
window once and settles those that it holds twice by itself.

Equal texts of at least ``length`` bytes are removed whole. Null texts count as empty,
texts shorter than ``length`` stay, keys may be null or repeat, other columns are
ignored. Text rows of a task are held one Arrow batch at a time.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import as_bytes, documents, stored

GRAM = 32
SEGMENT = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(11).integers(0, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    global _POW
    if len(_POW[0]) < n:
        up = np.full(n, _BASE, np.uint64)
        down = np.full(n, pow(_BASE, -1, 2**64), np.uint64)
        up[0] = down[0] = 1
        _POW = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POW[0][:n], _POW[1][:n]


_POW: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def window_hashes(x: np.ndarray, size: int, table: int = 0) -> np.ndarray:
    """Hash of every ``size`` values along the last axis of a byte array."""
    n = x.shape[-1]
    up, down = _powers(n + 1)
    p = np.zeros((*x.shape[:-1], n + 1), np.uint64)
    np.cumsum(_TABLE[table][x] * up[:n], axis=-1, out=p[..., 1:])
    h = (p[..., size:] - p[..., :-size]) * down[: n - size + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, the first and last window start of each, and its gram hash."""
    w, out = length - GRAM + 1, []
    mask = np.uint64((1 << 20) - 1)
    for s in range(0, max(len(text) - length + 1, 0), SEGMENT):
        e = min(s + SEGMENT, len(text) - length + 1)
        h = window_hashes(np.frombuffer(text, np.uint8)[s: e + length - 1], GRAM)
        v = (h & ~mask) | np.arange(len(h), dtype=np.uint64)  # ties go to the leftmost
        pad = np.full(-(-len(v) // w) * w, np.iinfo(np.uint64).max, np.uint64)
        pad[: len(v)] = v
        blocks = pad.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = e - s
        at = (np.minimum(behind[:n], ahead[w - 1: w - 1 + n]) & mask).astype(np.int64)
        lo = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        out.append((at[lo] + s, lo + s, np.r_[lo[1:], n] - 1 + s, h[at[lo]]))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    pos, lo, hi, h = (np.concatenate(c) for c in zip(*out, strict=True))
    first = np.flatnonzero(np.r_[True, pos[1:] != pos[:-1]])  # both segments at a border find its anchor
    return pos[first], lo[first], hi[np.r_[first[1:], len(pos)] - 1], h[first]


TEXT, PLACE = np.dtype("S16"), np.dtype([("h", "<u8"), ("text", "<u4"), ("pos", "<u4")])


def _surveyed(docs: DataFrame, length: int, parts: int, key: str, text: str, flush: int = 1 << 20) -> DataFrame:
    """Per document key, size and hash; and packed anchors, once per distinct text of a task."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["doc_id", "key", "n_bytes", "sha", "part", "texts", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held: list[tuple] = []
        count, typ = 0, None

        def pack():
            pos = np.concatenate([a for _, a, _ in held])
            h = np.concatenate([g for _, _, g in held])
            own = np.repeat(np.arange(len(held)), [len(a) for _, a, _ in held])
            part = (h % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[by], np.arange(parts + 1))
            rows = []
            for p in range(parts):
                at = by[cuts[p]: cuts[p + 1]]
                if len(at):
                    mine, local = np.unique(own[at], return_inverse=True)
                    e = np.empty(len(at), PLACE)
                    e["h"], e["text"], e["pos"] = h[at], local, pos[at]
                    rows.append((p, b"".join(held[i][0] for i in mine), e.tobytes()))
            p, t, e = zip(*rows, strict=True)
            m = pa.nulls(len(p))
            return pa.RecordBatch.from_arrays([m.cast(typ), m.cast(pa.binary()), m.cast(pa.int64()), m.cast(pa.string()), pa.array(p, pa.int32()),
                                               pa.array(t, pa.binary()), pa.array(e, pa.binary())], names=names)

        for b in batches:
            typ = b.column(0).type
            texts = [t or b"" for t in as_bytes(b.column(1))]
            keys = [hashlib.md5(t, usedforsecurity=False).digest() for t in texts]
            for k, t in zip(keys, texts, strict=True):
                if len(t) >= length and k not in seen:
                    seen.add(k)
                    a, _, _, h = anchors(t, length)
                    held.append((k, a, h))
                    count += len(a)
                if count >= flush:
                    yield pack()
                    held, count = [], 0
            m = pa.nulls(len(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts]), m.cast(pa.int32()), m.cast(pa.binary()), m.cast(pa.binary())], names=names)
        if held:
            yield pack()

    return docs.select(key, text).mapInArrow(
        run, f"doc_id {kind}, key binary, n_bytes long, sha string, part int, texts binary, places binary")


def _shared_grams(rows: DataFrame, parts: int, hot: int) -> DataFrame:
    """key, v: anchors whose gram occurs more than once; v is twice the position, plus 1 for a hot gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for p, t, e in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.setdefault(p, []).append((np.frombuffer(t, "V16"), np.frombuffer(e, PLACE)))
        for got in held.values():
            texts = np.concatenate([t for t, _ in got]).view("<u8").reshape(-1, 2)
            base = np.cumsum([0] + [len(t) for t, _ in got])
            own = np.concatenate([e["text"].astype(np.int64) + k for (_, e), k in zip(got, base, strict=False)])
            h, pos = np.concatenate([e["h"] for _, e in got]), np.concatenate([e["pos"] for _, e in got])
            by = np.lexsort((pos, texts[own, 1], texts[own, 0], h))
            h, own, pos = h[by], own[by], pos[by]
            keep = np.ones(len(h), bool)
            keep[1:] = (h[1:] != h[:-1]) | (pos[1:] != pos[:-1]) | (texts[own[1:]] != texts[own[:-1]]).any(axis=1)
            h, own, pos = h[keep], own[keep], pos[keep]
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
            n = np.repeat(np.diff(np.r_[start, len(h)]), np.diff(np.r_[start, len(h)]))
            at = np.flatnonzero(n > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([texts[o].tobytes() for o in own[at]], pa.binary()), pa.array(pos[at].astype(np.int64) * 2 + (n[at] > hot))], names=["key", "v"])

    return rows.where("part is not null").select("part", "texts", "places").repartition(parts, "part").mapInArrow(
        run, "key binary, v long")


def lcp(a: bytes, b: bytes, h: int) -> int:
    """Common prefix of two strings of one length that agree in the first ``h`` bytes."""
    n = len(a)
    while h < n:
        x, y = a[h: h + 64], b[h: h + 64]
        if x != y:
            d = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
            return h + (8 * len(x) - d.bit_length()) // 8
        h += 64
    return n


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Common prefix with the string before, and the rest of each, of sorted strings."""
    heads = np.zeros(len(strings), np.uint16)
    rest = []
    for i, s in enumerate(strings):
        heads[i] = lcp(strings[i - 1], s, 0) if i else 0
        rest.append(s[heads[i]:])
    return heads, b"".join(rest)


def opened(heads: np.ndarray, rest: bytes, size: int) -> Iterator[tuple[int, bytes]]:
    last, at = b"", 0
    for h in heads.tolist():
        last = last[:h] + rest[at: at + size - h]
        at += size - h
        yield h, last


def merge(runs: list[Iterator[tuple[int, bytes]]]) -> Iterator[tuple[int, int, bytes]]:
    """(run, common prefix with the output before, string) in order, by a loser tree over common prefixes."""
    k = len(runs)
    cur: list[bytes | None] = [None] * k
    h = [0] * k
    for i, r in enumerate(runs):
        first = next(r, None)
        cur[i] = first[1] if first else None

    def duel(i: int, j: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes the one it shares with the winner."""
        if cur[i] is None or cur[j] is None:
            return (j, i) if cur[i] is None else (i, j)
        if h[i] != h[j]:
            return (i, j) if h[i] > h[j] else (j, i)
        a, b = cur[i], cur[j]
        p = lcp(a, b, h[i])
        first = i if p == len(a) and i < j or p < len(a) and a[p] < b[p] else j
        other = j if first == i else i
        h[other] = p
        return first, other

    tree = [0] * max(k, 1)

    def build(node: int) -> int:
        if node >= k:
            return node - k
        win, tree[node] = duel(build(2 * node), build(2 * node + 1))
        return win

    top = build(1) if k else 0
    while k and cur[top] is not None:
        yield top, h[top], cur[top]
        nxt = next(runs[top], None)
        cur[top], h[top] = (nxt[1], nxt[0]) if nxt else (None, 0)
        node, cand = (k + top) // 2, top
        while node >= 1:
            cand, tree[node] = duel(cand, tree[node])
            node //= 2
        top = cand


class Suffix:
    """A string of the merged order with what lies beyond text ends cut off, and the anchors that have it."""

    __slots__ = ("s", "left", "right", "refs", "head")

    def __init__(self, s: bytes, left: int, right: int, refs: list, head: int):
        self.s, self.left, self.right, self.refs, self.head = s, left, right, refs, head


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of whole numbers without overlap, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def repeated(group: list[Suffix], length: int, pairwise: int = 48) -> list[list[tuple[int, int]]]:
    """For every suffix of one gram the intervals of offsets whose window occurs more than once."""
    out: list[list[tuple[int, int]]] = [[(length - g.right, g.left)] if len(g.refs) > 1 else [] for g in group]
    if len(group) == 1:
        return out
    if len(group) <= pairwise:
        for i, a in enumerate(group):
            common = 2 * length
            for j in range(i + 1, len(group)):
                b = group[j]
                common = min(common, b.head)
                r = min(common, length, a.right, b.right)
                li = common - length if common >= length else lcp(a.s[length:], b.s[length:], 0)
                span = (length - r, min(li, a.left, b.left))
                if span[0] <= span[1]:
                    out[i].append(span)
                    out[j].append(span)
        return [united(spans) for spans in out]
    m = np.frombuffer(b"".join(g.s for g in group), np.uint8).reshape(-1, 2 * length)
    x = np.ascontiguousarray(np.concatenate([m[:, length:][:, ::-1], m[:, :length]], axis=1))
    h = window_hashes(x, length)
    left, right = np.array([g.left for g in group]), np.array([g.right for g in group])
    hit = np.zeros((len(group), length + 1), bool)
    for o in range(length - int(right.max()), int(left.max()) + 1):
        at = np.flatnonzero((left >= o) & (right >= length - o))
        if len(at) < 2:
            continue
        at = at[np.argsort(h[at, length - o], kind="stable")]
        same = h[at[1:], length - o] == h[at[:-1], length - o]
        i = np.flatnonzero(same)
        equal = (x[at[i], length - o: 2 * length - o] == x[at[i + 1], length - o: 2 * length - o]).all(axis=1)
        if not equal.all():  # two windows with one hash: tell them apart by their bytes
            by: dict[bytes, list[int]] = {}
            for k in at:
                by.setdefault(x[k, length - o: 2 * length - o].tobytes(), []).append(k)
            for ks in by.values():
                hit[ks, o] = len(ks) > 1
            continue
        hit[at[i], o] = hit[at[i + 1], o] = True
    for k in range(len(group)):
        edge = np.flatnonzero(np.diff(np.r_[0, hit[k].astype(np.int8), 0]))
        out[k] += [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]
    return out


REF = np.dtype([("text", "<u4"), ("pos", "<i8"), ("least", "<u2"), ("most", "<u2")])


def _runs(texts: DataFrame, length: int, parts: int, flush: int = 48 << 20) -> DataFrame:
    """Front-coded sorted runs (kind 0) per range of gram hashes, and windows of hot grams (kinds 1 and 2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        cold: dict[tuple, list] = {}
        warm: dict[tuple, list] = {}

        def pack():
            rows = []
            by_part: dict[int, list] = {}
            for (part, s, left, right), refs in cold.items():
                by_part.setdefault(part, []).append((s, left, right, refs))
            for p, items in by_part.items():
                items.sort(key=lambda e: e[:3])
                heads, rest = front_coded([e[0] for e in items])
                used: dict[int, int] = {}
                refs = np.array([(used.setdefault(t, len(used)), *r) for e in items for t, *r in e[3]], REF)
                rows.append((0, p, pickle.dumps((heads.tobytes(), rest, np.array([e[1:3] for e in items], "<u2").tobytes(),
                                                 np.array([len(e[3]) for e in items], "<u4").tobytes(), refs.tobytes(), [keys[t] for t in used]))))
            rows += _windows(warm, keys, length, parts)
            k, p, d = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(p, pa.int32()), pa.array(d, pa.binary())], names=["kind", "part", "data"])

        size = 0
        for b in batches:
            for key, text, at in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                a, lo, hi, h = anchors(text, length)
                v = np.unique(np.array(at, np.int64))
                pick = np.flatnonzero(np.isin(a, v >> 1))
                hot = np.isin(a[pick], v[(v & 1) == 1] >> 1)
                t = len(keys)
                keys.append(key)
                for i, is_hot in zip(pick.tolist(), hot.tolist(), strict=True):
                    p = int(a[i])
                    right, left = text[p: p + length], text[max(0, p - length): p][::-1]
                    e = (int(h[i] >> np.uint64(8)) % parts, right.ljust(length, b"\0") + left.ljust(length, b"\0"), len(left), len(right))
                    into = warm if is_hot else cold
                    if e in into:
                        into[e].append((t, p, p - int(hi[i]), p - int(lo[i])))
                    else:
                        into[e] = [(t, p, p - int(hi[i]), p - int(lo[i]))]
                        size += 2 * length + 100
                    size += 50
                if size >= flush:
                    yield pack()
                    keys, cold, warm, size = [], {}, {}, 0
        if cold or warm:
            yield pack()

    return texts.select("key", "text", "at").mapInArrow(run, "kind int, part int, data binary")


WINDOW = np.dtype([("f", "<u8"), ("g", "<u8"), ("ref", "<u4"), ("off", "<u2"), ("many", "u1")])


def _windows(warm: dict, keys: list[bytes], length: int, parts: int, chunk: int = 512) -> Iterator[tuple[int, int, bytes]]:
    """Rows (kind, part, data): distinct windows of a task's hot grams by fingerprint (1), and marks known here (2)."""
    items = list(warm.items())
    held = []
    refs = []
    for c in range(0, len(items), chunk):
        part = items[c: c + chunk]
        m = np.frombuffer(b"".join(e[1] for e, _ in part), np.uint8).reshape(-1, 2 * length)
        x = np.concatenate([m[:, length:][:, ::-1], m[:, :length]], axis=1)
        f, g = window_hashes(x, length), window_hashes(x, length, 1)
        for k, (_, places) in enumerate(part):
            for t, p, least, most in places:
                o = np.arange(least, most + 1)
                w = np.zeros(len(o), WINDOW)
                w["f"], w["g"], w["ref"], w["off"] = f[k, length - o], g[k, length - o], len(refs), o
                refs.append((t, p))
                held.append(w)
    if not held:
        return
    w = np.concatenate(held)
    w = w[np.lexsort((w["g"], w["f"]))]
    same = (w["f"][1:] == w["f"][:-1]) & (w["g"][1:] == w["g"][:-1])
    first, several = np.r_[True, ~same], np.r_[False, same] | np.r_[same, False]
    rows = [(keys[refs[r][0]], refs[r][1] - b, refs[r][1] - a) for r, a, b in _stretches(w[several])]
    yield 2, int(w["f"][0] % np.uint64(parts)), pickle.dumps(rows)
    w["many"] = several
    w = w[first]
    part = (w["f"] % np.uint64(parts)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[by], np.arange(parts + 1))
    for p in range(parts):
        mine = w[by[cuts[p]: cuts[p + 1]]]
        if len(mine):
            used, mine["ref"] = np.unique(mine["ref"], return_inverse=True)
            yield 1, p, pickle.dumps((mine.tobytes(), [keys[refs[r][0]] for r in used], [refs[r][1] for r in used]))


def _stretches(w: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(ref, first offset, last offset) of neighbouring windows of one anchor."""
    w = w[np.lexsort((w["off"], w["ref"]))]
    if len(w):
        first = np.flatnonzero(np.r_[True, (w["ref"][1:] != w["ref"][:-1]) | (w["off"][1:] != w["off"][:-1] + 1)])
        for a, b in zip(first, np.r_[first[1:], len(w)] - 1, strict=True):
            yield int(w["ref"][a]), int(w["off"][a]), int(w["off"][b])


def _marks(runs: DataFrame, length: int, parts: int) -> DataFrame:
    """key, lo, hi: first and last start of windows that occur more than once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for b in batches:
            for k, p, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.setdefault((k, p), []).append(d)
        for (kind, _), got in held.items():
            rows = list(_merged(got, length) if kind == 0 else _met(got) if kind == 1 else (r for d in got for r in pickle.loads(d)))
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["key", "lo", "hi"])

    return runs.repartition(parts, "kind", "part").mapInArrow(run, "key binary, lo long, hi long")


def _merged(blobs: list[bytes], length: int) -> Iterator[tuple[bytes, int, int]]:
    runs, meta = [], []
    for d in blobs:
        heads, rest, ends, counts, refs, keys = pickle.loads(d)
        runs.append(opened(np.frombuffer(heads, np.uint16), rest, 2 * length))
        n = np.frombuffer(counts, "<u4").astype(np.int64)
        meta.append([0, np.frombuffer(ends, "<u2").reshape(-1, 2).tolist(), (np.cumsum(n) - n).tolist(), n.tolist(), np.frombuffer(refs, REF), keys])
    group: list[Suffix] = []

    def flushed():
        for g, spans in zip(group, repeated(group, length), strict=True):
            for a, b in spans:
                for keys, refs in g.refs_by_run():
                    for t, p, least, most in refs.tolist():
                        lo, hi = max(a, least), min(b, most)
                        if lo <= hi:
                            yield keys[t], p - hi, p - lo

    for r, head, s in merge(runs):
        m = meta[r]
        i = m[0]
        m[0] += 1
        left, right = m[1][i]
        refs = (m[5], m[4][m[2][i]: m[2][i] + m[3][i]])
        if group and head < GRAM:
            yield from flushed()
            group.clear()
        if group and head == 2 * length and (left, right) == (group[-1].left, group[-1].right):
            group[-1].add(refs)
        else:
            group.append(_Entry(s, left, right, refs, head))
    if group:
        yield from flushed()


class _Entry(Suffix):
    """A suffix whose anchors come from several runs; ``refs`` counts them."""

    __slots__ = ("parts",)

    def __init__(self, s, left, right, refs, head):
        super().__init__(s, left, right, range(len(refs[1])), head)
        self.parts = [refs]

    def add(self, refs) -> None:
        self.parts.append(refs)
        self.refs = range(len(self.refs) + len(refs[1]))

    def refs_by_run(self):
        return self.parts


def _met(blobs: list[bytes]) -> Iterator[tuple[bytes, int, int]]:
    keys, pos, held = [], [], []
    for d in blobs:
        w, k, p = pickle.loads(d)
        w = np.frombuffer(w, WINDOW).copy()
        w["ref"] += len(keys)
        keys += k
        pos += p
        held.append(w)
    w = np.concatenate(held)
    w = w[np.lexsort((w["g"], w["f"]))]
    same = (w["f"][1:] == w["f"][:-1]) & (w["g"][1:] == w["g"][:-1])
    w = w[(np.r_[False, same] | np.r_[same, False]) & (w["many"] == 0)]
    for r, a, b in _stretches(w):
        yield keys[r], pos[r] - b, pos[r] - a


def removed_runs(lo: np.ndarray, hi: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows starting from ``lo`` to ``hi``."""
    out: list[list[int]] = []
    for a, b in sorted(zip(lo.tolist(), (hi + length).tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = 400, hot: int = 4096, key: str = "doc_id", text: str = "text",
                   keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept bytes as ``kept`` if asked for)."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(_surveyed(docs, length, parts, key, text))
    d = rows.where("part is null").select("doc_id", "key", "n_bytes", "sha")
    shared = _shared_grams(rows, parts, hot).groupBy("key").agg(F.collect_list("v").alias("at"))
    own = docs.where(F.octet_length(text) >= length).select(F.unhex(F.md5(F.col(text).cast("binary"))).alias("key"), F.col(text).alias("text"))
    texts = stored(own.groupBy("key").agg(F.first("text").alias("text")).join(shared, "key"))
    marks = _marks(_runs(texts, length, parts), length, parts).groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("m"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, t, m in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), b.column(2), strict=True):
                m = m.values.flatten()
                gone = removed_runs(m[0].to_numpy(), m[1].to_numpy(), length)
                kept, at = [], 0
                for x, y in gone:
                    kept.append(t[at:x])
                    at = y
                left = b"".join([*kept, t[at:]])
                out.append((k, sum(y - x for x, y in gone), len(gone), hashlib.sha256(left).hexdigest(), left if keep_text else None))
            c = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.binary()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                                              pa.array(c[3], pa.string()), pa.array(c[4], pa.binary())], names=["key", "r", "s", "sha2", "kept"])

    done = texts.join(marks, "key").select("key", "text", "m").mapInArrow(cut, "key binary, r long, s long, sha2 string, kept binary")
    copies = d.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    out = d.join(done.join(copies, "key", "full"), "key").select(
        "doc_id", "key", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("r", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("s", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("sha2", "sha")).alias("kept_sha256"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
    if not keep_text:
        return out.drop("key", "kept")
    return out.withColumn("untouched", F.col("n_removed") == 0).drop("key")


def op4_suffix_runs(spark, sf_dir):
    return remove_repeats(documents(spark, sf_dir))
