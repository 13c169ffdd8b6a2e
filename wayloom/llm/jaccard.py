"""Jaccard join of word-shingle sets with skipping by set relations.

A set holds the distinct 5-word shingles of a text (64-bit hashes); equal texts are
one set. Sets are ordered with frequent shingles last (a counting table of
``cells`` cells over all shingles tells frequent ones; any order is correct), and
each is indexed under its prefix: two sets that link share a shingle there. Pairs of a
list are tested by size and position one by one; ``list_pairs``, which skips whole pairs
of blocks, is not used by the query.

Lists of up to ``short`` sets give all their pairs. In a longer list every set is
first compared with pivots of similar size only. After those answers are known and
joined into components, a long list is revisited: sets of one component need no
further comparison, and answers of the remaining pairs follow from those of the
components' roots where the triangle inequality of Jaccard distance decides them;
only undecided pairs are verified, exactly. No list, group or candidate is capped.

A task builds packed index parts, so one shuffled row holds thousands of entries.
Texts of candidate sets meet in salted groups of bounded size. Null and empty texts
have an empty set and link with nothing; repeated rows link by equal sets; a null
doc_id takes part but is never the smallest. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import as_bytes, documents, stored
from wayloom.llm.components import components

_G = np.random.default_rng(23)
_BYTE = _G.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = _G.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def shingles(texts: list[bytes], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each text's begin (one more than texts)."""
    joined = b"\n".join(texts).lower() + b"\n"
    x = np.frombuffer(joined, np.uint8)
    blank = _BLANK[x]
    edge = np.flatnonzero(np.diff(np.r_[True, blank].view(np.int8)))
    first, last = edge[::2], edge[1::2]
    up, down = _powers(len(x) + 1)
    p = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(_BYTE[x] * up[: len(x)], out=p[1:])
    h = mixed((p[last] - p[first]) * down[first] + (last - first).astype(np.uint64))
    size = np.array([len(t) + 1 for t in texts], np.int64)
    cuts = np.searchsorted(first, np.r_[0, np.cumsum(size)])  # words of each text
    count = np.diff(cuts)
    total = len(h)
    s = np.zeros(total, np.uint64)
    for k in range(min(n, total)):
        s[: total - k] += h[k:] * _MULT[k]
    text = np.repeat(np.arange(len(texts)), count)
    left = cuts[1:][text] - np.arange(total)  # words from here to the end of the text
    whole = left >= n
    for t in np.flatnonzero((count > 0) & (count < n)):  # the whole sequence is the only shingle
        a = cuts[t]
        s[a] = (h[a: a + count[t]] * _MULT[: count[t]]).sum(dtype=np.uint64) + np.uint64(count[t])
        whole[a] = True
    s, text = mixed(s[whole]), text[whole]
    begin = np.searchsorted(text, np.arange(len(texts) + 1))
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        s[a:b].sort()
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != s[:-1]) | (text[1:] != text[:-1])
    s, text = s[keep], text[keep]
    return s, np.searchsorted(text, np.arange(len(texts) + 1))


def in_parts(texts: list, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Stretches of about ``most`` bytes; a longer text is a stretch of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= most or i == len(texts) - 1:
            yield begin, i + 1
            begin, size = i + 1, 0


def least_overlap(n: int | np.ndarray, percent: int):
    """Fewest shared shingles of a set of ``n`` with any set it links to."""
    return -(-n * percent // 100)


def _measured(docs: DataFrame, cells: int, key: str, text: str) -> DataFrame:
    """Per document its set id and size, and per task the counting table in chunks."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.int64)
        names = ["doc_id", "id", "n", "sign", "chunk", "counts"]
        typ = None
        for b in batches:
            typ = b.column(0).type
            n = np.zeros(b.num_rows, np.int64)
            texts, signs = [t or b"" for t in as_bytes(b.column(2))], []
            for lo, hi in in_parts(texts):
                h, begin = shingles(texts[lo:hi])
                n[lo:hi] = np.diff(begin)
                signs += [signature(h[x:y]) for x, y in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
                np.add.at(counts, (h & np.uint64(cells - 1)).astype(np.int64), 1)
            none = pa.nulls(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), pa.array(signs, pa.binary()),
                                               none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        if typ is not None:
            at = [c for c in range(0, cells, CHUNK) if counts[c: c + CHUNK].any()]
            m = pa.nulls(len(at))
            yield pa.RecordBatch.from_arrays(
                [m.cast(typ), m.cast(pa.int64()), m.cast(pa.int64()), m.cast(pa.binary()), pa.array([c // CHUNK for c in at], pa.int32()),
                 pa.array([np.minimum(counts[c: c + CHUNK], 2**31 - 1).astype("<i4").tobytes() for c in at], pa.binary())], names=names)

    return docs.select(key, F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("id"), text).mapInArrow(
        run, f"doc_id {kind}, id long, n long, sign binary, chunk int, counts binary")


def frequent_cells(parts: DataFrame, cells: int, factor: float, extra: int) -> np.ndarray:
    """Packed bits of the cells that count over ``factor`` times the mean plus ``extra``."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for c, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(v, "<i4").astype(np.int64)
                sums[c] = sums[c] + x if c in sums else x
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["chunk", "counts"])

    rows = parts.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(add, "chunk int, counts binary").collect()
    total = np.zeros(cells, np.int64)
    for r in rows:
        total[r[0] * CHUNK: r[0] * CHUNK + len(r[1]) // 8] = np.frombuffer(r[1], np.int64)
    return np.packbits(total > factor * total.mean() + extra)


class Order:
    """Frequent shingles last, others by hash."""

    def __init__(self, bits: np.ndarray, cells: int):
        self.hot, self.cells = np.unpackbits(bits)[:cells].astype(bool), cells

    def ranked(self, s: np.ndarray) -> np.ndarray:
        """Numbers to sort shingles by; they tell shingles apart as the hashes do, but for one bit."""
        late = self.hot[(s & np.uint64(self.cells - 1)).astype(np.int64)]
        return (mixed(s) >> np.uint64(1)) | (late.astype(np.uint64) << np.uint64(63))


SIGNATURE = 1024
CHUNK = 1 << 10  # counting cells in a row


def signature(s: np.ndarray) -> bytes:
    """Bits set by the shingles; at least two bits for each, so that long sets are told apart as well."""
    m = max(SIGNATURE, 1 << (2 * len(s) - 1).bit_length()) if len(s) else SIGNATURE
    bits = np.zeros(m, bool)
    bits[((s >> np.uint64(32)) & np.uint64(m - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def most_common(na: int, sa: bytes, nb: int, sb: bytes) -> int:
    """Upper bound of what two sets share: a bit of one alone stands for at least one shingle of its own."""
    a, b = np.frombuffer(sa, np.uint8), np.frombuffer(sb, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2:]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2:]
    return min(na - int(np.bitwise_count(a & ~b).sum()), nb - int(np.bitwise_count(b & ~a).sum()))


ENTRY = np.dtype([("h", "<u4"), ("set", "<u4"), ("pos", "u1")])
SET = np.dtype([("id", "<i8"), ("n", "<u4"), ("first", "<u4")])


def _indexed(docs: DataFrame, bits: np.ndarray, cells: int, percent: int, parts: int, flush: int, text: str) -> DataFrame:
    """Packed index parts: part, sets, entries. Equal texts of a task are indexed once."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = Order(shared.value, cells), set()
        held: list[tuple] = []
        size = 0

        def pack():
            ids = np.array([(i, n, int(t[0] >> np.uint64(31)) & 0xFFFFFFFF) for i, n, t in held], SET)
            tok = np.concatenate([t for _, _, t in held])
            own = np.repeat(np.arange(len(held)), [len(t) for _, _, t in held])
            pos = np.concatenate([np.minimum(np.arange(len(t)), 255) for _, _, t in held])
            part = (tok % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[by], np.arange(parts + 1))
            rows = []
            for p in range(parts):
                at = by[cuts[p]: cuts[p + 1]]
                if len(at):
                    sets, local = np.unique(own[at], return_inverse=True)
                    e = np.empty(len(at), ENTRY)
                    e["h"], e["set"], e["pos"] = (tok[at] >> np.uint64(16)).astype(np.uint32), local, pos[at]
                    rows.append((p, ids[sets].tobytes(), e.tobytes()))
            p, s, e = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(s, pa.binary()), pa.array(e, pa.binary())], names=["part", "sets", "entries"])

        for b in batches:
            fresh = []
            for i, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                if t and i not in seen:
                    seen.add(i)
                    fresh.append((i, t))
            for lo, hi in in_parts([t for _, t in fresh]):
                h, begin = shingles([t for _, t in fresh[lo:hi]])
                r = order.ranked(h)
                for k, (x, y) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
                    if x < y:
                        r[x:y].sort()
                        held.append((fresh[lo + k][0], y - x, r[x: x + (y - x) - least_overlap(y - x, percent) + 1].copy()))
                        size += len(held[-1][2])
                if size >= flush:
                    yield pack()
                    held, size = [], 0
        if held:
            yield pack()

    return docs.select(F.xxhash64(text).alias("id"), text).mapInArrow(run, "part int, sets binary, entries binary")


def list_pairs(n: np.ndarray, pos: np.ndarray, percent: int, block: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a list (sorted by size) that sizes and positions allow; whole blocks are skipped first."""
    left, right = [], []
    rest = n - pos
    m = len(n)
    top = np.array([rest[i: i + block].max() for i in range(0, m, block)])
    for i in range(0, m, block):
        for j in range(i, m, block):
            if n[j] * percent > 100 * n[min(i + block, m) - 1]:
                break  # all later blocks hold larger sets
            if min(top[i // block], top[j // block]) * (100 + percent) < percent * (n[i] + n[j]):
                continue
            a, b = np.meshgrid(np.arange(i, min(i + block, m)), np.arange(j, min(j + block, m)), indexing="ij")
            ok = (a < b) & (n[b] * percent <= 100 * n[a]) & \
                (np.minimum(rest[a], rest[b]) * (100 + percent) >= percent * (n[a] + n[b]))
            left.append(a[ok])
            right.append(b[ok])
    none = np.zeros(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _answers(index: DataFrame, percent: int, short: int, parts: int) -> DataFrame:
    """Rows (part, h, a, b, n): candidate pairs with ``h`` null, and entries (a) of long lists with ``b`` null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for p, s, e in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.setdefault(p, []).append((np.frombuffer(s, SET), np.frombuffer(e, ENTRY)))
        for p, parts in held.items():
            ids = np.concatenate([s["id"] for s, _ in parts])
            n = np.concatenate([s["n"] for s, _ in parts]).astype(np.int64)
            first = np.concatenate([s["first"] for s, _ in parts])
            base = np.cumsum([0] + [len(s) for s, _ in parts])
            own = np.concatenate([e["set"].astype(np.int64) + k for (_, e), k in zip(parts, base, strict=False)])
            h = np.concatenate([e["h"] for _, e in parts])
            pos = np.concatenate([e["pos"] for _, e in parts]).astype(np.int64)
            by = np.lexsort((ids[own], n[own], h))
            h, own, pos = h[by], own[by], pos[by]
            keep = np.ones(len(h), bool)  # a text that several tasks indexed counts once
            keep[1:] = (h[1:] != h[:-1]) | (ids[own[1:]] != ids[own[:-1]])
            h, own, pos = h[keep], own[keep], pos[keep]
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            count = np.diff(np.r_[start, len(h)])
            got_a, got_b, long_at = [], [], []
            for m in np.unique(count[(count > 1) & (count <= short)]):
                at = start[count == m]
                i, j = np.triu_indices(m, 1)
                x, y = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
                got_a.append(x)
                got_b.append(y)
            for at, m in zip(start[count > short], count[count > short], strict=True):
                # pivots: one for every span of sizes that can link at all
                size = n[own[at: at + m]]
                pivot = np.empty(m, np.int64)
                lo = 0
                while lo < m:
                    hi = int(np.searchsorted(size, size[lo] * 100 / percent, side="right"))
                    pivot[lo:hi] = lo + (hi - lo) // 2
                    lo = hi
                got_a.append(at + pivot)
                got_b.append(at + np.arange(m))
                long_at.append(np.arange(at, at + m))
            if got_a:
                x, y = np.concatenate(got_a), np.concatenate(got_b)
                nx, ny = n[own[x]], n[own[y]]
                ok = (x != y) & (np.minimum(nx, ny) * 100 >= percent * np.maximum(nx, ny)) & \
                    (np.minimum(nx - pos[x], ny - pos[y]) * (100 + percent) >= percent * (nx + ny))
                # sets with the same first shingle meet in its list; other lists need not repeat the pair
                same = (first[own[x]] == first[own[y]]) & ~((pos[x] == 0) & (pos[y] == 0))
                listed = count[np.searchsorted(start, x, side="right") - 1]
                x, y = x[ok & ~(same & (listed <= short))], y[ok & ~(same & (listed <= short))]
                pairs = np.unique(np.stack([ids[own[x]], ids[own[y]]], axis=1), axis=0)
                if len(pairs):
                    yield _rows(p, None, pairs[:, 0], pairs[:, 1], None)
            if long_at:
                at = np.concatenate(long_at)
                yield _rows(p, h[at].astype(np.int64), ids[own[at]], None, n[own[at]], pos[at])

    packed = index.repartition(parts, "part")
    return packed.mapInArrow(run, "part int, h long, a long, b long, n long, pos long")


def _rows(part, h, a, b, n, pos=None) -> pa.RecordBatch:
    opt = lambda v: pa.nulls(len(a), pa.int64()) if v is None else pa.array(np.asarray(v, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), part, np.int32)), opt(h), pa.array(a), opt(b), opt(n), opt(pos)],
                                      names=["part", "h", "a", "b", "n", "pos"])


def _possible(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs that bit signatures do not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [most_common(na, sa, nb, sb) * (100 + percent) >= percent * (na + nb)
                    for na, sa, nb, sb in zip(*(b.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = pairs.join(signs.selectExpr("id as a", "n as na", "sign as sa"), "a").join(signs.selectExpr("id as b", "n as nb", "sign as sb"), "b")
    return met.select("a", "b", "na", "sa", "nb", "sb").mapInArrow(run, "a long, b long")


def overlaps(pairs: DataFrame, texts: DataFrame, group: int = 256) -> DataFrame:
    """a, b, na, nb, both of each pair, from the texts; a pivot with many partners is dealt over salted groups."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / group).alias("salts"))
    dealt = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    left = dealt.select("a", "salt").distinct().join(texts, F.col("a") == F.col("id")).select(
        "a", "salt", F.lit(None).cast("long").alias("b"), "text")
    right = dealt.join(texts, F.col("b") == F.col("id")).select("a", "salt", "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own = None, None
        for batch in batches:
            out = []
            a, salt, b = (batch.column(k).to_pylist() for k in range(3))
            texts = as_bytes(batch.column(3))
            for lo, hi in in_parts(texts):
                h, begin = shingles(texts[lo:hi])
                for k in range(lo, hi):
                    z = h[begin[k - lo]: begin[k - lo + 1]]
                    if b[k] is None:
                        here, own = (a[k], salt[k]), z.copy()
                    elif here == (a[k], salt[k]):
                        at = np.minimum(np.searchsorted(own, z), len(own) - 1)
                        out.append((a[k], b[k], len(own), len(z), int((own[at] == z).sum())))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["a", "b", "na", "nb", "both"])

    met = left.union(right).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return met.select("a", "salt", "b", "text").mapInArrow(run, "a long, b long, na long, nb long, both long")


def _linked(percent: int) -> Column:
    return F.col("both") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("both"))


def _revisited(long: DataFrame, roots: DataFrame, signs: DataFrame, docs: DataFrame, percent: int, text: str) -> DataFrame | None:
    """Pairs (a, b) of long lists in different components that no known answer decides."""
    e = long.join(roots, F.col("a") == F.col("id"), "left").select(
        "part", "h", F.col("a").alias("id"), "n", "pos", F.coalesce("root", "a").alias("root"))
    several = e.groupBy("part", "h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("part", "h")
    e = stored(e.join(several, ["part", "h"]))
    if e.isEmpty():
        return None
    x, y = e.alias("x"), e.alias("y")
    rest = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    pairs = x.join(y, (F.col("x.part") == F.col("y.part")) & (F.col("x.h") == F.col("y.h")) & (F.col("x.id") < F.col("y.id"))
                   & (F.col("x.root") != F.col("y.root")) & (F.least("x.n", "y.n") * 100 >= percent * F.greatest("x.n", "y.n"))
                   & (rest * (100 + percent) >= percent * (F.col("x.n") + F.col("y.n"))))
    pairs = pairs.selectExpr("x.id as a", "y.id as b", "x.root as p", "y.root as q").distinct()
    pairs = stored(pairs.join(_possible(pairs.select("a", "b").distinct(), signs, percent), ["a", "b"]))
    if pairs.isEmpty():
        return None
    e = pairs.selectExpr("p as root", "a as id").union(pairs.selectExpr("q", "b"))
    wanted = pairs.selectExpr("p as a", "q as b").union(e.selectExpr("root as a", "id as b").where("a != b"))
    far = 1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))
    wanted = stored(wanted.distinct())
    known = stored(overlaps(wanted, _texts_of(docs, wanted, text)).select("a", "b", far.alias("d")))
    own = known.selectExpr("a as r", "b as i", "d as away")
    near = pairs.join(known.selectExpr("a as p", "b as q", "d"), ["p", "q"], "left")
    for side, root in (("a", "p"), ("b", "q")):
        k = own.selectExpr(f"r as {root}", f"i as {side}", f"away as away_{side}")
        near = near.join(k, [root, side], "left")
    slack = F.col("d") - F.coalesce("away_a", F.lit(0.0)) - F.coalesce("away_b", F.lit(0.0))
    return stored(near.where(F.coalesce(slack, F.lit(0.0)) <= 1 - percent / 100 + 1e-9).select("a", "b").distinct())


def _texts_of(docs: DataFrame, pairs: DataFrame, text: str) -> DataFrame:
    """Each text of a pair once, by set id."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    own = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("id"), F.col(text).alias("text"))
    return stored(own.groupBy("id").agg(F.first("text").alias("text")).join(ids, "id"))


def near_duplicates(docs: DataFrame, percent: int = 75, short: int = 48, cells: int = 1 << 20, hot_factor: float = 2.0,
                    hot_extra: int = 256, flush: int = 1 << 21, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, id (set), root (smallest set id of the component), n_shingles, component_id of every document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(_measured(docs, cells, key, text))
    signs = rows.where("chunk is null").select("id", "n", "sign").dropDuplicates(["id"])
    bits = frequent_cells(rows, cells, hot_factor, hot_extra)
    found = stored(_answers(_indexed(docs, bits, cells, percent, parts, flush, text), percent, short, parts))
    pairs = found.where("b is not null").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a", "b").groupBy(
        "x", "y").agg(F.min(F.struct("a", "b")).alias("p")).select("p.*")
    pairs = stored(_possible(pairs, signs, percent))
    long = found.where("b is null")
    links = stored(overlaps(pairs, _texts_of(docs, pairs, text)).where(_linked(percent)).select("a", "b"))
    roots = stored(components(links))
    more = _revisited(long, roots, signs, docs, percent, text) if not long.isEmpty() else None
    if more is not None:
        extra = overlaps(more, _texts_of(docs, more, text)).where(_linked(percent)).select("a", "b")
        roots = stored(components(links.union(extra)))
    d = rows.where("chunk is null").select("doc_id", "id", F.col("n").alias("n_shingles"))
    own = d.where("n_shingles > 0").groupBy("id").agg(F.min("doc_id").alias("least")).join(roots, "id", "left").select(
        "id", "least", F.coalesce("root", "id").alias("root"))
    best = own.groupBy("root").agg(F.min("least").alias("component_id"))
    of = own.join(best, "root").select("id", "root", "component_id")
    return d.join(of, "id", "left").select("doc_id", "id", "root", "n_shingles", F.when(
        F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op6_shingle_join(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS h FROM s),
common AS (SELECT h FROM e GROUP BY h HAVING count(*) > 1),
k AS (SELECT * FROM e JOIN common USING (h)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS c FROM k a JOIN k b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY ALL HAVING 100 * c >= 75 * (na + nb - c)),
r(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.m AS component_id FROM s JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) c ON c.a = s.doc_id
"""
