"""Benchmark decontamination by CGK embedding and bit sampling.

Texts and items are word sequences (A-Z in lower case, ASCII punctuation as blanks).
A random walk copies a sequence into a longer string: step ``j`` writes the word
at the pointer and moves on if a random bit of (step, word) says so. Two sequences
at small edit distance so get strings at small Hamming distance. A repetition draws
its own bits and a few steps; windows that agree with an item in those steps are
candidates. Windows start at every word of a text and are sized by class of item
length. Steps are compared one after the other, and windows that no item can match
leave the walk at once. The number of repetitions of a class is raised until ``recall`` of
its items are found again amid other words with as many edits as are accepted (every item is
measured when the index is built; it is an error if that fails). Candidates are verified by exact edit distance on words:
at most ``max_rate`` of the item's words.

Words outside the benchmark are one symbol, which only brings sequences closer;
verification uses the true words. Items are indexed in blocks of ``block_bytes`` of
text, each block being one pass over all documents, so what a task holds is bounded.

One row per document and item found: doc_id, item_id, start and end (words), distance,
item_words. Null or empty texts and items match nothing; repeated rows are treated
alike; null keys stay null; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayloom.llm.common import as_bytes, documents

_PUNCT = b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""
_TABLE = bytes(32 if c in _PUNCT else c + 32 if 65 <= c <= 90 else c for c in range(256))


def word_list(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def edit_distance(item: list[bytes], window: list[bytes], most: int) -> tuple[int, int]:
    """Distance of ``item`` to the best prefix of ``window``, and that prefix's length; ``most + 1`` if above ``most``."""
    n = len(window)
    code = {w: i for i, w in enumerate(dict.fromkeys(item))}
    x = np.array([code.get(w, -1) for w in window], np.int32)
    ramp = np.arange(n + 1)
    row = ramp.copy()
    for i, w in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (x != code[w]))
        row = np.minimum.accumulate(new - ramp) + ramp
        if row.min() > most:
            return most + 1, 0
    end = int(row.argmin())
    return int(row[end]), end


class Index:
    """Items of one block: symbols, and per repetition and length class the sampled steps as a trie."""

    END, OTHER = 0, 1

    def __init__(self, items: list[tuple[int, list[bytes]]], max_rate: float, recall: float,
                 samples: int = 3, most_repeats: int = 200, seed: int = 5):
        self.items = [(i, w) for i, w in items if w]
        self.max_rate = max_rate
        self.vocab = {w: n for n, w in enumerate(sorted({w for _, ws in self.items for w in ws}), 2)}
        self.coded = [np.array([self.vocab[w] for w in ws] + [self.END], np.int32) for _, ws in self.items]
        wide = len(self.vocab) + 2
        self.member = np.unique(np.concatenate([n * wide + c[:-1].astype(np.int64) for n, c in enumerate(self.coded)] or [[0]]))
        self.classes: dict[int, list[int]] = {}
        for n, (_, ws) in enumerate(self.items):
            self.classes.setdefault(len(ws).bit_length() - 1, []).append(n)
        g = np.random.default_rng(seed)
        self.tables: list[tuple[int, np.ndarray, np.ndarray, list]] = []  # class, bits, steps, trie
        for c, members in sorted(self.classes.items()):
            probes = [n for n in members for _ in range(max(1, 1000 // len(members)))]
            ids, begin, inside = self._probes(probes, g)
            missed = np.ones(len(probes), bool)
            for _ in range(most_repeats):
                bits = g.integers(0, 2**63, len(self.vocab) + 2, dtype=np.uint64)
                m = 1 << c
                span = max(1, m + m // 2)
                first = int(g.integers(0, min(span, 3)))  # early, so that few walks go on, but not always the first word, which may be edited
                rest = g.choice(np.arange(first + 1, span), min(samples - 1, span - first - 1), replace=False) if span > first + 1 else []
                steps = np.sort(np.array([first, *rest], np.int64))
                table = (c, bits, steps, self._trie(members, bits, steps))
                self.tables.append(table)
                at, n = self._hits(table, ids, inside[missed[np.searchsorted(begin, inside, side="right") - 1]])
                k = np.searchsorted(begin, at, side="right") - 1
                for i in np.flatnonzero(n == np.array(probes)[k]).tolist():
                    if missed[k[i]]:
                        item = self.coded[n[i]][:-1].tolist()
                        most = int(max_rate * len(item))
                        missed[k[i]] = edit_distance(item, ids[at[i]: at[i] + len(item) + most].tolist(), most)[0] > most
                if missed.sum() <= (1 - recall) * len(probes):
                    break
            else:
                raise ValueError(f"items of {1 << c} words or more: recall {recall} not reached in {most_repeats} repetitions")

    def _probes(self, members: list[int], g) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items with as many edits as are accepted, amid other words: words, where each probe begins, places to search."""
        ids, begin, inside, at = [], [], [], 0
        for n in members:
            item = self.coded[n][:-1]
            pad = [self.OTHER] * (int(self.max_rate * len(item)) + 1)
            part = [*pad, *self._edited(item, self.max_rate, g), *pad, *pad, self.END]
            begin.append(at)
            inside.append(at + np.arange(2 * len(pad)))
            ids += part
            at += len(part)
        return np.array(ids, np.int32), np.array(begin), np.concatenate(inside)

    def _edited(self, ids: np.ndarray, rate: float, g) -> np.ndarray:
        out = list(ids)
        for _ in range(int(rate * len(ids))):
            at = int(g.integers(0, len(out)))
            kind = int(g.integers(0, 3))
            if kind == 0:
                out[at] = self.OTHER
            elif kind == 1 and len(out) > 1:
                del out[at]
            else:
                out.insert(at, self.OTHER)
        return np.array(out, np.int32)

    @staticmethod
    def _bit(bits: np.ndarray, ids: np.ndarray, j: int) -> np.ndarray:
        b = bits[ids]
        if j >= 64:  # more steps than bits of a word's hash: mix once for every 64
            b = (b + np.uint64(j // 64)) * np.uint64(0x9E3779B97F4A7C15)
            b ^= b >> np.uint64(29)
        return ((b >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64) * (ids != 0)

    def _trie(self, members: list[int], bits: np.ndarray, steps: np.ndarray) -> list:
        """Per level the sorted codes ``state * symbols + symbol``; the last state lists its items."""
        width, state = len(self.vocab) + 2, np.zeros(len(members), np.int64)
        read = np.array([self._walk(self.coded[n], bits, steps) for n in members], np.int64).reshape(len(members), -1)
        levels = []
        for s in range(len(steps)):
            codes, state = np.unique(state * width + read[:, s], return_inverse=True)
            levels.append(codes)
        return [levels, [np.array(members)[state == k] for k in range(len(levels[-1]))]]

    def _walk(self, ids: np.ndarray, bits: np.ndarray, steps: np.ndarray) -> list[int]:
        p, out, want = 0, [], set(steps.tolist())
        for j in range(int(steps[-1]) + 1):
            if j in want:
                out.append(int(ids[p]))
            p += int(self._bit(bits, ids[p: p + 1], j)[0])
        return out

    def _hits(self, table, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and items that agree in all sampled steps of one repetition."""
        _, bits, steps, (levels, items) = table
        width = len(self.vocab) + 2
        p, kept, state, j = starts, starts, np.zeros(len(starts), np.int64), 0
        for s, step in enumerate(steps.tolist()):
            for at in range(j, step):
                p = p + self._bit(bits, ids[p], at)
            j = step
            code = state * width + ids[p]
            k = np.searchsorted(levels[s], code)
            ok = levels[s][np.minimum(k, len(levels[s]) - 1)] == code
            p, kept, state = p[ok], kept[ok], k[ok]
            if not len(p):
                break
        n = np.array([len(i) for i in items])
        return np.repeat(kept, n[state]), np.concatenate([items[s] for s in state]) if len(state) else np.zeros(0, np.int64)

    def search(self, texts: list[list[bytes]]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, end, distance): the nearest window of every item found in a text."""
        get = self.vocab.get
        ids = np.array([c for ws in texts for c in (*[get(w, 1) for w in ws], 0)], np.int32)
        size = np.array([len(ws) + 1 for ws in texts])
        begin = np.cumsum(size) - size
        known = np.concatenate([[0], np.cumsum(ids > 1)])
        pairs: set[tuple[int, int]] = set()
        every = np.arange(len(ids), dtype=np.int64)
        for c, members in self.classes.items():
            longest = max(len(self.items[n][1]) for n in members)
            m = 1 << c
            need = m - int(self.max_rate * longest)  # a window near an item has that many known words up front
            starts = every[(ids != 0) & (known[np.minimum(every + m, len(ids))] - known[:-1] >= need)]
            for table in self.tables:
                if table[0] == c and len(starts):
                    a, n = self._hits(table, ids, starts)
                    pairs.update(zip(a.tolist(), n.tolist(), strict=True))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        bags: dict[int, Counter] = {}
        for a, n in self._plausible(ids, sorted(pairs)):
            t = int(np.searchsorted(begin, a, side="right")) - 1
            item = self.items[n][1]
            most = int(self.max_rate * len(item))
            window = texts[t][a - begin[t]: a - begin[t] + len(item) + most]
            bag = bags.setdefault(n, Counter(item))
            if sum((bag & Counter(window)).values()) < len(item) - most:
                continue
            d, end = (0, len(item)) if window[: len(item)] == item else edit_distance(item, window, most)
            if d <= most:
                at = int(a - begin[t])
                best[t, n] = min(best.get((t, n), (d, at, at + end)), (d, at, at + end))
        return [(t, n, at, end, d) for (t, n), (d, at, end) in sorted(best.items())]


    def _plausible(self, ids: np.ndarray, pairs: list[tuple[int, int]], chunk: int = 4096) -> list[tuple[int, int]]:
        """Pairs whose window holds enough words of the item; counts never fall short, so no match is lost."""
        out, wide = [], len(self.vocab) + 2
        size = np.array([len(w) for _, w in self.items])
        for c in range(0, len(pairs), chunk):
            a, n = np.array(pairs[c: c + chunk], np.int64).T
            most = (self.max_rate * size[n]).astype(np.int64)
            step = np.arange(int((size[n] + most).max()))
            code = n[:, None] * wide + ids[np.minimum(a[:, None] + step, len(ids) - 1)]
            k = np.minimum(np.searchsorted(self.member, code), len(self.member) - 1)
            there = (self.member[k] == code) & (step < (size[n] + most)[:, None])
            out += [pairs[c + i] for i in np.flatnonzero(there.sum(axis=1) >= size[n] - most)]
        return out


def contaminated(docs: DataFrame, benchmark: DataFrame, max_rate: float = 0.2, recall: float = 0.97,
                 block_bytes: int = 1 << 25, chunk_words: int = 1 << 18,
                 key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Places of benchmark items in documents, one row per document and item."""
    spark = docs.sparkSession
    items = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_key).cast("long").alias("i"), F.col(item_text).alias("t"))
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, start long, `end` long, distance long, item_words long"
    names = ["doc_id", "item_id", "start", "end", "distance", "item_words"]
    blocks, out = int(total // block_bytes) + 1, None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == k).collect()
        index = Index(sorted((-1 if r["i"] is None else r["i"], word_list(r["t"].encode())) for r in rows), max_rate, recall)
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value

            def found(part, where):
                hits = index.search(part)
                at = pa.array([where[t] for t, *_ in hits], pa.int64())
                ids = pa.array([None if index.items[n][0] < 0 else index.items[n][0] for _, n, *_ in hits], pa.int64())
                cols = list(zip(*[(a, e, d, len(index.items[n][1])) for _, n, a, e, d in hits], strict=True)) or [()] * 4
                return at, [ids, *[pa.array(c, pa.int64()) for c in cols]]

            for b in batches:
                part, where, size = [], [], 0
                for i, t in enumerate(as_bytes(b.column(1))):
                    if t:
                        part.append(word_list(t))
                        where.append(i)
                        size += len(part[-1])
                    if part and (size >= chunk_words or i == b.num_rows - 1):
                        at, cols = found(part, where)
                        yield pa.RecordBatch.from_arrays([b.column(0).take(at), *cols], names=names)
                        part, where, size = [], [], 0
                if part:
                    at, cols = found(part, where)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(at), *cols], names=names)

        one = docs.select(key, text).mapInArrow(run, schema)
        out = one if out is None else out.union(one)
    return out


def op2_cgk_windows(spark, sf_dir):
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
