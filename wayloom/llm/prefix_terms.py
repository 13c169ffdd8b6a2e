"""Divergence between sources by terms, whose vocabulary is found by iceberg prefix refinement.

Terms are the matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower case. A
language keeps the terms that at least ``least`` of its documents hold. They are found
level by level on byte prefixes of growing length (``levels``, then eight times as
long each): a prefix held by fewer documents cannot begin a kept term, so it is dropped
and nothing that starts with it is counted at a later level. A term shorter than
the level is complete and is counted with its occurrences per source. Documents are packed
once (terms by number, and how often each document holds them); a level is one pass over
that, and the last is the one after which no prefix is left.

Documents are additive: a task counts each (language, prefix) once per document that it
reads and sends sums by hash range, so no prefix, language or source gathers in one task. The
prefixes left over go back to the tasks as a bit table of ``2**table_bits`` bits whatever
their number; two that share a bit only leave a prefix to be dropped at a later level, for the
last word is always the exact count.

Scores are whole numbers. The sum over all kept terms of one source's score against
another's splits into what both lack (one product), what one has (from how many terms occur
how often) and a correction for terms that both have, summed in numpy per task; so the work
follows the counts that occur, not terms x sources x sources. The result itself has a row
for every two sources of a language.

Null text, lang and source are ''. Every row is a document (repeated rows count each);
empty tables give no rows; other columns are ignored. Each sum stays exact as long as
one group has fewer than 9 * 10**15 occurrences.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayloom.llm.common import as_bytes, documents, stored

_TERM = bytes(c if c >= 0x80 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
LEVELS = (4, 8, 16, 32)
SCALE = 1_000_000_000
_KEPT = "lang string, source string, term binary, n long, nl long, once boolean"


def terms(text: bytes | None) -> list[bytes]:
    """Bytes of code points from U+0080 on belong to terms, as do letters; all else parts them."""
    return text.translate(_TERM).split() if text else []


class _Numbered(dict):
    """Numbers values in the order they come."""

    def __missing__(self, value) -> int:
        self[value] = n = len(self)
        return n


def _packed(docs: DataFrame, unit_words: int = 1 << 19) -> DataFrame:
    """Documents as units of about ``unit_words`` words: the terms, and per document which it holds how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, groups = _Numbered(), _Numbered()
        ids: list[np.ndarray] = []
        sizes: list[int] = []
        own: list[int] = []
        held = 0

        def unit():
            names, n = sorted(number), max(len(number), 1)  # in order, so what begins alike stands together
            place = np.empty(n, np.int64)
            place[np.fromiter(map(number.__getitem__, names), np.int64, n)] = np.arange(n)
            x = place[np.concatenate(ids)]
            pair, count = np.unique(np.repeat(np.arange(len(sizes)), sizes) * n + x, return_counts=True)
            doc, x = pair // n, pair % n
            per = np.bincount(doc, minlength=len(sizes))
            step = np.diff(x, prepend=0)
            first = np.cumsum(per) - per
            step[first] = x[first]
            fits = np.uint16 if step.max() < 1 << 16 else np.uint32
            many = np.flatnonzero(count > 255)
            data = (b"\0".join(names), list(groups), np.array(own, np.uint32).tobytes(), per.astype(np.uint32).tobytes(),
                    np.dtype(fits).str, step.astype(fits).tobytes(), np.minimum(count, 255).astype(np.uint8).tobytes(), many.tobytes(), count[many].tobytes())
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(data)], pa.binary())], names=["unit"])

        for b in batches:
            for t, lang, source in zip(as_bytes(b.column(0)), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = terms(t)
                if words:
                    ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                    sizes.append(len(words))
                    own.append(groups[lang, source])
                    held += len(words)
                if held >= unit_words:
                    yield unit()
                    number, groups, ids, sizes, own, held = _Numbered(), _Numbered(), [], [], [], 0
        if ids:
            yield unit()

    return docs.mapInArrow(run, "unit binary")


class _Unit:
    """One unit, opened: terms, groups, and arrays of (document, term, count)."""

    def __init__(self, data: bytes):
        words, self.groups, own, per, kind, step, count, many, more = pickle.loads(data)
        self.terms = words.split(b"\0")
        per = np.frombuffer(per, np.uint32).astype(np.int64)
        self.doc = np.repeat(np.arange(len(per)), per)
        x = np.cumsum(np.frombuffer(step, kind).astype(np.int64))
        start = np.cumsum(per) - per
        # sums ran on over documents: take off what stood before each one's first term
        lead = np.where(start > 0, x[np.maximum(start - 1, 0)], 0)
        self.term = x - lead[self.doc]
        self.count = np.frombuffer(count, np.uint8).astype(np.int64)
        self.count[np.frombuffer(many, np.int64)] = np.frombuffer(more, np.int64)
        group = np.frombuffer(own, np.uint32)[self.doc]
        names = _Numbered()
        self.lang = np.array([names[g[0]] for g in self.groups], np.int64)[group]
        self.group, self.langs = group.astype(np.int64), list(names)


def _at_level(units: DataFrame, done: int, size: int, bits: np.ndarray | None, parts: int) -> DataFrame:
    """part, data: per language and hash range the prefixes of ``size`` bytes and the complete terms shorter than that.

    Words shorter than ``done`` were complete before; others count if their first ``done`` bytes are left.
    """
    shared = units.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            for data in b.column(0).to_pylist():
                u = _Unit(data)
                n, length = len(u.terms), np.array([len(w) for w in u.terms], np.int64)
                live = length[u.term] >= done
                doc, term, count, group, lang = (v[live] for v in (u.doc, u.term, u.count, u.group, u.lang))
                if table is not None and len(term):
                    pair = lang * n + term
                    there = np.zeros(len(u.langs) * n, bool)
                    there[pair] = True
                    seen = np.flatnonzero(there)
                    start = [v.encode() + b"\0" for v in u.langs]
                    h = np.fromiter((zlib.crc32(start[k // n] + u.terms[k % n][:done]) for k in seen.tolist()), np.int64, len(seen)) & (len(table) * 8 - 1)
                    there[seen] = (table[h >> 3] >> (h & 7).astype(np.uint8)) & 1
                    ok = there[pair]
                    doc, term, count, group, lang = (v[ok] for v in (doc, term, count, group, lang))
                rows: dict[int, list] = {}
                short = length[term] < size

                def deal(kind, code, keys, docs, entries=None):
                    """One piece per hash range: keys of a language with their documents, and per key what each group has."""
                    start = zlib.crc32(u.langs[code].encode() + b"\0")
                    part = np.fromiter((zlib.crc32(k, start) for k in keys), np.int64, len(keys)) % parts
                    by = np.argsort(part, kind="stable")
                    used, cuts = np.unique(part[by], return_index=True)
                    cuts = [*cuts.tolist(), len(by)]
                    keys, docs = [keys[k] for k in by.tolist()], docs[by].astype(np.int64)
                    if entries is not None:
                        first, names, groups, many = entries
                        per = first[by + 1] - first[by]
                        ends = np.cumsum(per)
                        flat = np.repeat(first[by] - (ends - per), per) + np.arange(ends[-1])
                        groups, many, per = groups[flat].astype(np.uint32), many[flat], per.astype(np.uint32)
                        many = many.astype(np.uint32) if many.max() < 1 << 32 else many
                        ends = [0, *ends.tolist()]
                    for p, lo, hi in zip(used.tolist(), cuts, cuts[1:]):  # noqa: B905
                        more = None
                        if entries is not None:
                            x, y = ends[lo], ends[hi]
                            more = (per[lo:hi].tobytes(), names, groups[x:y].tobytes(), many.dtype.str, many[x:y].tobytes())
                        rows.setdefault(p, []).append((kind, u.langs[code], keys[lo:hi], docs[lo:hi].tobytes(), more))

                def numbered(values, most):
                    """Distinct values in order, and each value's number."""
                    there = np.zeros(most, bool)
                    there[values] = True
                    ids = np.flatnonzero(there)
                    at = np.zeros(most, np.int64)
                    at[ids] = np.arange(len(ids))
                    return ids, at[values]

                for code in range(len(u.langs)):
                    mine = lang == code
                    here = short & mine
                    if here.any():
                        ids, at = numbered(term[here], n)
                        own, g = numbered(group[here], len(u.groups))
                        pair = at * len(own) + g
                        if len(ids) * len(own) <= 16 * len(pair):
                            many = np.bincount(pair, count[here], len(ids) * len(own)).astype(np.int64)
                            pair = np.flatnonzero(many)
                            many = many[pair]
                        else:
                            pair, back = np.unique(pair, return_inverse=True)
                            many = np.bincount(back, count[here]).astype(np.int64)
                        deal(1, code, [u.terms[k] for k in ids.tolist()], np.bincount(at),
                             (np.searchsorted(pair, np.arange(len(ids) + 1) * len(own)), [u.groups[k][1] for k in own.tolist()], pair % len(own), many))
                    here = ~short & mine
                    if here.any():
                        ids, at = numbered(term[here], n)
                        number = _Numbered()
                        key = np.array([number[u.terms[k][:size]] for k in ids.tolist()], np.int64)[at]
                        d = doc[here]
                        first = np.r_[True, (d[1:] != d[:-1]) | (key[1:] != key[:-1])]  # terms in order: one prefix stands together
                        deal(0, code, list(number), np.bincount(key[first], minlength=len(number)))
                p = list(rows)
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array([pickle.dumps(rows[k]) for k in p], pa.binary())], names=["part", "data"])

    return units.mapInArrow(run, "part int, data binary")


class _Range:
    """Sums over one hash range."""

    def __init__(self):
        self.prefixes: dict[tuple[str, bytes], int] = {}
        self.number, self.sources = _Numbered(), _Numbered()
        self.docs: list[tuple] = []
        self.sums: list[tuple] = []
        self.held = 0

    def add(self, kind: int, lang: str, keys: list[bytes], docs: np.ndarray, more) -> None:
        if kind == 0:
            for k, d in zip(keys, docs.tolist(), strict=True):
                self.prefixes[lang, k] = self.prefixes.get((lang, k), 0) + d
            return
        at = np.array([self.number[lang, k] for k in keys], np.int64)
        per, names, g, kind_n, n = more
        code = np.array([self.sources[s] for s in names], np.int64)[np.frombuffer(g, np.uint32)]
        self.docs.append((at, docs))
        self.sums.append((np.repeat(at, np.frombuffer(per, np.uint32)), code, np.frombuffer(n, kind_n).astype(np.int64)))
        self.held += len(code)
        if self.held >= 1 << 22:
            self.fold()

    def fold(self) -> None:
        if not self.sums:
            return
        t, s, n = (np.concatenate(c) for c in zip(*self.sums, strict=True))
        wide = len(self.sources)
        pair, at = np.unique(t * wide + s, return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, at, n)
        self.sums, self.held = [(pair // wide, pair % wide, total)], 0
        a, d = (np.concatenate(c) for c in zip(*self.docs, strict=True))
        docs = np.zeros(len(self.number), np.int64)
        np.add.at(docs, a, d)
        self.docs = [(np.arange(len(docs)), docs)]

    def kept(self, least: int) -> list[list]:
        """Columns of ``_KEPT`` for terms that enough documents hold."""
        self.fold()
        if not self.sums:
            return [[], [], [], [], [], []]
        t, s, n = self.sums[0]
        whole = np.zeros(len(self.number), np.int64)
        np.add.at(whole, t, n)
        ok = self.docs[0][1][t] >= least
        t, s, n = t[ok], s[ok], n[ok]
        keys, names = list(self.number), list(self.sources)
        once = np.diff(t, prepend=-1) != 0
        return [[keys[k][0] for k in t.tolist()], [names[k] for k in s.tolist()], [keys[k][1] for k in t.tolist()], n, whole[t], once]


def _merged(rows: DataFrame, least: int, table_bits: int, parts: int) -> DataFrame:
    """Kept terms (columns of ``_KEPT``), and as ``at`` and ``v`` the bits of prefixes that are left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[int, _Range] = {}
        for b in batches:
            for p, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                into = ranges.setdefault(p, _Range())
                for kind, lang, keys, docs, more in pickle.loads(data):
                    into.add(kind, lang, keys, np.frombuffer(docs, np.int64), more)
        for r in ranges.values():
            lang, source, term, n, nl, once = r.kept(least)
            k = len(lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()), pa.array(n, pa.int64()), pa.array(nl, pa.int64()),
                 pa.array(once, pa.bool_()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], names=names)
            h = np.array([zlib.crc32(lang.encode() + b"\0" + key) for (lang, key), d in r.prefixes.items() if d >= least], np.int64) & ((1 << table_bits) - 1)
            at, place = np.unique(h >> 6, return_inverse=True)
            v = np.zeros(len(at), np.uint64)
            np.bitwise_or.at(v, place, np.uint64(1) << (h & 63).astype(np.uint64))
            none = pa.nulls(len(at))
            yield pa.RecordBatch.from_arrays(
                [none.cast(pa.string()), none.cast(pa.string()), none.cast(pa.binary()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.bool_()),
                 pa.array(at), pa.array(v.view(np.int64))], names=names)

    names = ["lang", "source", "term", "n", "nl", "once", "at", "v"]
    return rows.repartition(parts, "part").mapInArrow(run, _KEPT + ", at long, v long")


def _bit_table(rows: DataFrame, table_bits: int) -> np.ndarray | None:
    """The bits of all hash ranges as bytes; None if there are none."""
    got = rows.where("at is not null").groupBy("at").agg(F.bit_or("v").alias("v")).toArrow()
    if not got.num_rows:
        return None
    out = np.zeros(1 << (table_bits - 6), np.int64)
    out[got["at"].to_numpy()] = got["v"].to_numpy()
    return out.view(np.uint8)


def _in_small_batches(spark, job: Callable[[], DataFrame], rows: int = 500) -> DataFrame:
    """Run ``job`` with fewer rows to an Arrow batch, so that batches of long texts take less room beside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(was)) if int(was) > 0 else rows))
    try:
        return job()
    finally:
        spark.conf.set(name, was)


def kept_terms(docs: DataFrame, least: int = 3, levels: tuple[int, ...] = LEVELS, table_bits: int = 26, unit_words: int = 1 << 19) -> DataFrame:
    """lang, source, term (binary), n, n of the language (nl), once (true in one row of a term): kept terms where they occur."""
    if not 6 < table_bits <= 32:
        raise ValueError("table_bits must be from 7 to 32")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = _in_small_batches(docs.sparkSession, lambda: stored(_packed(docs, unit_words)))
    done, bits, k, out = 0, None, 0, None
    while k == 0 or bits is not None:
        size = levels[k] if k < len(levels) else done * 8
        rows = stored(_merged(_at_level(units, done, size, bits, parts), least, table_bits, parts))
        kept = rows.where("at is null").drop("at", "v")
        out = kept if out is None else out.union(kept)
        done, bits, k = size, _bit_table(rows, table_bits), k + 1
    return out


def _share(n: Column | str, total: Column | str) -> Column:
    """1 + floor(SCALE * (n + 1) / total), exactly; null for a total of 0."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (n, total))
    return 1 + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (a + 1).cast("decimal(19,0)"), F.nullif(b, F.lit(0)).cast("decimal(19,0)"))


def _score(p: str, q: str) -> Column:
    return F.call_function("div", (F.col(p) - F.col(q)) * (F.col(p) - F.col(q)), F.col(q))


def shared_corrections(rows: DataFrame, step: int = 1 << 20, most: int = 1 << 22) -> DataFrame:
    """lang, a, b, v over terms that both sources have: score less the scores with one or both counted as absent.

    ``rows``: lang and a list of (source, p, p0) per term.  A task works on ``step`` pairs at a time and sends its
    sums when they are of ``most`` pairs, so a term in very many sources needs no more room than others.
    """
    def f(p, q):
        return (p - q) * (p - q) // q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, names = _Numbered(), _Numbered()
        held: list[tuple[np.ndarray, np.ndarray]] = []  # (language, a, b) as one number, and sums
        wide = 1 << 20

        def fold():
            code, back = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            v = np.zeros(len(code), np.int64)
            np.add.at(v, back, np.concatenate([x for _, x in held]))
            held[:] = [(code, v)]

        def sent():
            fold()
            code, v = held.pop()
            lang, source = np.array(list(langs), object), np.array(list(names), object)
            return pa.RecordBatch.from_arrays([pa.array(lang[code // wide // wide], pa.string()), pa.array(source[code // wide % wide], pa.string()),
                                               pa.array(source[code % wide], pa.string()), pa.array(v)], names=["lang", "a", "b", "v"])

        for b in batches:
            lists = b.column(1)
            per = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            source = flat.field("source").dictionary_encode()
            code = np.array([names[v] for v in source.dictionary.to_pylist()], np.int64)[source.indices.to_numpy()]
            if len(names) > wide or len(langs) > 1 << 22:
                raise ValueError("more than 2**20 sources in one task")
            p, p0 = flat.field("p").to_numpy(), flat.field("p0").to_numpy()
            lang = np.repeat(np.array([langs[v] for v in b.column(0).to_pylist()], np.int64), per)
            first, size = np.repeat(np.cumsum(per) - per, per), np.repeat(per, per)  # of the term that an entry belongs to
            ends = np.cumsum(size)
            lo = 0
            while lo < len(ends):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + step, side="right")))
                x = np.repeat(np.arange(lo, hi), size[lo:hi])
                y = np.arange(len(x)) - np.repeat(np.cumsum(size[lo:hi]) - size[lo:hi], size[lo:hi]) + first[x]
                x, y = x[x != y], y[x != y]
                v = f(p[x], p[y]) - f(p[x], p0[y]) - f(p0[x], p[y]) + f(p0[x], p0[y])
                held.append(((lang[x] * wide + code[x]) * wide + code[y], v))
                if sum(len(c) for c, _ in held) >= 4 * step:
                    fold()
                    if len(held[0][0]) >= most:
                        yield sent()
                lo = hi
        if held:
            yield sent()

    return rows.mapInArrow(run, "lang string, a string, b string, v long")


def divergence(docs: DataFrame, least: int = 3, top: int = 200, levels: tuple[int, ...] = LEVELS, table_bits: int = 26, unit_words: int = 1 << 19,
               text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: every two sources of a language, and each source's most telling terms."""
    d = docs.select(F.coalesce(text, F.lit("")).alias("text"), F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source"))
    kept = stored(kept_terms(d, least, levels, table_bits, unit_words))
    sizes = kept.groupBy("lang").agg(F.sum("n").alias("nl_all"), F.sum(F.col("once").cast("long")).alias("v"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("present"))
    groups = d.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0)
    total = F.col("n_all") + F.col("v")
    groups = stored(groups.select("lang", "source", "present", "v", total.alias("m"), (F.col("nl_all") + F.col("v")).alias("ml"),
                                  _share(F.lit(0), total).alias("p0")))

    rows = kept.join(groups, ["lang", "source"]).select("lang", "source", "term", "p0", _share("n", "m").alias("p"), _share("nl", "ml").alias("q"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    by_term = rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), _score("p", "q").alias("value"))
    by_term = by_term.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    other = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("q0"), F.col("present").alias("present_b"))
    both = groups.select("lang", F.col("source").alias("a"), "p0", "present", "v").join(other, "lang").where("a != b")
    lacking = (F.col("v") - F.col("present") - F.col("present_b")).cast("decimal(38,0)") * _score("p0", "q0")
    pieces = both.select("lang", "a", "b", F.coalesce(lacking, F.lit(0)).cast("decimal(38,0)").alias("v"))
    # terms by how often they occur: as many rows as there are different counts in a source
    counts = kept.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("terms")).join(groups.select("lang", "source", "m"), ["lang", "source"])
    counts = counts.select("lang", F.col("source").alias("a"), "terms", _share("n", "m").alias("p")).join(other, "lang").where("a != b")
    weigh = lambda s: (F.col("terms").cast("decimal(38,0)") * s).cast("decimal(38,0)").alias("v")
    pieces = pieces.union(counts.select("lang", "a", "b", weigh(_score("p", "q0")))).union(counts.select("lang", "b", "a", weigh(_score("q0", "p"))))
    lists = rows.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("e")).where(F.size("e") > 1)
    pieces = pieces.union(shared_corrections(lists.select("lang", "e")).select("lang", "a", "b", F.col("v").cast("decimal(38,0)")))
    pairs = pieces.groupBy("lang", "a", "b").agg(F.sum("v").cast("long").alias("value"))
    pairs = pairs.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    return pairs.withColumn("rank", F.row_number().over(best)).union(by_term)


def op12_prefix_iceberg(spark, sf_dir):
    return divergence(documents(spark, sf_dir))


OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS nl FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(nl) AS nl_all FROM kept GROUP BY lang),
g AS (SELECT d.lang, d.source, coalesce(n_all, 0) AS n_all, coalesce(v, 0) AS v, nl_all
      FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN v USING (lang)
      LEFT JOIN (SELECT lang, source, sum(n) AS n_all FROM c GROUP BY ALL) s ON d.lang = s.lang AND d.source = s.source),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
      (1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (n_all + v))::BIGINT AS p,
      (1 + ({SCALE}::HUGEINT * (k.nl + 1)) // (nl_all + v))::BIGINT AS q
      FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM r)
WHERE part = 'pair' OR rank <= 200"""
