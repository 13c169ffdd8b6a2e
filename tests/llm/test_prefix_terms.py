"""Kept terms and divergences against a plain version, with narrow levels and crowded bit tables."""

import pickle
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import documents, prose
from wayloom.llm import prefix_terms as P

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=3, top=200):
    df, n, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        found = Counter("".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or ""))
        groups[lang].add(source)
        df[lang].update(set(found))
        n[lang, source].update(found)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, d in df[lang].items() if d >= least]
        def share(c, kept=kept):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}
        whole = Counter()
        for s in sources:
            whole.update(n[lang, s])
        q, p = share(whole), {s: share(n[lang, s]) for s in sources}
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources - {s}]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda e: (-e[1], e[0].encode()))
                out |= {(lang, s, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= top}
    return out


def table():
    rows = []
    for i in range(60):
        extra = ("Straße ", "straße", "naïve|naïve", "x" * 90 + " ", "y" * (30 + i % 4) + " ", "a-b_c`d ", "É é \u0085x ")[i % 7]
        rows.append((i, extra + prose(i % 23, 12 + i) + f" only{i}", ("en", "de", None)[i % 3], ("s1", "s2", None, "Ü", "s1")[i % 5], None))
    rows += [(100, None, "en", "bare", None), (101, "", "none", "s1", 0), (102, "rare words here", "none", "s2", 0), (103, "a b", "one", "s", 0)]
    return rows + [rows[5]] * 2 + [(None, "alpha alpha beta", "en", "s1", None)]


@pytest.mark.parametrize("levels,bits", [((4, 8, 16, 32), 26), ((1, 2, 3), 7), ((2,), 10)])
def test_divergence_is_that_of_a_plain_version(spark, levels, bits):
    got = P.divergence(documents(spark, table()), levels=levels, table_bits=bits, top=7, unit_words=150).collect()
    rows = {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got}
    assert len(rows) == len(got) and rows == plain(table(), top=7)


def test_many_sources_are_summed_in_parts(spark, monkeypatch):
    rows = [(i, prose(i % 9, 20), "en", f"s{i % 30}", None) for i in range(200)]
    base = P.shared_corrections
    monkeypatch.setattr(P, "shared_corrections", lambda r: base(r, step=50, most=40))
    got = P.divergence(documents(spark, rows))
    assert {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got.collect()} == plain(rows)


def test_dropped_prefixes_are_not_counted_again(spark):
    rows = [(i, f"common{i} shared word{'abc'[i % 3]}x", "en", "s", None) for i in range(9)]
    d = documents(spark, rows).select("text", "lang", "source")
    units = P._packed(d)

    def seen(done, size, bits):
        out = Counter()
        for r in P._at_level(units, done, size, bits, 4).collect():
            for kind, _, keys, docs, _ in pickle.loads(r.data):
                for k, n in zip(keys, np.frombuffer(docs, np.int64).tolist(), strict=True):
                    out[kind, k] += n
        return out

    assert seen(0, 4, None) == {(0, b"comm"): 9, (0, b"shar"): 9, (0, b"word"): 9}
    table = np.zeros(1 << 17, np.uint8)
    for p in (b"comm", b"word"):
        h = zlib.crc32(b"en\0" + p) & ((1 << 20) - 1)
        table[h >> 3] |= 1 << (h & 7)
    assert seen(4, 7, table) == {(1, b"common"): 9, **{(1, b"word" + x): 3 for x in (b"ax", b"bx", b"cx")}}
    assert {bytes(r.term): r.n for r in P.kept_terms(d).collect()} == {b"common": 9, b"shared": 9, b"wordax": 3, b"wordbx": 3, b"wordcx": 3}


def test_units_keep_what_documents_hold(spark):
    rows = table() + [(500, "many " * 70000 + "x " * 300, "en", "s9", None)]
    d = documents(spark, rows).select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])
    got, want = Counter(), Counter()
    for r in P._packed(d.coalesce(1), 200).collect():
        u = P._Unit(r.unit)
        for doc, term, n, g in zip(u.doc, u.term, u.count, u.group, strict=True):
            got[u.groups[g], u.terms[term], int(n)] += 1
    for r in d.collect():
        for w, n in Counter(P.terms(r.text.encode())).items():
            want[(r.lang, r.source), w, n] += 1
    assert got == want


def test_empty_and_blank_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.op12_prefix_iceberg(spark, str(tmp_path)).collect() == []
    got = P.divergence(documents(spark, [(1, None, None, "a", 0), (2, "12 34", None, "b", 0)])).collect()
    assert {tuple(r) for r in got} == {("", "a", "pair", "b", 0, 1), ("", "b", "pair", "a", 0, 1)}
