"""Personal data, decontamination, language, licences, scores, links and mixing on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import check
from tests.llm.data import documents, prose, texts
from wayloom.llm import decontaminate, lang_id, licenses, link_trust, lm_score, mixing, pii
from wayloom.llm.common import crc_mod

# ---- personal data

EMAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD, PHONE = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def plain_spans(t):
    out = [(0, m.start(), m.end()) for m in re.finditer(EMAIL, t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(IP, t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(CARD, t):
        d = [int(c) for c in re.sub("[^0-9]", "", m[0])]
        s = sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d)))
        out += [(2, m.start(), m.end())] * (13 <= len(d) <= 19 and s % 10 == 0)
    return out + [(3, m.start(), m.end()) for m in re.finditer(PHONE, t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_match_the_patterns():
    g = random.Random(1)
    parts = ["a.b@c.d", "@", "x@y", "@@", "1.2.3.4", "1.2.3.4.5.6", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (319) 555-5132",
             "+", "ü", " ", ".", "-", "12", "+49 30 1234567", "a@b.c@d.e", "0000000000001.1.1.1", "()", "7992739871300000", "_%"]
    for _ in range(4000):
        t = "".join(g.choice(parts) for _ in range(g.randrange(12)))
        assert pii.base_spans(t) == plain_spans(t), t


@pytest.fixture(scope="module")
def weights(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_field_labels_likenesses_and_spares_the_rest(weights):
    t = "write to hein.19@mail5.example.com today, or hein.19[at]mail5.example.com; host 55.63.178.142 up, version 4.0. and 17 more"
    (base, more), = pii.find([t], weights)
    assert [t[a:b] for _, a, b in base] == ["hein.19@mail5.example.com", "55.63.178.142"]
    assert [t[a:b] for k, a, b in more if k == 0] == ["hein.19[at]mail5.example.com"]
    clean = ["in 1999 there were 12 of 40 houses", "version 3. of 2.0", "AKIAJDZWJNP6ZRYWK44", "call 555", prose(1, 50), None, ""]
    assert pii.find(clean, weights) == [([], [])] * len(clean)


def test_messages_settle_and_agree_with_enumeration(weights):
    g = pii.Graph()
    g.add(0, "10.2.3.4 and 10-2-3-4 or 10:2:3:4", [(1, 0, 8)])
    q = pii.marginals(g, weights)
    x, y, chain, skip = g.arrays()
    assert len(chain) == 0 and len(skip) == len(q) - 1  # a tree, so messages are exact
    k = len(pii.KINDS) + 1
    node = x @ weights["W"]
    node[0], node[0, 2] = -40, 0
    total = np.zeros((len(x), k))
    for s in np.ndindex(*[k] * len(x)):
        p = math.exp(sum(node[i, s[i]] for i in range(len(x))) + sum(weights["S"][s[a], s[b]] for a, b in skip))
        for i in range(len(x)):
            total[i, s[i]] += p
    assert np.allclose(q, total / total.sum(axis=1, keepdims=True), atol=1e-3)


def test_personal_data_query_shape(spark, weights):
    df = documents(spark)
    rows = {r.doc_id: r for r in pii.tagged(df, weights, rewrite=True).select("doc_id", F.col("_pii").alias("p"), "text", "key").collect()}
    assert len(rows) == len(texts()) and rows[0].p.base_sha256 == hashlib.sha256(b"").hexdigest() and rows[0].p.spans == ""
    assert pii.tagged(documents(spark, []), weights).count() == 0
    assert pii.train(pii.Graph())["W"].shape == (pii.FEATURES, 5)
    assert pii.masked("a x@y.z b", [(0, 2, 7)]) == "a [EMAIL] b"


# ---- decontamination

def test_decontamination(spark):
    items = [(i, prose(2000 + i, 14 + i)) for i in range(40)] + [(90, None), (91, ""), (92, "two words"), (0, prose(2000, 14))]
    g = random.Random(8)
    rows, want = [], set()
    for i in range(40):
        w = items[i][1].split()
        for kind, edits in (("exact", 0), ("edited", 1 + len(w) // 20)):
            e = list(w)
            for _ in range(edits):
                e[g.randrange(len(e))] = "zzz"
            d = len(rows)
            rows.append((d, " ".join(f"q{g.randrange(99)}" for _ in range(50)) + " " + " ".join(e).upper() + " end", None, None, None))
            want.add((d, i, kind))
    rows += [(900 + k, " ".join(f"w{g.randrange(5000)}" for _ in range(200)), None, None, None) for k in range(30)]
    rows += [(1000 + i, t, None, None, None) for i, t in enumerate([None, "", "two, WORDS!"])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 25, 1500):
        got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents(spark, rows), bench, block_bytes=block).collect()}
        assert all((d, i) in got and got[d, i].distance == 0 for d, i, k in want if k == "exact")
        assert sum((d, i) in got for d, i, k in want if k == "edited") >= 36
        assert not any(900 <= d < 1000 for d, _ in got) and got[1002, 92].distance == 0
        for (d, i), r in got.items():
            item, text = decontaminate.word_list(dict(items[:43])[i].encode()), decontaminate.word_list(dict((x[0], x[1]) for x in rows)[d].encode())
            assert r.distance == plain_distance(item, text[r.start: r.end]) <= 0.2 * r.item_words
    assert decontaminate.contaminated(documents(spark, []), bench).count() == 0
    assert decontaminate.contaminated(documents(spark, rows), bench.limit(0)).count() == 0


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


# ---- language

def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = crc_mod("doc_id", 4) == 2
    got = lang_id.identify(docs.where(held), lang_id.fit(docs.where(~held)))
    right, n, lo, hi = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert right > 0.97 and n == docs.where(held).count() and 0 <= lo <= hi <= 1


def test_language_edges(spark):
    df = documents(spark).drop("score")
    model = lang_id.fit(df)
    got = {r.doc_id: r for r in lang_id.identify(df, model).collect()}
    for i, t in enumerate(texts()):
        assert (got[i].lang_pred == "und") == (t is None or not any(c.isalpha() for c in t)), (i, got[i])
    again = {r.doc_id: (r.lang_pred, r.score) for r in lang_id.identify(df, lang_id.fit(df)).collect()}
    assert again == {i: (r.lang_pred, r.score) for i, r in got.items()}
    assert lang_id.fit(df.withColumn("lang", F.lit(None).cast("string"))) is None
    assert lang_id.identify(documents(spark, []), model).count() == 0


def test_tables_equal_the_network():
    g = np.random.default_rng(1)
    net = lang_id.ByteCnn(["a", "b"], 32)
    x = g.integers(1, 9, (5, 32)).astype(np.uint8)
    t = net.tables(np.arange(1, 9))
    e = net.p["E"][x]
    h = []
    for w in lang_id.WIDTHS:
        patch = np.concatenate([e[:, i: 32 - w + 1 + i] for i in range(w)], axis=2)
        h.append(np.maximum((patch @ net.p[f"W{w}"] + net.p[f"b{w}"]).max(axis=1), 0))
    o = np.exp(np.concatenate(h, axis=1) @ net.p["V"] + net.p["c"])
    assert np.allclose(lang_id.probabilities(x, t), o / o.sum(axis=1, keepdims=True), atol=1e-4)


# ---- licences

def test_licenses(spark):
    apache = licenses.TEMPLATES["apache-2.0-header"]
    w = apache.split()
    rows = [(1, prose(1, 300) + "\n" + apache.upper() + "\n" + prose(2, 300)), (2, " ".join(w[:10] + ["really"] + w[10:20] + w[21:])), (3, " ".join(w[: len(w) // 2])),
            (4, "Released under the MIT License. text Released under the MIT License."), (5, "license version permission conditions"), (6, None), (7, ""), (8, prose(3, 20000))]
    got = [tuple(r) for r in licenses.scan_licenses(documents(spark, [(*r, None, None, None) for r in rows])).collect()]
    assert {(r[0], r[1]) for r in got if r[1] != "apache-2.0"} == {(1, "apache-2.0-header"), (2, "apache-2.0-header"), (4, "mit")}
    assert sum(r[1] == "mit" for r in got) == 2
    one = next(r for r in got if r[:2] == (1, "apache-2.0-header"))
    assert one[6] == 1.0 and rows[0][1][one[2]: one[3]] == apache.upper()[: one[3] - one[2]]
    assert licenses.scan_licenses(documents(spark, [])).count() == 0


def test_alignment_is_a_common_subsequence():
    g = random.Random(6)
    for _ in range(300):
        a, b = ([g.choice("abcdefghij") for _ in range(g.randrange(25))] for _ in range(2))
        p = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in p) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(p, p[1:]))
    assert licenses.align(list("abcxdef"), list("abcdef")) == [(0, 0), (1, 1), (2, 2), (4, 3), (5, 4), (6, 5)]


# ---- scores

@pytest.mark.parametrize("bits", [19, 3])
def test_base_scores(spark, bits):
    rows = list(enumerate(texts()))
    df = documents(spark)
    got = {r.doc_id: r for r in lm_score.score_texts(df, crc_mod("doc_id", 5) == 1, fit_docs=10, share_bits=bits).collect()}
    count = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            count.update([*(t or "").encode().lower().split(), None])
    n, v = sum(count.values()), len(count)
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), None]
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(count[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0 and math.isfinite(r.score)
    assert got[3].score == pytest.approx(got[4].score)


def test_scores_without_training_rows(spark):
    got = lm_score.score_texts(documents(spark), F.lit(True)).collect()
    assert len(got) == len(texts()) and all(r.base_score == pytest.approx(0, abs=1e-9) and r.n_known == 0 for r in got)
    assert lm_score.score_texts(documents(spark, []), F.lit(False)).count() == 0


def test_every_id_is_scored_once_and_probabilities_add_up():
    counts = np.array([5, 1, 0, 9, 30, 2, 8])
    s = lm_score.Scorer(counts, window=8, stride=6, classes=3, direct=4)
    sizes = np.array([1, 7, 8, 9, 30, 65])
    own, x, y, ok = s.arrays(np.arange(sizes.sum()) % 7, sizes)
    assert np.array_equal(np.bincount(own, ok.sum(axis=1)), sizes)
    # the next id's probabilities after one context sum to one
    total = sum(math.exp(s.score(np.array([4, 3, i]), np.array([3]))[0] - s.score(np.array([4, 3]), np.array([2]))[0]) for i in range(7))
    assert total == pytest.approx(1, abs=1e-4)
    # the folded tables say what the layers say
    logp = s.model.forward(x)[0]
    assert np.allclose(s.model.log_probs(x, s.cls[y]), np.take_along_axis(logp, s.cls[y][..., None], 2)[..., 0], atol=1e-4)
    # the mask hides what follows
    a, b = s.model.forward(np.array([[1, 2, 3, 0, 0, 0, 0, 0]]))[0], s.model.forward(np.array([[1, 2, 3, 4, 5, 4, 3, 2]]))[0]
    assert np.allclose(a[0, :3], b[0, :3], atol=1e-6)


def test_attention_learns():
    g = np.random.default_rng(1)
    x = g.integers(0, 4, (200, 8))
    y = np.concatenate([np.zeros((200, 1), int), x[:, :-1]], axis=1)  # the input before: needs attention
    m = lm_score.Attention(4, 4, 8)
    loss = lambda: -np.take_along_axis(m.forward(x)[0], y[..., None], 2).mean()
    before = loss()
    m.fit(x, y, np.ones(x.shape, np.float32), steps=600)
    assert loss() < 0.5 * before


# ---- links

def test_links(spark, tmp_path):
    pages = [(1, "http://a.example.com/en/70?x", '<a href="http://b.example.org/x">'), (2, "HTTPS://B.Example.org/es/1#y", "<a href='//c.test.net/'>"),
             (3, "http://c.test.net/de/1", None), (4, None, "<a href=http://a.example.com>"), (5, "no scheme", ""), (6, "x://", "h"), (7, "http://d.io/q", '<a HREF="http://c.test.net/z">'),
             (8, "http://example.net/de/8/1", ""), (9, "http://com/en/", ""), (10, "http://c.test.net?de/", ""), (10, "http://c.test.net?de/", ""), (None, "http://e.com:80/en/1", "")]
    df = spark.createDataFrame([(*p, "clash", "clash") for p in pages], "page_id long, url string, html string, host string, rule string")
    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    assert check(spark, con, "", "op3", lambda s, d: link_trust.filter_urls(df), link_trust.OP3_SQL) is None
    got = {r.page_id: r for r in link_trust.filter_urls(df).collect()}
    assert (got[1].rule, got[1].verdict, got[1].path) == ("example.com/en/7", "allow", "/en/70")
    assert (got[2].host, got[2].rule, got[2].verdict) == ("b.example.org", "org/es/", "block")
    assert (got[8].rule, got[9].rule, got[4].host, got[5].path) == ("example.net/de/8", "com/en/", "", "")
    assert link_trust.filter_urls(df.limit(0)).count() == 0


# ---- mixing

def test_mixing(spark):
    df = documents(spark)
    con = duckdb.connect()
    con.register("d", df.select("doc_id", "text", "source").toPandas())
    con.execute("CREATE VIEW documents AS SELECT CAST(doc_id AS BIGINT) doc_id, CAST(text AS VARCHAR) AS text, CAST(source AS VARCHAR) AS source FROM d")
    assert check(spark, con, "", "op10", lambda s, d: mixing.mix(df), mixing.OP10_SQL) is None
    rows = mixing.mix(df).collect()
    assert len(rows) == len(texts()) and all(0 <= r.taken <= 3 * r.size for r in rows)
    sizes = mixing.sized(df).groupBy("skey").agg(F.sum("size").alias("source_size"))
    assert sum(r.size for r in rows) == pytest.approx(sum(r.target for r in mixing.source_targets(sizes).collect()), rel=1e-9)
    assert mixing.mix(documents(spark, [])).count() == 0
    zero = mixing.mix(documents(spark, [(1, None, None, "a", 0), (1, "", None, "a", 0)])).collect()
    assert [(r.size, r.target, r.taken) for r in zero] == [(0, 0.0, 0)] * 2
