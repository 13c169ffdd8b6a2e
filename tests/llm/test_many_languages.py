"""More labels than 64, and a rejection that can act at any number of classes."""

import random
import string

import corpus_pipeline as P

from tests.llm.data import documents
from wayloom.llm import lang_id
from wayloom.llm.common import crc_mod


def test_every_label_is_learned(spark):
    g = random.Random(4)
    words = {f"l{k:02d}": ["".join(g.choices(string.ascii_lowercase, k=4)) for _ in range(8)] for k in range(70)}
    rows = []
    for k, (lang, w) in enumerate(words.items()):
        rows += [(1000 * k + i, " ".join(g.choices(w, k=60)), lang, None, None) for i in range(24 if k < 64 else 12)]
    df = documents(spark, rows)
    model = lang_id.fit(df)
    assert model["langs"] == sorted(words)
    fresh = documents(spark, [(k, " ".join(g.choices(words[f"l{k:02d}"], k=60)), None, None, None) for k in range(64, 70)])
    got = lang_id.identify(fresh.drop("score"), model).collect()
    assert sum(r.lang_pred == f"l{r.doc_id:02d}" for r in got) >= 4


def test_rejection_acts_and_spares_clean_texts(spark):
    for c in (2, 3, 4, 64, 1000):
        assert 1 / c < P.least_score(c) < 1
    assert P.least_score(1) == 0
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = crc_mod("doc_id", 4) == 2
    model = lang_id.fit(docs.where(~held))
    got = lang_id.identify(docs.where(held & (docs.n_chars > 0)), model).where("lang_pred != 'und'")
    n, kept = got.count(), got.where(got.score > P.least_score(len(model["langs"]))).count()
    assert kept >= 0.99 * n
