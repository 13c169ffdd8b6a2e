"""The pipeline's stages against plain versions on a small table with planted cases."""

import corpus_pipeline as P
import pytest

from tests.llm.data import documents, prose
from tests.llm.test_pairs_and_repeats import classes
from wayloom.llm import decontaminate, pii
from wayloom.llm.common import stored


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    item = items.first()["text"]
    base = [tuple(r[c] for c in P.COLUMNS) for r in real.collect()]
    near = base[3][1].split(" ")
    near[len(near) // 2] = "zzz"
    extra = [(9001, None, "en", "src1", None), (9002, "", "en", "src1", 0), (9003, "12 34 !!", "en", "src2", 8), (9004, base[3][1], "en", None, 5),
             (9005, " ".join(near), "en", "src3", 7), (9006, prose(1, 60) + "\n" + item.upper() + "\n" + prose(2, 60), "en", "src0", 9),
             (9007, base[5][1] + " mail a.b@c.example.com", "en", "src0", 9), (9007, base[5][1] + " mail a.b@c.example.com", "en", "src0", 9), (None, prose(3, 80), "en", "src0", 1)]
    folder = str(tmp_path_factory.mktemp("sf"))
    documents(spark, base + extra).write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return folder, base + extra, [r["text"] for r in items.collect()]


def test_stages(spark, planted):
    folder, rows, items = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one = stored(P.keep_languages(spark, docs, folder))
    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    got = [tuple(r) for r in one.collect()]
    assert one.columns == list(P.COLUMNS) and not {9001, 9002, 9003} & {r[0] for r in got}
    assert set(got) <= set(kept) and len(got) >= 0.98 * len(kept)

    two = stored(P.keep_one_of_each(spark, one, folder))
    key = {i: r for i, r in enumerate(sorted(got, key=lambda r: (r[0] is None, r[0] or 0)))}
    root = {i: c for i, (_, c) in classes([(i, r[1]) for i, r in key.items()]).items()}
    after = [tuple(r) for r in two.collect()]
    assert sorted(map(str, after)) == sorted(str(key[i]) for i in key if root[i] == i)

    three = stored(P.remove_benchmark(spark, two, folder))
    words = [b" ".join(decontaminate.word_list(t.encode())) for t in items]
    clean = [r for r in after if not any(w in b" ".join(decontaminate.word_list(r[1].encode())) for w in words)]
    left = [tuple(r) for r in three.collect()]
    assert 9006 not in {r[0] for r in left} and set(left) <= set(clean) and len(left) >= len(clean) - 1

    four = stored(P.mask_personal(spark, three, folder))
    before = {r[0]: r for r in left}
    masked = [tuple(r) for r in four.collect()]
    assert len(masked) == len(left) and all(not pii.base_spans(r[1]) for r in masked)
    for r in masked:
        assert r[1] == before[r[0]][1] or r[4] == len(r[1])
        assert not pii.base_spans(before[r[0]][1]) or "[" in r[1]

    five = P.mix_sources(spark, four, folder).collect()
    assert sorted(str(r.doc_id) for r in five) == sorted(str(r[0]) for r in masked)
    assert all(r.taken <= 3 * r.size for r in five)


def test_whole_run_and_empty_table(spark, planted, tmp_path):
    folder, _, _ = planted
    assert P.run(spark, folder).count() > 100
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
