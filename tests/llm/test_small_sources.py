"""Small sources meet their targets however many words a slot would otherwise hold."""

from collections import defaultdict

from tests.llm.data import documents, prose
from wayloom.llm import mixing


def test_taken_comes_near_target_at_a_coarse_number_of_slots(spark):
    rows = [(i, prose(i, 400), None, "big", None) for i in range(50)]
    rows += [(1000 + 10 * k + i, prose(1000 + i, 20), None, f"small{k}", None) for k in range(6) for i in range(2)]
    got, target = defaultdict(int), {}
    name = {r[0]: r[3] for r in rows}
    for r in mixing.mix(documents(spark, rows), slots=16).collect():
        got[name[r.doc_id]] += r.taken
        target[name[r.doc_id]] = r.target
    assert len(target) == 7 and all(abs(got[s] - target[s]) <= 3 + 0.01 * target[s] for s in target), (dict(got), target)


def test_blocks_stay_small_and_ranks_run_on(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 128)
    targets = spark.createDataFrame([("a", 60000, 30000.0, 90000), ("b", 30000, 60000.0, 90000)], "skey string, source_size long, target double, total long")
    block, n = mixing.resolution(targets, 16)
    rows = mixing.schedule(targets, 16).orderBy("slot").collect()
    assert block <= mixing.MOST_BLOCK and len(rows) == n and n * block >= 90000
    for s, want in (("a", 30000), ("b", 60000)):
        mine = [r for r in rows if r.skey == s]
        assert [r["rank"] for r in mine] == list(range(len(mine))) and abs(len(mine) * block - want) <= 3 * block
