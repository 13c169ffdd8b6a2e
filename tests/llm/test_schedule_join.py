"""What documents give comes from their blocks' meeting the slots of the schedule."""

import pytest

from wayloom.llm import mixing


def test_mix_joins_its_schedule(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(90)], "doc_id long, text string, source string")
    whole = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    assert sum(r["taken"] for r in whole.values()) == pytest.approx(sum(r["size"] for r in whole.values()), abs=3)
    full = mixing.schedule
    monkeypatch.setattr(mixing, "schedule", lambda t, slots=1 << 18: full(t, slots).where("rank % 2 = 0"))
    half = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    assert 0 < sum(half.values()) < sum(r["taken"] for r in whole.values())  # every other slot gone: its words are not taken
