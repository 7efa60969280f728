import random
import zlib

import pytest

from recordloom.llm import sharding as s

SCHEMA = "doc_id long, text string, shard string, slot string"


def best_capacity(sizes, shards):
    """Smallest capacity by plain binary search over the ordered sizes."""

    def needed(cap):
        used, room = 1, cap
        for n in sizes:
            if n > room:
                used, room = used + 1, cap
            room -= n
        return used

    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= shards else (middle + 1, high)
    return low


def run(spark, texts, **kw):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    out = s.shard_rows(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw).collect()
    assert len(out) == len(texts)
    return {r["doc_id"]: r for r in out}, out


def check_slots(out):
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    return by


@pytest.mark.parametrize("shards,slot_rows", [(4, 50_000), (7, 10)])
def test_matches_plain_search(spark, monkeypatch, shards, slot_rows):
    monkeypatch.setattr(s, "FIRST_BITS", 3)
    monkeypatch.setattr(s, "STEP_BITS", 2)
    rnd = random.Random(5)
    texts = ["é" * rnd.randint(0, 60) + str(i % 150) for i in range(400)]
    got, out = run(spark, texts, shards=shards, slot_rows=slot_rows)
    check_slots(out)
    keys = {r["doc_id"]: r for r in out}
    for i, t in enumerate(texts):
        assert keys[i]["size"] == len(t.encode()) + 16
        assert keys[i]["text_crc32"] == zlib.crc32(t.encode())
    df = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr(
        "shiftrightunsigned(xxhash64(cast(text as binary)), 1) key", "octet_length(text) + 16 b")
    order = [r[1] for r in sorted(tuple(x) for x in df.groupBy("key").sum("b").collect())]
    totals = {}
    for r in out:
        totals[r["shard"]] = totals.get(r["shard"], 0) + r["size"]
    assert max(totals.values()) <= best_capacity(order, shards)
    together = {}
    for i, t in enumerate(texts):
        together.setdefault(t, set()).add(got[i]["shard"])
    assert all(len(x) == 1 for x in together.values())


def test_hot_group_gets_its_own_shard_and_the_rest_stays_even(spark):
    texts = ["same text for a third"] * 200 + [f"text number {i:05d}......" for i in range(400)]
    got, out = run(spark, texts, shards=10, slot_rows=7)
    by = check_slots(out)
    hot = got[0]["shard"]
    assert len(by[hot]) == 200
    others = [len(v) for k, v in by.items() if k != hot]
    assert len(others) == 9 and max(others) - min(others) <= 5


def test_nulls_empty_and_tiny_tables(spark):
    _, out = run(spark, [None, "", "a"], shards=40)
    check_slots(out)
    assert sorted(r["size"] for r in out) == [16, 16, 17]
    assert len({r["shard"] for r in out if r["size"] == 16}) == 1
    empty = s.shard_rows(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert empty.collect() == []
    twice = spark.createDataFrame([(None, "b", "", ""), (None, "b", "", "")], SCHEMA)
    assert sorted(r["slot"] for r in s.shard_rows(twice, shards=3).collect()) == [0, 1]
