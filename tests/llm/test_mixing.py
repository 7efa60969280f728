import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import mixing as m

SCHEMA = "doc_id long, text string, source string, size string, copies string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", 0) for i, t, s in rows], SCHEMA)


def plain_targets(sizes, share=1.5):
    """Targets by sharing out the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, got, full = share * sum(sizes.values()), {}, set()
    while True:
        left = budget - sum(2 * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        got = {s: 2 * sizes[s] if s in full else left * w[s] / sum(w[x] for x in free) for s in order}
        over = {s for s in free if got[s] > 2 * sizes[s]}
        if not over:
            return got
        full |= over


def corpus():
    rnd = random.Random(3)
    sources = ["a"] * 6 + ["b", "é", None]
    return [(i, " ".join(["w"] * rnd.randint(0, 30)), rnd.choice(sources)) for i in range(900)]


@pytest.mark.parametrize("blocks,fan", [(50_000, 1000), (40, 3)])
def test_targets_are_met_and_runs_agree(spark, blocks, fan):
    rows = corpus()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = plain_targets(sizes)
    run = lambda n: m.mix_rows(table(spark, rows).repartition(n), block_rows=blocks, fan_in=fan).collect()
    out = run(2)
    assert sorted(map(tuple, out)) == sorted(map(tuple, run(5)))
    source = {i: s for i, _, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        assert r["source_size"] == sizes[source[r["doc_id"]]]
        assert r["target"] == pytest.approx(want[source[r["doc_id"]]])
        taken[source[r["doc_id"]]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30
    assert len(out) == len(rows)


def test_settle_keeps_mass_and_expectation():
    size = np.array([5.0, 1, 9, 4, 4, 7])
    p = np.array([0.3, 0.5, 0.9, 0.25, 0.6, 0.4])
    total = np.zeros(6)
    for k in range(4000):
        out = m.settle(p, size, np.random.default_rng(k))
        assert np.sum((out > 0) & (out < 1)) <= 1
        assert np.dot(out, size) == pytest.approx(np.dot(p, size))
        total += out
    assert np.allclose(total / 4000, p, atol=0.04)


def test_nulls_repeats_and_empty(spark):
    rows = [(1, "a b c", "s")] * 4 + [(None, None, None), (2, "", "s"), (None, "x", None)]
    out = m.mix_rows(table(spark, rows)).collect()
    assert len(out) == 7
    assert {r["taken"] for r in out if r["doc_id"] == 1} <= {0, 3, 6}
    assert all(r["taken"] == 0 for r in out if r["size"] == 0)
    assert m.mix_rows(table(spark, rows).limit(0)).collect() == []


def test_documents_come_as_often_as_taken(spark):
    docs = table(spark, corpus())
    mixed = m.mixed_documents(docs)
    assert mixed.schema == docs.schema
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for r in m.mix_rows(docs).collect():
        assert copies.get(r["doc_id"], 0) * r["size"] == r["taken"]


def test_rows_repeated_very_often_meet_the_target(spark, monkeypatch):
    """One document stands for most of its source; ids that are null likewise."""
    monkeypatch.setattr(m, "SPAN", 70)
    rows = [(i, " ".join(["w"] * (i % 30)), "ab"[i % 2]) for i in range(400)]
    rows += [(1000, "w " * 10, "a")] * 4000 + [(None, "w " * 7, "b")] * 900
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = plain_targets(sizes)
    docs = table(spark, rows)
    out = m.mix_rows(docs).collect()
    assert len(out) == len(rows) and all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in out)
    by_source = {sizes[s]: s for s in sizes}
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        taken[by_source[r["source_size"]]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30
    mixed = m.mixed_documents(docs.withColumn("rank", F.pmod(F.monotonically_increasing_id(), F.lit(9973)).cast("int")))
    words = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(m.word_count(F.col("text"))).alias("n")).collect()}
    assert words == taken
