import random

import pytest
from pyspark.sql import functions as F

from recordloom import scale

random.seed(3)
# one group holds two thirds of the rows, one key is null
ROWS = [(i, "hot" if i % 3 else random.choice(["a", "b", None]), random.randint(0, 50) if i % 7 else None)
        for i in range(900)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id long, k string, v long").repartition(5)


def brute(keys):
    groups, out = {}, {}
    for i, k, v in sorted(ROWS):
        seen = groups.setdefault(k if keys else 0, [])
        vals = [x for x in seen if x[1] is not None]
        out[i] = (
            len(seen),
            sum(x[1] for x in vals),
            max((x[1] for x in vals), default=None),
            min((x[1] for x in vals), default=None),
            seen[-1][0] if seen else None,
        )
        seen.append((i, v))
    return out


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("limit", [10, 10_000])
def test_running(df, keys, limit):
    aggs = {
        "n": ("sum", F.lit(1)),
        "s": ("sum", F.col("v")),
        "hi": ("max", F.col("v")),
        "lo": ("min", F.col("v")),
        "prev": ("lag", F.struct("id")),
    }
    got = scale.running(df, keys, ["id"], aggs, limit=limit, blocks=7)
    want = brute(keys)
    result = {r["id"]: (r["n"], r["s"], r["hi"], r["lo"], r["prev"] and r["prev"]["id"]) for r in got.collect()}
    assert result == want


@pytest.mark.parametrize("limit", [0, 10_000])
@pytest.mark.parametrize("start", [0, 2])
def test_global_index(df, limit, start):
    got = scale.global_index(df, [F.col("v").desc_nulls_last(), "id"], "pos", start, limit=limit, blocks=6)
    order = sorted(ROWS, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    assert [r["id"] for r in got.orderBy("pos").collect()] == [r[0] for r in order]
    assert sorted(r["pos"] for r in got.collect()) == list(range(start, start + len(ROWS)))


def test_rows_at_ranks(df):
    ids = sorted(r[0] for r in ROWS)
    ranks = [1, 17, 450, 900, 901, 0]
    got = scale.rows_at_ranks(df, F.floor(F.col("id") / 64).cast("int"), ["id"], ranks)
    assert got == [(ids[0],), (ids[16],), (ids[449],), (ids[899],), None, None]


def test_at_or_before(df):
    kept = df.filter(scale.at_or_before(["v", "id"], (20, 400)))
    assert kept.count() == sum(1 for i, _, v in ROWS if v is not None and (v, i) <= (20, 400))
    assert df.filter(scale.at_or_before(["id"], None)).count() == 0


def test_largest_group_and_small(df):
    assert scale.largest_group(df, ["k"]) == 600
    assert scale.largest_group(df, []) == 900
    assert scale.largest_group(df.limit(0), ["k"]) == 0
    assert scale.is_small(df, 900) and not scale.is_small(df, 899)


def test_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scale.shared_dir(Session())


def test_spread_leaves_split_input_alone(df):
    cores = df.sparkSession.sparkContext.defaultParallelism
    assert scale.spread(df) is df
    assert scale.spread(df.coalesce(1)).rdd.getNumPartitions() == cores
