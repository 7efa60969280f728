import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordloom.functions import values as v
from recordloom.operators import relational as r

random.seed(8)


def test_filter_and_distinct_maps(spark):
    df = spark.createDataFrame([(i,) for i in [1, 2, 2, 3, 4]], "x int")
    squares = r.filter_map(df, F.col("x") % 2 == 0, F.col("x") * F.col("x"), "sq")
    assert sorted(x["sq"] for x in squares.collect()) == [4, 4, 16]
    assert r.distinct_map(df, F.col("x") % 2, "odd").count() == 2
    last = r.build_map(df, F.col("x") % 2, F.col("x"), F.col("x"))
    assert {x["key"]: x["value"] for x in last.collect()} == {0: 4, 1: 3}


@pytest.mark.parametrize("max_items", [1000, 7])
def test_group_lists_keep_everything(spark, max_items):
    data = [(i, "hot" if i % 3 else "cold", random.randint(0, 9)) for i in range(200)]
    df = spark.createDataFrame(data, "id long, k string, v int").repartition(5)
    parts = r.group_lists(df, "k", "v", "id", max_items)
    assert max(len(x["items"]) for x in parts.collect()) <= max_items
    joined = {}
    for x in parts.orderBy("k", "part").collect():
        joined.setdefault(x["k"], []).extend(x["items"])
    want = {}
    for _, k, value in data:
        want.setdefault(k, []).append(value)
    assert joined == want


def test_most_common_ties_by_first_place(spark):
    df = spark.createDataFrame(list(enumerate("bacab")), "i long, c string")
    assert [(x["c"], x["n"]) for x in r.most_common(df, "c", 2, "i").collect()] == [("b", 2), ("a", 2)]


def test_products_and_pairs(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["z"])], "id int, opts array<string>")
    assert r.cartesian(df, {"x": [1, 2], "y": ["p", "q", "r"]}).count() == 12
    assert rows(r.array_pairs(df, "opts").select("id", "first", "second")) == [
        (1, "a", "b"), (1, "a", "c"), (1, "b", "c"),
    ]
    with pytest.raises(Exception, match="option lists hold at most"):
        r.array_pairs(df, "opts", max_items=2).collect()
    assert len(r.bounded_values(df, ["id"], 2)) == 2
    with pytest.raises(ValueError):
        r.bounded_values(df, ["id"], 1)


@pytest.mark.parametrize("share", [0.001, 0.3, 2.0])
def test_membership_with_hot_and_null_keys(spark, share, monkeypatch):
    monkeypatch.setattr(r, "HOT_SHARE", share)
    keys = [1] * 50 + [2] * 50 + [None] * 50 + list(range(3, 30))
    probes = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k int").repartition(4)
    members = spark.createDataFrame([(1,)] * 40 + [(5,), (6,), (None,), (99,)], "m int")
    inside = {x["id"] for x in r.membership(probes, "k", members, "m").collect()}
    outside = {x["id"] for x in r.non_membership(probes, "k", members, "m").collect()}
    assert inside == {i for i, k in enumerate(keys) if k in (1, 5, 6)}
    assert outside == set(range(len(keys))) - inside


def test_membership(spark):
    probes = spark.createDataFrame([(k,) for k in [1, 1, 1, 2, 3, None]], "k int")
    members = spark.createDataFrame([(1,), (1,), (3,), (9,)], "m int")
    assert sorted(x["k"] for x in r.membership(probes, "k", members, "m").collect()) == [1, 1, 1, 3]
    assert r.non_membership(probes, "k", members, "m").count() == 2
    assert tuple(r.membership_counts(probes, "k", members, "m").first()) == (4, 2)


def test_updates_and_totals(spark):
    df = spark.createDataFrame([("a", 2.0, 3), ("b", 1.5, 2)], "c string, p double, q int")
    assert rows(r.update_where(df, F.col("c") == "a", "q", F.lit(0)).select("c", "q")) == [("a", 0), ("b", 2)]
    assert sorted(x["total_value"] for x in r.with_total(df, "p", "q").collect()) == [3.0, 6.0]


@pytest.mark.parametrize("limit", [0, 100])
def test_enumerate(spark, limit):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "item string")
    got = r.enumerate_rows(df, ["item"], "item", limit=limit).orderBy("index").collect()
    assert [x["line"] for x in got] == ["Index: 0, Item: 'a'", "Index: 1, Item: 'b'", "Index: 2, Item: 'c'"]


def test_sum_squares(spark):
    n = 3_000_000
    assert int(r.sum_squares_range(spark, n).first()[0]) == (n - 1) * n * (2 * n - 1) // 6
    big = spark.createDataFrame([(9_000_000_000_000_000_000,)], "x long")
    assert int(r.sum_squares(big, F.col("x")).first()[0]) == 81 * 10**36


def test_values(spark):
    df = spark.createDataFrame(
        [(8.0, "2", "add", {"a": 1}, [1, 2, 3, 4, 5, 6]), (5.0, "0", "pow", {}, []), (75.0, "x", None, {"b": 2}, [9])],
        "a double, b string, op string, m map<string,int>, l array<int>",
    )
    div = df.select(v.safe_divide(F.col("a"), F.col("b"))).collect()
    assert [x[0] for x in div] == [4.0, None, None]
    cuts = [(90, "A"), (70, "C"), (8, "D")]
    assert [x[0] for x in df.select(v.bucketize(F.col("a"), cuts, "F")).collect()] == ["D", "F", "C"]
    result, error = v.op_dispatch(F.lit(6), F.lit(3), F.col("op"))
    assert [tuple(x) for x in df.select(result, error).collect()] == [
        (9, None), (None, "unknown operation: pow"), (None, "unknown operation: null"),
    ]
    with pytest.raises(Exception, match="unknown operation: (pow|null)"):
        df.select(v.op_dispatch_strict(F.lit(1), F.lit(2), F.col("op"))).collect()
    got = df.select(v.map_get(F.col("m"), "a"), v.map_get(F.col("m"), "a", 0), v.map_set_default(F.col("m"), "a", 7)).collect()
    assert [tuple(x) for x in got] == [(1, 1, {"a": 1}), (None, 0, {"a": 7}), (None, 0, {"b": 2, "a": 7})]
    assert [tuple(x) for x in df.select(*v.array_parts(F.col("l"))).collect()] == [
        (1, 6, [3, 4, 5]), (None, None, []), (9, 9, []),
    ]


def test_coercion(spark):
    payloads = [
        '{"id": "7", "email": "a@b", "tags": ["x"]}',
        '{"id": "7.5", "email": "a@b", "tags": []}',
        '{"id": "7", "email": "ab", "tags": []}',
        '{"email": "a@b", "tags": []}',
        "not json",
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "i int, p string")
    rule = {"email has no @": F.contains("email", F.lit("@"))}
    good, bad = r.coerce(df, "p", {"id": "int", "email": "string", "tags": "array<string>"}, rule)
    assert [tuple(x) for x in good.select("i", "id", "email", "tags").collect()] == [(0, 7, "a@b", ["x"])]
    assert {x["i"]: x["reason"] for x in bad.collect()} == {
        1: "id has the wrong type", 2: "email has no @", 3: "id is missing", 4: "id is missing",
    } or {x["i"]: x["reason"] for x in bad.collect()}[4] == "not a JSON object"
    numbers = spark.createDataFrame([("1",), ("2.5",), ("x",), (None,)], "t string")
    assert tuple(r.sum_numbers(numbers, "t").first()) == (3.5, 2)


def _replay(moves):
    balance, ok, no = 0.0, 0, 0
    for amount, kind in moves:
        if amount > 0 and (kind == "deposit" or amount <= balance):
            balance += amount if kind == "deposit" else -amount
            ok += 1
        else:
            no += 1
    return balance, ok, no


@pytest.mark.parametrize("block", [1000, 16, 1])
def test_ledger_equals_a_sequential_replay(spark, block):
    n = 60 if block == 1 else 400
    data = []
    for i in range(n):
        key = "hot" if i % 4 else f"k{i % 8}"
        data.append((i, key, float(random.randint(-3, 60)), random.choice(["deposit", "withdraw", "withdraw"])))
    df = spark.createDataFrame(data, "id long, k string, amount double, kind string").repartition(3)
    want = {}
    for _, key, amount, kind in data:
        want.setdefault(key, []).append((amount, kind))
    got = {x["k"]: (x["balance"], x["n_accepted"], x["n_rejected"]) for x in r.ledger(df, "k", "id", "amount", "kind", block).collect()}
    assert got == {k: _replay(m) for k, m in want.items()}
