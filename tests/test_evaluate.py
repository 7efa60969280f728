import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordloom.functions import arrays as a
from recordloom.operators import evaluate as e
from recordloom.operators import features as f

random.seed(11)


def test_confusion_sums_to_n_and_has_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 2), (2, 2)], "y int, p int")
    cells = e.confusion_matrix(df, "y", "p").collect()
    assert len(cells) == 9 and sum(c["n"] for c in cells) == 4
    with pytest.raises(ValueError):
        e.confusion_matrix(df, "y", "p", max_classes=2)
    assert rows(e.confusion_matrix(df, "y", "p", 2, dense=False)) == [(0, 0, 1), (0, 1, 1), (2, 2, 2)]


def test_report_by_hand(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    got = {r["label"]: tuple(round(x, 6) for x in r[1:]) for r in e.classification_report(df, "y", "p").collect()}
    assert got["a"] == (1.0, 0.5, 0.666667, 2)
    assert got["b"] == (0.333333, 1.0, 0.5, 1)
    assert got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"] == (0.5, 0.5, 0.5, 4)
    assert got["macro avg"] == (0.444444, 0.5, 0.388889, 4)
    assert got["weighted avg"] == (0.583333, 0.5, 0.458333, 4)
    assert e.accuracy(df, "y", "p").first()["accuracy"] == 0.5


@pytest.mark.parametrize("limit", [5, 1000])
def test_auc(spark, limit):
    data = [("hot", float(i), float(i * i % 17)) for i in range(60)] + [("one", 2.0, 5.0)]
    data += [("hot", 7.0, 3.0)] * 40 + [("hot", 7.0, 9.0)] * 40  # a third of the rows in two points
    random.shuffle(data)
    df = spark.createDataFrame(data, "g string, x double, y double")
    pts = sorted((x, y) for g, x, y in data if g == "hot")
    want = sum((x1 - x0) * (y0 + y1) / 2 for (x0, y0), (x1, y1) in zip(pts, pts[1:]))
    got = {r["g"]: r["auc"] for r in e.auc(df, ["g"], "x", "y", limit).collect()}
    assert got["one"] == 0.0 and got["hot"] == pytest.approx(want)


def _u(x, y):
    return sum((p > q) + (p == q) / 2 for p in x for q in y)


@pytest.mark.parametrize("limit", [2, 1000])
def test_mann_whitney_small_groups_are_exact(spark, limit):
    x, y = [9.0, 4.0, 7.5], [3.0, 8.0, 1.0, 2.0]
    df = spark.createDataFrame([("a", v) for v in x] + [("b", v) for v in y] + [("c", 0.0)], "g string, v double")
    got = e.mann_whitney(df, "g", "v", "a", "b", limit).first()
    pool = x + y
    draws = list(itertools.combinations(range(7), 3))
    tail = sum(
        _u([pool[i] for i in pick], [pool[i] for i in range(7) if i not in pick]) >= _u(x, y) for pick in draws
    ) / len(draws)
    assert got["u"] == _u(x, y) and got["p_value"] == pytest.approx(tail)


def _u_counts(a, b):
    """Orderings of a and b values by U, one factor of the generating function at a time."""
    top = a * b
    counts = [1] + [0] * top
    for i in range(1, a + 1):
        for v in range(i, top + 1):
            counts[v] += counts[v - i]
        for v in range(top, b + i - 1, -1):
            counts[v] -= counts[v - b - i]
    return counts


@pytest.mark.parametrize("a, b", [(1, 1), (1, 9), (2, 3), (3, 40), (5, 5), (7, 130), (8, 8), (8, 200)])
def test_exact_u_tail_at_every_value(a, b):
    counts, total = _u_counts(a, b), math.comb(a + b, a)
    for u in range(-1, a * b + 2):
        assert e._exact_u_tail(float(u), b, a) == sum(counts[max(u, 0) :]) / total
    assert e._exact_u_tail(0.5, a, b) == e._exact_u_tail(1.0, a, b)


def test_exact_u_tail_is_bounded_on_the_large_side():
    began = time.perf_counter()
    b = 10_000_000
    for u in (0, 4 * b, 5 * b, 8 * b - 3):
        z = (u - 4 * b) / math.sqrt(8 * b * (b + 9) / 12)
        assert e._exact_u_tail(float(u), 8, b) == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=5e-3)
    assert e._exact_u_tail(8.0 * b - 3, 8, b) == 7 / math.comb(b + 8, 8)  # 1 + 1 + 2 + 3 partitions
    assert time.perf_counter() - began < 1.0


def test_mann_whitney_with_ties_uses_the_normal_tail(spark):
    x, y = [1.0, 2.0, 2.0, 3.0, 5.0], [1.0, 1.0, 2.0, 4.0]
    df = spark.createDataFrame([("a", v) for v in x] + [("b", v) for v in y], "g string, v double")
    got = e.mann_whitney(df, "g", "v", "a", "b").first()
    n, ties = 9, (27 - 3) + (27 - 3)
    sd = math.sqrt(20 / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (_u(x, y) - 10 - 0.5) / sd
    assert got["u"] == _u(x, y) and got["z"] == pytest.approx(z)
    assert got["p_value"] == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)))


def test_t_tail_against_integration():
    def density(t, df):
        return math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi) * (1 + t * t / df) ** (-(df + 1) / 2)

    for t, df in [(0.0, 5), (1.3, 7), (-0.8, 30), (2.5, 4)]:
        steps, top = 200_000, 400.0
        h = (top - t) / steps
        area = h * (sum(density(t + i * h, df) for i in range(1, steps)) + (density(t, df) + density(top, df)) / 2)
        assert e._t_tail(t, df) == pytest.approx(area, abs=1e-5)


def test_t_test_and_flag(spark):
    x, y = [5.0, 6.0, 7.0, 9.0], [1.0, 2.0, 4.0]
    df = spark.createDataFrame([("a", v) for v in x] + [("b", v) for v in y], "g string, v double")
    got = e.significance_flag(e.t_test_ind(df, "g", "v", "a", "b")).first()
    mx, my = sum(x) / 4, sum(y) / 3
    pooled = (sum((v - mx) ** 2 for v in x) + sum((v - my) ** 2 for v in y)) / 5
    assert got["df"] == 5 and got["t"] == pytest.approx((mx - my) / math.sqrt(pooled * (1 / 4 + 1 / 3)))
    assert got["reject"] is True and got["p_value"] < 0.01


def test_grid_and_champion(spark):
    df = spark.createDataFrame([("m1", 2, 0.5), ("m2", 1, 0.4), ("m3", 9, 0.01)], "name string, k int, s double")
    grid = e.experiment_grid(df, "name", [5, 6], limit=0).orderBy("run_no").collect()
    assert [(r["run_no"], r["seed"], r["name"]) for r in grid] == [
        (1, 5, "m1"), (2, 5, "m2"), (3, 5, "m3"), (4, 6, "m1"), (5, 6, "m2"), (6, 6, "m3"),
    ]
    assert len({r["score"] for r in grid}) == 6 and all(0 <= r["score"] < 1 for r in grid)
    best = min([("m1", 2, 0.5), ("m2", 1, 0.4), ("m3", 9, 0.01)], key=lambda m: m[1] * math.log(100) - 2 * math.log(1 / m[2]))
    assert e.select_champion(df, "name", F.col("k"), F.col("s")).first()["name"] == best[0]


def _checkpoint(points, mode, patience):
    best = at = stop = None
    misses = 0
    for step, m in points:
        if best is None or (m > best if mode == "max" else m < best):
            best, at, misses = m, step, 0
        else:
            misses += 1
            if misses >= patience:
                stop = step
                break
    return at, best, stop


@pytest.mark.parametrize("limit", [6, 1000])
@pytest.mark.parametrize("mode", ["max", "min"])
def test_best_checkpoint(spark, limit, mode):
    data = [(run, s, float(random.randint(0, 30))) for run, n in (("long", 80), ("short", 2), ("mid", 12)) for s in range(n)]
    df = spark.createDataFrame(data, "run string, step long, m double").repartition(4)
    got = {r["run"]: tuple(r[1:]) for r in e.best_checkpoint(df, "run", "step", "m", mode, 4, limit).collect()}
    for run in ("long", "short", "mid"):
        assert got[run] == _checkpoint([(s, m) for r, s, m in data if r == run], mode, 4)


def test_scaler_uses_training_rows_only(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (100.0, 7.0)], "x double, c double")
    stats = f.fit_scaler(df.filter("x < 50"), ["x", "c"])
    assert stats == {"x": (2.0, 1.0), "c": (7.0, 1.0)}
    assert sorted(r["x_scaled"] for r in f.apply_scaler(df, stats).collect()) == [-1.0, 1.0, 98.0]
    report = {r["feature"]: r for r in f.skew_report(df.filter("x < 50"), df.filter("x > 50"), ["x", "c"]).collect()}
    assert report["x"]["serve_scaled"] == 98.0 and report["c"]["mean_shift"] == 0.0


def test_drift(spark):
    old = spark.createDataFrame([(1, "a", 2.0)], "t int, h string, s double")
    new = spark.createDataFrame([("a", 1, True)], "h string, t long, n boolean")
    assert {r["name"]: r["change"] for r in f.schema_drift(old, new).collect()} == {
        "t": "retyped", "h": "reordered", "s": "removed", "n": "added",
    }


@pytest.mark.parametrize("n", [1, 7, 1000])
def test_split_sizes_are_exact(spark, n):
    df = spark.range(n)
    got = {r["split"]: r["count"] for r in f.split_rows(df, {"train": 0.8, "val": 0.1}, "test", 1, "id").groupBy("split").count().collect()}
    train, val = int(0.8 * n), int(0.1 * n)
    assert got == {k: c for k, c in (("train", train), ("val", val), ("test", n - train - val)) if c}
    two = f.holdout_split(df, 0.3, 1, "id")
    assert two.filter("split = 'test'").count() == math.ceil(0.3 * n)


def test_batches(spark):
    df = spark.range(70).withColumn("v", F.col("id") * 2)
    got = f.batch_rows(df, 32, "id", ["v"], limit=0).orderBy("batch").collect()
    assert [r["n"] for r in got] == [32, 32, 6]
    assert [x["v"] for x in got[2]["rows"]] == [128, 130, 132, 134, 136, 138]
    mixed = f.batch_rows(df, 32, "id", ["id"], seed=3).collect()
    assert sorted(x["id"] for r in mixed for x in r["rows"]) == list(range(70))


def test_models(spark):
    df = spark.createDataFrame([(float(i), float(i % 5), 3.0 * i + 2.0 * (i % 5) + 1) for i in range(40)], "a double, b double, y double")
    one = f.fit_linear(df.withColumn("y", 2 * F.col("a") + 1), ["a"], "y")
    assert one["a"] == pytest.approx(2) and one["intercept"] == pytest.approx(1)
    many = f.fit_linear(df, ["a", "b"], "y")
    assert [many[k] for k in ("a", "b", "intercept")] == pytest.approx([3, 2, 1], abs=1e-6)
    assert f.predict_linear(df, many).filter(F.abs(F.col("predicted") - F.col("y")) > 1e-6).count() == 0
    labelled = df.withColumn("label", (F.col("a") > 20).cast("int"))
    model = f.fit_logistic(labelled, ["a", "b"], "label")
    assert f.predict_logistic(labelled, model).filter("label = predicted").count() >= 38


def test_vectors(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0], 1), (2, [0.0, 0.0], 0)], "id int, v array<double>, t int")
    basis = F.array(F.lit(1.0), F.lit(0.0))
    got = [r[0] for r in df.select(a.projection(F.col("v"), basis)).collect()]
    assert got == pytest.approx([0.36, 0.5])
    top = df.select(a.softmax_top1(F.col("v")).alias("t")).select("t.*").collect()
    assert (top[0]["label"], top[1]["label"]) == (1, 0)
    assert top[0]["confidence"] == pytest.approx(1 / (1 + math.exp(-1)))
    assert df.select(F.get(a.softmax(F.col("v")), F.lit(1))).first()[0] == pytest.approx(top[0]["confidence"])
    ce = math.log(1 + math.exp(-1))
    want = 0.25 * (1 - math.exp(-ce)) ** 2 * ce
    assert df.select(a.focal_loss(F.col("v"), F.col("t"), 0.25, 2.0)).first()[0] == pytest.approx(want)
    each = [r[0] for r in df.select(a.focal_loss(F.col("v"), F.col("t"), 0.25, 2.0)).collect()]
    both = df.select(*[a.focal_loss(F.col("v"), F.col("t"), 0.25, 2.0, how) for how in ("mean", "sum")]).first()
    assert tuple(both) == pytest.approx((sum(each) / 2, sum(each)))
    with pytest.raises(ValueError):
        a.focal_loss(F.col("v"), F.col("t"), 0.25, 2.0, "median")
    assert df.select(a.channel_normalize(F.col("v"), [1.0], [2.0])).first()[0] == [1.0, 1.5]


def test_dropout(spark):
    df = spark.range(50).withColumn("v", F.array([F.lit(1.0)] * 40))
    kept = df.select(a.element_dropout(F.col("v"), 0.3, 1, F.col("id")).alias("d"))
    share = kept.select(F.avg(F.size(F.filter("d", lambda x: x == 0)) / 40)).first()[0]
    assert 0.25 < share < 0.35
    assert rows(kept) == rows(df.select(a.element_dropout(F.col("v"), 0.3, 1, F.col("id"))))
    assert df.select(a.element_dropout(F.col("v"), 1.0, 1, F.col("id"))).first()[0] == [0.0] * 40
    assert df.select(a.element_dropout(F.col("v"), 0.0, 1, F.col("id"))).first()[0] == [1.0] * 40
    with pytest.raises(ValueError):
        a.element_dropout(F.col("v"), 1.5, 1, F.col("id"))


def test_means_and_curve(spark):
    df = spark.createDataFrame([("t", 1, 0.5, True), ("t", 1, 1.5, False)], "ph string, ep int, loss double, ok boolean")
    assert tuple(e.phase_means(df.withColumn("ok", F.col("ok").cast("int")), ["ph", "ep"], "loss", "ok").first()) == ("t", 1, 1.0, 0.5)
    row = e.group_curve(df, "ph", "ep", "loss").first()
    assert row["mean"] == 1.0 and row["sd"] == pytest.approx(math.sqrt(0.5))


def test_tails_stay_exact_for_large_groups():
    start = time.time()
    half = e._exact_u_tail(50_000, 8, 12_500)
    assert time.time() - start < 5 and abs(half - 0.5) < 1e-4
    assert e._exact_u_tail(6, 2, 3) == pytest.approx(0.1) and e._exact_u_tail(0, 3, 2) == 1.0
    for df in (1e5, 1e8, 1e12, 1e14):
        assert e._t_tail(0.05, df) == pytest.approx(0.4800612, abs=2e-7)
    assert e._t_tail(2.0, 0.999999e6) == pytest.approx(e._t_tail(2.0, 1.000001e6), abs=1e-9)
