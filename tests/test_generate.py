import ast

import pytest
from pyspark.sql import functions as F

from conftest import CATALOG, rows
from recordloom import scale
from recordloom.operators import generate as g
from recordloom.operators.catalog import DOUBLE_BODY, MISSING_BODY, catalog_listing, check_catalog, load_stats
from recordloom.operators.params import bind_params, draw_patterns, expand_grid
from recordloom.sources.catalog import parse_catalog, read_catalog, read_catalog_files


@pytest.fixture(scope="module")
def catalog(spark):
    good, _ = read_catalog(spark, CATALOG)
    return good.cache()


def test_read_catalog(spark, catalog):
    _, bad = read_catalog(spark, CATALOG)
    ids = {r["pattern_id"] for r in catalog.collect()}
    assert ids == {"basics.greeting", "shapes.area", "shapes.star", "tables.broken"}
    errors = {r["path"]: r["errors"] for r in bad.collect()}
    assert set(errors) == {"tables/nobody.yaml", "tables/unreadable.yaml"}
    assert errors["tables/nobody.yaml"] == [MISSING_BODY]


def test_load_stats_and_listing(spark):
    parsed = parse_catalog(read_catalog_files(spark, CATALOG))
    assert tuple(load_stats(check_catalog(parsed)).first()) == (4, 2, 1)
    listed = [tuple(r) for r in catalog_listing(parsed).collect()]
    assert listed[0] == ("general", "basics.greeting", "Greets a person by name.")
    assert [r[0] for r in listed] == ["general", "shapes", "shapes", "tables", "tables/deep"]
    lines = [r["line"] for r in catalog_listing(parsed, "markdown").collect()]
    assert lines[:2] == ["## General", "- **`basics.greeting`**: Greets a person by name."]


def test_both_bodies_and_wrong_types(spark):
    text = (
        "x_version: '1'\npattern_id: 5\nmetadata: {author: a, description: d, tags: [1], pedagogy: {concept: c}}\n"
        "instruction: i\ntemplate: t\ncomponents: {imports: x}\nparameters: {p: {type: int, description: d}}\n"
    )
    df = spark.createDataFrame([("a.yaml", text)], "path string, yaml_text string")
    errors = check_catalog(parse_catalog(df)).first()["errors"]
    assert DOUBLE_BODY in errors and MISSING_BODY not in errors
    assert "pattern_id must be str" in errors and "pattern_id is missing" in errors
    assert "metadata.pedagogy.difficulty is missing" in errors
    assert "metadata.tags must hold only str" in errors
    assert "parameters.p.default is missing" in errors


def test_normalized_fields(catalog):
    r = {x["pattern_id"]: x for x in catalog.collect()}
    assert r["basics.greeting"]["components"]["model_definition"].startswith("def greet")
    assert r["basics.greeting"]["requires"] == [] and r["shapes.star"]["validation"]["tests"] == []
    assert r["shapes.area"]["components"]["imports"] == "import math"
    assert r["shapes.area"]["parameters"]["names"]["default"]["items"] == ["width", "height"]


def test_grid_is_the_full_product(catalog):
    sizes = {r["pattern_id"]: r["count"] for r in expand_grid(catalog).groupBy("pattern_id").count().collect()}
    assert sizes == {"basics.greeting": 6, "shapes.area": 2, "shapes.star": 1, "tables.broken": 1}
    both = expand_grid(catalog, include_bools=True).filter("pattern_id = 'basics.greeting'")
    assert both.count() == 12
    contexts = [
        tuple(r["ctx"][n]["v"] for n in ("who", "tone", "fix")) for r in both.orderBy("grid_no").collect()
    ]
    assert len(set(contexts)) == 12
    assert contexts[:2] == [("the crew", "warm", "True"), ("the crew", "warm", "False")]


def test_binding_keeps_defaults_and_draws_options(spark, catalog):
    tries = spark.range(400).withColumnRenamed("id", "attempt")
    bound = bind_params(draw_patterns(tries, catalog, 1, "pattern_id"), 1).collect()
    assert len(bound) == 400
    greet = [r["ctx"] for r in bound if r["pattern_id"] == "basics.greeting"]
    assert {c["tone"]["v"] for c in greet} == {"warm", "dry", "loud"}
    assert {c["fix"]["v"] for c in greet} == {"True"}
    assert draw_patterns(tries, catalog.limit(0), 1, "pattern_id").count() == 0


def _rendered(catalog, **kw):
    return g.render_samples(expand_grid(g.compile_catalog(catalog), **kw))


def test_rendered_text(catalog):
    by_id = {}
    for r in _rendered(catalog).orderBy("grid_no").collect():
        by_id.setdefault(r["pattern_id"], []).append(r)
    first = by_id["basics.greeting"][0]
    assert first["instruction"] == "Write a function that greets The Crew in warm tone."
    assert first["code"] == 'def greet():\n    return "hello the crew"'
    assert first["tests"] == ['assert greet().lower() == "hello the crew"']
    assert by_id["basics.greeting"][2]["code"] == 'def greet():\n    return "HELLO THE CREW"'
    area = by_id["shapes.area"][0]
    assert area["instruction"] == "Compute the area of a square with width and height."
    assert area["code"] == (
        "import math\n\nwidth, height = 2, 3\n\ndef area(width=0, height=0, scale=1):\n"
        "    return math.prod([width, height]) * scale"
    )
    broken = by_id["tables.broken"][0]
    assert broken["code"] is None and "unknown_filter" in broken["render_error"]


def test_tests_are_rendered_with_defaults(catalog):
    tests = F.array(F.lit("assert 1"), F.lit("{{ n | nosuch }}"))
    own = F.struct(F.lit(True).alias("linter_checks"), tests.alias("tests"))
    none = F.struct(F.lit(True).alias("linter_checks"), F.lit(None).cast("array<string>").alias("tests"))
    shown = g.render_defaults(catalog.withColumn("validation", own)).select("tests").collect()
    assert shown and all(r["tests"] == ["assert 1", "{{ n | nosuch }}"] for r in shown)
    bare = g.render_defaults(catalog.withColumn("validation", none)).select("tests").collect()
    assert all(r["tests"] == [] for r in bare)


def test_render_defaults(catalog):
    code = {r["pattern_id"]: r["code"] for r in g.render_defaults(catalog).collect()}
    assert code["tables.broken"] == "x = {{ value | unknown_filter }}"
    assert code["shapes.star"].startswith("from math import *")


def test_assemble_order_and_requires(catalog):
    one = catalog.filter("pattern_id = 'shapes.area'")
    code = g.assemble(one, order=["model_definition", "data_setup", "imports"], with_requires=True).first()["code"]
    assert code.startswith("import math\nfrom typing import List\n\ndef area")
    assert code.endswith("import math")


def test_generated_dataset(spark, catalog):
    samples, report = g.generate_dataset(catalog, 5, seed=4, max_factor=40)
    got = samples.orderBy("attempt").collect()
    assert len(got) == 5 == report["accepted"] and report["shortfall"] == 0
    assert report["attempts"] == got[-1]["attempt"] + 1
    assert len({r["code"] for r in got}) == 5
    for r in got:
        ast.parse(r["code"])
        assert "import *" not in r["code"]


def test_large_catalogs_and_rounds_are_not_broadcast(spark, catalog, monkeypatch):
    attempts = spark.range(50).withColumnRenamed("id", "attempt")
    want = rows(g.generate_attempts(catalog, attempts, 4))
    _, told = g.generate_dataset(catalog, 50, seed=4, max_factor=4)
    monkeypatch.setattr("recordloom.scale.BROADCAST_ROWS", 2)
    marked = []
    monkeypatch.setattr(g, "unbroadcast", lambda df, n: marked.append(n) or scale.unbroadcast(df, n))
    judged = g.generate_attempts(catalog, attempts, 4)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 2
    assert rows(judged) == want
    assert "SortMergeJoin" in draw_patterns(attempts, catalog, 4, "pattern_id")._jdf.queryExecution().toString()
    # the catalog, then contexts and texts of the attempts before the second round
    marked.clear()
    assert g.generate_dataset(catalog, 50, seed=4, max_factor=4)[1] == told
    assert marked == [catalog.count(), 100, 100]
    # a catalog that is numbered in blocks is not broadcast to its numbers either
    monkeypatch.setattr(g, "is_small", lambda df: False)
    monkeypatch.setattr(g, "BROADCAST_ROWS", 2)
    plans = []
    monkeypatch.setattr(
        g, "materialize", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    )
    assert g.index_catalog(catalog).count() == catalog.count()
    assert "SortMergeJoin" in plans[0] and plans[0].count("BroadcastHashJoin") == 1  # of the block borders


def test_shortfall_and_reject_counts(catalog):
    samples, report = g.generate_dataset(catalog, 50, seed=4, max_factor=4)
    # four greetings differ (a dry one reads like a warm one), both areas read alike
    assert report["accepted"] == samples.count() == 5
    assert report["shortfall"] == 45 and report["attempts"] == 200
    assert report["invalid"] == 1
    assert report["accepted"] + report["invalid"] + report["render_errors"] + report["repeated"] == 200


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_result_does_not_depend_on_partitions(spark, catalog, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        samples, _ = g.generate_dataset(catalog, 4, seed=9, max_factor=50)
        got = [tuple(r[:4]) for r in samples.orderBy("attempt").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    samples, _ = g.generate_dataset(catalog, 4, seed=9, max_factor=50)
    assert got == [tuple(r[:4]) for r in samples.orderBy("attempt").collect()]


def _later(spark, path):
    """Modification times of the files of finished rounds."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return {r["path"]: r["modificationTime"] for r in names.select("path", "modificationTime").collect()}


def test_rounds_draw_new_attempts_only_and_resume(spark, catalog, tmp_path, monkeypatch):
    want = rows(g.generate_dataset(catalog, 6, seed=4, max_factor=30)[0])
    monkeypatch.setattr(g, "FIRST_FACTOR", 1)
    folder = str(tmp_path / "run")
    samples, report = g.generate_dataset(catalog, 6, seed=4, max_factor=30, folder=folder)
    assert rows(samples) == want
    seen, texts, choices, at = 0, set(), set(), 0
    while (tmp_path / "run" / f"round-{at}").exists():
        made = spark.read.parquet(f"{folder}/round-{at}/judged").collect()
        new = spark.read.parquet(f"{folder}/round-{at}/contexts").collect()
        end = max(2 * seen, 6)
        assert all(seen <= r["attempt"] < end for r in [*made, *new])
        assert not texts & {r["md5"] for r in made if r["md5"]}
        assert not choices & {(r["pattern_pos"], r["choice"]) for r in new}
        texts |= {r["md5"] for r in made}
        choices |= {(r["pattern_pos"], r["choice"]) for r in new}
        seen, at = end, at + 1
    assert at > 1
    # a run that was cut off in its last round keeps the finished ones
    (tmp_path / "run" / f"round-{at - 1}" / "judged" / "_SUCCESS").unlink()
    before = _later(spark, folder)
    again, second = g.generate_dataset(catalog, 6, seed=4, max_factor=30, folder=folder)
    assert rows(again) == want and second == report
    after = _later(spark, folder)
    kept = {p for p in before if f"round-{at - 1}/judged" not in p}
    assert kept and all(after[p] == before[p] for p in kept)
    with pytest.raises(ValueError):
        g.generate_dataset(catalog, 6, seed=5, max_factor=30, folder=folder)


def test_no_samples_wanted(catalog):
    samples, report = g.generate_dataset(catalog, 0, seed=1)
    assert samples.count() == 0 and report["attempts"] == report["accepted"] == 0


def test_empty_catalog(catalog):
    samples, report = g.generate_dataset(catalog.limit(0), 3, seed=1, max_factor=5)
    assert samples.count() == 0 and report["accepted"] == 0 and report["attempts"] == 15


def test_batch(catalog):
    got = g.generate_batch(catalog, "basics.greeting", 30, seed=2).collect()
    assert len({r["code"] for r in got}) == len(got) == 4
    star = g.generate_batch(catalog, "shapes.star", 3, seed=2)
    assert star.count() == 0  # the only unique text is attempt 0, and it fails
    assert g.generate_batch(catalog, "shapes.star", 3, seed=2, validate_sample=False).count() == 1


def test_pairs_share_their_context(catalog):
    pairs = g.pair_flawed_fixed(_rendered(catalog, include_bools=True).filter("render_error is null"), "fix")
    got = pairs.collect()
    assert len(got) == 6
    assert sum(r["flawed"] != r["fixed"] for r in got) == 4  # loud ones do not use the flag


def test_dedup_is_idempotent_and_keeps_the_first(spark):
    data = [(i, "copy" if i % 3 == 0 else f"text {i % 50}") for i in range(1, 400)] + [(400, ""), (401, None)]
    df = spark.createDataFrame(data, "id long, text string")
    once = g.dedup_md5(df, "text", "id")
    firsts = {}
    for i, t in data:
        if t:
            firsts.setdefault(t, i)
    assert {r["id"] for r in once.collect()} == set(firsts.values())
    assert rows(g.dedup_md5(once.drop("md5"), "text", "id")) == rows(once)


def test_turns_hot_conversation(spark):
    roles = ["system", "user", "assistant", "user", "user", "assistant", "assistant"]
    data = [(1, i, roles[i % 7], f"t{i}") for i in range(300)] + [(2, 0, "user", "alone"), (3, 0, "user", "q"), (3, 5, "assistant", "a")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    small, hot = g.turns_to_records(df), g.turns_to_records(df, limit=20)
    assert rows(small) == rows(hot)
    by_conv = {}
    for c, t, r, x in data:
        by_conv.setdefault(c, []).append((t, r, x))
    want = sum(a[1] == "user" and b[1] == "assistant" for turns in by_conv.values() for a, b in zip(turns, turns[1:]))
    assert small.count() == want


def test_records_shape(spark):
    df = spark.createDataFrame([("do", "x = 1")], "instruction string, code string")
    assert g.to_records(df).first().asDict() == {"instruction": "do", "input": "", "output": "x = 1"}
