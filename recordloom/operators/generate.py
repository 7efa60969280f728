"""Instruction records from catalogs: render, drop copies, check, shape."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.template import (
    compiled,
    compiled_list,
    render_segment_lists,
    render_segments,
)
from ..scale import (
    BROADCAST_ROWS,
    RANK_BUCKETS,
    at_or_before,
    global_index,
    is_small,
    materialize,
    pin,
    rows_at_ranks,
    running,
    scratch_path,
    unbroadcast,
)
from .params import (
    context_of,
    default_context,
    drawn_choice,
    option_entries,
    with_draw,
)
from .quality import validate

PART_ORDER = ["imports", "data_setup", "training_loop", "evaluation", "model_definition"]


# -------------------------------------------------------------------- rendering


def assemble_parts(parts: list[Column]) -> Column:
    """Non-empty parts joined by a blank line, in the given order."""
    return F.concat_ws("\n\n", *[F.nullif(p, F.lit("")) for p in parts])


def assemble(
    df: DataFrame, out: str = "code", order: list[str] | None = None, with_requires: bool = False
) -> DataFrame:
    """Code template of a pattern; the definition comes last unless `order` says otherwise."""
    parts = [F.col(f"components.{name}") for name in order or PART_ORDER]
    if with_requires:
        lines = F.transform(
            "requires",
            lambda r: F.when(r.startswith("from ") | r.startswith("import "), r).otherwise(
                F.concat(F.lit("import "), r)
            ),
        )
        parts = [F.array_join(lines, "\n"), *parts]
    return df.withColumn(out, assemble_parts(parts))


def compile_catalog(catalog: DataFrame, *keep: str) -> DataFrame:
    """Compiled templates: code, instruction, tests, and why one cannot render."""
    with_code = pin(
        assemble(catalog, "_code"),
        {
            "_c": compiled(F.col("_code")),
            "_i": compiled(F.col("instruction")),
            "_t": compiled_list(F.col("validation.tests")),
        },
    )
    test_error = F.get(F.filter("_t", lambda t: t["error"].isNotNull()), F.lit(0))["error"]
    return with_code.select(
        *keep,
        "pattern_id",
        "parameters",
        F.coalesce("_i.error", "_c.error", test_error).alias("render_error"),
        F.col("_i.segments").alias("instruction_segments"),
        F.col("_c.segments").alias("code_segments"),
        F.transform("_t", lambda t: t["segments"]).alias("test_segments"),
    )


def strip_text(col: Column) -> Column:
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def render_samples(df: DataFrame) -> DataFrame:
    """Add instruction, code and tests to rows that hold compiled templates and `ctx`.

    A row whose templates cannot render keeps null texts and its `render_error`.
    """
    ok = F.col("render_error").isNull()
    texts = {
        "instruction": F.when(ok, render_segments("instruction_segments", "ctx")),
        "code": F.when(ok, strip_text(render_segments("code_segments", "ctx"))),
        "tests": F.when(ok, render_segment_lists("test_segments", "ctx")),
    }
    return pin(df, texts).drop("instruction_segments", "code_segments", "test_segments")


def render_defaults(catalog: DataFrame) -> DataFrame:
    """Code and `tests` with default values only; text that cannot render stays as it is."""
    ready = assemble(catalog, "raw_code")
    raw = F.coalesce("validation.tests", F.array().cast("array<string>"))
    bound = pin(
        ready,
        {
            "_raw": raw,
            "_c": compiled(F.col("raw_code")),
            "_t": compiled_list(raw),
            "_ctx": default_context(F.col("parameters")),
        },
    ).withColumn("_lists", F.transform("_t", lambda t: t["segments"]))
    shown = F.when(F.col("_c.error").isNull(), render_segments("_c.segments", "_ctx"))
    rendered = pin(
        bound,
        {
            "code": F.coalesce(shown, "raw_code"),
            "render_error": F.col("_c.error"),
            "_tests": render_segment_lists("_lists", "_ctx"),
        },
    )
    tests = F.transform(
        "_raw",
        lambda x, i: F.when(F.get("_t", i)["error"].isNull(), F.get("_tests", i)).otherwise(x),
    )
    return rendered.withColumn("tests", tests).drop("_raw", "_c", "_t", "_lists", "_tests", "_ctx")


# ---------------------------------------------------------------- removing copies


def dedup_md5(df: DataFrame, text: str, order: str) -> DataFrame:
    """Drop empty texts and keep the first row (by unique `order`) of each text hash.

    Only (hash, order) pairs are grouped, combined map-side, so a hash shared by a
    third of all rows costs one small row per task. The survivors are then picked by
    their unique order value, a join without hot keys.
    """
    rows = df.filter(F.col(text) != "").withColumn("md5", F.md5(F.col(text).cast("binary")))
    first = rows.groupBy("md5").agg(F.min(order).alias(order)).select(order)
    return rows.join(first, order, "left_semi").select(*df.columns, "md5")


# ----------------------------------------------------------------------- records


def to_records(df: DataFrame, instruction: str = "instruction", output: str = "code") -> DataFrame:
    """The three-field training record."""
    return df.select(
        F.col(instruction).alias("instruction"),
        F.lit("").alias("input"),
        F.col(output).alias("output"),
    )


def turns_to_records(turns: DataFrame, limit: int | None = None) -> DataFrame:
    """User turns directly followed by an assistant turn become records."""
    bounds = {} if limit is None else {"limit": limit}
    after = running(
        turns.select("conv_id", "turn", "role", "text"),
        ["conv_id"],
        [F.col("turn").desc()],
        {"_next": ("lag", F.struct("role", "text"))},
        **bounds,
    )
    return after.filter(
        (F.col("role") == "user") & (F.col("_next.role") == "assistant")
    ).select(
        "conv_id",
        "turn",
        F.col("text").alias("instruction"),
        F.lit("").alias("input"),
        F.col("_next.text").alias("output"),
    )


def pair_flawed_fixed(samples: DataFrame, flag: str) -> DataFrame:
    """Flawed and corrected sample of the same pattern and remaining context.

    One row per side and context is kept first (lowest code), so each pair is single.
    """
    rest = F.to_json(
        F.array_sort(
            F.transform(
                F.map_entries(F.map_filter("ctx", lambda k, _: k != flag)),
                lambda e: F.struct(e["key"], e["value"]),
            )
        )
    )
    sides = samples.select(
        "pattern_id",
        F.md5(rest.cast("binary")).alias("context_md5"),
        F.element_at("ctx", flag)["v"].alias("_flag"),
        "code",
    )
    flawed, fixed = F.col("_flag") == "True", F.col("_flag") == "False"
    return (
        sides.groupBy("pattern_id", "context_md5")
        .agg(
            F.min(F.when(flawed, F.col("code"))).alias("flawed"),
            F.min(F.when(fixed, F.col("code"))).alias("fixed"),
        )
        .filter(F.col("flawed").isNotNull() & F.col("fixed").isNotNull())
    )


# -------------------------------------------------------------------- generation


def index_catalog(catalog: DataFrame, path: str | None = None) -> DataFrame:
    """The catalog compiled and numbered by `pattern_pos`, written once for all rounds."""
    # the narrow ids alone are numbered, so compiling keeps the parallelism of the catalog
    ids = catalog.select("pattern_id")
    if is_small(ids):
        place = F.row_number().over(Window.orderBy("pattern_id")).cast("long") - 1
        places = F.broadcast(ids.select("pattern_id", place.alias("pattern_pos")))
    else:
        places = global_index(ids, ["pattern_id"], "pattern_pos", limit=0)
        # neither side is broadcast: the patterns are wide, however small the files they come from
        places = unbroadcast(places, BROADCAST_ROWS + 1)
    ready = compile_catalog(catalog.join(places, "pattern_id"), "pattern_pos").withColumn(
        "_entries", option_entries(F.col("parameters"))
    ).drop("parameters")
    return materialize(ready, "catalog") if path is None else _kept(ready, path)


def draw_contexts(indexed: DataFrame, size: int, attempts: DataFrame, seed: int) -> DataFrame:
    """(pattern_pos, choice, attempt): the first attempt of every distinct choice that is drawn.

    Attempts only carry numbers up to the grouping, which combines map-side: however
    many attempts there are, at most one row per distinct context goes on.
    """
    names = indexed.select(
        "pattern_pos",
        "pattern_id",
        F.transform(
            "_entries",
            lambda e: F.struct(
                e["name"].alias("name"),
                F.transform(e["options"], lambda o: F.lit(0).cast("tinyint")).alias("options"),
            ),
        ).alias("_shape"),
    )
    choices = with_draw(attempts.select("attempt"), size, seed).join(names, "pattern_pos").select(
        "pattern_pos",
        F.array_join(
            drawn_choice(F.col("_shape"), seed, F.col("attempt"), F.col("pattern_id")).cast(
                "array<string>"
            ),
            ",",
        ).alias("choice"),
        "attempt",
    )
    return choices.groupBy("pattern_pos", "choice").agg(F.min("attempt").alias("attempt"))


def judge_contexts(
    indexed: DataFrame, contexts: DataFrame, validators: list | None = None, seen: DataFrame | None = None
) -> DataFrame:
    """Rendered contexts with their `outcome`, one row per text and one per failure to render.

    Of equal texts the lowest attempt stays, empty texts go, and texts whose `md5` is in
    `seen` are dropped before they are checked. The text is carried through one shuffle; a
    text many contexts share leaves one row per task before it.
    """
    numbers = F.filter(F.split("choice", ","), lambda c: c != "").cast("array<int>")
    bound = pin(contexts.join(indexed, "pattern_pos"), {"ctx": context_of(F.col("_entries"), numbers)})
    rendered = render_samples(bound.drop("_entries", "choice"))
    fine = F.col("render_error").isNull()
    samples = rendered.filter(~fine | (F.col("code") != "")).select(
        "attempt",
        "pattern_id",
        "instruction",
        "code",
        "tests",
        "render_error",
        F.md5(F.col("code").cast("binary")).alias("md5"),
    )
    # a failure has no text, so its attempt stands for one
    same = Window.partitionBy(F.coalesce("md5", F.col("attempt").cast("string"))).orderBy("attempt")
    unique = samples.withColumn("_copy", F.row_number().over(same)).filter("_copy = 1").drop("_copy")
    if seen is not None:
        unique = unique.join(seen.select("md5"), "md5", "left_anti")
    judged = validate(unique, "code", validators or [], parse=True)
    outcome = F.when(~fine, "render_error").when(F.col("valid"), "accepted").otherwise("invalid")
    return judged.select(
        "attempt",
        "pattern_id",
        outcome.alias("outcome"),
        F.coalesce("render_error", "error").alias("error"),
        "instruction",
        "code",
        "tests",
        "md5",
    )


def generate_attempts(
    catalog: DataFrame, attempts: DataFrame, seed: int, validators: list | None = None
) -> DataFrame:
    """Judged samples: `outcome` is accepted, invalid or render_error."""
    indexed = index_catalog(catalog)
    size = indexed.count()
    indexed = unbroadcast(indexed, size)
    contexts = draw_contexts(indexed, size, attempts, seed)
    return judge_contexts(indexed, contexts, validators).drop("md5")


# Attempts per wanted sample in the first round.
FIRST_FACTOR = 2


def _kept(df: DataFrame, path: str) -> DataFrame:
    """The rows of `df` at a path: written now, or by an earlier run that finished them."""
    spark = df.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _claim(catalog: DataFrame, folder: str, plan: str) -> None:
    """Record what a folder's rounds were made from; anything else is refused later."""
    spark = catalog.sparkSession
    rows = F.xxhash64(F.to_json(F.struct(*catalog.columns)))
    mark = catalog.agg(F.concat_ws(":", F.lit(plan), F.count(F.lit(1)), F.bit_xor(rows)).alias("value"))
    wanted = mark.first()["value"]
    found = _kept(spark.createDataFrame([(wanted,)], "value string"), f"{folder}/plan").first()["value"]
    if found != wanted:
        raise ValueError(f"{folder} holds rounds of another catalog, size, seed or ceiling")


def generate_dataset(
    catalog: DataFrame,
    n: int,
    seed: int,
    max_factor: int = 200,
    validators: list | None = None,
    folder: str | None = None,
) -> tuple[DataFrame, dict]:
    """The first n accepted samples of at most n * max_factor attempts, and a report.

    Attempts never depend on later ones, so they are made in rounds that each draw new
    attempts only, as many as all rounds before together, until n are accepted or the ceiling is
    reached. A round drops contexts and text hashes of earlier rounds by anti-joins on those
    narrow columns, then writes its judged rows once; the result is read from these files. The
    stop point is found as an exact rank from a histogram of attempt numbers, so no global
    sort or single-task limit is needed. With `folder` (shared, one per catalog, size, seed
    and ceiling) finished rounds are kept there, and a run that was cut off goes on behind them; the
    validators must then be the same.
    """
    spark, ceiling = catalog.sparkSession, n * max_factor
    if folder is None:
        folder = scratch_path(spark, "rounds")
    else:
        _claim(catalog, folder, f"{n}:{seed}:{max_factor}")
    indexed = index_catalog(catalog, f"{folder}/catalog")
    size, start, counts, cut = indexed.count(), 0, Counter(), None
    indexed = unbroadcast(indexed, size)
    contexts: list[DataFrame] = []
    rounds: list[DataFrame] = []
    while start < ceiling and cut is None:
        end = min(ceiling, max(2 * start, n * FIRST_FACTOR))
        drawn = draw_contexts(indexed, size, spark.range(start, end).withColumnRenamed("id", "attempt"), seed)
        if contexts:
            earlier = unbroadcast(reduce(DataFrame.unionAll, contexts), start)
            drawn = drawn.join(earlier, ["pattern_pos", "choice"], "left_anti")
        at = f"{folder}/round-{len(rounds)}"
        new = _kept(drawn, f"{at}/contexts")
        seen = unbroadcast(reduce(DataFrame.unionAll, rounds), start) if rounds else None
        judged = _kept(judge_contexts(indexed, new, validators, seen), f"{at}/judged")
        contexts.append(new.select("pattern_pos", "choice"))
        rounds.append(judged)
        made = _outcomes(judged)
        if counts["accepted"] + made["accepted"] >= n:
            width = max(1, -(-(end - start) // RANK_BUCKETS))
            bucket = F.floor((F.col("attempt") - start) / width).cast("long")
            accepted = judged.filter(F.col("outcome") == "accepted")
            cut = rows_at_ranks(accepted, bucket, ["attempt"], [n - counts["accepted"]])[0]
            judged = judged.filter(at_or_before(["attempt"], cut))
            rounds[-1], made = judged, _outcomes(judged)
        counts += made
        start = end
    used = start if cut is None else cut[0] + 1
    columns = ["attempt", "pattern_id", "instruction", "code", "tests"]
    if rounds:
        rows = reduce(DataFrame.unionAll, rounds).filter(F.col("outcome") == "accepted").select(columns)
    else:
        texts = {"instruction": "string", "code": "string", "tests": "array<string>"}
        blank = [F.lit(None).cast(kind).alias(name) for name, kind in texts.items()]
        rows = spark.range(0).select(F.col("id").alias("attempt"), F.lit("").alias("pattern_id"), *blank)
    report = dict(
        requested=n,
        accepted=counts["accepted"],
        shortfall=n - counts["accepted"],
        attempts=used,
        invalid=counts["invalid"],
        render_errors=counts["render_error"],
        repeated=used - counts.total(),
    )
    return rows, report


def _outcomes(judged: DataFrame) -> Counter:
    counted = judged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()
    return Counter({r["outcome"]: r["n"] for r in counted})


def generate_batch(
    catalog: DataFrame,
    pattern_id: str | None,
    count: int,
    seed: int,
    validate_sample: bool = True,
    validators: list | None = None,
) -> DataFrame:
    """`count` attempts per pattern (or for one pattern), unique texts of each.

    With `validate_sample` only attempt 0 is checked and dropped when it fails.
    """
    chosen = catalog if pattern_id is None else catalog.filter(F.col("pattern_id") == pattern_id)
    ready = compile_catalog(chosen).withColumn("_entries", option_entries(F.col("parameters")))
    tries = ready.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    choice = drawn_choice(F.col("_entries"), seed, F.col("attempt"), F.col("pattern_id"))
    bound = pin(tries, {"ctx": context_of(F.col("_entries"), choice)}).drop("parameters", "_entries")
    rendered = render_samples(bound).filter(F.col("render_error").isNull() & (F.col("code") != ""))
    samples = materialize(rendered, "batch")
    hashed = samples.withColumn("md5", F.md5(F.col("code").cast("binary")))
    first = hashed.groupBy("pattern_id", "md5").agg(F.min("attempt").alias("attempt"))
    unique = hashed.join(first.select("pattern_id", "attempt"), ["pattern_id", "attempt"], "left_semi")
    columns = ["pattern_id", "attempt", "instruction", "code", "tests", "md5"]
    if not validate_sample:
        return unique.select(columns)
    checked = unique.withColumn(
        "_checked", F.when(F.col("attempt") == 0, F.col("code"))
    )
    judged = validate(checked, "_checked", validators or [], parse=True)
    return judged.filter((F.col("attempt") > 0) | F.col("valid")).select(columns)
