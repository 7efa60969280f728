"""Structured Streaming: rendering without repeats, and line counts."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.template import template_column

SALTS = 16
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _disk_state(df: DataFrame):
    """A query started inside keeps its state on executor disk; the session's setting comes back."""
    conf = df.sparkSession.conf
    before = conf.get(_STORE, None)
    conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        conf.set(_STORE, before) if before else conf.unset(_STORE)


def read_parquet_stream(spark, folder: str, schema: T.StructType, glob: str = "*") -> DataFrame:
    """Files of a folder as a stream, new ones as they arrive."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)


def render_stream(
    stream: DataFrame, template: str, key: str, watermark: tuple[str, str] | None = None
) -> DataFrame:
    """Unique rendered texts of a stream, as (md5, text).

    Copies are dropped in two steps, first per (salt, hash), so that a text shared by a
    third of the rows spreads over SALTS state partitions and the second step sees at
    most SALTS rows of it. With a watermark (column, delay) old hashes leave the state,
    and uniqueness holds within that delay.
    """
    time = [F.col(watermark[0])] if watermark else []
    text = template_column(template, stream.schema)
    rendered = stream.select(
        F.md5(text.cast("binary")).alias("md5"),
        text.alias("text"),
        F.pmod(F.xxhash64(key), F.lit(SALTS)).alias("salt"),
        *time,
    ).filter(F.col("text") != "")
    if not watermark:
        return rendered.dropDuplicates(["md5", "salt"]).dropDuplicates(["md5"]).select("md5", "text")
    timed = rendered.withWatermark(*watermark)
    once = timed.dropDuplicatesWithinWatermark(["md5", "salt"])
    return once.dropDuplicatesWithinWatermark(["md5"]).select("md5", "text", watermark[0])


def write_unique(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all rows available now to Parquet, exactly once, then stop."""
    with _disk_state(stream):
        return (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .outputMode("append")
            .start()
        )


def outcome_stream(stream: DataFrame, template: str, time: str, delay: str, width: str = "1 day") -> DataFrame:
    """Rows per window of time and text hash, as (start, md5, n); the hash is null where nothing renders.

    Counted map-side, so a text shared by a third of the rows is one row per task. A window leaves
    the state once the watermark (`delay` behind the latest time) has passed its end; rows
    that come later still, and rows without a time, are not counted.
    """
    text = template_column(template, stream.schema)
    rendered = stream.withWatermark(time, delay).select(F.col(time), text.alias("text"))
    mark = F.when(F.col("text") != "", F.md5(F.col("text").cast("binary")))
    return (
        rendered.groupBy(F.window(time, width).alias("window"), mark.alias("md5"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("start"), "md5", "n")
    )


def write_changes(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the counts that each batch changed below `path`, one folder per batch, then stop.

    A batch that is repeated after a failure replaces its own folder, so nothing counts twice.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    with _disk_state(counts):
        return (
            counts.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(save)
            .start()
        )


def outcome_report(spark: SparkSession, path: str) -> DataFrame:
    """(start, n_rows, n_rejected, n_texts, n_repeated) per window, from what `write_changes` wrote.

    Of each (window, hash) the count of its last batch holds. Rejected rows rendered to nothing,
    repeated ones to a text their window had already.
    """
    schema = "start timestamp, md5 string, n long, batch_id long"
    changes = spark.read.schema(schema).parquet(path)
    latest = changes.groupBy("start", "md5").agg(F.max_by("n", "batch_id").alias("n"))
    kept = F.col("md5").isNotNull()
    totals = latest.groupBy("start").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~kept, F.col("n"))), F.lit(0)).alias("n_rejected"),
        F.count("md5").alias("n_texts"),
    )
    return totals.withColumn("n_repeated", F.col("n_rows") - F.col("n_rejected") - F.col("n_texts"))


def count_stream(lines: DataFrame, token: str, column: str = "value") -> DataFrame:
    """Running total of lines and of lines with `token`; counted map-side per batch."""
    return lines.groupBy().agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.contains(F.col(column), F.lit(token))).alias("n_matching"),
    )


def write_totals(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Replace the one-row total at `path` after every batch."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(path)

    return (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
