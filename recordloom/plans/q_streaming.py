"""Registered queries: the streaming jobs, run over all available rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..scale import scratch_path
from ..sources import files
from ..streaming import streams
from .registry import query, table

EVENT_TEMPLATE = "{{ event_type | upper }} by {{ user_id }}{% if event_type == 'error' %} (retry){% endif %}"

DELAY = "30 days"  # a hash leaves the state when the stream's time is so far beyond it
# nothing renders for views
SOME_EVENTS = "{% if event_type == 'view' %}{% else %}{{ event_type | upper }} by {{ user_id }}{% endif %}"


@query(
    "stream_generate",
    """
    SELECT DISTINCT text, md5(text) AS md5 FROM (
      SELECT upper(event_type) || ' by ' || user_id || CASE WHEN event_type = 'error' THEN ' (retry)' ELSE '' END AS text FROM events)""",
)
def stream_generate(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = streams.read_parquet_stream(spark, sf_dir, schema, "events.parquet")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    unique = streams.render_stream(stream, EVENT_TEMPLATE, "event_id", ("ts", DELAY))
    streams.write_unique(unique, out, state).awaitTermination()
    return spark.read.schema("md5 string, text string").parquet(out)


@query(
    "stream_outcomes",
    """
    SELECT day, n_rows, n_rejected, n_texts, n_rows - n_rejected - n_texts AS n_repeated FROM (
      SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_rows,
        count(*) FILTER (WHERE event_type = 'view') AS n_rejected,
        count(DISTINCT event_type || user_id) FILTER (WHERE event_type <> 'view') AS n_texts
      FROM events GROUP BY day)""",
)
def stream_outcomes(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = streams.read_parquet_stream(spark, sf_dir, schema, "events.parquet")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    streams.write_changes(streams.outcome_stream(stream, SOME_EVENTS, "ts", DELAY), out, state).awaitTermination()
    report = streams.outcome_report(spark, out)
    return report.select(
        F.date_format("start", "yyyy-MM-dd").alias("day"), "n_rows", "n_rejected", "n_texts", "n_repeated"
    )


@query(
    "stream_lines",
    """
    SELECT count(*) AS n_lines, count(*) FILTER (WHERE contains(line, 'the')) AS n_matching
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""",
)
def stream_lines(spark, sf_dir):
    source = scratch_path(spark, "stream-lines")
    files.write_lines(table(spark, sf_dir, "documents"), "text", source)
    lines = spark.readStream.option("lineSep", "\n").text(source)
    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    streams.write_totals(streams.count_stream(lines, "the"), out, state).awaitTermination()
    return spark.read.parquet(out).select(F.col("n_lines"), F.col("n_matching"))
