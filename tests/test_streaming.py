from pyspark.sql import functions as F

from conftest import rows
from recordloom.streaming import streams

SCHEMA = "id long, ts timestamp, kind string"


def _write(spark, folder, data):
    df = spark.createDataFrame(data, "id long, ts string, kind string")
    df.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, folder):
    empty = spark.createDataFrame([], SCHEMA)
    return streams.read_parquet_stream(spark, folder, empty.schema)


def test_texts_stay_unique_across_restarts(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    template = "{{ kind | upper }}{% if kind == 'b' %}!{% endif %}"
    _write(spark, source, [(i, "2024-01-01 00:00:00", "a" if i % 3 else "b") for i in range(300)])
    streams.write_unique(streams.render_stream(_stream(spark, source), template, "id"), out, state).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(out).collect()) == ["A", "B!"]
    _write(spark, source, [(i, "2024-01-02 00:00:00", "abc"[i % 3]) for i in range(300)])
    streams.write_unique(streams.render_stream(_stream(spark, source), template, "id"), out, state).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(out).collect()) == ["A", "B!", "C"]


def test_watermark_keeps_copies_out(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    _write(spark, source, [(i, f"2024-01-01 00:00:{i % 60:02d}", "xy"[i % 2]) for i in range(120)])
    unique = streams.render_stream(_stream(spark, source), "{{ kind }}", "id", ("ts", "1 hour"))
    streams.write_unique(unique, out, state).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(out).collect()) == ["x", "y"]


def test_running_line_totals(spark, tmp_path):
    source, out, state = tmp_path / "lines", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    (source / "1.txt").write_text("ok\nERROR a\n")
    for name, text, want in ((None, None, (2, 1)), ("2.txt", "ERROR b\nERROR c\nfine\n", (5, 3))):
        if name:
            (source / name).write_text(text)
        lines = spark.readStream.option("lineSep", "\n").text(str(source))
        streams.write_totals(streams.count_stream(lines, "ERROR"), out, state).awaitTermination()
        assert rows(spark.read.parquet(out).select("n_lines", "n_matching")) == [want]


def test_outcomes_are_counted_across_restarts_and_leave_the_state(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    template = "{% if kind == 'bad' %}{% else %}{{ kind }}{% endif %}"

    def run(data):
        _write(spark, source, data)
        counts = streams.outcome_stream(_stream(spark, source), template, "ts", "1 hour")
        query = streams.write_changes(counts, out, state)
        query.awaitTermination()
        report = streams.outcome_report(spark, out).orderBy("start").drop("start")
        left = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]][-1]
        return [tuple(r) for r in report.collect()], left

    day = "2024-01-01 10:00:00"
    report, left = run([(i, day, ["a", "b", "bad", "a"][i % 4]) for i in range(400)] + [(900, None, "a")])
    assert report == [(400, 100, 2, 298)] and left == 3
    report, left = run([(1, "2024-01-01 11:00:00", "a"), (2, "2024-01-01 12:00:00", "c"), (3, "2024-01-01 12:00:00", "bad")])
    assert report == [(403, 101, 3, 299)] and left == 4
    report, left = run([(4, "2024-01-05 00:00:00", "a")])
    assert report == [(403, 101, 3, 299), (1, 0, 1, 0)]
    report, left = run([(5, "2024-01-01 10:00:00", "late"), (6, "2024-01-05 01:00:00", "a")])
    assert report == [(403, 101, 3, 299), (2, 0, 1, 1)] and left == 1
