"""Log parsing, routing, daily indices, retention; streams against batches."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from clipyard.operators import logs
from clipyard.session import scratch_path
from clipyard.sinks import logs as sinks
from clipyard.sources import indices
from clipyard.sources import logs as sources
from clipyard.streaming import log_stream

LEVELS = ["FATAL", "ERROR", "WARN", "INFO", "DEBUG", "TRACE"]
LINES = [
    f"2024-01-0{n % 3 + 1} 07:37:51.99{n} | {level:5} | main       | lnetgateway.Server  :56    | m | {n}"
    for n, level in enumerate(LEVELS)
]


@pytest.fixture
def lines(spark):
    rows = [(x,) for x in [*LINES, "  at a.b.C(D.java:1)", "2024-13-99 00:00:00.000" + LINES[1][23:]]]
    return spark.createDataFrame(rows, "value string")


def test_parse(lines):
    rows = {r["line"]: r for r in sources.parse_lines(lines).collect()}
    first = rows[LINES[0]].asDict()
    assert first == {
        "line": LINES[0], "ts": datetime(2024, 1, 1, 7, 37, 51, 990000), "level": "FATAL", "thread": "main",
        "class": "lnetgateway.Server", "line_no": "56", "message": "m | 0",
    }
    assert rows["  at a.b.C(D.java:1)"]["level"] is None and len(rows) == 8
    assert rows["2024-13-99 00:00:00.000" + LINES[1][23:]]["ts"] is None


def test_format_is_the_inverse(spark):
    df = spark.createDataFrame([(datetime(2024, 5, 6, 7, 8, 9, 123456), "WARN", "t", "c.D", "7", "x")], "a timestamp, b string, c string, d string, e string, f string")
    line = df.select(sources.format_line(*[F.col(c) for c in "abcdef"]).alias("value"))
    row = sources.parse_lines(line).first()
    assert row["ts"] == datetime(2024, 5, 6, 7, 8, 9, 123000)
    assert [row[c] for c in ("level", "thread", "class", "line_no", "message")] == ["WARN", "t", "c.D", "7", "x"]


def test_severity_routing(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    routed = logs.route_by_severity(sources.parse_lines(lines)).collect()
    got = {}
    for r in routed:
        got.setdefault(r["sink"], set()).add(r["level"])
    assert got == {
        "DATA": {"FATAL", "ERROR", "WARN", "INFO"},
        "all": {"FATAL", "ERROR", "WARN", "INFO"},
        "error": {"FATAL", "ERROR"},
        "warn": {"WARN"},
    }


def test_level_range(spark):
    df = spark.createDataFrame([(x,) for x in [*LEVELS, "odd"]], "level string")
    rows = df.filter(logs.level_between(F.col("level"), "ERROR", "INFO")).collect()
    assert [r[0] for r in rows] == ["ERROR", "WARN", "INFO"]


def test_severity_files(spark, lines):
    root = scratch_path(spark, "files")
    sinks.write_severity_files(logs.route_by_severity(sources.parse_lines(lines)).filter("ts IS NOT NULL"), root)
    assert [r[0] for r in spark.read.text(f"{root}/day=2024-01-03/sink=warn").collect()] == [LINES[2]]


def test_json_events(spark):
    df = spark.createDataFrame([('{"message":"m","n":1}',), ("junk",)], "value string")
    rows = sources.json_events(df, "message STRING, n INT").collect()
    assert [tuple(r) for r in rows] == [("m", 1, ["docker-elk"]), (None, None, ["docker-elk"])]


def daily(spark):
    return spark.range(10).select(
        "id", F.expr("timestamp_ntz'2024-01-20 00:00:00' + make_interval(0,0,0,cast(id as int),5)").alias("ts")
    )


def test_index_set(spark, capsys):
    root = scratch_path(spark, "indices")
    sinks.write_daily_indices(daily(spark), root)
    assert indices.index_set(spark, root).count() == 10
    some = indices.index_set(spark, root, "logstash-2024.01.2*")
    assert some.count() == 10 and indices.index_set(spark, root, "*.29").count() == 1
    some.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(index_name" in plan


def test_retention(spark):
    rows = [("logstash-2024.01.27", "2024-01-27"), ("logstash-2024.01.28", "2024-01-28"), ("other-2024.01.01", "2024-01-01")]
    df = spark.createDataFrame(rows, "index_name string, created string")
    kept = logs.retain(df, "2024-01-30 00:00:00").collect()
    assert [r["index_name"][-10:] for r in kept] == ["2024.01.28", "2024.01.01"]


def test_drop_expired_partitions(spark):
    rows = logs.with_daily_index(daily(spark)).unionByName(
        daily(spark).limit(1).withColumn("index_name", F.lit("other-2000.01.01"))
    )
    rows.write.partitionBy("index_name").format("parquet").saveAsTable("log_events")
    dropped = sinks.drop_expired(spark, "log_events", "2024-01-30 00:00:00")
    assert sorted(dropped) == [f"logstash-2024.01.{d}" for d in range(20, 28)]
    assert sinks.drop_expired(spark, "log_events", "2024-01-30 00:00:00") == []
    assert spark.table("log_events").count() == 3
    spark.sql("DROP TABLE log_events")


def test_streams_equal_batches(spark):
    folder = scratch_path(spark, "lines")
    for line in LINES:
        spark.createDataFrame([(line,)], "value string").write.mode("append").text(folder)
    batch = sources.parse_lines(spark.read.text(folder))
    for start, want in (
        (log_stream.start_severity_files, logs.route_by_severity(batch).select("sink", "line")),
        (log_stream.start_daily_indices, logs.with_daily_index(batch).select("index_name", "line")),
    ):
        out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
        for _ in range(2):  # the second run finds nothing new
            source = sources.line_stream(spark, folder, maxFilesPerTrigger=2)
            start(source, out, state).awaitTermination()
        got = spark.read.parquet(out).select(want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stream_batches_are_rebalanced_and_replaced(spark):
    folder = scratch_path(spark, "lines")
    for line in LINES:
        spark.createDataFrame([(line,)], "value string").write.mode("append").text(folder)
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")
    log_stream.start_severity_files(sources.line_stream(spark, folder), out, state).awaitTermination()
    first = sorted(map(tuple, spark.read.parquet(out).select("day", "sink", "line", "batch").collect()))
    # A replayed batch (the same writer and id written again) replaces its own partitions.
    again = spark.read.parquet(out).drop("batch")
    again.withColumn("batch", F.lit(first[0][3])).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("day", "sink", "batch").parquet(out)
    assert sorted(map(tuple, spark.read.parquet(out).select("day", "sink", "line", "batch").collect())) == first
