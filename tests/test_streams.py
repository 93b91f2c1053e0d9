"""Streams against the batch forms of the same operators."""

import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import panes as batch_panes
from millrace.operators import triggers as T
from millrace.session import scratch_path
from millrace.streaming import jobs as J
from millrace.streaming import processors as P


def drops(spark, rows, schema):
    """One file per element of ``rows``, in that order; a stream takes one per micro-batch."""
    path = scratch_path(spark, "drops")
    for number, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05 if number else 0.0)  # the source orders files by their time
    return path


def collect(spark, stream):
    out = scratch_path(spark, "out")
    J.run_available(J.append_files(stream, out, J.new_checkpoint(spark)))
    return spark.read.schema(stream.schema).parquet(out)


# Event times (s) of the elements of each batch; windows of 10 s, lateness 5 s.
ARRIVED = [[0, 4, 6], [4, 7, 11], [0, 5, 6, 14], [9, 9, 16], [9, 17], [1, 31], [26, 45], [100]]


def test_stream_panes_equal_batch_panes(spark):
    schema = "k string, batch_id long, s long, v long"
    # Spark's watermark starts at the epoch and is never before it, so the times are well after it.
    log = [[(k, b, 1_000_000 + s, s + 1) for s in times for k in ("a", "b")] for b, times in enumerate(ARRIVED)]
    path = drops(spark, log, schema)
    stream = J.stream_files(spark, path, schema, files_per_batch=1).withColumn("ts", F.timestamp_seconds("s"))
    flat = spark.createDataFrame([row for part in log for row in part], schema).withColumn("ts", F.timestamp_seconds("s"))
    names = ["k", "window_start", "window_end", "pane_index", "pane_timing", "n", "total"]
    for trigger in (T.default_trigger(), T.or_finally(T.AfterCount(2))):
        want = batch_panes.trigger_panes(flat, ["k"], "v", trigger, 10, 5).where("window_start < 1000100000000")
        got = collect(spark, P.stream_panes(stream, ["k"], "ts", "v", trigger, 10, 5))
        rows = sorted(tuple(r) for r in got.select(*names).collect())
        assert rows == sorted(tuple(r) for r in want.select(*names).collect())
        assert any(r[4] == "LATE" for r in rows)


def test_count_buffer_keeps_the_rest(spark):
    schema = "k string, n long"
    path = drops(spark, [[("a", n) for n in range(0, 7)], [("a", n) for n in range(7, 12)] + [("b", 0)]], schema)
    stream = J.stream_files(spark, path, schema, files_per_batch=1)
    got = collect(spark, P.stream_batches_by_count(stream, ["k"], F.col("n"), F.lit(5))).collect()
    assert sorted((r.k, r.batch, sorted(map(int, r["items"]))) for r in got) == [
        ("a", 0, [0, 1, 2, 3, 4]),
        ("a", 1, [5, 6, 7, 8, 9]),
    ]


def test_null_gives_out_the_rest(spark):
    schema = "k string, n long"
    path = drops(spark, [[("a", n) for n in range(0, 7)], [("a", None), ("b", None)]], schema)
    stream = J.stream_files(spark, path, schema, files_per_batch=1)
    got = collect(spark, P.stream_batches_by_count(stream, ["k"], F.col("n"), F.lit(5))).collect()
    assert sorted((r.k, r.batch, len(r["items"])) for r in got) == [("a", 0, 5), ("a", 1, 2)]


def test_lines_of_paths(spark, tmp_path):
    for name, content in {"c.txt": "1\n2\n", "a b.txt": "1", "e.txt": "", "g1.log": "1\n2", "g2.log": "3\n", "g/deep.log": "9"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(content)
    names = ["c.txt", "a b.txt", "e.txt", "g*.log", "*/deep.log", "no path"]
    messages = [(n if n == "no path" else f"file:{tmp_path}/{n}", k) for k, n in enumerate(names)]
    stream = J.stream_files(spark, drops(spark, [messages], "path string, k long"), "path string, k long")
    counted = J.count_lines_of_paths(stream, "path", "k", r"file:/.*")
    assert {r.ts: r.lines for r in collect(spark, counted).collect()} == {0: 2, 1: 1, 2: 0, 3: 3, 4: 1}
    missing = spark.createDataFrame([(f"file:{tmp_path}/x*", 0)], "path string, k long")
    with pytest.raises(Exception, match="no file for"):
        J.count_lines_of_paths(missing, "path", "k", r"file:/.*").collect()


def test_stream_panes_keep_fractions(spark):
    rows = [[("a", 1_000_000.0, 0.75), ("a", 1_000_001.0, 0.75)], [("a", 2_000_000.0, 1.0)]]
    schema = "k string, s double, v double"
    stream = J.stream_files(spark, drops(spark, rows, schema), schema, files_per_batch=1).withColumn("ts", F.timestamp_seconds("s"))
    got = collect(spark, P.stream_panes(stream, ["k"], "ts", "v", T.default_trigger(), 10, 5)).collect()
    assert [(r.n, r.total) for r in got] == [(2, 1.5)]


def test_time_buffer_releases_on_the_timer(spark):
    schema = "k string, n long"
    path = drops(spark, [[("a", 1), ("a", 2)]], schema)
    stream = J.stream_files(spark, path, schema, files_per_batch=1)
    out = scratch_path(spark, "out")
    buffered = P.stream_batches_by_time(stream, ["k"], F.col("n"), F.lit(1))
    query = J.append_files(buffered, out, J.new_checkpoint(spark)).trigger(processingTime="200 milliseconds").start()
    try:
        deadline = time.time() + 60
        rows = []
        while not rows and time.time() < deadline:
            time.sleep(1)
            rows = spark.read.schema(buffered.schema).parquet(out).collect() if query.lastProgress else []
    finally:
        query.stop()
    assert [(r.k, sorted(r["items"])) for r in rows] == [("a", ["1", "2"])]


def test_streaming_duplicates_and_windows(spark):
    from millrace.sources import messages

    schema = "uuid string, s long"
    path = drops(spark, [[("x", 1), ("x", 1), ("y", 2)], [("x", 3), ("z", 400)], [("w", 2000)]], schema)
    stream = J.stream_files(spark, path, schema, files_per_batch=1).withColumn("ts", F.timestamp_seconds("s"))
    once = messages.drop_repeated_stream(stream, "ts", "60 seconds")
    assert sorted(r.uuid for r in collect(spark, once).collect()) == ["w", "x", "y", "z"]
    counted = J.windowed_aggregate(stream, "ts", [], [F.count("*").alias("n")], 300, 60)
    assert sorted((r.window_start // 1_000_000, r.n) for r in collect(spark, counted).collect()) == [(0, 4), (300, 1)]


def test_session_gap_in_a_stream(spark):
    schema = "k string, s long"
    path = drops(spark, [[("a", s) for s in (0, 119, 239, 359)], [("a", 100_000)]], schema)
    stream = J.stream_files(spark, path, schema, files_per_batch=1).withColumn("ts", F.timestamp_seconds("s"))
    sessions = J.session_aggregate(stream, "ts", ["k"], [F.count("*").alias("n")], 120, 60)
    got = sorted((r.window_start // 1_000_000, r.window_end // 1_000_000, r.n) for r in collect(spark, sessions).collect())
    assert got == [(0, 239, 2), (239, 359, 1), (359, 479, 1)]


def test_stop_when_idle(spark):
    path = drops(spark, [[("a", 1)]], "k string, n long")
    stream = J.stream_files(spark, path, "k string, n long")
    out = scratch_path(spark, "out")
    query = J.append_files(stream, out, J.new_checkpoint(spark)).trigger(processingTime="100 milliseconds").start()
    J.stop_when_idle(query, idle_seconds=3, poll_seconds=0.2)
    assert not query.isActive and spark.read.parquet(out).count() == 1


def test_groups_of_events_are_a_partition(spark, tmp_path):
    from millrace.plans.registry import Tables
    from millrace.plans.streams import _grouped_events

    times = [None, *(f"2024-01-0{d} 00:00:00" for d in range(1, 8)), None]
    rows = [(i, "purchase", t) for i, t in enumerate(times)]
    frame = spark.createDataFrame(rows, "event_id long, event_type string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    frame.write.parquet(str(tmp_path / "events.parquet"))
    groups = spark.read.parquet(_grouped_events(Tables(spark, str(tmp_path))) + "/group-*")
    assert sorted(r.event_id for r in groups.collect()) == list(range(len(rows)))


def test_written_files_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """What a task writes and a micro-batch takes stays bounded, and a micro-batch is still one part of the events."""
    from millrace.plans import streams
    from millrace.plans.registry import all_queries

    assert streams._files_for(spark.range(10)) == streams.FILES
    monkeypatch.setattr(streams, "ROWS_PER_FILE", 100)
    monkeypatch.setattr(streams, "MANY_ROWS", 10)
    monkeypatch.setattr(streams, "FILES_AT_ONCE", 4)
    assert streams._files_for(spark.range(950), spark.range(1000)) == 10
    assert streams._files_for(spark.range(15), spark.range(1000)) == streams.FILES
    spark.range(1000).selectExpr("id AS o_orderkey", "'O' AS o_orderstatus").write.parquet(str(tmp_path / "orders.parquet"))
    read = []
    plain = streams.J.stream_files
    monkeypatch.setattr(streams.J, "stream_files", lambda s, path, *a, **k: read.append((path, k["files_per_batch"])) or plain(s, path, *a, **k))
    once = all_queries()["stream_dedup_by_uuid"](spark, str(tmp_path))
    assert sorted(r.o_orderkey for r in once.collect()) == list(range(1000))
    path, at_once = read.pop()
    first = spark.read.parquet(path.replace("*", "step-0"))
    assert at_once == 4 and first.count() == 1200 and len(first.inputFiles()) == 12
