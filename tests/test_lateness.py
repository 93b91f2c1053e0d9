"""Late elements on Spark's watermark, element by element."""

from collections import Counter

from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import jobs as J
from millrace.streaming.lateness import dropped_by_watermark, panes_with_late_rows
from tests.test_streams import collect, drops

SIZE, LATENESS, BASE = 10, 5, 1_000_000
# Event times of each micro-batch; the watermark is the largest of those before.
ARRIVED = [[0, 4, 6, 12], [4, 11], [0, 15, 19], [9, 21, 25], [9, 14, 16, 25], [1, 19, 26, 100], [99, 12], [200]]


def expected(keys):
    out, panes, watermark = Counter(), Counter(), None
    held = {}
    for times in [*ARRIVED, []]:
        rows = Counter((s // SIZE * SIZE, k) for s in times for k in keys)
        for (start, k), (n, total) in list(held.items()):
            if watermark is not None and watermark >= start + SIZE:
                out[(k, start, 0, "ON_TIME", n, total)] += 1
                panes[(start, k)] += 1
                del held[(start, k)]
        for (start, k), n in rows.items():
            total = sum(s + 1 for s in times if s // SIZE * SIZE == start)
            if watermark is not None and watermark > start + SIZE + LATENESS:
                out[(k, start, None, "DROPPED", n, total)] += 1
            elif watermark is not None and watermark >= start + SIZE:
                out[(k, start, panes[(start, k)], "LATE", n, total)] += 1
                panes[(start, k)] += 1
            else:
                before = held.get((start, k), (0, 0))
                held[(start, k)] = (before[0] + n, before[1] + total)
        watermark = max([*times, *([watermark] if watermark is not None else [])], default=None)
    return out, {start for start, _ in held}


def test_on_time_late_and_dropped(spark):
    schema = "k string, s long, v long, panes int"
    log = [[(k, BASE + s, s + 1, 0) for s in times for k in ("a", None)] for times in ARRIVED]
    stream = J.stream_files(spark, drops(spark, log, schema), schema, files_per_batch=1)
    panes = panes_with_late_rows(stream.withColumn("ts", F.timestamp_seconds("s")), ["k"], "ts", "v", SIZE, LATENESS)
    got = collect(spark, panes)
    assert got.columns == ["k", "window_start", "window_end", "pane_index", "pane_timing", "n", "total"]
    rows = Counter()
    for r in got.collect():
        assert r.window_end - r.window_start == SIZE * 1_000_000
        rows[(r.k, r.window_start // 1_000_000 - BASE, r.pane_index, r.pane_timing, r.n, r.total)] += 1
    wanted, still_open = expected(["a", None])
    assert rows == wanted and still_open == {200}
    timings = Counter(key[3] for key in rows)
    assert min(timings[t] for t in ("ON_TIME", "LATE", "DROPPED")) >= 4
    # Every element of a window that is over is in one row.
    assert sum(row[4] * times for row, times in rows.items()) == 2 * sum(s != 200 for times in ARRIVED for s in times)


def test_null_values_and_times(spark):
    schema = "s long, v double"
    log = [[(BASE, None), (BASE + 1, 0.5), (None, 1.0)], [(BASE + 1000, 1.0)], [(BASE + 3, None), (BASE + 2000, None)]]
    stream = J.stream_files(spark, drops(spark, log, schema), schema, files_per_batch=1)
    panes = panes_with_late_rows(stream.withColumn("ts", F.timestamp_seconds("s")), [], "ts", "v", SIZE, LATENESS)
    got = sorted((r.window_start // 1_000_000 - BASE, r.pane_timing, r.n, r.total) for r in collect(spark, panes).collect())
    assert got == [(0, "DROPPED", 1, None), (0, "ON_TIME", 2, 0.5), (1000, "ON_TIME", 1, 1.0)]


def test_what_spark_itself_drops_is_counted(spark):
    schema = "s long"
    log = [[(BASE + s,) for s in times] for times in ([0, 100], [5, 6, 110], [7, 300])]
    stream = J.stream_files(spark, drops(spark, log, schema), schema, files_per_batch=1).withColumn("ts", F.timestamp_seconds("s"))
    counted = J.windowed_aggregate(stream, "ts", [], [F.count("*").alias("n")], 10, 0)
    out = scratch_path(spark, "out")
    query = J.run_available(J.append_files(counted, out, J.new_checkpoint(spark)))
    got = sorted((r.window_start // 1_000_000 - BASE, r.n) for r in spark.read.parquet(out).collect())
    # Spark's filter goes by the watermark of the micro-batch before, so 5 and 6 still count and 7 does not.
    assert got == [(0, 3), (100, 1), (110, 1)]
    assert dropped_by_watermark(query) == 1
