"""Row inserts and watched folders: policies, repeated micro-batches, restarts."""

import datetime
import errno
import pathlib
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.functions import places
from millrace.session import scratch_path
from millrace.sinks import inserts
from millrace.sources import watch
from millrace.streaming import jobs as J
from tests.test_streams import drops

TARGET = "id long not null, price double, day date"


def local(uri: str) -> pathlib.Path:
    return pathlib.Path("/" + uri.removeprefix("file:").lstrip("/"))


class Flaky(inserts.InsertWriter):
    """Its store fails as often as told before it works."""

    def __init__(self, path, retry, faults, **more):
        super().__init__(path, retry, **({"attempts": 3, "request_rows": 2, "wait_seconds": 0.0} | more))
        self.faults, self.puts = list(faults), 0

    def put(self, rows):
        self.puts += 1
        if "error" not in rows.column_names and self.faults:
            if fault := self.faults.pop(0):
                raise fault
        return super().put(rows)


def batch(rows):
    """(id, error) as the sink gets them."""
    record = pa.array([None if e else {"id": i} for i, e in rows], pa.struct([("id", pa.int64())]))
    columns = [pa.array([f'{{"id":{i}}}' for i, _ in rows]), pa.array([e for _, e in rows], pa.string()), pa.array(["t"] * len(rows))]
    return pa.RecordBatch.from_arrays([*columns, record], names=["row", "error", "table", "record"])


def contents(path):
    good = [r["id"] for f in sorted(path.glob("rows/*/*.parquet")) for r in pq.read_table(f).to_pylist()]
    bad = [(r["row"], r["error"]) for f in sorted(path.glob("failed/*/*.parquet")) for r in pq.read_table(f).to_pylist()]
    return good, bad


def test_transient_faults_are_tried_again(tmp_path):
    writer = Flaky(str(tmp_path), inserts.TRANSIENT, [ConnectionError("away"), None, TimeoutError("slow"), OSError("curl")])
    message = writer.write(iter([batch([(1, None), (2, None), (3, None), (4, "bad")])]))
    writer.commit([message], 0)
    assert contents(tmp_path) == ([1, 2, 3], [('{"id":4}', "bad")])
    assert writer.puts == 6 and not list(tmp_path.glob("_drafts*"))


def test_permanent_faults_give_failed_rows(tmp_path):
    writer = Flaky(str(tmp_path), inserts.TRANSIENT, [None, OSError(errno.ENOSPC, "full")])
    writer.commit([writer.write(iter([batch([(1, None), (2, None), (3, None)])])), None], 7)
    assert contents(tmp_path) == ([1, 2], [('{"id":3}', "OSError: [Errno 28] full")])
    assert writer.puts == 3


def test_never_and_always(tmp_path):
    never = Flaky(str(tmp_path / "n"), inserts.NEVER, [ConnectionError("away")])
    never.commit([never.write(iter([batch([(1, None), (2, None), (3, None)])]))], 0)
    assert contents(tmp_path / "n") == ([3], [('{"id":1}', "ConnectionError: away"), ('{"id":2}', "ConnectionError: away")])
    always = Flaky(str(tmp_path / "a"), inserts.ALWAYS, [ValueError("x"), ValueError("y")])
    always.commit([always.write(iter([batch([(1, None)])]))], 0)
    assert contents(tmp_path / "a") == ([1], [])
    ends = Flaky(str(tmp_path / "e"), inserts.TRANSIENT, [ConnectionError("away")] * 3)
    with pytest.raises(ConnectionError):
        ends.write(iter([batch([(1, None)])]))
    ends.abort([None], 0)
    assert not list((tmp_path / "e").rglob("*"))
    with pytest.raises(ValueError):
        inserts.InsertWriter(str(tmp_path), "sometimes", 1, 1, 0)


def test_a_repeated_micro_batch_replaces_its_files(tmp_path):
    first, again = Flaky(str(tmp_path), inserts.NEVER, []), Flaky(str(tmp_path), inserts.NEVER, [])
    first.commit([first.write(iter([batch([(9, None)])]))], 0)
    first.commit([first.write(iter([batch([(1, None), (2, None), (3, None)]), batch([(4, "bad")])]))], 1)
    # The second run has its rows in fewer requests.
    message = again.write(iter([batch([(1, None), (2, None), (4, "bad")])]))
    again.commit([message], 1)
    again.commit([message], 1)
    assert contents(tmp_path) == ([9, 1, 2], [('{"id":4}', "bad")])


ROWS = ['{"id":1,"price":2.5,"day":"2024-01-01"}', '{"id":2}', '{"price":1}', '{"id":3,"extra":1}', "no", None, '{"id":"x"}', '{"id":4}']


def test_a_stream_run_again_from_its_last_commit(spark):
    out, checkpoint = scratch_path(spark, "inserts"), J.new_checkpoint(spark)
    path = drops(spark, [[(r,) for r in ROWS[:4]], [(r,) for r in ROWS[4:]]], "row string")

    def run():
        stream = J.stream_files(spark, path, "row string", files_per_batch=1)
        J.run_available(inserts.insert_rows(stream, TARGET, "people", out, checkpoint))

    run()
    # The last micro-batch was written but, so it looks, never noted: it runs anew.
    commits = sorted((local(checkpoint) / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    good = inserts.inserted_rows(spark, out, TARGET).collect()
    assert sorted(tuple(r) for r in good) == sorted(
        [(1, 2.5, datetime.date(2024, 1, 1)), (2, None, None), (4, None, None)], key=lambda r: r[0]
    )
    bad = Counter(tuple(r) for r in inserts.failed_rows(spark, out).collect())
    wanted = ["missing required field: id", "no such field: extra", "not a record", "not a record", "wrong type in field: id"]
    assert bad == Counter(zip([ROWS[2], ROWS[3], ROWS[4], None, ROWS[6]], wanted, ["people"] * 5))


def test_no_rows_yet(spark):
    path = scratch_path(spark, "inserts")
    assert inserts.inserted_rows(spark, path, TARGET).columns == ["id", "price", "day"]
    assert inserts.failed_rows(spark, path).count() == 0


def test_watch_takes_each_file_once_also_after_a_restart(spark, tmp_path):
    log, out, checkpoint = (scratch_path(spark, n) for n in ("log", "out", "checkpoint"))
    folder = tmp_path / "in"
    folder.mkdir()

    def put(*names):
        for name in names:
            (folder / name).write_text(f"{name}\nsecond\n")

    def run():
        stream = watch.watch_files(spark, f"file://{folder}/*.txt", log, interval_seconds=0)
        J.run_available(J.append_files(stream, out, checkpoint))

    put("a.txt", "b.txt", ".hidden.txt", "_draft.txt", "other.log")
    run()
    put("c.txt", "a.txt")  # one is new, one is written anew
    run()
    run()
    put("d e.txt")
    run()
    rows = spark.read.parquet(out).collect()
    assert sorted(r.path.rpartition("/")[2] for r in rows) == ["a.txt", "b.txt", "c.txt", "d e.txt"]
    assert all(r.size == len(r.path.rpartition("/")[2]) + 8 and r.matched >= r.modified for r in rows)
    counted = J.count_lines_of_paths(spark.read.parquet(out), "path", "matched", ".*")
    assert [r.lines for r in counted.collect()] == [2] * 4


def test_watch_polls_by_the_interval_and_deals_listings(tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(7):
        (folder / f"f{k}").write_text("x")
    monkeypatch.setattr(watch, "FILES_PER_TASK", 3)
    reader = watch.WatchReader(f"{folder}/f*", str(tmp_path / "log"), 3600)
    assert reader.initialOffset() == {"listing": 0} and reader.latestOffset() == {"listing": 1}
    (folder / "f9").write_text("y")
    assert reader.latestOffset() == {"listing": 1}  # not due yet
    reader.polled = float("-inf")
    assert reader.latestOffset() == {"listing": 2}
    parts = reader.partitions({"listing": 0}, {"listing": 2})
    assert [(p.listing, p.begin, p.end) for p in parts] == [(1, 0, 3), (1, 3, 6), (1, 6, 7), (2, 0, 1)]
    # A new reader knows what has come from the listings alone.
    again = watch.WatchReader(f"{folder}/f*", str(tmp_path / "log"), 0)
    assert again.latestOffset() == {"listing": 2}
    paths = [p for part in again.partitions({"listing": 0}, {"listing": 2}) for b in again.read(part) for p in b["path"].to_pylist()]
    assert [p.rpartition("/")[2] for p in paths] == [f"f{k}" for k in range(7)] + ["f9"]
    assert watch.WatchReader(str(folder / "f1"), str(tmp_path / "one"), 0).latestOffset() == {"listing": 1}
    assert watch.WatchReader(str(tmp_path / "none*"), str(tmp_path / "no"), 0).latestOffset() == {"listing": 0}


def test_places(tmp_path):
    (tmp_path / "a[1]").mkdir()
    (tmp_path / "x" / "y").mkdir(parents=True)
    for name in ("a[1]/f", "x/g", "x/y/h", "x/.h", "x/_s"):
        (tmp_path / name).write_text("1")
    names = lambda found: [i.path.removeprefix(f"{tmp_path}/") for i in found]
    assert names(places.files_under(str(tmp_path / "x"))) == ["x/g", "x/y/h"]
    assert names(places.files_under(f"file:{tmp_path}/a[1]")) == ["a[1]/f"]
    assert names(i for _, i in places.matching_files(f"file://{tmp_path}/*/?")) == ["a[1]/f", "x/g"]
    assert [u for u, _ in places.matching_files(f"{tmp_path}/x/*/h")] == [f"file://{tmp_path}/x/y/h"]


def test_ranges_of_clustered_ids_are_even(spark):
    from millrace.sinks import jdbc as jdbc_sink
    from millrace.sources import jdbc

    url, name = jdbc.configured_url(spark), "clustered_ids_of_the_tests"
    n = F.col("id")
    # A dense cluster, two far ones, ids below zero, one id many times, and rows without id.
    ids = F.when(n < 3000, n).when(n < 3500, n * 10**12).when(n < 4000, -n * 7919).when(n < 4900, F.lit(5 * 10**9)).when(n < 4950, n + 10**7)
    jdbc_sink.append(spark.range(5000).select(ids.alias("id"), n.alias("n")), url, name)
    ranges = jdbc.even_ranges(spark, url, name, "id", 250)
    assert sum(r[2] for r in ranges) == 4950 and ranges == sorted(ranges)
    sizes = sorted(r[2] for r in ranges)
    mean = sum(sizes[:-1]) / (len(sizes) - 1)
    assert sizes[-1] == 900 and sizes[-2] < 2 * mean  # only the one repeated id is larger
    read = jdbc.read_even(spark, url, name, "id", 250)
    assert read.rdd.getNumPartitions() == len(ranges) + 1
    assert sorted(r.n for r in read.collect()) == list(range(5000))
    jdbc_sink.append(spark.range(3).where("id < 0"), url, "no_ids_of_the_tests")
    assert jdbc.read_even(spark, url, "no_ids_of_the_tests", "id", 10).count() == 0


def test_metrics_of_a_stream_are_put_together(spark):
    parts = [[(1,), (5,)], [(None,)], [(-3,), (10,)]]
    stream = J.stream_files(spark, drops(spark, parts, "v long"), "v long", files_per_batch=1)
    out = scratch_path(spark, "out")
    metrics = [F.count("*").alias("n"), F.sum("v").alias("total"), F.min("v").alias("v_min"), F.max("v").alias("v_max")]
    got = J.run_observed(stream, "m", metrics, lambda rows: J.append_files(rows, out, J.new_checkpoint(spark)))
    assert got == {"n": 5, "total": 13, "v_min": -3, "v_max": 10}
    assert spark.read.parquet(out).count() == 5


def test_files_are_named_at_the_commit(tmp_path):
    from millrace.sinks import windowed

    def rows(*pairs):
        record = pa.array([{"v": v} for _, v in pairs], pa.struct([("v", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in pairs]), record], names=["name", "record"])

    sink = windowed.WindowedFiles(str(tmp_path))
    a, b = "2024/01/01/00-05--a", "2024/01/01/00-10--b%2Fc"
    two = [sink.write(iter([rows((a, 1), (b, 2), (a, 3)), rows((a, 4))])), sink.write(iter([rows((a, 5))]))]
    two[1].task = 1
    sink.commit([*two, None], 0)
    layout = lambda: {str(f.relative_to(tmp_path)): pq.ParquetFile(f).read()["v"].to_pylist() for f in tmp_path.rglob("*.parquet")}
    first = {
        f"{a}-pane-000000-00000-of-00002.parquet": [1, 3, 4], f"{a}-pane-000000-00001-of-00002.parquet": [5],
        f"{b}-pane-000000-00000-of-00001.parquet": [2],
    }
    assert layout() == first
    sink.commit([sink.write(iter([rows((a, 6))]))], 1)
    assert layout() == first | {f"{a}-pane-000001-00000-of-00001.parquet": [6]}
    # The first micro-batch runs again, as one task: one shard of it is left, and no second copy.
    again = windowed.WindowedFiles(str(tmp_path))
    again.commit([again.write(iter([rows((a, 1), (b, 2), (a, 3), (a, 4), (a, 5))]))], 0)
    assert layout() == {
        f"{a}-pane-000000-00000-of-00001.parquet": [1, 3, 4, 5], f"{b}-pane-000000-00000-of-00001.parquet": [2],
        f"{a}-pane-000001-00000-of-00001.parquet": [6],
    }
    many = [(f"2024/02/02/00-{k:02d}--k", k) for k in range(40)]
    sink.commit([sink.write(iter([rows(*many), rows(*many)]))], 2)
    assert sum(v for name, vs in layout().items() if name.startswith("2024/02") for v in vs) == 2 * sum(range(40))
    assert not list(tmp_path.glob("_drafts*"))


def test_windowed_files_of_a_stream(spark):
    from millrace.sinks import windowed

    parts = [[("a/b", 10, 1), (None, 299, 2), ("a/b", 300, 3)], [("a/b", 20, 4), ("é", None, 5)]]
    schema = "k string, s long, v long"
    stream = J.stream_files(spark, drops(spark, parts, schema), schema, files_per_batch=1).withColumn("ts", F.timestamp_seconds("s"))
    out = scratch_path(spark, "named")
    J.run_available(windowed.windowed_files(stream, "ts", F.col("k"), out, J.new_checkpoint(spark), 300, shards=2))
    read = spark.read.option("recursiveFileLookup", "true").parquet(out).select("v", F.col("_metadata.file_path").alias("f")).collect()
    names = {r.v: r.f.split("/", 3)[-1].split("named-")[1].split("/", 1)[1].rpartition("-")[0][:-9] for r in read}
    from urllib.parse import unquote

    assert {v: unquote(n) for v, n in names.items()} == {
        1: "1970/01/01/00-05--a%2Fb-pane-000000", 2: "1970/01/01/00-05--none-pane-000000", 3: "1970/01/01/00-10--a%2Fb-pane-000000",
        4: "1970/01/01/00-05--a%2Fb-pane-000001", 5: "none/none--%C3%A9-pane-000001",
    }


def test_a_snapshot_stays_while_rows_are_appended(spark):
    from millrace.sources import tables

    path = scratch_path(spark, "snapshot")
    spark.range(5).write.parquet(path)
    now = tables.pinned(spark, path)
    for n in (3, 4):
        spark.range(n).write.mode("append").parquet(path)
        assert now.count() == now.where("id >= 0").count() == 5
    assert tables.pinned(spark, path).count() == 12
