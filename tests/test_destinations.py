"""Destinations that come with the rows: names, schemas, skew, failed and repeated commits."""

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sinks import destinations as D

NAMES = ["plain", "with space", "a/b", "100%", "x=y", "é ü", "dot.", "..", "{g}", "[1]", "tab\t", "q?*", "__odd__", "2024-01-01", "007"]


def table(spark, n=300):
    rows = [(k, NAMES[k % len(NAMES)] if k % 11 else (None if k % 2 else ""), f"v{k}") for k in range(n)]
    return rows, spark.createDataFrame(rows, "id long, name string, v string")


def test_every_name_is_a_destination(spark):
    rows, frame = table(spark)
    path = scratch_path(spark, "destinations")
    schemas = spark.createDataFrame([("plain", ["v"]), ("a/b", ["v", "id"]), ("plain", ["z"]), ("absent", ["v"])], "destination string, fields array<string>")
    D.write_to_destinations(frame.repartition(4), F.col("name"), path, schemas.where("fields[0] <> 'z'"))
    got = D.read_destinations(spark, path, "id long, name string, v string").collect()
    wanted = Counter()
    for k, name, v in rows:
        place = name or "unrouted"
        row = {"plain": (None, None, v), "a/b": (k, None, v)}.get(place, (k, name, v))
        wanted[(place, *row)] += 1
    assert Counter((r.destination, r.id, r.name, r.v) for r in got) == wanted
    assert D.destinations(path) == sorted({n for n, *_ in wanted})
    assert D.read_destination(spark, path, "plain").columns == ["v"]
    assert D.read_destination(spark, path, "a/b").columns == ["v", "id"]
    assert D.read_destination(spark, path, "{g}").columns == ["id", "name", "v"]


def test_modes_and_errors(spark):
    rows, frame = table(spark, 40)
    path = scratch_path(spark, "destinations")
    count = lambda: D.read_destinations(spark, path, "id long").count()
    D.write_to_destinations(frame, F.col("name"), path)
    D.write_to_destinations(frame.limit(5), F.lit("more"), path)
    assert count() == 45
    unknown = spark.createDataFrame([("plain", ["other"])], "destination string, fields array<string>")
    with pytest.raises(Exception, match="no such column: other"):
        D.write_to_destinations(frame, F.col("name"), path, unknown, mode="overwrite")
    assert count() == 45  # a write that fails leaves all as it was
    D.write_to_destinations(frame.limit(7), F.lit("only"), path, mode="overwrite")
    assert count() == 7 and D.destinations(path) == ["only"]
    D.write_to_destinations(frame.limit(0), F.col("name"), path)
    assert count() == 7


def test_types_nest_and_columns_clash(spark):
    path = scratch_path(spark, "destinations")
    frame = spark.range(6).select(
        F.lit("d").alias("destination"), F.lit(1).alias("fields"), F.struct("id").alias("record"), F.array("id").alias("a.b"),
        F.timestamp_seconds("id").alias("at"), F.when(F.col("id") > 2, F.create_map(F.lit("k"), "id")).alias("m"),
    )
    D.write_to_destinations(frame, F.col("destination"), path)
    got = D.read_destination(spark, path, "d")
    assert got.columns == frame.columns
    assert sorted(str(r) for r in got.collect()) == sorted(str(r) for r in frame.collect())


def test_a_task_has_one_file_open_and_rolls_it(tmp_path):
    writer = D.DestinationWriter(str(tmp_path), file_bytes=1, overwrite=False)
    names = ["destination", "fields", "record"]

    def batch(keys, fields):
        record = pa.array([{"a": i, "b": str(i)} for i in range(len(keys))], pa.struct([("a", pa.int64()), ("b", pa.string())]))
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fields, pa.list_(pa.string())), record], names=names)

    batches = [batch(["x", "x", "y", "y"], [["a"], ["a"], None, ["b"]]), batch(["y", "z"], [["b"], None]), batch([], [])]
    message = writer.write(iter(batches))
    other = writer.write(iter([]))  # an attempt without rows
    lost = writer.write(iter([batch(["x"], [None])]))  # a second attempt of a task, which does not count
    assert lost.drafts
    writer.commit([message, None, other])
    found = [(f.parent.name, pq.ParquetFile(f).read().to_pydict()) for f in tmp_path.glob("*/*.parquet")]
    key = lambda pair: (pair[0], str(pair[1]))
    assert sorted(found, key=key) == sorted(
        [("destination=x", {"a": [0, 1]}), ("destination=y", {"a": [2], "b": ["2"]}), ("destination=y", {"b": ["3"]}),
         ("destination=y", {"b": ["0"]}), ("destination=z", {"a": [1], "b": ["1"]})], key=key,
    )
    assert not list(tmp_path.glob("_drafts*"))
