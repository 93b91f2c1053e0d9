"""Files, tables and keyed stores: formats, errors, layout."""

import struct

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sinks import files as file_sinks
from millrace.sinks import stores, tables
from millrace.sources import files, messages, tfrecord
from millrace.sources import stores as store_sources
from millrace.sources import tables as table_sources


def bitwise_crc(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_crc_of_many():
    assert bitwise_crc(b"123456789") == 0xE3069283  # the published check value
    values = [b"", b"a", b"123456789", bytes(range(256)) * 3, b"zz"]
    for value, masked in zip(values, tfrecord.masked_crc(values)):
        crc = bitwise_crc(value)
        assert int(masked) == (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def test_record_files_are_checked(spark, tmp_path):
    tfrecord.register(spark)
    framed = tfrecord.frame([b"one", b"", b"three"])
    assert struct.unpack("<Q", framed[:8]) == (3,)
    (tmp_path / "a.tfrecord").write_bytes(framed)
    read = spark.read.format("tfrecord").load(str(tmp_path))
    assert sorted(bytes(r.record) for r in read.collect()) == [b"", b"one", b"three"]
    (tmp_path / "b.tfrecord").write_bytes(framed[:-1] + b"x")
    with pytest.raises(Exception, match="checksum does not match"):
        spark.read.format("tfrecord").load(str(tmp_path)).collect()


def test_record_write_modes(spark):
    tfrecord.register(spark)
    path = scratch_path(spark, "records")
    ten = spark.range(10).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("record"))
    for mode, expected in (("append", 10), ("append", 20), ("overwrite", 10)):
        ten.repartition(3).write.format("tfrecord").mode(mode).save(path)
        assert spark.read.format("tfrecord").load(path).count() == expected


def test_csv_comments_come_first_in_each_file(spark):
    path = scratch_path(spark, "csv")
    file_sinks.write_csv(spark.range(100).repartition(3), path, comments=["made for a test"])
    firsts = spark.read.text(path, wholetext=True).collect()
    assert all(r.value.startswith("# made for a test\nid\n") for r in firsts) and len(firsts) == 3
    assert files.read_csv(spark, path, "id long", comment="#").count() == 100


def test_required_field(spark):
    rows = spark.createDataFrame([("a",), (None,)], "name string")
    with pytest.raises(Exception, match="null in required field"):
        file_sinks.write_records(rows, scratch_path(spark, "required"), required=["name"])


def test_typed_read_needs_its_columns(spark):
    with pytest.raises(ValueError, match="columns missing"):
        table_sources.read_typed(spark.range(1), "id long, status string")


def test_rejected_rows(spark):
    rows = spark.createDataFrame(
        [('{"id": 1, "v": "2.5"}',), ('{"id": "x"}',), ('{"v": 1}',), ('{"id": 2, "w": 1}',), ("nonsense",)], "row string"
    )
    checked = tables.split_rejected(rows, "id int not null, v double", "t")
    assert [tuple(r) for r in tables.accepted(checked).collect()] == [(1, 2.5)]
    assert sorted(r.error for r in tables.rejected(checked).collect()) == [
        "missing required field: id", "no such field: w", "not a record", "wrong type in field: id",
    ]


def test_mutations(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id int, first string, last string")
    ops = [
        ("insert", 1, "n", "n", True, 1), ("insert", 9, "n", "n", True, 2), ("update", 2, "n", None, False, 3),
        ("update", 8, "n", "n", True, 2), ("replace", 3, "n", None, False, 4), ("delete", 7, None, None, True, 5),
    ]
    mutations = spark.createDataFrame(ops, "op string, id int, first string, last string, last_set boolean, g int")
    judged = stores.judge_mutations(target, mutations, "id")
    after = stores.apply_mutations(target, judged, "id", {"last": "last_set"})
    assert sorted(map(tuple, after.collect())) == [(1, "a", "x"), (2, "n", "y"), (3, "n", None), (9, "n", "n")]
    # Group 2 has an update of a missing key, so its insert is not applied either.
    grouped = stores.apply_mutations(target, stores.judge_groups(judged, "g", "id"), "id", {"last": "last_set"})
    assert 9 not in [r.id for r in grouped.collect()]
    with pytest.raises(Exception, match="two mutations for key"):
        stores.judge_mutations(target, mutations.unionByName(mutations), "id").collect()


def test_cells(spark):
    cells = spark.createDataFrame(
        [("row1", "cf", "q", "abc", 1_000_000), ("row1", "cf", "q", "new", 2_000_000), ("row2", "cf", "q", "xyz", 0)],
        "row_key string, family string, qualifier string, value string, ts_micros long",
    )
    lines = {r.row_key: r.text for r in store_sources.render_rows(cells).collect()}
    assert lines["row1"] == "cf:q=new @ 1970/01/01 00:00:02; cf:q=abc @ 1970/01/01 00:00:01"
    assert store_sources.filter_cells(cells, "row1", "row2", ".*b.*").count() == 1
    assert store_sources.filter_cells(cells, value="b").count() == 0


def test_event_time_from_attribute(spark):
    data = spark.createDataFrame(
        [({"timestamp": "1000"}, 1), ({"timestamp": "1970-01-01T00:00:02Z"}, 2), ({"timestamp": "later"}, 3), ({}, 4)],
        "attributes map<string,string>, n int",
    ).withColumn("publish_time", F.timestamp_seconds(F.lit(9)))
    seconds = messages.with_event_time(data).orderBy("n").select(F.unix_seconds("event_time")).collect()
    assert [r[0] for r in seconds] == [1, 2, 9, 9]


def test_scan_is_pushed_down(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    scan = table_sources.scan_pushed_down(lines, ["l_orderkey"], "l_returnflag = 'A' AND l_quantity > 10")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,A)" in plan and "GreaterThan(l_quantity," in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_destinations_are_all_written_or_refused(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "n int, d string")
    paths = tables.write_destinations(rows, "d", {"a": ["n"], "b": ["n", "d"]}, str(tmp_path / "kept"))
    assert [spark.read.parquet(paths[k]).count() for k in "ab"] == [2, 1]
    for stray in ("c", None):
        more = rows.unionByName(spark.createDataFrame([(4, stray)], "n int, d string"))
        with pytest.raises(Exception, match="no such destination"):
            tables.write_destinations(more, "d", {"a": ["n"], "b": ["n"]}, str(tmp_path / f"refused-{stray}"))


def test_unknown_columns_are_refused(spark):
    spark.range(3).createOrReplaceTempView("unused_view")
    name = "narrow_table_of_the_tests"
    tables.write_table(spark.range(3), name, "truncate")
    try:
        with pytest.raises(ValueError, match="no column extra"):
            tables.write_table(spark.range(3).withColumn("extra", F.lit(1)), name)
        assert spark.table(name).count() == 3
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_mutations_without_a_key_are_rejected_rows(spark):
    target = spark.createDataFrame([(1, "x")], "id int, v string")
    asked = spark.createDataFrame([("insert", None, "y"), ("insert", None, "z"), ("insert", 2, "w")], "op string, id int, v string")
    judged = stores.judge_mutations(target, asked, "id").collect()
    assert sorted((r.id or 0, r.valid) for r in judged) == [(0, False), (0, False), (2, True)]


def test_ids_are_the_same_when_computed_again(spark):
    rows = spark.createDataFrame([(1, None), (2, "b")], "n int, d string")
    first, again = (sorted(r.uuid for r in messages.with_id(rows, ["n", "d"]).collect()) for _ in range(2))
    assert first == again and len(set(first)) == 2


def test_a_missing_connector_is_an_error(spark, tmp_path):
    assert files.has_format(spark, "parquet") and not files.has_format(spark, "nosuchformat")
    if not files.has_format(spark, "avro"):
        with pytest.raises(Exception):
            file_sinks.write_records(spark.range(1), str(tmp_path / "x"), "avro", avro_schema="{}")


def test_checksums_of_long_records():
    import random

    def one_by_one(data):
        state = 0xFFFFFFFF
        for byte in data:
            state = (state >> 8) ^ int(tfrecord._TABLE[(state ^ byte) & 255])
        state ^= 0xFFFFFFFF
        return ((state >> 15 | state << 17) + tfrecord.MASK_DELTA) & 0xFFFFFFFF

    rng = random.Random(3)
    values = [rng.randbytes(n) for n in (0, 1, 9, tfrecord.BLOCK - 1, tfrecord.BLOCK, tfrecord.BLOCK + 1, 5 * tfrecord.BLOCK)]
    assert tfrecord.masked_crc(values).tolist() == [one_by_one(v) for v in values]
    assert tfrecord.head_crc(values[2][:8]) == one_by_one(values[2][:8])
