"""Avro container files: the format byte by byte, schema resolution, splits, the data source."""

import datetime
import decimal
import io
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.sources import avro


def encoded(schema, value):
    out = bytearray()
    avro.encoder(avro.parsed(schema))(value, out)
    return bytes(out)


def decoded(data, writer, reader=None):
    writer = avro.parsed(writer)
    cursor = avro.Cursor(data)
    value = avro.decoder(writer, avro.parsed(reader) if reader is not None else writer)(cursor)
    skipped = avro.Cursor(data)
    avro.skipper(writer)(skipped)
    assert cursor.at == skipped.at == len(data)
    return value


def record(*fields, name="R"):
    return {"type": "record", "name": name, "fields": [dict(zip(("name", "type", "default"), f)) for f in fields]}


def test_bytes_of_the_format():
    # Examples of the published specification.
    assert [avro.number(n).hex() for n in (0, -1, 1, -2, 2, -64, 64)] == ["00", "01", "02", "03", "04", "7f", "8001"]
    assert encoded("string", "foo") == bytes.fromhex("06666f6f")
    assert encoded(record(("a", "long"), ("b", "string")), {"a": 27, "b": "foo"}) == bytes.fromhex("3606666f6f")
    assert encoded({"type": "array", "items": "long"}, [3, 27]) == bytes.fromhex("04063600")
    assert encoded(["null", "string"], None) == b"\0" and encoded(["null", "string"], "a") == bytes.fromhex("020261")
    # A block with a negative count tells its size.
    assert decoded(bytes.fromhex("0304063600"), {"type": "array", "items": "long"}) == [3, 27]


@given(st.integers(-(2**63), 2**63 - 1))
@settings(max_examples=200)
def test_numbers(n):
    assert avro.Cursor(avro.number(n)).number() == n


KINDS = {
    "type": "record",
    "name": "All",
    "namespace": "n.s",
    "fields": [
        {"name": "flag", "type": "boolean"},
        {"name": "i", "type": "int"},
        {"name": "l", "type": ["long", "null"]},
        {"name": "f", "type": "float"},
        {"name": "d", "type": "double"},
        {"name": "raw", "type": "bytes"},
        {"name": "s", "type": ["null", "string"]},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "at", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "local", "type": {"type": "long", "logicalType": "local-timestamp-millis"}},
        {"name": "price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2}},
        {"name": "suit", "type": {"type": "enum", "name": "Suit", "symbols": ["SPADES", "HEARTS"]}},
        {"name": "again", "type": "Suit"},
        {"name": "code", "type": {"type": "fixed", "name": "Code", "size": 3}},
        {"name": "items", "type": {"type": "array", "items": ["null", "int"]}},
        {"name": "map", "type": {"type": "map", "values": "double"}},
        {"name": "inner", "type": ["null", {"type": "record", "name": "In", "fields": [{"name": "x", "type": "n.s.Code"}]}]},
    ],
}


def row(k):
    return {
        "flag": k % 2 == 0, "i": k - 50, "l": None if k % 3 == 0 else -(k << 40), "f": k / 2, "d": k / 7, "raw": bytes([k % 256] * (k % 5)),
        "s": None if k % 4 == 0 else "ü" * (k % 9), "day": datetime.date(1969, 12, 1) + datetime.timedelta(days=k),
        "at": datetime.datetime(1969, 12, 31, 23, tzinfo=datetime.timezone.utc) + datetime.timedelta(seconds=k * 97, microseconds=k),
        "local": datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=k * 1001), "price": decimal.Decimal(k * 37 - 5000).scaleb(-2),
        "suit": "HEARTS", "again": "SPADES", "code": b"%03d" % k, "items": [None, k] * (k % 3),
        "map": [(str(j), j / 4) for j in range(k % 3)], "inner": None if k % 2 else {"x": b"abc"},
    }


def test_values_of_all_kinds():
    for k in range(100):
        assert decoded(encoded(KINDS, row(k)), KINDS) == row(k)


@pytest.mark.parametrize(
    "writer, value, reader, wanted",
    [
        ("int", 5, "double", 5.0), ("int", 5, "long", 5), ("float", 0.5, "double", 0.5), ("string", "é", "bytes", "é".encode()),
        ("bytes", b"a", "string", "a"), ("int", 5, ["null", "long"], 5), (["null", "int"], 5, "int", 5), (["int", "string"], "a", ["string", "null"], "a"),
        (record(("a", "int"), ("b", "string")), {"a": 1, "b": "x"}, record(("b", "string")), {"b": "x"}),
        (record(("a", "int")), {"a": 1}, record(("c", ["null", "int"], None), ("a", "long")), {"c": None, "a": 1}),
        (record(("a", "int")), {"a": 1}, {"type": "record", "name": "R", "fields": [{"name": "z", "aliases": ["a"], "type": "int"}]}, {"z": 1}),
        (record(("x", {"type": "map", "values": {"type": "array", "items": "string"}}), ("y", "int")), {"x": {"k": ["a", "b"]}, "y": 2}, record(("y", "int")), {"y": 2}),
        ({"type": "enum", "name": "E", "symbols": ["A", "B"]}, "B", {"type": "enum", "name": "E", "symbols": ["A"], "default": "A"}, "A"),
    ],
)
def test_resolution(writer, value, reader, wanted):
    assert decoded(encoded(writer, value), writer, reader) == wanted


def test_schemas_that_do_not_go_together():
    for writer, reader in (("string", "int"), ("double", "float"), (record(("a", "int")), record(("b", "int")))):
        with pytest.raises(ValueError):
            avro.decoder(avro.parsed(writer), avro.parsed(reader))
    with pytest.raises(ValueError):
        decoded(encoded(["null", "int"], None), ["null", "int"], "int")
    for schema, value in (("int", 2**31), ("int", "5"), ("string", None), (record(("a", "int")), {"a": True}), ("boolean", 1)):
        with pytest.raises(ValueError):
            encoded(schema, value)
    with pytest.raises(ValueError, match="R|row.a"):
        encoded(record(("a", "int")), {"a": None})
    with pytest.raises(ValueError):
        avro.parsed("unknown")


@pytest.mark.parametrize("codec", sorted(avro.CODECS))
def test_each_block_is_read_by_one_range(codec, tmp_path):
    schema, sync = record(("n", "long"), ("s", "string")), os.urandom(16)
    head = bytearray(avro.MAGIC)
    avro.encoder(avro.META_PARSED)({"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode(), "x": b"y" * 70_000}, head)
    data, n = bytes(head) + sync, 0
    for rows in (1, 700, 3, 50, 1):
        body = b"".join(encoded(schema, {"n": n + k, "s": str(k) * 5}) for k in range(rows))
        n += rows
        body = avro.packed(body, codec)
        data += avro.number(rows) + avro.number(len(body)) + body + sync
    file = io.BytesIO(data)
    parsed, found, mark, size = avro.header(file)
    assert (found, mark, size) == (codec, sync, len(head) + 16)
    decode = avro.decoder(parsed, parsed)
    for step in (33, 1000, len(data)):
        numbers = []
        for begin in range(0, len(data), step):
            for rows, block in avro.blocks(file, len(data), begin, min(begin + step, len(data)), sync, codec):
                cursor = avro.Cursor(block)
                numbers += [decode(cursor)["n"] for _ in range(rows)]
        assert numbers == list(range(n))
    broken = data[:-3] + b"xyz"
    with pytest.raises(ValueError, match="sync"):
        list(avro.blocks(io.BytesIO(broken), len(broken), 0, len(broken), sync, codec))
    with pytest.raises(TypeError):
        avro.header(io.BytesIO(b"Obj\x02 something else"))


TABLE = """id long, i int, flag boolean, f float, d double, raw binary, s string, day date, at timestamp, local timestamp_ntz,
price decimal(14,3), items array<int>, m map<string,double>, inner struct<x:string,y:array<struct<z:long>>>"""


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    table = spark.range(3000).select(
        "id", n.cast("int").alias("i"), (n % 2 == 0).alias("flag"), (n / 2).cast("float").alias("f"), (n / 7).alias("d"),
        F.encode(n.cast("string"), "UTF-8").alias("raw"), F.when(n % 3 != 0, F.concat(F.lit("é"), n)).alias("s"),
        F.date_add(F.lit("1965-01-01").cast("date"), n.cast("int")).alias("day"), F.timestamp_seconds(n * 1000 - 10**6).alias("at"),
        F.timestamp_seconds(n).cast("timestamp_ntz").alias("local"), (n.cast("decimal(11,0)") / 8).cast("decimal(14,3)").alias("price"),
        F.when(n % 5 != 0, F.array(n.cast("int"), F.lit(None).cast("int"))).alias("items"),
        F.create_map(F.concat(F.lit("k"), n % 3), n / 4).alias("m"),
        F.when(n % 4 != 0, F.struct(F.lit("x").alias("x"), F.array(F.struct((n + 1).alias("z"))).alias("y"))).alias("inner"),
    )
    return table.to(spark.createDataFrame([], TABLE).schema)


@pytest.mark.parametrize("codec", sorted(avro.CODECS))
def test_tables_come_back(spark, rows, codec):
    path = scratch_path(spark, "avro")
    avro.write_avro(rows.repartition(3), path, codec=codec)
    spark.dataSource.register(avro.AvroSource)
    read = spark.read.format("avro_container").option("splitBytes", 20_000).load(path)
    assert read.rdd.getNumPartitions() > 3
    assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in rows.schema]
    as_text = lambda frame: sorted(str(r) for r in frame.collect())
    assert as_text(read) == as_text(rows)


def test_reader_schemas_and_projections(spark, rows):
    path = scratch_path(spark, "avro")
    avro.write_avro(rows.select("id", "i", "s", "day"), path)
    part = avro.read_avro(spark, path, fields=["s", "id"])
    assert part.columns == ["s", "id"] and part.count() == 3000
    reader = record(("i", ["null", "double"]), ("extra", "string", "none"), name="Row")
    got = avro.read_avro(spark, path, reader_schema=json.dumps(reader))
    assert got.schema.simpleString() == "struct<i:double,extra:string>"
    assert got.agg(F.sum("i"), F.min("extra")).first() == (2999 * 1500.0, "none")
    with pytest.raises(Exception, match="reader no default"):
        avro.read_avro(spark, path, reader_schema=json.dumps(record(("none", "int"), name="Row"))).collect()


def test_explicit_writer_schema_and_modes(spark):
    path = scratch_path(spark, "avro")
    schema = json.dumps(record(("name", "string"), ("age", "long"), ("job", ["null", "string"], None), name="People"))
    people = spark.createDataFrame([("a", 3), ("b", 4)], "name string, age int")
    for mode, wanted in (("append", 2), ("append", 4), ("overwrite", 2)):
        avro.write_avro(people, path, schema, mode=mode)
        assert avro.read_avro(spark, path).count() == wanted
    assert sorted(tuple(r) for r in avro.read_avro(spark, path).collect()) == [("a", 3, None), ("b", 4, None)]
    with pytest.raises(Exception, match="no field other"):
        avro.write_avro(people.withColumn("other", F.lit(1)), path, schema)
    with pytest.raises(Exception, match="null is no string"):
        avro.write_avro(people.withColumn("name", F.lit(None).cast("string")), path, schema, mode="overwrite")
    assert avro.read_avro(spark, path).count() == 2  # a write that failed changes nothing
    with pytest.raises(Exception, match="give a schema"):
        avro.read_avro(spark, scratch_path(spark, "nothing")).collect()


def test_no_rows(spark):
    path = scratch_path(spark, "avro")
    avro.write_avro(spark.createDataFrame([], "a long"), path)
    assert avro.read_avro(spark, path, reader_schema=json.dumps(record(("a", ["null", "long"]), name="Row"))).count() == 0
