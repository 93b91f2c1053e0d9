"""Avro container files as a Spark data source, ``format("avro_container")``, for sessions without the JVM connector.

A large file is read by several tasks: a task takes the blocks whose sync marker begins in its range of bytes.
Fields that the reader's schema leaves out are skipped, not decoded. Decoding is Python code, row by row; where the
connector is on the class path, prefer it.
"""

from __future__ import annotations

import datetime
import decimal
import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.functions.places import Drafts, files_under, place_of

# Fixed values of the format.
MAGIC = b"Obj\x01"
SYNC = 16
META = {"type": "map", "values": "bytes"}

SPLIT_BYTES, BLOCK_BYTES, BATCH_ROWS = 32 << 20, 64 << 10, 4096

EPOCH = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
EPOCH_DAY = datetime.date(1970, 1, 1)
#: Where the times of a logical type begin, and its unit in microseconds.
TIMES = {
    "timestamp-millis": (EPOCH, 1000),
    "timestamp-micros": (EPOCH, 1),
    "local-timestamp-millis": (EPOCH.replace(tzinfo=None), 1000),
    "local-timestamp-micros": (EPOCH.replace(tzinfo=None), 1),
}
MICROSECOND = datetime.timedelta(microseconds=1)


# ------------------------------------------------------------------------------------------------ schemas


class Names:
    """The named types of a schema; a name stands for the type where it was first given."""

    def __init__(self) -> None:
        self.known: dict[str, dict] = {}

    def resolve(self, schema, space: str = ""):
        """The schema with every reference replaced by the type itself, and every type as a dict."""
        if isinstance(schema, str):
            if schema in PRIMITIVES:
                return {"type": schema}
            full = schema if "." in schema or not space else f"{space}.{schema}"
            found = self.known.get(full) or self.known.get(schema)
            if found is None:
                raise ValueError(f"no such type in the schema: {schema}")
            return found
        if isinstance(schema, list):
            return {"type": "union", "branches": [self.resolve(branch, space) for branch in schema]}
        kind = schema["type"]
        if not isinstance(kind, str) or kind not in PRIMITIVES | COMPLEX:
            return self.resolve(kind, space)
        out = {k: v for k, v in schema.items() if k not in ("fields", "items", "values")}
        if kind in ("record", "enum", "fixed"):
            space = schema.get("namespace", schema["name"].rpartition(".")[0] or space)
            full = schema["name"] if "." in schema["name"] or not space else f"{space}.{schema['name']}"
            out["full"] = full
            self.known[full] = out
        if kind == "record":
            out["fields"] = [{**f, "type": self.resolve(f["type"], space)} for f in schema["fields"]]
        if kind == "array":
            out["items"] = self.resolve(schema["items"], space)
        if kind == "map":
            out["values"] = self.resolve(schema["values"], space)
        return out


PRIMITIVES = {"null", "boolean", "int", "long", "float", "double", "bytes", "string"}
COMPLEX = {"record", "enum", "array", "map", "fixed"}


def parsed(schema: str | dict | list) -> dict:
    """A schema given as JSON text, as what JSON gives, or as the name of a primitive type."""
    is_json = isinstance(schema, str) and schema.lstrip()[:1] in ("{", "[", '"')
    return Names().resolve(json.loads(schema) if is_json else schema)


def _logical(schema: dict) -> str | None:
    return schema.get("logicalType")


def spark_type(schema: dict) -> tuple[T.DataType, bool]:
    """The Spark type of a parsed schema, and whether it can be null."""
    kind, logical = schema["type"], _logical(schema)
    if kind == "union":
        branches = [b for b in schema["branches"] if b["type"] != "null"]
        nullable = len(branches) < len(schema["branches"])
        if len(branches) == 1:
            return spark_type(branches[0])[0], nullable
        kinds = {b["type"] for b in branches}
        if kinds <= {"int", "long"}:
            return T.LongType(), nullable
        if kinds <= {"int", "long", "float", "double"}:
            return T.DoubleType(), nullable
        raise ValueError(f"a union of {sorted(kinds)} has no column type")
    if logical == "decimal" and kind in ("bytes", "fixed"):
        return T.DecimalType(schema["precision"], schema.get("scale", 0)), False
    if kind == "int" and logical == "date":
        return T.DateType(), False
    if kind == "long" and logical in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType(), False
    if kind == "long" and logical in ("local-timestamp-millis", "local-timestamp-micros"):
        return T.TimestampNTZType(), False
    if kind == "record":
        fields = [T.StructField(f["name"], *spark_type(f["type"])) for f in schema["fields"]]
        return T.StructType(fields), False
    if kind == "array":
        return T.ArrayType(*spark_type(schema["items"])), False
    if kind == "map":
        return T.MapType(T.StringType(), *spark_type(schema["values"])), False
    simple = {
        "null": T.NullType, "boolean": T.BooleanType, "int": T.IntegerType, "long": T.LongType, "float": T.FloatType,
        "double": T.DoubleType, "bytes": T.BinaryType, "string": T.StringType, "enum": T.StringType, "fixed": T.BinaryType,
    }
    return simple[kind](), kind == "null"


def avro_type(kind: T.DataType, nullable: bool = True, name: str = "Row") -> dict | list | str:
    """An Avro schema for a Spark type; types without a counterpart are an error."""
    if isinstance(kind, T.StructType):
        fields = [{"name": f.name, "type": avro_type(f.dataType, f.nullable, f"{name}_{f.name}")} for f in kind]
        for field in fields:
            if isinstance(field["type"], list):
                field["default"] = None
        out: dict | str = {"type": "record", "name": name, "fields": fields}
    elif isinstance(kind, T.ArrayType):
        out = {"type": "array", "items": avro_type(kind.elementType, kind.containsNull, f"{name}_item")}
    elif isinstance(kind, T.MapType):
        out = {"type": "map", "values": avro_type(kind.valueType, kind.valueContainsNull, f"{name}_value")}
    elif isinstance(kind, T.DecimalType):
        out = {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    elif isinstance(kind, T.DateType):
        out = {"type": "int", "logicalType": "date"}
    elif isinstance(kind, T.TimestampType):
        out = {"type": "long", "logicalType": "timestamp-micros"}
    elif isinstance(kind, T.TimestampNTZType):
        out = {"type": "long", "logicalType": "local-timestamp-micros"}
    else:
        simple = {
            T.BooleanType: "boolean", T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long",
            T.FloatType: "float", T.DoubleType: "double", T.BinaryType: "bytes", T.StringType: "string",
        }
        if type(kind) not in simple:
            raise ValueError(f"no Avro type for {kind.simpleString()}")
        out = simple[type(kind)]
    return ["null", out] if nullable else out


def projected(schema: dict, fields: list[str]) -> dict:
    """The record schema with the named fields only, in that order: a reader's schema."""
    of = {f["name"]: f for f in schema["fields"]}
    if missing := [f for f in fields if f not in of]:
        raise ValueError(f"no such field: {', '.join(missing)}")
    return {**schema, "fields": [of[f] for f in fields]}


# ----------------------------------------------------------------------------------------------- decoding


class Cursor:
    """A place in the bytes of a block."""

    __slots__ = ("data", "at")

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def number(self) -> int:
        """A variable-length zig-zag number."""
        data, at = self.data, self.at
        byte = data[at]
        value, shift = byte & 127, 7
        while byte > 127:
            at += 1
            byte = data[at]
            value |= (byte & 127) << shift
            shift += 7
        self.at = at + 1
        return (value >> 1) ^ -(value & 1)

    def take(self, n: int) -> bytes:
        begin = self.at
        self.at = end = begin + n
        if n < 0 or end > len(self.data):
            raise ValueError("value reaches behind its block")
        return self.data[begin:end]

    def skip(self, n: int) -> None:
        self.at += n


def _counted(cursor: Cursor) -> Iterator[int]:
    """The item counts of the blocks of an array or map."""
    while count := cursor.number():
        if count < 0:
            cursor.number()
            count = -count
        yield count


def skipper(writer: dict) -> Callable[[Cursor], None]:
    """Goes over a value without making it."""
    kind = writer["type"]
    if kind == "null":
        return lambda c: None
    if kind == "boolean":
        return lambda c: c.skip(1)
    if kind in ("int", "long", "enum"):
        return lambda c: c.number() and None
    if kind in ("float", "double"):
        width = 4 if kind == "float" else 8
        return lambda c: c.skip(width)
    if kind in ("bytes", "string"):
        return lambda c: c.skip(c.number())
    if kind == "fixed":
        size = writer["size"]
        return lambda c: c.skip(size)
    if kind == "union":
        branches = [skipper(b) for b in writer["branches"]]
        return lambda c: branches[c.number()](c)
    if kind == "record":
        fields = [skipper(f["type"]) for f in writer["fields"]]

        def record(c: Cursor) -> None:
            for field in fields:
                field(c)

        return record
    value = skipper(writer["items"] if kind == "array" else writer["values"])

    def many(c: Cursor) -> None:
        while count := c.number():
            if count < 0:
                c.skip(c.number())
                continue
            for _ in range(count):
                if kind == "map":
                    c.skip(c.number())
                value(c)

    return many


def _matches(writer: dict, reader: dict) -> bool:
    """Whether a value of the writer's type can be read as the reader's."""
    w, r = writer["type"], reader["type"]
    if "union" in (w, r):
        return True
    if w == r:
        return w not in ("record", "enum", "fixed") or _short(writer) == _short(reader) or _short(writer) in reader.get("aliases", ())
    widened = {"int": {"long", "float", "double"}, "long": {"float", "double"}, "float": {"double"}}
    return r in widened.get(w, ()) or {w, r} == {"string", "bytes"}


def _short(schema: dict) -> str:
    return schema["name"].rpartition(".")[2]


def _converted(raw: Callable[[Cursor], object], schema: dict) -> Callable[[Cursor], object]:
    """A decoded value as the Python value of its logical type."""
    kind, logical = schema["type"], _logical(schema)
    if kind == "int" and logical == "date":
        return lambda c: EPOCH_DAY + datetime.timedelta(days=raw(c))
    if kind == "long" and logical in TIMES:
        start, unit = TIMES[logical]
        return lambda c: start + datetime.timedelta(microseconds=raw(c) * unit)
    if kind in ("bytes", "fixed") and logical == "decimal":
        scale = schema.get("scale", 0)
        wide = decimal.Context(prec=80)
        return lambda c: decimal.Decimal(int.from_bytes(raw(c), "big", signed=True)).scaleb(-scale, wide)
    return raw


def decoder(writer: dict, reader: dict) -> Callable[[Cursor], object]:
    """Reads a value written with one schema as the other has it, or fails where the schemas do not go together."""
    kind = writer["type"]
    if kind == "union":
        branches: list[Callable[[Cursor], object] | ValueError] = []
        for branch in writer["branches"]:
            try:
                branches.append(decoder(branch, reader))
            except ValueError as error:  # matters only where such a value comes
                branches.append(error)

        def union(c: Cursor) -> object:
            branch = branches[c.number()]
            if isinstance(branch, ValueError):
                raise branch
            return branch(c)

        return union
    if reader["type"] == "union":
        same = [b for b in reader["branches"] if b["type"] == kind and _matches(writer, b)]
        fitting = same or [b for b in reader["branches"] if _matches(writer, b)]
        if not fitting:
            raise ValueError(f"{kind} is none of the reader's {[b['type'] for b in reader['branches']]}")
        return decoder(writer, fitting[0])
    if not _matches(writer, reader):
        raise ValueError(f"{kind} {writer.get('name', '')} cannot be read as {reader['type']} {reader.get('name', '')}")
    want = reader["type"]
    if kind == "null":
        return lambda c: None
    if kind == "boolean":
        return lambda c: c.take(1) != b"\0"
    if kind in ("int", "long"):
        return (lambda c: float(c.number())) if want in ("float", "double") else _converted(Cursor.number, reader)
    if kind in ("float", "double"):
        form, width = ("<f", 4) if kind == "float" else ("<d", 8)
        return lambda c: struct.unpack(form, c.take(width))[0]
    if kind in ("bytes", "string"):
        if want == "string":
            return lambda c: c.take(c.number()).decode()
        return _converted(lambda c: c.take(c.number()), reader)
    if kind == "fixed":
        size = writer["size"]
        if size != reader["size"]:
            raise ValueError(f"fixed of {size} and of {reader['size']} bytes")
        return _converted(lambda c: c.take(size), reader)
    if kind == "enum":
        symbols, known = writer["symbols"], set(reader["symbols"])
        fallback = reader.get("default")
        values = [s if s in known else fallback for s in symbols]

        def enum(c: Cursor) -> str:
            place = c.number()
            if values[place] is None:
                raise ValueError(f"the reader does not know {symbols[place]}")
            return values[place]

        return enum
    if kind == "array":
        item = decoder(writer["items"], reader["items"])
        return lambda c: [item(c) for count in _counted(c) for _ in range(count)]
    if kind == "map":
        value = decoder(writer["values"], reader["values"])
        return lambda c: [(c.take(c.number()).decode(), value(c)) for count in _counted(c) for _ in range(count)]
    return _record(writer, reader)


def _record(writer: dict, reader: dict) -> Callable[[Cursor], dict]:
    """Fields by name or alias: read, skipped, or, where the writer has none, the reader's default."""
    theirs = {}
    for field in reader["fields"]:
        for name in (field["name"], *field.get("aliases", ())):
            theirs.setdefault(name, field)
    steps: list[tuple[str | None, Callable[[Cursor], object]]] = []
    given = set()
    for field in writer["fields"]:
        match = theirs.get(field["name"])
        if match is None or match["name"] in given:
            steps.append((None, skipper(field["type"])))
        else:
            given.add(match["name"])
            steps.append((match["name"], decoder(field["type"], match["type"])))
    rest = {}
    for field in reader["fields"]:
        if field["name"] not in given:
            if "default" not in field:
                raise ValueError(f"the writer has no field {field['name']}, and the reader no default")
            rest[field["name"]] = default_value(field["type"], field["default"])

    def record(c: Cursor) -> dict:
        row = dict(rest)
        for name, step in steps:
            if name is None:
                step(c)
            else:
                row[name] = step(c)
        return row

    return record


def default_value(schema: dict, value):
    """A default of a schema, which JSON can only say in part, as a value."""
    kind = schema["type"]
    if kind == "union":
        return default_value(schema["branches"][0], value)
    if kind in ("bytes", "fixed"):
        value = value.encode("latin-1")
        return _converted(lambda data: data, schema)(value)
    if kind in ("float", "double"):
        return float(value)
    if kind == "array":
        return [default_value(schema["items"], v) for v in value]
    if kind == "map":
        return [(k, default_value(schema["values"], v)) for k, v in value.items()]
    if kind == "record":
        return {f["name"]: default_value(f["type"], value.get(f["name"], f.get("default"))) for f in schema["fields"]}
    return _converted(lambda number: number, schema)(value)


# ----------------------------------------------------------------------------------------------- encoding


def number(value: int) -> bytes:
    """A variable-length zig-zag number of up to 64 bits."""
    if not -(1 << 63) <= value < 1 << 63:
        raise ValueError(f"{value} has more than 64 bits")
    value = (value << 1) ^ (value >> 63)
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    out.append(value)
    return bytes(out)


def encoder(schema: dict, where: str = "row") -> Callable[[object, bytearray], None]:
    """Appends a value's bytes; a value that does not fit the schema is an error that names the field."""
    kind, logical = schema["type"], _logical(schema)

    def fits(value, *types) -> None:
        if not isinstance(value, types) or (isinstance(value, bool) and bool not in types):
            raise ValueError(f"{where}: {'null' if value is None else type(value).__name__} is no {logical or kind}")

    if kind == "null":
        return lambda v, out: None if v is None else fits(v)
    if kind == "boolean":
        return lambda v, out: (fits(v, bool), out.append(v)) and None
    if kind in ("int", "long"):
        limit = 1 << (31 if kind == "int" else 63)

        def whole(v, out: bytearray) -> None:
            if logical == "date":
                fits(v, datetime.date)
                v = (v - EPOCH_DAY).days
            elif logical in TIMES:
                fits(v, datetime.datetime)
                start, unit = TIMES[logical]
                v = (v.replace(tzinfo=v.tzinfo or datetime.timezone.utc) - start.replace(tzinfo=datetime.timezone.utc)) // MICROSECOND // unit
            else:
                fits(v, int)
            if not -limit <= v < limit:
                raise ValueError(f"{where}: {v} does not fit {kind}")
            out += number(v)

        return whole
    if kind in ("float", "double"):
        form = "<f" if kind == "float" else "<d"

        def real(v, out: bytearray) -> None:
            fits(v, float, int)
            out += struct.pack(form, v)

        return real
    if kind in ("bytes", "fixed", "string"):

        def block(v, out: bytearray) -> None:
            if logical == "decimal":
                fits(v, decimal.Decimal)
                scaled = v.scaleb(schema.get("scale", 0), decimal.Context(prec=80))
                if scaled != scaled.to_integral_value():
                    raise ValueError(f"{where}: {v} has more than {schema.get('scale', 0)} decimals")
                unscaled = int(scaled)
                size = schema["size"] if kind == "fixed" else (unscaled + (unscaled < 0)).bit_length() // 8 + 1
                data = unscaled.to_bytes(size, "big", signed=True)
            elif kind == "string":
                fits(v, str)
                data = v.encode()
            else:
                fits(v, bytes, bytearray)
                data = bytes(v)
            if kind != "fixed":
                out += number(len(data))
            elif len(data) != schema["size"]:
                raise ValueError(f"{where}: {len(data)} bytes, not {schema['size']}")
            out += data

        return block
    if kind == "enum":
        places = {symbol: number(i) for i, symbol in enumerate(schema["symbols"])}

        def enum(v, out: bytearray) -> None:
            if v not in places:
                raise ValueError(f"{where}: {v!r} is none of {schema['symbols']}")
            out += places[v]

        return enum
    if kind == "union":
        branches = [(number(i), encoder(b, where)) for i, b in enumerate(schema["branches"])]
        nulls = [head for head, b in zip((h for h, _ in branches), schema["branches"]) if b["type"] == "null"]
        others = [pair for pair, b in zip(branches, schema["branches"]) if b["type"] != "null"]

        def union(v, out: bytearray) -> None:
            if v is None and nulls:
                out += nulls[0]
                return
            begin, fault = len(out), None
            for head, branch in others:
                try:
                    out += head
                    branch(v, out)
                    return
                except ValueError as error:  # the next branch may take it
                    del out[begin:]
                    fault = fault or error
            raise fault or ValueError(f"{where}: no branch for {v!r}")

        return union
    if kind == "record":
        fields = [(f["name"], encoder(f["type"], f"{where}.{f['name']}")) for f in schema["fields"]]

        def record(v, out: bytearray) -> None:
            fits(v, dict)
            for name, field in fields:
                field(v.get(name), out)

        return record
    value = encoder(schema["items"] if kind == "array" else schema["values"], where)

    def many(v, out: bytearray) -> None:
        if kind == "map" and isinstance(v, list):  # Arrow gives maps as pairs
            v = dict(v)
        fits(v, list if kind == "array" else dict)
        if v:
            out += number(len(v))
            for item in v if kind == "array" else v.items():
                if kind == "map":
                    key = item[0].encode()
                    out += number(len(key)) + key
                    item = item[1]
                value(item, out)
        out.append(0)

    return many


# -------------------------------------------------------------------------------------------------- files

CODECS = {"null", "deflate", "zstandard", "snappy"}


def packed(data: bytes, codec: str) -> bytes:
    if codec == "null":
        return data
    if codec == "deflate":
        engine = zlib.compressobj(6, zlib.DEFLATED, -15)
        return engine.compress(data) + engine.flush()
    if codec == "zstandard":
        return pa.compress(data, codec="zstd", asbytes=True)
    return pa.compress(data, codec="snappy", asbytes=True) + struct.pack(">I", zlib.crc32(data))


def unpacked(data: bytes, codec: str) -> bytes:
    if codec == "null":
        return data
    if codec == "deflate":
        return zlib.decompress(data, -15)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    if codec != "snappy":
        raise ValueError(f"no such codec: {codec}")
    size, shift, at = 0, 0, 0
    while True:  # the length of the content stands in front of it
        size |= (data[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if data[at - 1] < 128:
            break
    out = pa.decompress(data[:-4], size, codec="snappy", asbytes=True)
    if zlib.crc32(out) != struct.unpack(">I", data[-4:])[0]:
        raise ValueError("checksum of a block does not match")
    return out


def header(file) -> tuple[dict, str, bytes, int]:
    """The writer's schema, the codec, the sync marker, and the size of the header."""
    data, piece = b"", 64 << 10
    while True:
        more = file.read(piece)
        data += more
        cursor = Cursor(data)
        try:
            if cursor.take(4) != MAGIC:
                raise TypeError("not an Avro container file")
            meta = dict(decoder(META_PARSED, META_PARSED)(cursor))
            sync = cursor.take(SYNC)
            break
        except (ValueError, IndexError):  # the header is longer than what has been read
            if not more:
                raise TypeError("not an Avro container file") from None
    codec = meta.get("avro.codec", b"null").decode()
    return parsed(meta["avro.schema"].decode()), codec, sync, cursor.at


META_PARSED = parsed(META)


class Window:
    """Reads a file in large pieces, however small the reads asked for."""

    def __init__(self, file, size: int, piece: int = 4 << 20) -> None:
        self.file, self.size, self.piece = file, size, piece
        self.begin, self.data = 0, b""

    def get(self, at: int, n: int) -> bytes:
        """``n`` bytes from there, fewer at the end of the file."""
        if at < self.begin or at + n > self.begin + len(self.data):
            self.file.seek(at)
            self.begin, self.data = at, self.file.read(max(n, min(self.piece, self.size - at)))
        return self.data[at - self.begin : at - self.begin + n]


def blocks(file, size: int, begin: int, end: int, sync: bytes, codec: str) -> Iterator[tuple[int, bytes]]:
    """(rows, bytes) of the blocks whose preceding sync marker begins in [begin, end)."""
    window, at, step = Window(file, size), begin, 1 << 20
    while True:  # look for the first marker; one may lie over two steps
        if at >= end:
            return
        found = window.get(at, min(step + SYNC - 1, size - at)).find(sync)
        if found >= 0:
            at += found
            break
        at += step
    while at < end and at + SYNC < size:
        cursor = Cursor(window.get(at + SYNC, 20))
        rows, length = cursor.number(), cursor.number()
        body = window.get(at + SYNC + cursor.at, length + SYNC)
        if len(body) < length + SYNC or body[length:] != sync:
            raise ValueError("a block does not end with the file's sync marker")
        yield rows, unpacked(body[:length], codec)
        at += SYNC + cursor.at + length


class Range(InputPartition):
    def __init__(self, path: str, size: int, begin: int, end: int) -> None:
        self.path, self.size, self.begin, self.end = path, size, begin, end


class AvroReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, reader: str | None, split_bytes: int) -> None:
        self.path, self.schema, self.reader, self.split = path, schema, reader, split_bytes

    def partitions(self) -> list[InputPartition]:
        found = []
        for info in files_under(self.path):
            found += [Range(info.path, info.size, b, min(b + self.split, info.size)) for b in range(0, info.size, self.split)]
        return found

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no files
            return
        arrow = to_arrow_schema(self.schema)
        store, _ = place_of(self.path)
        with store.open_input_file(partition.path) as file:
            writer, codec, sync, _ = header(file)
            wanted = parsed(self.reader) if self.reader else projected(writer, self.schema.names)
            decode = decoder(writer, wanted)
            held: list[dict] = []
            for rows, data in blocks(file, partition.size, partition.begin, partition.end, sync, codec):
                cursor = Cursor(data)
                for _ in range(rows):
                    held.append(decode(cursor))
                    if len(held) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held = []
                if cursor.at != len(data):
                    raise ValueError(f"a block of {partition.path} is longer than its rows")
            if held:
                yield pa.RecordBatch.from_pylist(held, arrow)


class Written(WriterCommitMessage):
    def __init__(self, draft: str, name: str) -> None:
        self.draft, self.name = draft, name


class AvroWriter(DataSourceArrowWriter):
    """One file for each task, in blocks of about ``BLOCK_BYTES``."""

    def __init__(self, path: str, schema: dict | list, codec: str, overwrite: bool) -> None:
        if codec not in CODECS:
            raise ValueError(f"no such codec: {codec}")
        self.schema, self.codec, self.overwrite, self.drafts = schema, codec, overwrite, Drafts(path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        encode, sync = encoder(parsed(self.schema)), os.urandom(SYNC)
        store, draft = self.drafts.create()
        meta = {"avro.schema": json.dumps(self.schema).encode(), "avro.codec": self.codec.encode()}
        with store.open_output_stream(draft) as file:
            head = bytearray(MAGIC)
            encoder(META_PARSED)(meta, head)
            file.write(bytes(head) + sync)
            block, rows = bytearray(), 0

            def close() -> None:
                data = packed(bytes(block), self.codec)
                file.write(number(rows) + number(len(data)) + data + sync)

            for batch in iterator:
                for begin in range(0, batch.num_rows, BATCH_ROWS):
                    for row in batch.slice(begin, BATCH_ROWS).to_pylist():
                        encode(row, block)
                        rows += 1
                        if len(block) >= BLOCK_BYTES:
                            close()
                            block, rows = bytearray(), 0
            if rows:
                close()
        return Written(draft, f"part-{draft.rpartition('/')[2]}.avro")

    def commit(self, messages: list) -> None:
        moves = [(m.draft, m.name) for m in messages if m is not None]
        self.drafts.publish(moves, r".*\.avro$" if self.overwrite else None)

    def abort(self, messages: list) -> None:
        self.drafts.clear()


class AvroSource(DataSource):
    """Data source ``avro_container``.

    Options: ``path``; ``avroSchema``, the reader's or the writer's schema as JSON; ``codec``; ``splitBytes``. Without
    a schema the first file's, by name, is the reader's, and the rows' own types make the writer's.
    """

    @classmethod
    def name(cls) -> str:
        return "avro_container"

    def schema(self) -> T.StructType:
        return spark_type(self._reader_schema())[0]

    def _reader_schema(self) -> dict:
        if given := self.options.get("avroSchema"):
            return parsed(given)
        found = files_under(self.options["path"])
        if not found:
            raise ValueError(f"no file under {self.options['path']}: give a schema")
        store, _ = place_of(self.options["path"])
        with store.open_input_file(found[0].path) as file:
            return header(file)[0]

    def reader(self, schema: T.StructType) -> AvroReader:
        split = int(self.options.get("splitBytes", SPLIT_BYTES))
        return AvroReader(self.options["path"], schema, self.options.get("avroSchema"), split)

    def writer(self, schema: T.StructType, overwrite: bool) -> AvroWriter:
        given = self.options.get("avroSchema")
        target = json.loads(given) if given else avro_type(schema, nullable=False)
        names = {f["name"] for f in parsed(target)["fields"]}
        if unknown := [f for f in schema.names if f not in names]:
            raise ValueError(f"the schema has no field {', '.join(unknown)}")
        return AvroWriter(self.options["path"], target, self.options.get("codec", "deflate"), overwrite)


def read_avro(spark: SparkSession, path: str, fields: list[str] | None = None, reader_schema: str | None = None) -> DataFrame:
    """Records of all files under the path.

    ``reader_schema`` (JSON) is resolved against each file's own: fields by name or alias, wider numbers, defaults.
    Or ``fields`` names those to read, typed as in the first file.
    """
    spark.dataSource.register(AvroSource)
    reader = spark.read.format("avro_container")
    if reader_schema:
        reader = reader.option("avroSchema", reader_schema)
    elif fields is not None:
        whole = reader.load(path).schema
        reader = reader.schema(T.StructType([whole[f] for f in fields]))
    return reader.load(path)


def write_avro(df: DataFrame, path: str, schema: str | None = None, codec: str = "deflate", mode: str = "append") -> None:
    """Writes records by the schema (JSON), or by one made of the columns' types.

    A column that the schema does not have, and a value that its field does not take, end the write with an error.
    """
    df.sparkSession.dataSource.register(AvroSource)
    writer = df.write.format("avro_container").mode(mode).option("codec", codec)
    (writer.option("avroSchema", schema) if schema else writer).save(path)
