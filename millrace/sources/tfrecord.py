"""TFRecord files as a Spark data source, ``spark.read.format("tfrecord")``.

A record is: length (8 bytes, little endian), masked CRC-32C of the length (4),
the bytes, masked CRC-32C of the bytes (4). One file is one input partition; a
write makes one file per task, moved to its final name when the job commits.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

# Fixed values of the format.
CRC32C_POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

BATCH_RECORDS, BATCH_BYTES = 2048, 16 << 20
BLOCK = 4096


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(CRC32C_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()
_STEPS = _TABLE.tolist()


def _advance(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The checksum states after the bytes of each piece, one byte position per step for all pieces."""
    order = np.argsort(-sizes, kind="stable")
    state, starts, sizes = crc[order], starts[order], sizes[order]
    alive = len(state)
    for position in range(int(sizes[0]) if alive else 0):
        while sizes[alive - 1] <= position:
            alive -= 1
        head = state[:alive]
        state[:alive] = (head >> np.uint32(8)) ^ _TABLE[(head ^ data[starts[:alive] + position]) & np.uint32(0xFF)]
    out = np.empty_like(state)
    out[order] = state
    return out


@lru_cache(maxsize=1)
def _block_tables() -> list[list[int]]:
    """What a block of zero bytes makes of each byte of a state; a state's four bytes add up by exclusive or."""
    states = (np.arange(256, dtype=np.uint32)[None] << np.array([[0], [8], [16], [24]], np.uint32)).ravel()
    zeros = np.zeros(BLOCK, np.uint8)
    none = np.zeros(len(states), np.int64)
    return _advance(states, zeros, none, none + BLOCK).reshape(4, 256).tolist()


def masked_crc(values: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of many byte strings at once.

    A long string is cut into blocks of ``BLOCK`` bytes behind a first shorter piece; the pieces go
    through together and their checksums are put together, so the steps don't grow with the length.
    """
    lengths = np.array([len(v) for v in values], dtype=np.int64)
    blocks = np.maximum(lengths - 1, 0) // BLOCK
    first = lengths - blocks * BLOCK
    begins = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(values) else np.empty(0, np.int64)
    piece_of = np.repeat(np.arange(len(values)), blocks + 1)
    nth = np.arange(len(piece_of)) - np.repeat(np.cumsum(blocks + 1) - blocks - 1, blocks + 1)
    starts = begins[piece_of] + np.where(nth == 0, 0, first[piece_of] + (nth - 1) * BLOCK)
    sizes = np.where(nth == 0, first[piece_of], BLOCK)
    initial = np.where(nth == 0, 0xFFFFFFFF, 0).astype(np.uint32)
    states = _advance(initial, np.frombuffer(b"".join(values), np.uint8), starts, sizes)
    crc = states[nth == 0].copy()
    for i in np.flatnonzero(blocks):
        t0, t1, t2, t3 = _block_tables()
        state = int(crc[i])
        for block in states[(piece_of == i) & (nth > 0)].tolist():
            state = t0[state & 255] ^ t1[state >> 8 & 255] ^ t2[state >> 16 & 255] ^ t3[state >> 24] ^ block
        crc[i] = state
    crc = ~crc
    rotated = (crc >> np.uint32(15)) | (crc << np.uint32(17))
    return rotated + np.uint32(MASK_DELTA)


def head_crc(head: bytes) -> int:
    """Masked CRC-32C of the eight bytes of a length."""
    state = 0xFFFFFFFF
    for byte in head:
        state = (state >> 8) ^ _STEPS[(state ^ byte) & 255]
    state ^= 0xFFFFFFFF
    return ((state >> 15 | state << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(values: list[bytes]) -> bytes:
    """The file bytes of the records."""
    heads = [struct.pack("<Q", len(v)) for v in values]
    body_crc = masked_crc(values)
    return b"".join(
        b"".join((head, struct.pack("<I", head_crc(head)), value, struct.pack("<I", int(b))))
        for head, value, b in zip(heads, values, body_crc)
    )


def _checked(values: list[bytes], body_crc: list[int], path: str) -> list[bytes]:
    if not np.array_equal(masked_crc(values), np.array(body_crc, dtype=np.uint32)):
        raise ValueError(f"checksum does not match in {path}")
    return values


def unframe(stream, path: str = "") -> Iterator[list[bytes]]:
    """Batches of records out of a byte stream, bounded in number and bytes, checksums verified."""
    values, body_crc, held = [], [], 0
    while True:
        head = stream.read(12)
        if not head:
            break
        if len(head) < 12:
            raise ValueError(f"truncated record in {path}")
        size, crc = struct.unpack("<QI", head)
        if head_crc(head[:8]) != crc:
            raise ValueError(f"length checksum does not match in {path}")
        body = stream.read(size + 4)
        if len(body) < size + 4:
            raise ValueError(f"truncated record in {path}")
        values.append(body[:size])
        body_crc.append(struct.unpack("<I", body[size:])[0])
        held += size
        if len(values) >= BATCH_RECORDS or held >= BATCH_BYTES:
            yield _checked(values, body_crc, path)
            values, body_crc, held = [], [], 0
    if values:
        yield _checked(values, body_crc, path)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        filesystem, root = fs.FileSystem.from_uri(self.path)
        info = filesystem.get_file_info(root)
        if info.type == fs.FileType.File:
            return [_File(root)]
        listed = filesystem.get_file_info(fs.FileSelector(root, recursive=True))
        names = sorted(i.path for i in listed if i.type == fs.FileType.File and not i.base_name.startswith((".", "_")))
        return [_File(name) for name in names]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        filesystem, _ = fs.FileSystem.from_uri(self.path)
        with filesystem.open_input_stream(partition.path, buffer_size=1 << 20) as stream:
            for values in unframe(stream, partition.path):
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["record"])


class _Written(WriterCommitMessage):
    def __init__(self, draft: str, final: str):
        self.draft, self.final = draft, final


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path = path
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        filesystem, root = fs.FileSystem.from_uri(self.path)
        filesystem.create_dir(root, recursive=True)
        name = f"part-{uuid.uuid4().hex}.tfrecord"
        draft, final = f"{root}/.{name}.draft", f"{root}/{name}"
        with filesystem.open_output_stream(draft) as stream:
            for batch in iterator:
                values = batch.column(0).to_pylist()
                for first in range(0, len(values), BATCH_RECORDS):
                    stream.write(frame(values[first : first + BATCH_RECORDS]))
        return _Written(draft, final)

    def commit(self, messages: list) -> None:
        filesystem, root = fs.FileSystem.from_uri(self.path)
        if self.overwrite:
            earlier = filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True))
            for info in earlier:
                if info.path.endswith(".tfrecord"):
                    filesystem.delete_file(info.path)
        for message in messages:
            if message is not None:
                filesystem.move(message.draft, message.final)

    def abort(self, messages: list) -> None:
        filesystem, _ = fs.FileSystem.from_uri(self.path)
        for message in messages:
            if message is not None:
                filesystem.delete_file(message.draft)


class TfRecordSource(DataSource):
    """Data source ``tfrecord`` with one column ``record binary``."""

    @classmethod
    def name(cls) -> str:
        return "tfrecord"

    def schema(self) -> str:
        return "record binary"

    def _uri(self) -> str:
        """The path as a URI the file system library knows."""
        path = self.options["path"]
        scheme, _, rest = path.partition(":")
        if scheme == "file":
            return "file:///" + rest.lstrip("/")
        if scheme in ("s3a", "s3n"):
            return f"s3:{rest}"
        return path if "://" in path else f"file://{path}"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self._uri())

    def writer(self, schema, overwrite: bool):
        return _Writer(self._uri(), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TfRecordSource)
