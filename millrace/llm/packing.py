"""Best-fit packing: exact-complement hashing over the counts of lengths, then best fit for the rest."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.arrow import pieces, utf8
from millrace.llm.common import numbered, written
from millrace.llm.tokens import encoder

END_ID = 1

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path() -> str:
    """The public vocabulary's place on the machine that asks; executors ask for themselves."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """The documents' ids, each document's end mark included, cut into pieces of ``capacity`` where longer.

    A null text is empty: one piece, the end mark alone. With ``keep_ids`` the ids come along as ``ids``.
    """
    schema = PIECE + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer or tokenizer_path()).encode
        for batch in batches:
            for part in pieces(batch, "text", 16 << 20):
                flat, bounds = encode(utf8(part.column("text")))
                doc, piece, start, length, crc, held = [], [], [], [], [], []
                for i, key in enumerate(part.column("doc_id").to_pylist()):
                    ids = np.append(flat[bounds[i] : bounds[i + 1]], np.uint32(END_ID)).astype("<u4")
                    for k, begin in enumerate(range(0, len(ids), capacity)):
                        cut = ids[begin : begin + capacity]
                        doc.append(key), piece.append(k), start.append(begin), length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                        if keep_ids:
                            held.append(cut.astype(np.int32))
                columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                columns += [pa.array(held, pa.list_(pa.int32()))] * keep_ids
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


class Fill:
    """Which lengths go together, from how many pieces there are of each length.

    ``counts[n]`` is the number of pieces of length n. The longest length left opens a sequence; the gap is looked up
    among the sums of one, two and three lengths that are still there. Without an exact filling the largest length
    that fits goes in and the smaller gap is looked up again. A filling is used as often as its counts allow.
    """

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.astype(np.int64).copy()
        self.capacity = len(counts) - 1

    def _pair(self, gap: int, there: np.ndarray) -> list[int] | None:
        """Two lengths that make up the gap, the larger as large as can be."""
        both = np.flatnonzero(there[1:gap] & there[gap - 1 : 0 : -1])
        if not len(both):
            return None
        large = int(both[-1]) + 1
        if large * 2 == gap and self.left[large] < 2:
            both = both[both + 1 != large]
            if not len(both):
                return None
            large = int(both[-1]) + 1
        return [large, gap - large]

    def exact(self, gap: int) -> list[int] | None:
        """One, two or three lengths, all still there, that make up the gap."""
        there = self.left > 0
        if there[gap]:
            return [gap]
        if pair := self._pair(gap, there):
            return pair
        for first in np.flatnonzero(there[1:gap])[::-1] + 1:
            if 3 * first < gap:  # the largest of the three is tried first
                return None
            self.left[first] -= 1
            pair = self._pair(gap - int(first), self.left > 0)
            self.left[first] += 1
            if pair:
                return [int(first), *pair]
        return None

    def sequences(self) -> Iterator[tuple[list[int], int]]:
        """Lengths that share a sequence, and how many sequences are filled so."""
        while (longest := np.flatnonzero(self.left)).size:
            taken = [int(longest[-1])]
            self.left[taken[0]] -= 1
            gap = self.capacity - taken[0]
            while gap:
                found = self.exact(gap)
                if found is None:
                    fits = np.flatnonzero(self.left[: gap + 1])
                    if not fits.size:
                        break
                    found = [int(fits[-1])]
                np.subtract.at(self.left, found, 1)
                taken += found
                gap -= sum(found)
            lengths, uses = np.unique(taken, return_counts=True)
            more = int((self.left[lengths] // uses).min())
            self.left[lengths] -= more * uses
            yield taken, more + 1


def plan(counts: np.ndarray) -> np.ndarray:
    """Rows (length, first rank, sequence of that rank, offset), sorted: where pieces of a length go by their rank."""
    rows, used, sequence = [], np.zeros(len(counts), np.int64), 0
    for lengths, times in Fill(counts).sequences():
        offset = 0
        for length in lengths:
            rows.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(parts: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity``.

    Only the count of each length (at most ``capacity`` numbers) reaches the driver; the plan made of them is as
    bounded. Pieces are numbered within their length and look up their place by that number.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in parts.groupBy("length").agg(F.count("*")).collect():
        counts[length] = n
    where = plan(counts)
    bits = np.int64(2**46)
    keys = where[:, 0] * bits + where[:, 1]
    schema = StructType(list(parts.schema.fields)).add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            row = where[np.searchsorted(keys, batch.column("length").to_numpy() * bits + rank, "right") - 1]
            columns = [batch.column(c) for c in schema.names[:-2]]
            columns += [pa.array(row[:, 2] + rank - row[:, 1]), pa.array(row[:, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return numbered(parts, ["length"], "_rank", cells=256).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per piece of a document: its ids' place in the packed sequences of at most ``capacity`` ids.

    Null texts are empty documents; equal rows are packed each; a null doc_id is kept. The pieces are written once,
    since counts and places both read them. No documents give no rows.
    """
    return pack(written(token_pieces(docs, capacity, tokenizer, keep_ids), "pieces"), capacity)
