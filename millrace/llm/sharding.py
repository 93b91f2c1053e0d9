"""Sharding by weighted rendezvous hashing: every (record key, shard) pair draws a number, the best shard wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import numbered


def rendezvous(key: Sequence[str | Column], weights: Mapping[int, float]) -> Column:
    """The shard of a record, from its key and the weighted shards alone.

    Each shard draws u in (0, 1) from a hash of key and shard number; the largest ``-weight / ln(u)`` wins, ties to
    the smaller number. A shard's draw does not depend on the others: a new shard takes rows only into itself, a
    removed one gives away only its own. A null key is a key like any other.
    """
    if not weights or any(not w > 0 for w in weights.values()):
        raise ValueError("shards need positive weights")

    def cost(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(*key, F.lit(shard)), 11)
        return -F.ln((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(float(weight))

    drawn = [F.struct(cost(s, w).alias("cost"), F.lit(s).alias("shard")) for s, w in sorted(weights.items())]
    return F.array_min(F.array(*drawn))["shard"]


def shard_rows(df: DataFrame, key: Sequence[str], weights: Mapping[int, float], name: str = "shard") -> DataFrame:
    """Adds the shard of each row under ``name``; no shuffle, all other columns stay."""
    return df.withColumn(name, rendezvous(key, weights))


def place_documents(docs: DataFrame, shards: int = 8, cells: int = 1024) -> DataFrame:
    """One row per document: its shard, its slot there (0, 1, 2 …), and its shard if there were one more.

    ``size`` is the text's UTF-8 bytes plus 1; a null text counts as empty (size 1, checksum 0). Equal rows take
    slots of their own. Only key, size and checksum leave the scan.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = shard_rows(rows, ["doc_id"], dict.fromkeys(range(shards), 1.0))
    placed = shard_rows(placed, ["doc_id"], dict.fromkeys(range(shards + 1), 1.0), "grown_shard")
    slots = numbered(placed, ["shard"], "slot", cells)
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
