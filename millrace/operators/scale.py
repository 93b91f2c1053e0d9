"""Helpers that keep an operator safe when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

SIDE_ROWS = 1000


def null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[f"{prefix}{name}"])
    return condition


def position_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position", sizes: Sequence[Column] = ()) -> DataFrame:
    """Numbers the rows of each key 1, 2, 3 … in ``order`` (must be unique within a key).

    The rows are range-partitioned by (keys, order), so a hot key is spread over many
    partitions; each partition numbers its part and adds the count of the parts
    before it. The ranges are written to the checkpoint folder once, because the
    counts and the rows must see the same split. For each of ``sizes`` a column
    ``name_0``, ``name_1`` … has its sum up to the row.
    """
    named = [F.lit(1).cast("long").alias("_one"), *[s.cast("long").alias(f"_size_{i}") for i, s in enumerate(sizes)]]
    measures = ["_one", *[f"_size_{i}" for i in range(len(sizes))]]
    ranged = materialize(df.select("*", *named).repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    split = [*keys, "_part"]
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*split).agg(*[F.sum(m).alias(m) for m in measures])
    offsets = totals.select(
        *[F.col(c).alias(f"_o_{c}") for c in split],
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_o_{m}") for m in measures],
    )
    inside = Window.partitionBy(*split).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(m).over(inside).alias(f"_l_{m}") for m in measures])
    joined = local.join(offsets, null_safe(local, offsets, split, "_o_"))
    names = [name, *[f"{name}_{i}" for i in range(len(sizes))]]
    return joined.select(*df.columns, *[(F.col(f"_l_{m}") + F.col(f"_o_{m}")).alias(n) for m, n in zip(measures, names)])


def chunk_in_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int, name: str = "chunk", size: Column | None = None, chunk_bytes: int = 8 << 20
) -> DataFrame:
    """Splits each key into chunks, numbered from 0, of at most ``chunk_rows`` rows and about ``chunk_bytes`` of ``size``.

    A chunk is over when the next row would start another run of ``chunk_rows`` rows or of
    ``chunk_bytes``; chunks are numbered densely.
    """
    sizes = [size] if size is not None else []
    numbered = position_in_key(df, keys, order, "_position", sizes)
    by_rows = F.floor((F.col("_position") - 1) / F.lit(chunk_rows)).cast("long")
    if size is None:
        return numbered.withColumn(name, by_rows).drop("_position")
    by_bytes = F.floor((F.col("_position_0") - size.cast("long")) / F.lit(chunk_bytes)).cast("long")
    # Both parts only grow along a key, so their sum numbers the runs in order and without a gap of rows.
    return numbered.withColumn(name, by_rows + by_bytes).drop("_position", "_position_0")


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` whose hot keys, of either side, Spark may split at run time.

    Adaptive execution splits both sides of an inner join, but not the side that an outer
    join keeps the partners of. So the matched rows come from an inner join, and the
    unmatched rows from anti joins against the distinct keys. Rows with a null key match
    nothing; a hash of the whole row beside the key spreads them. ``how`` is inner, left or full.
    """
    matched = left.join(right, key)
    parts = [matched]
    for kept, other in ((left, right), (right, left))[: {"inner": 0, "left": 1, "full": 2}[how]]:
        spread = F.coalesce(F.when(F.col(key).isNotNull(), F.xxhash64(key)), F.xxhash64(*kept.columns))
        keys = other.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_spread", F.xxhash64(key))
        parts.append(kept.withColumn("_spread", spread).join(keys, [key, "_spread"], "left_anti").drop("_spread"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def attach_all(df: DataFrame, side: DataFrame, side_rows: int = SIDE_ROWS) -> DataFrame:
    """Every row of ``df`` with every row of a small fixed ``side``, as an iterable side input gives it.

    The side is one array value, exploded in the map stage. A side of more than
    ``side_rows`` rows ends the job with an error: it would multiply the table.
    """
    fields = side.columns
    too_many = F.raise_error(F.lit(f"the side input has more than {side_rows} rows"))
    bounded = side.limit(side_rows + 1).agg(F.collect_list(F.struct(*fields)).alias("items"), F.count("*").alias("n"))
    items = bounded.select(F.when(F.col("n") <= side_rows, F.col("items")).otherwise(too_many).alias("items")).scalar()
    return df.withColumn("_item", F.explode(items)).select(*df.columns, *[f"_item.{c}" for c in fields])
