"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import scratch_path

#: Equal rows are given out again in runs of at most this many, so no array of a hot row grows with the table.
RUN = 65_536


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once as Parquet to the shared folder and read from there.

    Cuts the lineage at a table that survives lost executors and is far smaller than cached rows.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]):
    """Equality of the column pairs in which null equals null."""
    condition = F.lit(True)
    for mine, theirs in pairs:
        condition = condition & left[mine].eqNullSafe(right[theirs])
    return condition


def folded(df: DataFrame) -> DataFrame:
    """Equal rows as one row with their number ``_n``."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n"))


def unfolded(df: DataFrame, name: str, first: str) -> DataFrame:
    """Each row ``_n`` times, ``name`` counting up from the column ``first``."""
    rest = [c for c in df.columns if c not in ("_n", first)]
    runs = df.withColumn("_run", F.explode(F.expr(f"sequence(0L, _n - 1, {RUN}L)")))
    last = f"least(_run + {RUN - 1}L, _n - 1)"
    return runs.select(*rest, F.explode(F.expr(f"transform(sequence(_run, {last}), i -> i + {first})")).alias(name))


def numbered(df: DataFrame, group: Sequence[str], name: str, cells: int = 1024) -> DataFrame:
    """Numbers the rows of each group 0, 1, 2 … without a gap, in no particular but repeatable order.

    A group, however large, is split into ``cells`` by a hash of its rows; each cell numbers its own rows and adds
    the rows of the cells before it. Equal rows are folded first, so they cost one row. Null is a group value.
    """
    counted = folded(df).withColumn("_cell", F.pmod(F.xxhash64(*df.columns), F.lit(cells)).cast("int"))
    earlier = (Window.unboundedPreceding, -1)
    sizes = counted.groupBy(*group, "_cell").agg(F.sum("_n").alias("_size"))
    offsets = sizes.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("_cell").alias("_g_cell"),
        F.coalesce(F.sum("_size").over(Window.partitionBy(*group).orderBy("_cell").rowsBetween(*earlier)), F.lit(0)).alias(
            "_before"
        ),
    )
    inside = Window.partitionBy(*group, "_cell").orderBy(*[c for c in df.columns if c not in group]).rowsBetween(*earlier)
    local = counted.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    joined = local.join(offsets, null_safe(local, offsets, [*((c, f"_g_{c}") for c in group), ("_cell", "_g_cell")]))
    placed = joined.select(*df.columns, "_n", (F.col("_before") + F.col("_inside")).alias("_first"))
    return unfolded(placed, name, "_first")


def ordered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Numbers the rows of each group 0, 1, 2 … in ``order``, ties by all other columns.

    Rows are dealt by ranges of (group, order), so a large group lies in many ranges; a range numbers its rows of
    a group and adds those of earlier ranges. The ranges are written once, because both sides need the same split.
    """
    rest = [c for c in df.columns if c not in group and c not in order]
    keys = [*group, *order, *rest]
    ranged = folded(df).repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "ordered")
    earlier = (Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(*group, "_part").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(*earlier)
    offsets = sizes.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("_part").alias("_g_part"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*group, "_part").orderBy(*order, *rest).rowsBetween(*earlier)
    local = ranged.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    joined = local.join(offsets, null_safe(local, offsets, [*((c, f"_g_{c}") for c in group), ("_part", "_g_part")]))
    return unfolded(joined.select(*df.columns, "_n", (F.col("_before") + F.col("_inside")).alias("_first")), name, "_first")
