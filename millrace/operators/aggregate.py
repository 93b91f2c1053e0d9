"""Counts, means, sums, combiners, grouping and samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby, islice
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from millrace.operators.rows import map_rows
from millrace.operators.scale import chunk_in_key

CHUNK_ROWS = 10_000
PIECE_ROWS = 10_000
NAN = float("nan")


def count_global(df: DataFrame) -> DataFrame:
    """One row with the count, 0 for an empty input."""
    return df.agg(F.count("*").alias("n"))


def count_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def mean_global(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.avg(value).alias("mean"))


def sum_per_key(df: DataFrame, keys: Sequence[str], value: str | Column, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The ``n`` largest rows; each task keeps only its own ``n``."""
    return df.orderBy(*order).limit(n)


def group_values(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str] = (), chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Values of each key as arrays, in order: (keys, chunk, values).

    A group is as many rows as it needs chunks of at most ``chunk_rows`` values and about
    8 MB, so it never has to fit one task; a smaller group is the single chunk 0.
    """
    order = list(order) or [value]
    size = F.coalesce(F.octet_length(F.col(value).cast("string")), F.lit(0)) + 16
    chunked = chunk_in_key(df, keys, order, chunk_rows, size=size)
    pairs = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_value"))))
    gathered = chunked.groupBy(*keys, "chunk").agg(pairs.alias("pairs"))
    return gathered.select(*keys, "chunk", F.transform("pairs", lambda p: p["_value"]).alias("values"))


def join_values(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    separator: str,
    order: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Texts of each key joined in order, one row per chunk: (keys, chunk, text)."""
    grouped = group_values(df, keys, value, order, chunk_rows)
    return grouped.select(*keys, "chunk", F.array_join("values", separator).alias("text"))


def render_groups(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str] = (), chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``key: a, b, etc.`` lines of the groups."""
    joined = join_values(df, keys, value, ", ", order, chunk_rows)
    return joined.select(
        *keys, "chunk", F.concat(F.concat_ws(" ", *keys), F.lit(": "), "text", F.lit(", etc.")).alias("line")
    )


def sample_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """``n`` rows of each key, the first by ``order`` so that a rerun takes the same ones.

    Spark keeps at most ``n`` rows per key and task before the shuffle (window group limit).
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


@dataclass(frozen=True)
class Combiner:
    """A user-defined aggregate: create, add, merge, extract.

    The accumulator is a tuple with the types of ``accumulator`` (DDL of its fields);
    ``merge`` must not depend on order. Where ``add_all`` is given it takes
    the place of ``add`` for any number of values: a list of them goes in at once.
    """

    create: Callable[[], tuple]
    add: Callable[[tuple, Any], tuple]
    merge: Callable[[tuple, tuple], tuple]
    extract: Callable[[tuple], Any]
    accumulator: str
    result: str
    add_all: Callable[[tuple, list], tuple] | None = None


def combine_per_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    combiner: Combiner,
    name: str = "result",
    held_keys: int = 50_000,
) -> DataFrame:
    """Applies a :class:`Combiner` per key with partial aggregation before the shuffle.

    Every task folds its rows into one accumulator per key, given out early when it
    holds ``held_keys`` of them. After the shuffle the accumulators of a key follow
    each other in sorted order and are merged as they stream by, so a hot key costs
    one accumulator per task that saw it and is never gathered. Keys are those of Spark's
    grouping: NaN equals NaN. Arrays, maps, structs and variants are refused.
    """
    keys = list(keys)
    width = len(keys)
    for field in df.select(*keys).schema:
        if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            raise TypeError(f"{field.name}: {field.dataType.simpleString()} can't be a key of a combiner")
    key_types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)

    def key_of(row: tuple) -> tuple:
        # One NaN object for all, as Python finds two of them unequal.
        return tuple(NAN if part != part else part for part in row[:width])

    def partial(rows: Iterator[tuple]) -> Iterator[tuple]:
        held: dict = {}
        while piece := list(islice(rows, PIECE_ROWS)):
            values: dict = {}
            for row in piece:
                values.setdefault(key_of(row), []).append(row[width])
            for key, items in values.items():
                acc = held[key] if key in held else combiner.create()
                if combiner.add_all is not None:
                    acc = combiner.add_all(acc, items)
                else:
                    for item in items:
                        acc = combiner.add(acc, item)
                held[key] = acc
            if len(held) >= held_keys:
                yield from (key + acc for key, acc in held.items())
                held = {}
        yield from (key + acc for key, acc in held.items())

    def merge_runs(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, parts in groupby(rows, key=key_of):
            acc = combiner.create()
            for part in parts:
                acc = combiner.merge(acc, part[width:])
            yield (*key, combiner.extract(acc))

    partials = map_rows(df.select(*keys, value), partial, f"{key_types}, {combiner.accumulator}")
    together = partials.repartition(*keys).sortWithinPartitions(*keys)
    return map_rows(together, merge_runs, f"{key_types}, {name} {combiner.result}")


def combine_globally(df: DataFrame, value: str, combiner: Combiner, name: str = "result") -> DataFrame:
    one_key = df.select(F.lit(0).alias("_all"), value)
    return combine_per_key(one_key, ["_all"], value, combiner, name).drop("_all")


def aggregate_by_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    zero: Any,
    seq: Callable[[Any, Any], Any],
    comb: Callable[[Any, Any], Any],
    kind: str,
    name: str = "result",
) -> DataFrame:
    """Zero value, add and merge per key; the accumulator is one value of type ``kind``."""
    combiner = Combiner(
        create=lambda: (zero,),
        add=lambda acc, item: (seq(acc[0], item),),
        merge=lambda a, b: (comb(a[0], b[0]),),
        extract=lambda acc: acc[0],
        accumulator=f"acc {kind}",
        result=kind,
    )
    return combine_per_key(df, keys, value, combiner, name)


def _add_present(acc: tuple, values: list) -> tuple:
    present = [v for v in values if v is not None]
    return acc[0] + sum(present), acc[1] + len(present)


# The mean of the values that are not null as a combiner: (sum, count). NaN gives NaN.
MEAN = Combiner(
    create=lambda: (0.0, 0),
    add=lambda acc, x: _add_present(acc, [x]),
    merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
    extract=lambda acc: acc[0] / acc[1] if acc[1] else None,
    accumulator="total double, n long",
    result="double",
    add_all=_add_present,
)


@dataclass(frozen=True)
class ColumnCombiner:
    """A combiner said in columns: all of it runs in Spark's own partial and final aggregation.

    ``add`` gives what a value puts into each part of the accumulator (null adds nothing), ``merge`` the built-in
    aggregate that puts a part's pieces together, ``extract`` the result from the parts. A part without any piece is
    null, unless its aggregate says otherwise.
    """

    add: Callable[[Column], dict[str, Column]]
    merge: dict[str, Callable[[Column], Column]]
    extract: Callable[[dict[str, Column]], Column]


def combine_columns(df: DataFrame, keys: Sequence[str], value: str | Column, combiner: ColumnCombiner, name: str = "result") -> DataFrame:
    """Applies the combiner per key, or to all rows without keys; then an empty input gives the result of no values.

    Rows are folded in their tasks before the shuffle, so a hot key costs one accumulator for each task.
    """
    pieces = combiner.add(F.col(value) if isinstance(value, str) else value)
    if set(pieces) != set(combiner.merge):
        raise ValueError(f"parts to add {sorted(pieces)}, parts to merge {sorted(combiner.merge)}")
    folded = df.groupBy(*keys).agg(*[combiner.merge[part](piece).alias(f"_part_{part}") for part, piece in pieces.items()])
    return folded.select(*keys, combiner.extract({part: F.col(f"_part_{part}") for part in pieces}).alias(name))


# The mean as in ``avg``: nulls are left out, NaN gives NaN, no values give null.
MEAN_BY_COLUMNS = ColumnCombiner(
    add=lambda v: {"total": v.cast("double"), "n": v},
    merge={"total": F.sum, "n": F.count},
    extract=lambda part: F.try_divide(part["total"], part["n"]),
)

# The sum of whole numbers, zero where there are none.
SUM_FROM_ZERO = ColumnCombiner(
    add=lambda v: {"total": v.cast("long")}, merge={"total": F.sum}, extract=lambda part: F.coalesce(part["total"], F.lit(0).cast("long"))
)
