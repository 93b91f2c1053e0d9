"""Nearest neighbours: a forest of random-projection trees, one queue over all its trees, exact distances at the leaves."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written


@dataclass(frozen=True)
class Tree:
    """Inner nodes as rows: a unit normal, a threshold, and two children; a child below 0 is the leaf ``-child - 1``."""

    normals: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int64) if len(self.children) else np.full(len(vectors), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], self.normals[node]) > self.thresholds[node]
            at[inner] = self.children[node, side.astype(int)]
        return -at - 1


def grow(sample: np.ndarray, leaf: int, rng: np.random.Generator, tries: int = 3) -> Tree:
    """Splits at the median along the difference of two sampled points, the widest spread of ``tries`` draws."""
    normals, thresholds, children, leaves = [], [], [], 0
    todo = [(np.arange(len(sample)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        if len(rows) > leaf:
            for _ in range(tries):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                if (norm := np.linalg.norm(a - b)) > 0:
                    along = sample[rows] @ ((a - b) / norm)
                    if split is None or along.var() > split[0]:
                        split = along.var(), (a - b) / norm, along
        if split is None or not (high := split[2] > np.median(split[2])).any():
            here = -leaves - 1
            leaves += 1
        else:
            here = len(normals)
            normals.append(split[1]), thresholds.append(np.median(split[2])), children.append([0, 0])
            todo += [(rows[high], here, 1), (rows[~high], here, 0)]
        if parent >= 0:
            children[parent][side] = here
    shape = (-1, sample.shape[1])
    return Tree(np.array(normals).reshape(shape), np.array(thresholds), np.array(children, int).reshape(-1, 2), leaves)


def visited(trees: list[Tree], sizes: list[np.ndarray], query: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """Leaves in the order of one queue over all trees, until their rows number ``wanted``.

    A node waits with the largest distance from the query to a plane that had to be crossed to reach it.
    """
    sides = [t.normals @ query - t.thresholds for t in trees]
    queue = [(0.0, k, 0 if len(t.children) else -1) for k, t in enumerate(trees)]
    out, rows = [], 0
    while queue and rows < wanted:
        far, k, node = heapq.heappop(queue)
        while node >= 0:
            margin = sides[k][node]
            near = int(margin > 0)
            heapq.heappush(queue, (max(far, abs(margin)), k, int(trees[k].children[node, 1 - near])))
            node = int(trees[k].children[node, near])
        out.append((k, -node - 1))
        rows += sizes[k][-node - 1]
    return out


def matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Vectors that take part, one for each id: the smallest where an id has several."""
    good = F.forall(F.col(vector), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    some = F.exists(F.col(vector), lambda x: x != 0)
    kept = rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & good & some)
    return kept.groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.min(vector).alias("vec"))


def nearest(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 100,
    k: int = 10,
    trees: int = 8,
    sample_rows: int = 20_000,
    leaf_share: float = 1 / 250,
    visit_share: float = 1.3,
    block_rows: int = 8192,
    block_queries: int = 2048,
    seed: int = 7,
) -> DataFrame:
    """The ``k`` nearest rows (Euclidean) found for each row whose id is divisible by ``every``, itself left out.

    ``trees`` trees are grown from ``sample_rows`` rows (those with the smallest hash of the id) to leaves of
    ``leaf_share`` of the sample; every row is put into its leaf of every tree. A query takes leaves from a queue
    shared by the trees until they hold ``visit_share`` of the rows (counted once for each tree). All rows of these
    leaves are candidates; their distances are exact, in double precision, on the original vectors.

    Equal vectors are searched as one, with their ``k + 1`` smallest ids, so a vector that many rows have costs one
    row. A leaf is cut into blocks of rows and of queries by a hash, so no task holds more than one of each. Vectors
    that are null, empty, zero, or hold null or non-finite components take no part, nor do null ids; of several
    vectors with one id the smallest counts. Vectors of different lengths are searched apart. Ties go to the smaller
    id. Columns: query_id, rank from 1, vec_id, score.
    """
    spark = rows.sparkSession
    usable = written(_usable(rows, key, vector), "vectors")
    ranked = usable.withColumn("_r", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id")))
    same = ranked.filter(F.col("_r") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    same = written(same.select(F.col("ids")[0].alias("rep"), "ids", "vec"), "distinct-vectors")
    queries = usable.filter(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")

    # The forest, one for each length of vectors; its size depends on the parameters only.
    forests: dict[int, list[Tree]] = {}
    rng = np.random.default_rng(seed)
    for (dim,) in sorted(same.select(F.size("vec")).distinct().collect()):
        drawn = same.filter(F.size("vec") == dim).orderBy(F.xxhash64("rep"), "rep").limit(sample_rows)
        sample = matrix(pa.array(drawn.select("vec").toPandas()["vec"].to_list(), pa.list_(pa.float64())))
        leaf = max(2 * k, int(len(sample) * leaf_share))
        forests[dim] = [grow(sample, leaf, rng) for _ in range(trees)]
    forest = spark.sparkContext.broadcast(forests)
    vec_type = usable.schema["vec"].dataType.simpleString()

    def in_lengths(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
        sizes = batch.column("vec").value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(sizes):
            yield int(dim), batch.filter(pa.array(sizes == dim))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in in_lengths(batch):
                vectors = matrix(part.column("vec"))
                for t, tree in enumerate(forest.value[dim]):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(part), dim, np.int32)),
                            pa.array(np.full(len(part), t, np.int32)),
                            pa.array(tree.leaf_of(vectors).astype(np.int32)),
                            part.column("rep"),
                            part.column("vec"),
                        ],
                        names=["dim", "tree", "leaf", "rep", "vec"],
                    )

    leaf = ["dim", "tree", "leaf"]
    placed = same.select("rep", "vec").mapInArrow(put, f"dim int, tree int, leaf int, rep long, vec {vec_type}")
    sizes = {d: [np.zeros(t.leaves, np.int64) for t in f] for d, f in forests.items()}
    for d, t, at, n in placed.groupBy(*leaf).agg(F.count("*")).collect():
        sizes[d][t][at] = n
    leaf_sizes = spark.sparkContext.broadcast(sizes)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in in_lengths(batch):
                counts = leaf_sizes.value[dim]
                wanted = max((k + 1) * trees, visit_share * counts[0].sum())
                found = [visited(forest.value[dim], counts, q, wanted) for q in matrix(part.column("vec"))]
                who = np.repeat(np.arange(len(part)), [len(f) for f in found])
                flat = np.array([x for f in found for x in f], np.int32).reshape(-1, 2)
                for begin in range(0, len(who), 20_000):
                    cut = slice(begin, begin + 20_000)
                    ids = [pa.array(np.full(len(who[cut]), dim, np.int32)), *(pa.array(flat[cut, i]) for i in (0, 1))]
                    asked = [part.column(c).take(pa.array(who[cut])) for c in ("query_id", "vec")]
                    yield pa.RecordBatch.from_arrays([*ids, *asked], names=["dim", "tree", "leaf", "query_id", "vec"])

    routed = queries.mapInArrow(route, f"dim int, tree int, leaf int, query_id long, vec {vec_type}")
    asked = routed.groupBy(*leaf).agg(F.ceil(F.count("*") / block_queries).cast("int").alias("query_blocks"))
    held = placed.groupBy(*leaf).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("row_blocks"))
    # As many rows as there are leaves, which the parameters bound.
    blocks = F.broadcast(written(asked.join(held, leaf), "blocks"))

    def mine(name: str, blocks_of: str) -> F.Column:
        return F.pmod(F.xxhash64(name), F.col(blocks_of)).cast("int")

    def every_one(blocks_of: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks_of) - 1))

    left = placed.join(blocks, leaf).withColumn("rb", mine("rep", "row_blocks")).withColumn("qb", every_one("query_blocks"))
    right = routed.join(blocks, leaf).withColumn("qb", mine("query_id", "query_blocks"))
    right = right.withColumn("rb", every_one("row_blocks"))
    pair = [*leaf, "rb", "qb"]

    def compare(here: pa.Table, asking: pa.Table) -> pa.Table:
        columns: tuple[list, list, list] = ([], [], [])
        if here.num_rows and asking.num_rows:
            vectors = matrix(here.column("vec").combine_chunks())
            reps = here.column("rep").to_numpy()
            ids, points = asking.column("query_id").to_numpy(), matrix(asking.column("vec").combine_chunks())
            step = max(1, 4_000_000 // vectors.size)
            for begin in range(0, len(ids), step):
                apart = points[begin : begin + step, None, :] - vectors[None]
                far = np.sqrt(np.einsum("qij,qij->qi", apart, apart))
                for query, row in zip(ids[begin : begin + step], far):
                    best = np.lexsort((reps, row))[: k + 1]
                    columns[0].append(np.full(len(best), query)), columns[1].append(reps[best]), columns[2].append(row[best])
        kinds = (np.int64, np.int64, np.float64)
        arrays = [np.concatenate(c) if c else np.empty(0, kind) for c, kind in zip(columns, kinds)]
        return pa.table({"query_id": arrays[0], "rep": arrays[1], "score": arrays[2]})

    grouped = left.select(*pair, "rep", "vec").groupBy(*pair).cogroup(right.select(*pair, "query_id", "vec").groupBy(*pair))
    found = grouped.applyInArrow(compare, "query_id long, rep long, score double").distinct()
    best = found.withColumn(
        "_r", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "rep"))
    ).filter(F.col("_r") <= k + 1)
    each = best.join(same.select("rep", "ids"), "rep").select("query_id", F.explode("ids").alias("vec_id"), "score")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    final = each.filter(F.col("vec_id") != F.col("query_id")).withColumn("rank", F.row_number().over(order))
    return final.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

