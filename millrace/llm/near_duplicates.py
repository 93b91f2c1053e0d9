"""Near-duplicates: circulant MinHash, banding, and exact Jaccard on the full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import pieces, utf8
from millrace.llm.common import null_safe, written
from millrace.llm.graph import components

WORDS = 5
BANDS, ROWS = 32, 4
#: Places of the circle that both permutations arrange.
CIRCLE = 1 << 20
#: Shingles one task compares at a time.
BLOCK = 4_000_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.LargeStringArray) -> list[np.ndarray]:
    """Each text's sorted distinct 64-bit shingle hashes: five words, or all words of a shorter text; none without."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) if w else 0 for w in words), np.uint64, len(words))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    bounds = split.offsets.to_numpy(zero_copy_only=False)
    empty = words.index("") if "" in words else -1
    out = []
    for a, b in zip(bounds, bounds[1:]):
        of = codes[a:b]
        if empty >= 0:
            of = of[of != empty]
        word = hashes[of]
        width = min(WORDS, len(word))
        if not width:
            out.append(np.empty(0, np.uint64))
            continue
        sums = np.full(len(word) - width + 1, width, np.uint64)
        for j in range(width):
            sums = sums * FACTOR + word[j : j + len(sums)]
        out.append(np.unique(mixed(sums)))
    return out


@lru_cache(maxsize=1)
def circle() -> np.ndarray:
    """Row i holds the second permutation at i, i + 1, … around the circle: the values of all its shifts for place i."""
    order = np.random.default_rng(20).permutation(CIRCLE).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate((order, order[: BANDS * ROWS])), BANDS * ROWS)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each shift over the set.

    The first permutation puts a shingle at a place of the circle: its hash is a scrambled number already. Every
    coordinate is the second permutation, shifted once more.
    """
    places = (shingles >> np.uint64(40)).astype(np.int64) & (CIRCLE - 1)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for begin in range(0, len(places), 4096):
        np.minimum(least, circle()[places[begin : begin + 4096]].min(axis=0), out=least)
    return least


def bands(shingles: np.ndarray) -> np.ndarray:
    """One hash for each band of the signature, with the band's number in it."""
    rows = signature(shingles).reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mixed(key * FACTOR + rows[:, j])
    return key.view(np.int64)


def set_id(shingles: np.ndarray) -> int | None:
    """A signed number that equal sets share; none for the empty set."""
    if not len(shingles):
        return None
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def features(docs: DataFrame, facts: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, n_shingles, ``class`` (equal sets share it), the band hashes, and whole numbers ``facts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = shingle_sets(utf8(part.column("text")))
                columns = [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id(s) for s in sets], pa.int64()),
                    pa.array([bands(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ]
                columns += [part.column(f) for f in facts]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "class", "bands", *facts])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *facts)
    kinds = "doc_id long, n_shingles long, class long, bands array<long>"
    return rows.mapInArrow(run, ", ".join([kinds, *(f"{f} long" for f in facts)]))


def links(sets: list[np.ndarray], share: int = 75) -> np.ndarray:
    """For each set the first set of its group, when sets with ``100 * both >= share * either`` are linked.

    A set whose own shingles, which no other set has, are too many for any link is left alone at once. Then sets are
    taken as pivots and compared with all sets that were no pivot yet, in other groups; when the sets left are one
    group, no further comparison can change it. So every link between groups is found without listing pairs.
    """
    count = len(sets)
    parent = np.arange(count)
    sizes = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(count), sizes)
    token = np.unique(np.concatenate(sets), return_inverse=True)[1] if count else np.empty(0, np.int64)
    left = np.ones(count, bool)
    while True:
        common = np.bincount(token)[token] > 1 if len(token) else np.empty(0, bool)
        shared = np.bincount(row[common], minlength=count)
        lonely = left & (100 * shared < share * sizes)
        if not lonely.any():
            break
        left &= ~lonely
        token, row = token[~lonely[row]], row[~lonely[row]]
    mark = np.zeros(int(token.max()) + 1 if len(token) else 0, bool)
    while True:
        open_rows = np.flatnonzero(left)
        groups, sizes_of = np.unique(parent[open_rows], return_counts=True)
        if len(groups) < 2:
            return parent
        group = groups[sizes_of.argmin()]
        pivot = open_rows[parent[open_rows] == group][0]
        own = token[row == pivot]
        mark[own] = True
        both = np.bincount(row[mark[token]], minlength=count)
        mark[own] = False
        found = left & (100 * both >= share * (sizes + sizes[pivot] - both)) & (parent != group)
        merged = np.append(np.unique(parent[found]), group)
        parent[np.isin(parent, merged)] = merged.min()
        left[pivot] = False
        if row.size > 4096 and left[row].sum() < row.size // 2:
            token, row = token[left[row]], row[left[row]]


def _by_block(rows: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[int], list[np.ndarray]]]:
    """The sets of one block after another, from rows sorted by block and class; a repeated class counts once."""
    now, ids, sets = None, [], []
    for batch in rows:
        columns = [batch.column(k).to_pylist() for k in keys]
        flat, bounds = batch.column("shingles").flatten().to_numpy().view(np.uint64), batch.column("shingles").offsets.to_numpy()
        bounds = bounds - bounds[0]
        for i, (key, name) in enumerate(zip(zip(*columns), batch.column("class").to_pylist())):
            if key != now:
                if now is not None:
                    yield now, ids, sets
                now, ids, sets = key, [], []
            if not ids or ids[-1] != name:
                ids.append(name)
                sets.append(flat[bounds[i] : bounds[i + 1]].copy())
    if now is not None:
        yield now, ids, sets


def linked_classes(docs: DataFrame, found: DataFrame, share: int = 75, block: int = BLOCK) -> DataFrame:
    """Classes of equal sets (``node``) with the smallest class linked to them (``label``); the unlinked are left out."""
    one = found.filter("class is not null")
    reps = written(
        one.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")),
        "classes",
    )
    keys = reps.select("class", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("class").alias("pivot"), F.max("class").alias("most")).filter("pivot < most")
    stars = keys.join(buckets, "key").filter("class <> pivot").select(F.col("pivot").alias("a"), F.col("class").alias("b"))
    # Every link lies within one of these components: its ends share a bucket, and both are tied to its pivot.
    near = components(stars.distinct()).withColumnRenamed("node", "class").withColumnRenamed("label", "around")
    members = near.join(reps.drop("bands"), "class")
    # A component of more shingles than a block is dealt into parts; every two parts meet in a task.
    parts = members.groupBy("around").agg((F.floor(F.sum("n_shingles") * 2 / block) + 1).cast("int").alias("parts"))
    dealt = members.join(parts, "around").withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), "text")
    wanted = texts.join(dealt, null_safe(texts, dealt, [("_doc", "doc_id")])).select("class", "around", "part", "parts", "text")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = shingle_sets(utf8(piece.column("text")))
                # Another text of the same doc_id is not the one wanted.
                same = pa.array([set_id(s) == c for s, c in zip(sets, piece.column("class").to_pylist())], pa.bool_())
                arrays = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                columns = [piece.column(c) for c in ("class", "around", "part", "parts")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, arrays], names=["class", "around", "part", "parts", "shingles"]
                ).filter(same)

    sets = wanted.mapInArrow(to_sets, "class long, around long, part int, parts int, shingles array<long>")
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.array_except(F.sequence(F.lit(0), F.col("parts") - 1), F.array("part"))
    )
    met = sets.withColumn("other", F.explode(others)).select(
        "around", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "class", "shingles"
    )
    pair = ["around", "p", "q"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, of in _by_block(batches, pair):
            first = links(of, share)
            tied = np.flatnonzero(first != np.arange(len(first)))
            names = np.array(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names[first[tied]]), pa.array(names[tied])], names=["a", "b"])

    edges = met.repartition(*pair).sortWithinPartitions(*pair, "class").mapInArrow(compare, "a long, b long")
    return components(edges)


def near_duplicates(docs: DataFrame, share: int = 75, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when ``100 * intersection >= share * union`` of their shingle sets (see
    :func:`shingle_sets`); ``component_id`` is the smallest doc_id reachable over links, ``kept`` says it is the own.
    Candidates share a band of the circulant signature (32 bands of 4: a pair at exactly 0.75 is missed once in
    180,000), and are confirmed on the full sets. Equal sets are one class, so a group of copies costs one set.

    A null text, or one without words, has no shingles and is linked with nothing, not even its equal. Rows that
    repeat a doc_id are documents of their own with that id. A null doc_id is never a component's smallest unless it
    is alone.
    """
    found = written(features(docs), "features")
    labels = linked_classes(docs, found, share, block)
    classes = found.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    named = classes.join(labels, classes["class"] == labels["node"], "left").select(
        "class", "least", F.coalesce("label", "class").alias("label")
    )
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of = named.join(least, "label").select("class", "component_id")
    whole = found.drop("bands").join(of, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return whole.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component, that with the smallest doc_id; all columns as they were.

    Rows that share a doc_id are told apart by their texts: of several in a component the one with the smallest class,
    then text hash stays; of rows equal in doc_id and text one. A null doc_id comes last. Texts without words all stay.
    Columns of rows that repeat doc_id and text must not be maps.
    """
    facts = {"_h1": F.xxhash64(F.coalesce("text", F.lit(""))), "_h2": F.hash(F.coalesce("text", F.lit(""))).cast("long")}
    told = docs.withColumns(facts)
    found = written(features(told, list(facts)), "features")
    labels = linked_classes(docs, found)
    counted = found.groupBy("class", "doc_id", *facts).agg(F.count("*").alias("_n"))
    leader = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "class", *facts, "_n")
    classes = counted.filter("class is not null").groupBy("class").agg(F.min(leader).alias("_least"))
    named = classes.join(labels, classes["class"] == labels["node"], "left").select(F.coalesce("label", "class").alias("label"), "_least")
    leaders = named.groupBy("label").agg(F.min("_least").alias("_least")).select("_least.*")
    columns = [F.col("doc_id").alias("_doc"), *[F.col(f).alias(f"_k{f}") for f in facts]]
    wordless = counted.filter("class is null").select(*columns, F.lit(1).cast("long").alias("_n"))
    kept = written(leaders.select(*columns, "_n").unionByName(wordless), "kept")
    one, rows = kept.filter("_n = 1"), told.withColumn("_doc_id", F.col("doc_id").cast("long"))
    pairs = [("_doc_id", "_doc"), *((f, f"_k{f}") for f in facts)]
    left = rows.join(one, null_safe(rows, one, pairs), "left_semi").select(*docs.columns)
    many = kept.filter("_n > 1")
    if many.isEmpty():
        return left
    copies = rows.join(many, null_safe(rows, many, pairs), "left_semi")
    whole = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_row")
    return left.unionByName(copies.groupBy("_doc_id", *facts).agg(whole).select("_row.*"))
