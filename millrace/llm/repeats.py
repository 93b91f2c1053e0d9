"""Removes repeated passages: suffixes at sampled places, sorted deep and shallow, tell which strings start earlier too."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import raw
from millrace.llm.common import numbered, unfolded, written
from millrace.llm.suffixes import LENGTH, anchors, repeated
from millrace.session import scratch_path

#: Bytes looked at in one go, so that the numbers made of them stay in the cache.
STRETCH = 1 << 18
#: An anchor gram found so often in one batch is common for sure.
OFTEN = 64
#: Places of one gram up to which they are compared in one task.
CROWD = 50_000
#: Crowded grams that are sent to all tasks at most, and over how many tasks a gram's anchors are dealt beyond that.
SENT, SALTS = 1_000_000, 64
#: Contexts sorted together.
TOGETHER = 100_000
TEXT_BYTES = 64 << 20
NO_ID = -(2**63)

FACTS = ["h1", "h2", "n_bytes"]


def _rows(docs: DataFrame) -> DataFrame:
    """Each document's order (``dkey``), text, and what tells its text from others."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    return docs.select(
        doc.alias("doc_id"),
        F.coalesce(doc, F.lit(NO_ID)).alias("dkey"),
        F.xxhash64(text).alias("h1"),
        F.hash(text).alias("h2"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct text of 100 bytes or more: its first document, and how many rows (``copies``) are equal to that.

    ``twin``, the first hash of the text, tells texts of one doc_id apart and orders them.
    """
    counted = rows.filter(F.col("n_bytes") >= LENGTH).groupBy("dkey", *FACTS).agg(F.count("*").alias("copies"))
    first = counted.groupBy(*FACTS).agg(F.min(F.struct("dkey", "copies")).alias("_least")).select(*FACTS, "_least.*")
    return written(first.withColumn("twin", F.col("h1")), "texts-seen")


def _texts(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The first document of each distinct text, in a table bucketed by ``dkey`` and ``twin``: it is shuffled this once only."""
    spark = rows.sparkSession
    total, copies = classes.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.max("copies")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TEXT_BYTES))
    long = rows.filter(F.col("n_bytes") >= LENGTH).select("dkey", "h1", "h2", "text")
    if copies and copies > 1:
        long = long.dropDuplicates(["dkey", "h1", "h2"])
    keys = ["dkey", "twin"]
    left = long.select("dkey", F.col("h1").alias("twin"), "h2", "text").repartition(parts, *keys)
    right = classes.select(*keys, F.col("h2").alias("c2")).repartition(parts, *keys)
    # The second hash is compared after the join, so that rows lie by dkey and twin alone.
    same = F.col("h2").between(F.col("c2"), F.col("c2"))
    firsts = left.join(right.hint("shuffle_hash"), keys).filter(same).select("dkey", "twin", "text")
    name = f"millrace_texts_{uuid.uuid4().hex}"
    writer = firsts.write.format("parquet").bucketBy(parts, "dkey", "twin").option("compression", "zstd")
    writer.option("path", scratch_path(spark, "texts")).saveAsTable(name)
    return spark.table(name)


def _anchor_rows(batches: Iterator[pa.RecordBatch], common: int) -> Iterator[pa.RecordBatch]:
    """Anchors of the texts. Common grams go by the document, but for two rows that still tell the others."""
    for batch in batches:
        found: list[list[np.ndarray]] = [[], [], [], [], []]
        texts = raw(batch.column("text"))
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end]) <= STRETCH):
                size += len(texts[end])
                end += 1
            ends = np.cumsum([len(t) for t in texts[begin:end]])
            at, gram, low, high = anchors(np.frombuffer(b"".join(texts[begin:end]), np.uint8), ends)
            text = np.searchsorted(ends, at, "right")
            at = at - np.concatenate(([0], ends))[text]
            for column, value in zip(found, (text + begin, at, gram, low, high)):
                column.append(value)
            begin = end
        if not found[0]:
            continue
        text, at, gram, low, high = (np.concatenate(c) for c in found)
        by_gram = np.argsort(gram, kind="stable")
        new = np.flatnonzero(np.concatenate(([True], np.diff(gram[by_gram]) != 0))) if len(gram) else by_gram
        sizes = np.diff(np.append(new, len(gram)))
        nth = np.empty(len(gram), np.int64)
        nth[by_gram] = np.arange(len(gram)) - np.repeat(new, sizes)
        often = np.empty(len(gram), bool)
        often[by_gram] = np.repeat(sizes > common, sizes)
        dkey = batch.column("dkey").to_numpy()[text]
        twin = batch.column("twin").to_numpy()[text]
        key = np.where(often & (nth > 1), (dkey ^ twin) * 0x2545F491 + at, gram)
        columns = [key, gram, dkey, twin, (at << 16) | (low << 8) | high, often]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "gram", "dkey", "twin", "place", "often"])


def _shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by gram, those whose gram stands in a row beside them too."""
    names = ["gram", "dkey", "twin", "place"]
    held: pa.RecordBatch | None = None
    before = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        gram = batch.column("gram").to_numpy()
        same = gram[1:] == gram[:-1]
        keep = np.zeros(len(gram), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= before is not None and before == gram[0]
        keep |= batch.column("often").to_numpy(zero_copy_only=False)
        # The last row waits for the next batch.
        if len(gram) > 1:
            before = gram[-2]
        yield batch.slice(0, len(gram) - 1).filter(pa.array(keep[:-1])).select(names)
        held, last = batch.slice(len(gram) - 1), keep[-1]
    if held is not None and last:
        yield held.select(names)


CONTEXT = "key long, low int, high int, context binary, dkey long, twin long, place long"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies around shared anchors, and spans (without a context) that an earlier place of the batch has too.

    A context reaches over all strings that have the anchor. Around a crowded gram each string is a context of its
    own, by its own hash, so that places which agree in some strings only don't meet all in one task.
    """
    for batch in batches:
        kept: dict[tuple, tuple] = {}
        spans: list[tuple] = []

        def put(key: tuple, place: tuple) -> None:
            first = kept.setdefault(key, place)
            if first != place:
                if place < first:
                    kept[key], first, place = place, place, first
                begin = place[2] - key[2]
                spans.append((place[0], place[1], begin, begin + len(key[3])))

        columns = [batch.column(c).to_pylist() for c in ("dkey", "twin", "marks")]
        for dkey, twin, marks, text in zip(*columns, raw(batch.column("text"))):
            for mark in marks:
                at, low, high = mark["place"] >> 16, (mark["place"] >> 8) & 255, mark["place"] & 255
                if not mark["crowded"]:
                    put((mark["gram"], low, high, text[at - high : at - low + LENGTH]), (dkey, twin, at))
                    continue
                for begin in range(at - high, at - low + 1):
                    string = text[begin : begin + LENGTH]
                    name = xxhash.xxh3_64_intdigest(string) - 2**63
                    put((name, 0, 0, string), (dkey, twin, begin))
        keys, places = list(kept), list(kept.values())
        spans = joined_up(spans)
        n = len(spans)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys] + [((s[0] ^ s[1]) * 31 + s[2]) & (2**62 - 1) for s in spans], pa.int64()),
                pa.array([k[1] for k in keys] + [0] * n, pa.int32()),
                pa.array([k[2] for k in keys] + [s[3] - s[2] for s in spans], pa.int32()),
                pa.array([k[3] for k in keys] + [None] * n, pa.binary()),
                pa.array([p[0] for p in places] + [s[0] for s in spans], pa.int64()),
                pa.array([p[1] for p in places] + [s[1] for s in spans], pa.int64()),
                pa.array([p[2] for p in places] + [s[2] for s in spans], pa.int64()),
            ],
            names=["key", "low", "high", "context", "dkey", "twin", "place"],
        )


def joined_up(spans: list[tuple]) -> list[tuple]:
    """Spans (dkey, twin, start, end) with those of a text that overlap or touch put together."""
    out: list[tuple] = []
    for dkey, twin, start, end in sorted(spans):
        if out and out[-1][:2] == (dkey, twin) and start <= out[-1][3]:
            out[-1] = (dkey, twin, out[-1][2], max(end, out[-1][3]))
        else:
            out.append((dkey, twin, start, end))
    return out


def _side(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, step: int) -> np.ndarray:
    """Rows of bytes from ``first`` on, forwards or backwards, zeros behind their sizes."""
    reach = np.arange(LENGTH + 4)
    inside = reach[None] < sizes[:, None]
    return np.where(inside, flat[np.where(inside, first[:, None] + step * reach[None], 0)], np.uint8(0))


def _resolve(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Spans of whole groups of contexts, sorted by group, extent, bytes and place."""
    key, low, high = (table.column(c).to_numpy().astype(np.int64) for c in ("key", "low", "high"))
    dkey, twin, place = (table.column(c).to_numpy().astype(np.int64) for c in ("dkey", "twin", "place"))
    context = table.column("context").combine_chunks()
    code = context.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    fresh = np.ones(len(key), bool)
    for column in (key, low, high, code):
        fresh[1:] &= column[1:] == column[:-1]
    fresh[1:] = ~fresh[1:]
    of = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    # Equal contexts: all but the first place are repeats from end to end.
    again = np.flatnonzero(~fresh & ((dkey != dkey[of]) | (twin != twin[of]) | (place != place[of])))
    out = [(dkey[again], twin[again], place[again] - high[again], place[again] - low[again] + LENGTH)]
    one = np.flatnonzero(fresh)
    group = np.cumsum(np.concatenate(([0], np.diff(key[one]) != 0)))
    one = one[np.bincount(group)[group] > 1]
    if len(one):
        flat = np.frombuffer(context.buffers()[2], np.uint8)
        begin = np.frombuffer(context.buffers()[1], np.int32)[context.offset : context.offset + len(context)].astype(np.int64)
        anchor = begin[one] + high[one]
        left = _side(flat, anchor - 1, high[one], -1)
        right = _side(flat, anchor, LENGTH - low[one], 1)
        rank = np.empty(len(one), np.int64)
        rank[np.lexsort((place[one], twin[one], dkey[one]))] = np.arange(len(one))
        group = np.cumsum(np.concatenate(([0], np.diff(key[one]) != 0)))
        who, distance = repeated(group, left, right, low[one], high[one], rank)
        by_who = np.lexsort((-distance, who))
        who, distance = one[who[by_who]], distance[by_who]
        # Neighbouring strings of a context are one span.
        start = np.flatnonzero(np.concatenate(([True], (np.diff(who) != 0) | (np.diff(distance) != -1)))) if len(who) else who
        last = np.append(start[1:], len(who))[: len(start)] - 1
        at = who[start]
        out.append((dkey[at], twin[at], place[at] - distance[start], place[at] - distance[last] + LENGTH))
    columns = [np.concatenate(c) for c in zip(*out)]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["dkey", "twin", "start", "end"])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes known spans on and resolves contexts, as many whole groups at a time as make ``TOGETHER`` rows."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        known = batch.filter(batch.column("context").is_null())
        if known.num_rows:
            end = pa.array(known.column("place").to_numpy() + known.column("high").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [known.column("dkey"), known.column("twin"), known.column("place"), end], names=["dkey", "twin", "start", "end"]
            )
        batch = batch.filter(batch.column("context").is_valid())
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= TOGETHER:
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from _resolve(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                rows = table.num_rows - cut
    if held:
        yield from _resolve(pa.Table.from_batches(held))


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes are covered, and in how many maximal runs."""
    kept, runs, here, last = [], 0, 0, -1
    for begin, end in sorted(spans):
        if begin > last:
            runs += 1
            kept.append(text[here:begin])
        here = last = max(last, end)
    kept.append(text[here:])
    left = b"".join(kept)
    return left, len(text) - len(left), runs


def _marked(shared: DataFrame, crowd: int) -> DataFrame:
    """The anchors with ``crowded``: whether their gram has more than ``crowd`` of them.

    There is at most one crowded gram for every ``crowd`` anchors. They are counted, and up to ``SENT`` of them (16 MB)
    go to all tasks; more meet the anchors in a join over which a gram's anchors are dealt by a salt.
    """
    counts = shared.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > crowd)
    crowded = written(counts.select("gram", F.lit(True).alias("crowded")), "crowded")
    if crowded.count() <= SENT:
        joined = shared.join(F.broadcast(crowded), "gram", "left")
    else:
        dealt = crowded.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = shared.withColumn("salt", F.pmod(F.xxhash64("dkey", "twin", "place"), F.lit(SALTS)).cast("int"))
        joined = salted.join(dealt, ["gram", "salt"], "left").drop("salt")
    return joined.withColumn("crowded", F.coalesce("crowded", F.lit(False)))


def _removed(rows: DataFrame, classes: DataFrame, keep_text: bool, crowd: int, often: int) -> DataFrame:
    """For each distinct text of 100 bytes or more what its first document loses."""
    texts = _texts(rows, classes)
    found = texts.mapInArrow(partial(_anchor_rows, common=often), "key long, gram long, dkey long, twin long, place long, often boolean")
    shared = found.repartition("key").sortWithinPartitions("gram").mapInArrow(
        _shared_only, "gram long, dkey long, twin long, place long"
    )
    shared = written(shared, "anchors")
    marked = _marked(shared, crowd)
    keys = ["dkey", "twin"]
    marks = marked.groupBy(*keys).agg(F.collect_list(F.struct("place", "gram", "crowded")).alias("marks"))
    contexts = texts.join(marks.hint("shuffle_hash"), keys).select("dkey", "twin", "marks", "text")
    contexts = contexts.mapInArrow(_contexts, CONTEXT).repartition("key")
    order = ["key", "low", "high", "context", "dkey", "twin", "place"]
    spans = contexts.sortWithinPartitions(*order).mapInArrow(_spans, "dkey long, twin long, start long, end long")
    of = spans.groupBy(*keys).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    whole = texts.join(of.hint("shuffle_hash"), keys, "left").select("dkey", "twin", "spans", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [])
            for cuts, text in zip(batch.column("spans").to_pylist(), raw(batch.column("text"))):
                left, n, runs = cut_out(text, [(c["start"], c["end"]) for c in cuts or ()])
                values = (n, runs, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if keep_text else None)
                for column, value in zip(columns, values):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("dkey"), batch.column("twin"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["dkey", "twin", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    kind = "dkey long, twin long, n_removed long, n_spans long, kept_sha256 string, kept string"
    return whole.mapInArrow(run, kind)


def removed_bytes(docs: DataFrame, crowd: int = CROWD, often: int = OFTEN) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes, a null one is empty. A byte goes if a string of 100 bytes around it also starts earlier:
    in a document with a smaller doc_id (null before all; rows of one doc_id in the order of their texts' hashes,
    equal rows in any order) or earlier in the same one. Strings are judged on the input and never cross documents.

    A text that an earlier document has goes as a whole, so only the first of a group of copies is looked into.
    There each string of 100 bytes has an anchor, its smallest gram of 24 bytes; anchors whose gram stands alone are
    dropped. Around the others the sides of the anchors are sorted as suffixes (:mod:`millrace.llm.suffixes`). Grams
    with more than ``crowd`` places are dealt by the strings around them, so no task gets more of one gram; a gram seen
    more than ``often`` times in one batch is known to be shared and leaves all but two of its rows out of its group.
    """
    rows = _rows(docs)
    classes = _classes(rows)
    result = _removed(rows, classes, False, crowd, often).groupBy("dkey", "twin").agg(
        *(F.first(c).alias(c) for c in ("n_removed", "n_spans", "kept_sha256"))
    )
    known = classes.join(result, ["dkey", "twin"]).withColumnRenamed("dkey", "first").drop("twin", "copies")
    short = F.when(F.col("n_bytes") < LENGTH, F.sha2(F.col("text").cast("binary"), 256)).alias("short_sha256")
    counted = rows.select("doc_id", "dkey", *FACTS, short).groupBy("doc_id", "dkey", *FACTS, "short_sha256").agg(
        F.count("*").alias("_n")
    )
    each = unfolded(counted.withColumn("_zero", F.lit(0).cast("long")), "copy", "_zero").join(known, FACTS, "left")
    whole, own = F.col("first").isNull(), (F.col("dkey") == F.col("first")) & (F.col("copy") == 0)

    def choose(small, mine, gone):
        return F.when(whole, small).when(own, mine).otherwise(gone)

    return each.select(
        "doc_id",
        "n_bytes",
        choose(F.lit(0).cast("long"), F.col("n_removed"), F.col("n_bytes")).alias("n_removed"),
        choose(F.lit(0).cast("long"), F.col("n_spans"), F.lit(1).cast("long")).alias("n_spans"),
        choose(F.col("short_sha256"), F.col("kept_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, crowd: int = CROWD, often: int = OFTEN) -> DataFrame:
    """The documents without the bytes :func:`removed_bytes` counts; ``text`` and ``n_chars`` (if there) change.

    Every row stays, one whose text an earlier document has with an empty text. What is left of a character cut in
    two goes too. Of rows that repeat doc_id and text (100 bytes or more) one keeps its text; null texts stay null.
    """
    rows = _rows(docs)
    classes = _classes(rows)
    kept = _removed(rows, classes, True, crowd, often).groupBy("dkey", "twin").agg(F.first("kept").alias("kept"))
    firsts = classes.join(kept, ["dkey", "twin"]).select(
        *[F.col(c).alias(f"_f_{c}") for c in ("dkey", *FACTS)], F.col("kept").alias("_left")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    facts = {
        "_dkey": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
        "_h1": F.xxhash64(text),
        "_h2": F.hash(text),
        "_bytes": F.octet_length(text).cast("long"),
    }
    known = docs.withColumns(facts).withColumn("text", F.when(F.col("_bytes") < LENGTH, F.col("text")))
    copy = F.lit(0).cast("long")
    if not classes.filter("copies > 1").isEmpty():
        # Which of equal rows keeps its text is told by their numbers.
        long = numbered(known.filter(F.col("_bytes") >= LENGTH), list(facts), "_copy")
        known = known.filter(F.col("_bytes") < LENGTH).withColumn("_copy", copy).unionByName(long)
        copy = F.col("_copy")
    match = [known[a] == firsts[b] for a, b in zip(facts, ("_f_dkey", "_f_h1", "_f_h2", "_f_n_bytes"))]
    both = known.join(firsts, match, "left")
    new = F.when(F.col("_bytes") < LENGTH, F.col("text")).otherwise(F.coalesce(F.when(copy == 0, F.col("_left")), F.lit("")))
    changed = both.withColumn("text", new)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)
