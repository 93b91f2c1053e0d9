"""Quality by ordinal regression: one weight for each hashed word, ordered thresholds between the grades."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.arrow import pieces, utf8

SIGNS = ".,!?;:|\"'()[]{}"
SHAPES = 6
#: Letters of a word's beginning, which inflected forms share.
STEM = 4


def shapes(text: bytes, words: int, distinct: int) -> list[float]:
    """Length, share of capitals, digits and signs, share of repeated words, mean length of a word."""
    byte = np.frombuffer(text, np.uint8)
    n = max(1, len(byte))
    capital = ((byte >= 65) & (byte <= 90)).sum()
    digit = ((byte >= 48) & (byte <= 57)).sum()
    sign = (byte > 32).sum() - capital - digit - ((byte >= 97) & (byte <= 122)).sum() - (byte >= 128).sum()
    return [np.log1p(len(byte)), capital / n, digit / n, sign / n, 1 - distinct / max(1, words), n / max(1, words)]


def features(texts: pa.LargeStringArray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct buckets of words and of their beginnings, where they begin, and its shape numbers."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    words = pc.ascii_trim(coded.dictionary, SIGNS).to_pylist()
    hashed = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)) % buckets
    stems = np.fromiter((zlib.crc32(w[:STEM].encode(), 1) for w in words), np.int64, len(words)) % buckets
    bounds = split.offsets.to_numpy(zero_copy_only=False)
    counts = np.diff(bounds)
    row = np.repeat(np.arange(len(texts)), counts)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    keys = np.unique(np.concatenate((row * buckets + hashed[codes], row * buckets + stems[codes])))
    starts = np.searchsorted(keys, np.arange(len(texts) + 1) * buckets)
    raw = texts.cast(pa.large_binary()).to_pylist()
    dense = np.array([shapes(t, w, d) for t, w, d in zip(raw, counts, np.diff(starts))]).reshape(-1, SHAPES)
    return keys % buckets, starts, dense


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Ordinal:
    """P(grade > j) is the logistic of score less threshold j; all thresholds share the score."""

    words: np.ndarray
    shape: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    thresholds: np.ndarray

    def tails(self, ids: np.ndarray, starts: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """For each text the probabilities of a grade above 0, above 1, and so on; they fall from left to right."""
        score = _sums(self.words[ids], starts) + (dense - self.mean) / self.spread @ self.shape
        return _logistic(score[:, None] - self.thresholds[None])


def fit(
    ids: np.ndarray, starts: np.ndarray, dense: np.ndarray, grades: np.ndarray, top: int, buckets: int,
    rare: float = 0.001, rounds: int = 400, rate: float = 0.05, ridge: float = 0.02,
) -> Ordinal:
    """Maximum likelihood with a ridge on the word weights, by full-batch Adam; grades are 0 … ``top``.

    Buckets in less than the share ``rare`` of the texts weigh nothing: their weights would only fit the sample.
    The first threshold is free and the others lie above it by exponentials, so they stay in order.
    """
    n = max(1, len(grades))
    mean, spread = dense.mean(axis=0), dense.std(axis=0)
    spread[spread == 0] = 1
    scaled = (dense - mean) / spread
    known = np.bincount(ids, minlength=buckets) >= max(2, rare * n)
    row = np.repeat(np.arange(len(grades)), np.diff(starts))[known[ids]]
    ids = ids[known[ids]]
    starts = np.searchsorted(row, np.arange(len(grades) + 1))
    value = np.zeros(buckets + SHAPES + top)
    value[buckets + SHAPES :] = [-1.0, *[0.0] * (top - 1)]
    first, second = np.zeros_like(value), np.zeros_like(value)
    above = grades[:, None] > np.arange(top)[None]  # grade > j
    for step in range(1, rounds + 1):
        w, s, t = np.split(value, [buckets, buckets + SHAPES])
        theta = np.cumsum(np.concatenate((t[:1], np.exp(t[1:]))))
        score = _sums(w[ids], starts) + scaled @ s
        tail = _logistic(score[:, None] - theta[None])
        # P(grade) is a difference of neighbouring tails; 1 before the first, 0 behind the last.
        full = np.concatenate((np.ones((len(grades), 1)), tail, np.zeros((len(grades), 1))), axis=1)
        at = np.arange(len(grades))
        chance = np.maximum(full[at, grades] - full[at, grades + 1], 1e-12)
        slope = tail * (1 - tail)
        # Each tail raises the chance of a grade just above its threshold and lowers that of the one just below.
        sign = np.where(grades[:, None] == np.arange(top)[None] + 1, 1.0, 0.0) - np.where(grades[:, None] == np.arange(top)[None], 1.0, 0.0)
        pull = sign * slope / chance[:, None]
        by_score = pull.sum(axis=1)
        by_theta = -pull.sum(axis=0)
        by_t = np.concatenate((by_theta.sum(keepdims=True), np.cumsum(by_theta[::-1])[::-1][1:] * np.exp(t[1:])))
        gradient = np.concatenate((np.bincount(ids, by_score[row], buckets), scaled.T @ by_score, by_t)) / n
        gradient[:buckets] -= ridge * w / np.sqrt(n)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        value += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    w, s, t = np.split(value, [buckets, buckets + SHAPES])
    return Ordinal(w, s, mean, spread, np.cumsum(np.concatenate((t[:1], np.exp(t[1:])))))


def graded(labels: DataFrame) -> DataFrame:
    """Grades from ratings: 0 toxic, 1 poor, 2 good. A null rating is left out; of several for one id the lowest counts."""
    grade = F.when(F.col("toxic") == 1, 0).when((F.col("toxic") == 0) & F.col("quality").isin(0, 1), F.col("quality") + 1)
    rated = labels.select("doc_id", grade.cast("int").alias("grade")).filter("doc_id is not null and grade is not null")
    return rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample: int = 12_000, buckets: int = 1 << 18, top: int = 2) -> Ordinal:
    """Fits on ``sample`` rated documents, those with the smallest hash of their id.

    The sample bounds what reaches the driver: word buckets, not texts. The words are counted where the texts lie. Of
    rows that repeat a drawn id the one with the smallest text hash counts.
    """
    # Neither the ids drawn nor their number grow with the table.
    drawn = graded(labels).join(docs.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    every = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    # The partial aggregation leaves one row of an id per task before anything moves.
    rows = every.groupBy("doc_id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                ids, starts, dense = features(utf8(part.column("text")), buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("grade"),
                        pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32())),
                        pa.array(dense.tolist(), pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "grade", "ids", "dense"],
                )

    found = rows.mapInArrow(run, "doc_id long, grade int, ids array<int>, dense array<double>").toArrow()
    if not found.num_rows:
        return Ordinal(np.zeros(buckets), np.zeros(SHAPES), np.zeros(SHAPES), np.ones(SHAPES), np.full(top, -np.log(3)))
    found = found.sort_by([("doc_id", "ascending")]).combine_chunks()
    lists = found.column("ids").combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    starts = np.concatenate(([0], np.cumsum(sizes)))
    dense = np.array(found.column("dense").to_pylist()).reshape(-1, SHAPES)
    grades = found.column("grade").to_numpy()
    return fit(lists.flatten().to_numpy().astype(np.int64), starts, dense, grades, top, buckets)


def grade_documents(docs: DataFrame, model: Ordinal, least: int = 2, certainty: float = 0.5) -> DataFrame:
    """Adds ``expected_grade``, ``p_tail`` (of grade ``least`` or better) and ``accepted`` (``p_tail >= certainty``).

    Null and empty texts are graded by their shape alone. Columns of the documents with these names are replaced; no
    row moves between tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["expected_grade", "p_tail", "accepted"]
    frame = docs.select(*[c for c in docs.columns if c not in names])
    schema = StructType(list(frame.schema.fields)).add("expected_grade", "double").add("p_tail", "double").add("accepted", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                tails = shared.value.tails(*features(utf8(part.column("text")), len(shared.value.words)))
                kept = tails[:, least - 1]
                new = [pa.array(tails.sum(axis=1)), pa.array(kept), pa.array(kept >= certainty)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=schema.names)

    return frame.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, expected_grade, p_tail, accepted."""
    return grade_documents(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, labels)).drop("text")


def keep_accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the classifier accepts, their columns as they were."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                tails = shared.value.tails(*features(utf8(part.column("text")), len(shared.value.words)))
                yield part.filter(pa.array(tails[:, -1] >= 0.5))

    return docs.mapInArrow(run, docs.schema)
