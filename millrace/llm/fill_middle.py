"""Fill-in-middle documents: sentinels go into the text in place, and block rotations exchange its segments."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.llm.arrow import pieces, raw

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

PLAIN, PSM, SPM = "plain", "psm", "spm"

ROWS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def rotate(data: bytearray, begin: int, middle: int, end: int) -> None:
    """Exchanges the blocks [begin, middle) and [middle, end) in place: each is reversed, then both together.

    The way back is the rotation at the place where the blocks then meet, ``begin + end - middle``.
    """
    for a, b in ((begin, middle), (middle, end), (begin, end)):
        data[a:b] = data[a:b][::-1]


def arrange(data: bytearray, first: int, second: int, form: str) -> None:
    """Rearranges a text, cut at the bytes ``first`` and ``second``, into the form, in place.

    The sentinels are inserted as prefix, middle, suffix stand in the text. Then the suffix with its sentinel changes
    places with the middle (psm) or with all that stands before it (spm).
    """
    data[second:second] = SUFFIX
    data[first:first] = MIDDLE
    data[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(data, middle if form == PSM else 0, suffix, len(data))


def restore(data: bytearray, form: str) -> None:
    """Turns an arranged text back into what it was, in place, from the text and its form alone.

    A text that holds a sentinel of its own is never arranged, and no sentinel can arise where a segment meets one.
    So each of the three is found once.
    """
    if form == PLAIN:
        return
    begin = data.find(MIDDLE, data.find(SUFFIX)) if form == PSM else data.find(PREFIX)
    rotate(data, data.find(SUFFIX), begin, len(data))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        place = data.find(sentinel)
        del data[place : place + len(sentinel)]


def draws(key: Column, salt: str = "1:") -> list[Column]:
    """The first four groups of 8 hexadecimal digits of the key's digest, as numbers."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_middle(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20, salt: str = "1:") -> DataFrame:
    """One row per document: its form, the lengths of prefix and middle in code points, and the ``output`` text.

    Cuts and form are drawn from a digest of salt and doc_id, so a rerun draws the same. A null doc_id draws like an
    empty one; repeated ids draw alike, and every row gives a row. A null text is empty. Empty texts and those that
    hold a sentinel stay plain, without lengths. Other columns are left out. No rows give no rows.
    """
    names = [f.split()[0] for f in ROWS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                out: list[tuple] = []
                numbers = zip(*(part.column(c).to_pylist() for c in ("doc_id", "h1", "h2", "h3", "h4")))
                for (doc_id, h1, h2, h3, h4), data in zip(numbers, raw(part.column("text"))):
                    text = data.decode()
                    n = len(text)
                    if not n or h3 % 100 >= 100 - plain_percent or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)):
                        out.append((doc_id, n, PLAIN, None, None, data))
                        continue
                    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
                    form = SPM if h4 % 100 < spm_percent else PSM
                    room = bytearray(data)
                    head = len(text[:first].encode())
                    arrange(room, head, head + len(text[first:second].encode()), form)
                    out.append((doc_id, n, form, first, second - first, bytes(room)))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int64()),
                        pa.array(columns[2], pa.string()),
                        pa.array(columns[3], pa.int64()),
                        pa.array(columns[4], pa.int64()),
                        pa.array(columns[5], pa.binary()).cast(pa.string()),
                    ],
                    names=names,
                )

    drawn = [d.alias(f"h{i + 1}") for i, d in enumerate(draws(F.col("doc_id"), salt))]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *drawn, "text").mapInArrow(run, ROWS)


def restored(arranged: DataFrame, name: str = "restored") -> DataFrame:
    """Adds the document's text under ``name``, rebuilt from ``output`` and ``form`` alone. A null output is empty."""
    schema = StructType([*arranged.schema.fields, StructField(name, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "output"):
                texts = []
                for data, form in zip(raw(part.column("output")), part.column("form").to_pylist()):
                    room = bytearray(data)
                    restore(room, form)
                    texts.append(bytes(room))
                columns = [*part.columns, pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return arranged.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """The documents' forms, and digests of their arranged texts and of the texts rebuilt from these."""
    arranged = fill_middle(docs).withColumn("output_sha256", F.sha2("output", 256))
    both = restored(arranged).withColumn("restored_sha256", F.sha2("restored", 256))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


#: DuckDB SQL of ``digests``.
SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x
  FROM documents
), h AS (
  SELECT *, list_transform([0, 1, 2, 3], lambda i: list_reduce(
           list_transform(range(1, 9), lambda k: (strpos('0123456789abcdef', substr(x, (8 * i + k)::INT, 1)) - 1)::BIGINT),
           lambda a, b: a * 16 + b)) AS v
  FROM d
), c AS (
  SELECT *, least(v[1] % (n + 1), v[2] % (n + 1)) AS a, greatest(v[1] % (n + 1), v[2] % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR v[3] % 100 >= 90
              THEN 'plain' WHEN v[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), s AS (
  SELECT *, substr(t, 1, a::INT) AS p, substr(t, a::INT + 1, (b - a)::INT) AS m, substr(t, b::INT + 1) AS s FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""
