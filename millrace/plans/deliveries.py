"""Queries of the custom data sources: row inserts, watched folders, Avro files, destinations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import elementwise as E
from millrace.plans.registry import query
from millrace.plans.writing import PERSON_FIELDS
from millrace.session import scratch_path
from millrace.sinks import destinations, inserts
from millrace.sources import watch
from millrace.streaming import jobs as J

TARGET = "id long not null, price double, day date"


def _order_rows(t):
    """Orders as JSON texts, some with a field too many, without an id, with a price in words, or no record at all."""
    key = F.col("o_orderkey")
    price = F.when(key % 3 == 0, F.lit("dear")).otherwise(F.col("o_totalprice").cast("string"))
    fields = F.struct(
        F.when(key % 7 != 0, key).alias("id"),
        price.alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.when(key % 5 == 0, key.cast("string")).alias("extra"),
    )
    return t("orders").select(F.when(key % 31 == 0, F.concat(F.lit("no record "), key)).otherwise(F.to_json(fields)).alias("row"))


@query("stream_row_inserts", """
WITH judged AS (SELECT o_orderkey AS k, o_totalprice AS p, CAST(o_orderdate AS DATE) AS d,
    CASE WHEN o_orderkey % 31 = 0 THEN 'not a record' WHEN o_orderkey % 5 = 0 THEN 'no such field: extra'
         WHEN o_orderkey % 7 = 0 THEN 'missing required field: id' WHEN o_orderkey % 3 = 0 THEN 'wrong type in field: price' END AS error
  FROM orders)
SELECT CASE WHEN error IS NULL THEN 'rows' ELSE 'failed' END AS kind,
  CASE WHEN k % 7 <> 0 AND (error IS NULL OR k % 31 <> 0) THEN k END AS id, CASE WHEN error IS NULL THEN p END AS price,
  CASE WHEN error IS NULL OR k % 31 <> 0 THEN strftime(d, '%Y-%m-%d') END AS day,
  CASE WHEN error IS NOT NULL THEN CASE WHEN k % 31 = 0 THEN 'no record ' || k WHEN k % 5 = 0 THEN CAST(k AS VARCHAR) END END AS rest,
  error, CASE WHEN error IS NOT NULL THEN 'orders' END AS "table"
FROM judged
""")
def _(t):
    """Rows inserted in three micro-batches; accepted and failed ones are read back."""
    source, out = scratch_path(t.spark, "insert-rows"), scratch_path(t.spark, "inserts")
    _order_rows(t).repartition(6).write.parquet(source)
    stream = J.stream_files(t.spark, source, "row string", files_per_batch=2)
    J.run_available(inserts.insert_rows(stream, TARGET, "orders", out, J.new_checkpoint(t.spark)))
    good = inserts.inserted_rows(t.spark, out, TARGET).select(
        F.lit("rows").alias("kind"), "id", "price", F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.lit(None).cast("string").alias("rest"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("table"),
    )
    field = lambda name: F.get_json_object("row", f"$.{name}")
    bad = inserts.failed_rows(t.spark, out).select(
        F.lit("failed").alias("kind"), field("id").cast("long").alias("id"), F.lit(None).cast("double").alias("price"),
        field("day").alias("day"),
        F.when(F.col("error") == "not a record", F.col("row")).otherwise(field("extra")).alias("rest"), "error", "table",
    )
    return good.unionByName(bad)


STEPS, STEP_SECONDS = 3, 300


@query("stream_file_watch", f"""
SELECT CAST(doc_id % {STEPS} * {STEP_SECONDS} AS BIGINT) * 1000000 AS window_start, count(*) AS lines
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) FROM documents) GROUP BY 1
""")
def _(t):
    """Files that come while the stream runs are matched once; their lines are counted by 5-minute windows.

    A file's time is in its folder's name, a little after the window's begin. The stream polls twice a second and
    ends when nothing new has come for a while. A last file, far ahead, lets all windows before its own come out.
    """
    root, log, out = (scratch_path(t.spark, name) for name in ("watched", "watched-log", "watched-out"))
    texts = t("documents").select((F.col("doc_id") % STEPS).alias("step"), "text")
    found = watch.watch_files(t.spark, f"{root}/at=*/part-*.txt", log, interval_seconds=0.5)
    at = F.timestamp_seconds(F.regexp_extract("path", "/at=([0-9]+)/", 1).cast("long"))
    counted = J.count_lines_of_paths(found.withColumn("at", at), "path", "at", ".*")
    sums = J.windowed_aggregate(counted, "ts", [], [F.sum("lines").alias("lines")], STEP_SECONDS, STEP_SECONDS)
    writer = J.append_files(sums, out, J.new_checkpoint(t.spark)).trigger(processingTime="500 milliseconds")
    stream = writer.start()
    try:
        for step in range(STEPS):
            part = texts.where(F.col("step") == step).select("text")
            watch.put_whole(lambda path: part.write.option("lineSep", "\n").text(path), f"{root}/at={step * STEP_SECONDS + 1}")
            stream.processAllAvailable()
        ahead = texts.limit(1).select("text")
        watch.put_whole(lambda path: ahead.write.option("lineSep", "\n").text(path), f"{root}/at={10 ** 8}")
        J.stop_when_idle(stream, idle_seconds=3, poll_seconds=0.25)
    finally:
        stream.stop()
    return t.spark.read.schema("window_start long, lines long").parquet(out)


PERSON = "name string, year int, country string, grp string"


@query("sink_any_destination", """
SELECT country AS destination, name, year, CASE WHEN n_nationkey % 3 <> 1 THEN country END AS country,
  CASE WHEN n_nationkey % 3 = 0 THEN grp END AS grp
FROM persons JOIN nation ON n_name = country
""", uses=("persons",))
def _(t):
    """A destination per country, none of them known beforehand; two thirds have a schema of their own in a table."""
    path = scratch_path(t.spark, "sink-any")
    persons = E.parse_delimited(t.view("person_lines"), "value", PERSON_FIELDS).select("name", "year", "country", "grp")
    fields = {1: ["name", "year"], 2: ["name", "year", "country"]}
    cases = [F.when(F.col("n_nationkey") % 3 == k, F.array(*map(F.lit, names))) for k, names in fields.items()]
    schemas = t("nation").select(F.col("n_name").alias("destination"), F.coalesce(*cases).alias("fields")).where("fields IS NOT NULL")
    destinations.write_to_destinations(persons, F.col("country"), path, schemas)
    return destinations.read_destinations(t.spark, path, PERSON).select("destination", "name", "year", "country", "grp")
