"""Jobs that chain sources, transforms and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import elementwise as E
from millrace.operators import sqlapi as S
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sinks import files, messages, tables
from millrace.sources import files as file_sources
from millrace.sources import messages as message_sources
from millrace.streaming import jobs as stream_jobs


@query("job_sql_etl", """
SELECT c_mktsegment AS team, CAST(year(o_orderdate) AS BIGINT) AS year, round(avg(o_totalprice), 2) AS attendance
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
""")
def _(t):
    """Table, SQL, table."""
    games = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    named = games.select(
        F.col("c_mktsegment").alias("team"), F.year("o_orderdate").cast("long").alias("year"), F.col("o_totalprice").alias("attendance")
    )
    averaged = S.sql_over(named, "SELECT team, year, round(AVG(attendance), 2) AS attendance FROM rows GROUP BY team, year")
    name = f"attendance_{scratch_path(t.spark, 'x')[-12:]}"
    tables.write_table(averaged, name, "append", location=scratch_path(t.spark, "job-table"))
    return t.spark.table(name)


@query("job_filter_map_publish", """
SELECT 'orders' AS topic, CAST(o_orderkey AS VARCHAR) AS key, upper(o_orderpriority) AS name FROM orders WHERE o_orderkey > 2
""")
def _(t):
    """Read, filter, map fields, publish."""
    kept = t("orders").where("o_orderkey > 2")
    mapped = E.map_to_fields(kept, {"id": "o_orderkey", "name": "upper(o_orderpriority)"})
    frame = messages.log_frame(mapped, F.col("id"), F.to_json(F.struct("id", "name")), F.lit("orders"))
    path = scratch_path(t.spark, "job-log")
    messages.write_log(frame, path)
    read = t.spark.read.parquet(path)
    name = F.get_json_object(F.decode("value", "UTF-8"), "$.name").alias("name")
    return read.select("topic", F.decode("key", "UTF-8").alias("key"), name)


@query("job_csv_sql_json", """
SELECT o_orderpriority AS col1, count(*) AS n, CAST(sum(CAST(trunc(o_totalprice / 1000) AS INTEGER)) AS BIGINT) AS total
FROM orders WHERE CAST(trunc(o_totalprice / 1000) AS INTEGER) > 100 GROUP BY 1
""")
def _(t):
    """CSV, filter, SQL, JSON."""
    source, target = scratch_path(t.spark, "job-csv"), scratch_path(t.spark, "job-json")
    export = t("orders").select(F.col("o_orderpriority").alias("col1"), (F.col("o_totalprice") / 1000).cast("int").alias("col2"))
    files.write_csv(export, source)
    kept = file_sources.read_csv(t.spark, source, "col1 string, col2 int").where("col2 > 100")
    files.write_json(S.sql_over(kept, "SELECT col1, count(*) AS n, sum(col2) AS total FROM rows GROUP BY col1"), target)
    return t.spark.read.schema("col1 string, n long, total long").json(target)


def _log_stream(t):
    """The message log as a stream of files with the connector's columns."""
    path = scratch_path(t.spark, "log-stream")
    t.view("records").write.parquet(path)
    return stream_jobs.stream_files(t.spark, path, message_sources.LOG_SCHEMA)


@query("job_log_to_table", """
SELECT CAST(key AS BIGINT) AS id, value AS name, epoch_us(time_bucket(INTERVAL 60 SECOND, "timestamp", TIMESTAMP '1970-01-01')) AS minute_us
FROM records WHERE value IS NOT NULL
""", uses=("records",))
def _(t):
    """Message log, decode, one-minute windows, table."""
    decoded = message_sources.decoded(_log_stream(t)).where(F.col("value").isNotNull())
    windowed = S.add_window(decoded, "timestamp", 60)
    rows = E.map_to_fields(windowed, {"id": "cast(key as bigint)", "name": "value", "minute_us": "window_start"})
    out = scratch_path(t.spark, "job-windowed")
    stream_jobs.run_available(stream_jobs.load_job(rows, out, stream_jobs.new_checkpoint(t.spark)))
    return t.spark.read.parquet(out).select("id", "name", "minute_us")


@query("job_log_to_json", 'SELECT value, "offset" FROM records WHERE value IS NOT NULL', uses=("records",))
def _(t):
    """Message log, decode the raw payload, JSON files."""
    decoded = message_sources.decoded(_log_stream(t)).where(F.col("value").isNotNull()).select("value", "offset")
    out = scratch_path(t.spark, "job-json")
    stream_jobs.run_available(stream_jobs.append_files(decoded, out, stream_jobs.new_checkpoint(t.spark), "json"))
    return t.spark.read.schema("value string, offset long").json(out)
