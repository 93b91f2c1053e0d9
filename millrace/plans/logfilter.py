"""Queries of log filtering."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import logs as L
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sinks import files as file_sinks
from millrace.sinks import stores
from millrace.sources import files as file_sources


def _field(name):
    return F.col("line").contains(name)


# The JSON line of a log record.
RAW = """CASE WHEN mention_only THEN '{"note":"severity jsonPayload unknown","n":' || event_id || '}' ELSE
  '{"insertId":' || event_id || CASE WHEN severity IS NOT NULL THEN ',"severity":"' || severity || '"' ELSE '' END
  || CASE WHEN message IS NOT NULL THEN ',"jsonPayload":{"message":"' || message || '"}' ELSE '' END
  || ',"resource":{"resourceName":"' || resource_name || '","event_type":"' || event_type || '"},"timestamp":"' || stamp || '"}' END"""


@query("log_dlq_messages", f"""
SELECT event_id, 'Log of level error: ' || message || ' [' || stamp || ']' AS data, stamp AS ts, message, 'processed' AS output
FROM logs WHERE NOT mention_only AND severity IS NOT NULL AND message IS NOT NULL AND upper(severity) = 'ERROR'
UNION ALL SELECT event_id, {RAW}, NULL, NULL, 'dead_letter' FROM logs
WHERE mention_only OR severity IS NULL OR message IS NULL
""", uses=("logs",))
def _(t):
    parsed = L.parse_logs(t.view("logs"), "line")
    present = L.has_field(F.col("line"), "severity") & L.has_field(F.col("line"), "jsonPayload")
    routed = L.route_logs(parsed, present, F.col("log.severity"))
    processed = L.error_messages(routed).select(
        "event_id",
        "data",
        F.col("attributes")["timestamp"].alias("ts"),
        F.col("attributes")["message"].alias("message"),
        F.lit("processed").alias("output"),
    )
    # A dead letter is the raw line.
    dead = L.dead_letters(routed).select("event_id", "output", F.col("line").alias("data"))
    return processed.unionByName(dead, allowMissingColumns=True)


@query("log_dlq_table", """
SELECT message, NULL AS resource_name, stamp AS ts, 'processed' AS output
FROM logs WHERE severity IS NOT NULL AND message IS NOT NULL AND upper(severity) = 'ERROR'
UNION ALL SELECT NULL, resource_name, stamp, 'dead_letter' FROM logs WHERE severity IS NULL OR message IS NULL
""", uses=("logs",))
def _(t):
    """Rows of a table: a column is always there, so a field counts as present when it is not null."""
    events = t("events")
    number = F.col("event_id")
    severity = (
        F.when(F.col("event_type") == "error", F.when(number % 2 == 0, "error").otherwise("ERROR"))
        .when(F.col("event_type") == "click", "WARNING")
        .otherwise("INFO")
    )
    rows = events.select(
        F.when(number % 9 != 0, severity).alias("severity"),
        F.when(number % 10 != 0, F.concat("event_type", F.lit(" of user "), "user_id")).alias("message"),
        F.struct(F.concat(F.lit("projects/p"), F.col("user_id") % 7).alias("resourceName")).alias("resource"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
    )
    present = F.col("severity").isNotNull() & F.col("message").isNotNull()
    routed = L.route_logs(rows, present, F.col("severity"))
    processed = routed.where(F.col("output") == L.PROCESSED).select("message", "ts", "output")
    dead = L.dead_letters(routed).select(F.to_json("resource").alias("resource"), "ts", "output")
    dead = dead.select(F.get_json_object("resource", "$.resourceName").alias("resource_name"), "ts", "output")
    return processed.unionByName(dead, allowMissingColumns=True).select("message", "resource_name", "ts", "output")


def _from_text(t):
    """Log lines out of text files; the presence test is on the raw line.

    A line that only mentions the names passes that test but has no field: it is a dead
    letter here, not a failure.
    """
    path = scratch_path(t.spark, "log-text")
    file_sinks.write_text(t.view("logs"), path, "line")
    lines = file_sources.read_text(t.spark, path).withColumnRenamed("value", "line")
    parsed = L.parse_logs(lines, "line")
    mentioned = _field("severity") & _field("jsonPayload")
    usable = mentioned & F.col("log.severity").isNotNull() & F.col("log.jsonPayload").isNotNull()
    return L.route_logs(parsed, F.coalesce(usable, F.lit(False)), F.col("log.severity"))


FROM_TEXT = f"""
SELECT stamp AS ts, message, NULL AS line, 'processed' AS output FROM logs
WHERE NOT mention_only AND severity IS NOT NULL AND message IS NOT NULL AND upper(severity) = 'ERROR'
UNION ALL SELECT CASE WHEN NOT mention_only THEN stamp END, NULL, {RAW}, 'dead_letter' FROM logs
WHERE mention_only OR severity IS NULL OR message IS NULL
"""


@query("log_dlq_text", FROM_TEXT, uses=("logs",))
def _(t):
    routed = _from_text(t)
    kept = routed.where(F.col("output") != L.SKIPPED)
    message = F.when(F.col("output") == L.PROCESSED, F.col("log.jsonPayload.message"))
    # A dead letter keeps its raw line.
    line = F.when(F.col("output") != L.PROCESSED, F.col("line"))
    return kept.select(F.col("log.timestamp").alias("ts"), message.alias("message"), line.alias("line"), "output")


@query("log_dlq_insert", f"""
SELECT event_id AS id, message, stamp AS timestr, 'table' AS output FROM logs
WHERE NOT mention_only AND severity IS NOT NULL AND message IS NOT NULL AND upper(severity) = 'ERROR'
UNION ALL SELECT -1 - c_custkey, c_name, NULL, 'table' FROM customer
UNION ALL SELECT NULL, {RAW}, NULL, 'dead_letter' FROM logs WHERE mention_only OR severity IS NULL OR message IS NULL
""", uses=("logs",))
def _(t):
    """The processed rows are inserted into a keyed table that has rows already; dead letters are a second output."""
    routed = _from_text(t)
    processed = routed.where(F.col("output") == L.PROCESSED)
    rows = processed.select(
        F.lit(stores.INSERT).alias("op"),
        F.col("log.insertId").alias("id"),
        F.col("log.jsonPayload.message").alias("message"),
        F.col("log.timestamp").alias("timestr"),
    )
    target = t("customer").select(
        (-1 - F.col("c_custkey")).alias("id"), F.col("c_name").alias("message"), F.lit(None).cast("string").alias("timestr")
    )
    after = stores.apply_mutations(target, stores.judge_mutations(target, rows, "id"), "id")
    dead = L.dead_letters(routed).select(F.col("line").alias("message"), "output")
    return after.withColumn("output", F.lit("table")).unionByName(dead, allowMissingColumns=True)
