"""Inputs of the queries, derived row by row from the driver's tables.

``VIEWS[name](tables)`` gives the DataFrame, ``SQL[name]`` the same rows in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.panes import TICK_SECONDS

# ---------------------------------------------------------------- rides


def rides(t):
    """Taxi rides out of the event stream."""
    status = (
        F.when(F.col("event_type") == "purchase", "dropoff")
        .when(F.col("event_type") == "signup", "pickup")
        .when(F.col("event_type") == "view", "enroute")
        .otherwise(F.col("event_type"))
    )
    return t("events").select(
        "event_id",
        F.col("user_id").cast("string").alias("ride_id"),
        status.alias("ride_status"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("meter_reading"),
        (F.col("value") / 10).alias("meter_increment"),
        (F.get_json_object("props", "$.k").cast("int") % 7).alias("passenger_count"),
    )


RIDES = """
SELECT event_id, CAST(user_id AS VARCHAR) AS ride_id,
       CASE event_type WHEN 'purchase' THEN 'dropoff' WHEN 'signup' THEN 'pickup'
                       WHEN 'view' THEN 'enroute' ELSE event_type END AS ride_status,
       ts, value AS meter_reading, value / 10 AS meter_increment,
       CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS passenger_count
FROM events
"""

# ---------------------------------------------------------------- messages

RIDE_JSON_SCHEMA = (
    "ride_id string, ride_status string, timestamp string, meter_reading double, "
    "meter_increment double, passenger_count int"
)


def messages(t):
    """Rides as encoded JSON messages with attributes; some malformed, some delivered twice."""
    ride = rides(t)
    body = F.to_json(
        F.struct(
            "ride_id",
            "ride_status",
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
            "meter_reading",
            "meter_increment",
            "passenger_count",
        )
    )
    data = F.when(F.col("event_id") % 17 == 0, F.concat(F.lit("{broken "), body)).otherwise(body)
    present = F.col("event_id") % 5 != 0
    attributes = F.map_filter(
        F.create_map(
            F.lit("timestamp"),
            F.when(F.col("event_id") % 2 == 0, F.unix_millis("ts").cast("string")).otherwise(
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
            ),
            F.lit("passenger_count"),
            F.col("passenger_count").cast("string"),
            F.lit("age"),
            F.when(present, (F.col("event_id") % 90).cast("string")),
            F.lit("country"),
            F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("country"), F.col("event_id") % 4)),
        ),
        lambda _, value: value.isNotNull(),
    )
    once = ride.select(
        F.encode(data, "UTF-8").alias("data"),
        attributes.alias("attributes"),
        F.col("event_id").cast("string").alias("message_id"),
        F.col("ts").alias("publish_time"),
    )
    copies = F.when(F.col("message_id").cast("long") % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return once.withColumn("_copy", F.explode(copies)).drop("_copy")


# One row per delivered message, fields in place of the JSON text.
MESSAGES = """
SELECT r.*, CAST(event_id AS VARCHAR) AS message_id, event_id % 17 = 0 AS malformed,
       CASE WHEN event_id % 5 <> 0 THEN CAST(event_id % 90 AS VARCHAR) END AS age,
       CASE WHEN event_id % 3 <> 0 THEN 'country' || (event_id % 4) END AS country
FROM rides r, (SELECT unnest([0, 1]) AS copy_no) c
WHERE copy_no = 0 OR event_id % 11 = 0
"""

# ---------------------------------------------------------------- records of a message log


def records(t):
    """Key-value log records, some values without the expected prefix, some null."""
    prefix = F.when(F.col("event_id") % 6 == 0, "bad_").otherwise("kafka_")
    value = F.when(F.col("event_id") % 29 != 0, F.concat(prefix, F.col("event_type"), F.lit("_"), F.col("event_id")))
    return t("events").select(
        F.lit("rides").alias("topic"),
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


RECORDS = """
SELECT 'rides' AS topic, CAST(user_id AS VARCHAR) AS key,
       CASE WHEN event_id % 29 <> 0 THEN
         (CASE WHEN event_id % 6 = 0 THEN 'bad_' ELSE 'kafka_' END) || event_type || '_' || event_id END AS value,
       CAST(event_id % 4 AS INTEGER) AS partition, event_id AS "offset", ts AS "timestamp"
FROM events
"""

# ---------------------------------------------------------------- arrivals


def arrivals(t):
    """Arrival log: event time, processing time and the batch an element came with."""
    proc = F.unix_micros(F.col("ts").cast("timestamp")) + ((F.col("event_id") * 7919) % 40000) * 1_000_000
    return t("events").select(
        "event_id",
        F.col("event_type").alias("k"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        proc.alias("proc_us"),
        F.floor(proc / (TICK_SECONDS * 1_000_000)).cast("long").alias("batch_id"),
    )


ARRIVALS = f"""
SELECT event_id, event_type AS k, epoch_us(ts) AS ts_us, CAST(round(value * 100) AS BIGINT) AS cents,
       epoch_us(ts) + (event_id * 7919) % 40000 * 1000000 AS proc_us,
       (epoch_us(ts) + (event_id * 7919) % 40000 * 1000000) // ({TICK_SECONDS} * 1000000) AS batch_id
FROM events
"""

# Watermark each batch sees: the largest event time of the batches before it.
CLOCK = """
SELECT batch_id, max(top) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm
FROM (SELECT batch_id, max(ts_us) AS top FROM arrivals GROUP BY batch_id)
"""

# ---------------------------------------------------------------- persons


def person_lines(t):
    """``name, year, country, group`` lines."""
    return (
        t("customer")
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.concat(
                F.col("c_name"),
                F.lit(", "),
                F.lit(1990) + F.col("c_custkey") % 20,
                F.lit(", "),
                F.col("n_name"),
                F.lit(", group"),
                F.col("c_custkey") % 2 + 1,
            ).alias("value"),
        )
    )


PERSONS = """
SELECT c_custkey, c_name AS name, CAST(1990 + c_custkey % 20 AS INTEGER) AS year, n_name AS country,
       'group' || (c_custkey % 2 + 1) AS grp
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def person_dates(t):
    """Name, date and country of every order's customer."""
    return (
        t("orders")
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey"),
            F.col("c_name").alias("name"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("n_name").alias("country"),
        )
    )


PERSON_DATES = """
SELECT o_orderkey, c_name AS name, CAST(o_orderdate AS DATE) AS date, n_name AS country
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

# ---------------------------------------------------------------- text lines


def lines(t):
    """Lines of the documents' whole texts."""
    return t("documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))


LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"

# ---------------------------------------------------------------- nested and repeated


def repositories(t):
    """Documents with a nested record, null for some."""
    nested = F.struct(
        F.when(F.col("doc_id") % 11 != 0, F.concat(F.lit("https://example.org/"), F.col("doc_id"))).alias("url"),
        F.when(F.col("doc_id") % 13 != 0, F.concat(F.upper("source"), F.lit(" "), F.col("lang"))).alias("description"),
        (F.col("n_chars") % 100).alias("forks"),
        F.concat(F.lit("2012-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")).alias("created_at"),
    )
    return t("documents").select(
        "doc_id",
        F.col("lang").alias("type"),
        F.col("source").alias("url"),
        F.when(F.col("doc_id") % 7 != 0, nested).alias("repository"),
    )


REPOSITORIES = """
SELECT doc_id, lang AS type, source AS url, doc_id % 7 = 0 AS no_repo,
       CASE WHEN doc_id % 11 <> 0 THEN 'https://example.org/' || doc_id END AS r_url,
       CASE WHEN doc_id % 13 <> 0 THEN upper(source) || ' ' || lang END AS r_description,
       n_chars % 100 AS r_forks,
       '2012-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS r_created_at
FROM documents
"""


def ngrams(t):
    """A term with repeated records of year, volume and bracketed value, one per vector component."""
    return t("embeddings").select(
        "vec_id",
        F.concat(F.lit("term"), F.col("vec_id")).alias("ngram"),
        F.transform(
            "embedding",
            lambda x, i: F.struct(
                (F.lit(1850) + F.pmod(F.col("vec_id") * 31 + i * 7, F.lit(170))).cast("int").alias("year"),
                F.pmod(F.floor(x.cast("double") * 1000).cast("long"), F.lit(8)).alias("volume_count"),
                F.concat(F.lit("["), i, F.lit(","), F.col("label"), F.lit("]")).alias("value"),
            ),
        ).alias("cell"),
    )


# One row per repeated record, `pos` from 0.
NGRAMS = """
SELECT vec_id, 'term' || vec_id AS ngram, pos,
       CAST(1850 + (vec_id * 31 + pos * 7) % 170 AS INTEGER) AS year,
       ((CAST(floor(x * 1000) AS BIGINT) % 8) + 8) % 8 AS volume_count,
       '[' || pos || ',' || label || ']' AS value
FROM (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
             CAST(unnest(range(len(embedding))) AS BIGINT) AS pos FROM embeddings)
"""

# ---------------------------------------------------------------- wide-column cells

CELL_TS_MICROS = 1_577_836_800_000_000


def cells(t):
    """Part fields as timestamped cells of a wide-column table."""
    row = t("part").select(
        F.format_string("row_key%07d", F.col("p_partkey")).alias("row_key"),
        F.posexplode(F.array("p_name", "p_brand", "p_type")).alias("i", "value"),
        "p_partkey",
    )
    return row.select(
        "row_key",
        F.lit("cf1").alias("family"),
        F.concat(F.lit("field"), F.col("i")).alias("qualifier"),
        "value",
        (F.lit(CELL_TS_MICROS) + F.col("p_partkey") * 1_000_000).alias("ts_micros"),
    )


CELLS = f"""
SELECT printf('row_key%07d', p_partkey) AS row_key, 'cf1' AS family, 'field' || i AS qualifier,
       CASE i WHEN 0 THEN p_name WHEN 1 THEN p_brand ELSE p_type END AS value,
       {CELL_TS_MICROS} + p_partkey * 1000000 AS ts_micros
FROM part, (SELECT unnest([0, 1, 2]) AS i) q
"""

# ---------------------------------------------------------------- logs


def logs(t):
    """Structured log records as JSON lines; a severity or a payload is missing in some."""
    severity = (
        F.when(F.col("event_type") == "error", F.when(F.col("event_id") % 2 == 0, "error").otherwise("ERROR"))
        .when(F.col("event_type") == "click", "WARNING")
        .otherwise("INFO")
    )
    message = F.concat(F.col("event_type"), F.lit(" of user "), F.col("user_id"))
    resource = F.struct(F.concat(F.lit("projects/p"), F.col("user_id") % 7).alias("resourceName"), "event_type")
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    line = F.to_json(
        F.struct(
            F.col("event_id").alias("insertId"),
            F.when(F.col("event_id") % 9 != 0, severity).alias("severity"),
            F.when(F.col("event_id") % 10 != 0, F.struct(message.alias("message"))).alias("jsonPayload"),
            resource.alias("resource"),
            stamp.alias("timestamp"),
        )
    )
    mention = F.when(F.col("event_id") % 27 == 0, F.concat(F.lit('{"note":"severity jsonPayload unknown","n":'), "event_id", F.lit("}")))
    return t("events").select("event_id", F.coalesce(mention, line).alias("line"))


LOGS = """
SELECT event_id, event_id % 27 = 0 AS mention_only,
       CASE WHEN event_id % 9 <> 0 THEN
         CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'error' ELSE 'ERROR' END
              WHEN event_type = 'click' THEN 'WARNING' ELSE 'INFO' END END AS severity,
       CASE WHEN event_id % 10 <> 0 THEN event_type || ' of user ' || user_id END AS message,
       'projects/p' || (user_id % 7) AS resource_name, event_type,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS stamp
FROM events
"""

# ---------------------------------------------------------------- keyed table and its mutations


def mutation_target(t):
    """Customers as a keyed table: id, first, last."""
    return t("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("first"), F.col("c_mktsegment").alias("last")
    )


def mutations(t):
    """One mutation per customer key; some aim at keys that are not there."""
    ops = F.array(*[F.lit(op) for op in ("insert", "update", "replace", "insert_or_update", "delete")])
    # Groups: insert with replace, update with insert_or_update, delete alone.
    slots = F.array(*[F.lit(slot) for slot in (0, 1, 0, 1, 2)])
    key = F.col("c_custkey")
    shift = F.when(F.floor(key / 5) % 2 == 0, F.lit(1_000_000_000_000)).otherwise(0)
    return t("customer").select(
        F.element_at(ops, (key % 5 + 1).cast("int")).alias("op"),
        (key + shift).alias("id"),
        F.concat(F.lit("new"), key).alias("first"),
        F.when(key % 3 != 0, F.concat(F.lit("seg"), key % 4)).alias("last"),
        (key % 3 != 0).alias("last_set"),
        (F.floor(key / 5).cast("long") * 3 + F.element_at(slots, (key % 5 + 1).cast("int"))).alias("group_id"),
    )


MUTATIONS = """
SELECT ['insert', 'update', 'replace', 'insert_or_update', 'delete'][CAST(c_custkey % 5 + 1 AS INTEGER)] AS op,
       c_custkey + CASE WHEN (c_custkey // 5) % 2 = 0 THEN 1000000000000 ELSE 0 END AS id,
       'new' || c_custkey AS first,
       CASE WHEN c_custkey % 3 <> 0 THEN 'seg' || (c_custkey % 4) END AS last,
       c_custkey % 3 <> 0 AS last_set,
       c_custkey // 5 * 3 + [0, 1, 0, 1, 2][CAST(c_custkey % 5 + 1 AS INTEGER)] AS group_id
FROM customer
"""

VIEWS = {
    "rides": rides,
    "messages": messages,
    "records": records,
    "arrivals": arrivals,
    "person_lines": person_lines,
    "person_dates": person_dates,
    "lines": lines,
    "repositories": repositories,
    "ngrams": ngrams,
    "cells": cells,
    "logs": logs,
    "mutation_target": mutation_target,
    "mutations": mutations,
}

SQL = {
    "rides": RIDES,
    "messages": MESSAGES,
    "records": RECORDS,
    "arrivals": ARRIVALS,
    "clock": CLOCK,
    "persons": PERSONS,
    "person_dates": PERSON_DATES,
    "lines": LINES,
    "repositories": REPOSITORIES,
    "ngrams": NGRAMS,
    "cells": CELLS,
    "logs": LOGS,
    "mutations": MUTATIONS,
}
