"""Queries of the sinks: write to a new shared folder, read back, give the rows read."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from millrace.functions import numbers
from millrace.operators import elementwise as E
from millrace.operators.joins import map_side_input
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sinks import destinations, files, jdbc, messages, stores, tables
from millrace.sources import avro
from millrace.sources import files as file_sources
from millrace.sources import jdbc as jdbc_source
from millrace.sources import tfrecord

PERSON_FIELDS = {"name": "string", "year": "int", "country": "string", "grp": "string"}


def _persons(t):
    return E.parse_delimited(t.view("person_lines"), "value", PERSON_FIELDS)


@query("sink_text", "SELECT 'item no. ' || o_orderkey AS value FROM orders")
def _(t):
    path = scratch_path(t.spark, "sink-text")
    lines = t("orders").select(F.concat(F.lit("item no. "), "o_orderkey").alias("value"))
    files.write_text(lines, path)
    return file_sources.read_text(t.spark, path)


@query("sink_csv", """
SELECT c_custkey AS id, c_name AS name, kind FROM customer, (VALUES ('plain'), ('commented')) k(kind)
""")
def _(t):
    people = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    plain, commented = scratch_path(t.spark, "sink-csv"), scratch_path(t.spark, "sink-csv")
    files.write_csv(people, plain)
    files.write_csv(people, commented, comments=["people", "id and name"])
    first = file_sources.read_csv(t.spark, plain, "id long, name string")
    second = file_sources.read_csv(t.spark, commented, "id long, name string", comment="#")
    return first.withColumn("kind", F.lit("plain")).unionByName(second.withColumn("kind", F.lit("commented")))


@query("sink_json", "SELECT c_custkey AS id, c_name AS name FROM customer")
def _(t):
    path = scratch_path(t.spark, "sink-json")
    files.write_json(t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), path)
    return t.spark.read.schema("id long, name string").json(path)


@query("sink_serialised_files", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    path = scratch_path(t.spark, "sink-rows")
    files.write_serialised(t("orders").select("o_orderkey", "o_orderstatus"), path)
    lines = file_sources.read_text(t.spark, path)
    return lines.select(F.from_json("value", "o_orderkey long, o_orderstatus string").alias("r")).select("r.*")


STATE = json.dumps(
    {
        "type": "record",
        "name": "State",
        "namespace": "geography",
        "fields": [
            {"name": "name", "type": "string"},
            {"name": "post_abbr", "type": ["null", "string"], "default": None},
            {"name": "n_customers", "type": "long"},
        ],
    }
)


@query("sink_avro_roundtrip", "SELECT n_name AS name, lower(substr(n_name, 1, 2)) AS post_abbr, n_customers FROM nation JOIN (SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY 1) ON c_nationkey = n_nationkey")
def _(t):
    """Records written by an explicit schema, read back, lower-cased and saved by it again."""
    first, second = scratch_path(t.spark, "sink-avro"), scratch_path(t.spark, "sink-avro")
    counted = t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n_customers"))
    states = t("nation").join(counted, "n_nationkey").select(
        F.col("n_name").alias("name"), F.substring("n_name", 1, 2).alias("post_abbr"), "n_customers"
    )
    avro.write_avro(states, first, STATE)
    lowered = avro.read_avro(t.spark, first).withColumn("post_abbr", F.lower("post_abbr"))
    avro.write_avro(lowered, second, STATE, codec="zstandard")
    return avro.read_avro(t.spark, second)


@query("sink_parquet", "SELECT c_name AS name, CAST(c_custkey % 90 AS BIGINT) AS age FROM customer")
def _(t):
    path = scratch_path(t.spark, "sink-parquet")
    people = t("customer").select(F.col("c_name").alias("name"), (F.col("c_custkey") % 90).alias("age"))
    files.write_records(people, path, required=["name", "age"], shards=16)
    return t.spark.read.parquet(path)


@query("sink_tfrecord", "SELECT s_name || ' ' || s_suppkey AS text FROM supplier UNION ALL SELECT p_name || ' ' || p_partkey FROM part")
def _(t):
    tfrecord.register(t.spark)
    path = scratch_path(t.spark, "sink-tfrecord")
    suppliers = t("supplier").select(F.concat("s_name", F.lit(" "), "s_suppkey").alias("text"))
    parts = t("part").select(F.concat("p_name", F.lit(" "), "p_partkey").alias("text"))
    record = suppliers.unionByName(parts).select(F.encode("text", "UTF-8").alias("record"))
    record.write.format("tfrecord").mode("append").save(path)
    return t.spark.read.format("tfrecord").load(path).select(F.decode("record", "UTF-8").alias("text"))


@query("sink_dynamic_files", """
SELECT p_partkey, 'prime' AS destination FROM part WHERE p_size > 1 AND NOT EXISTS (
  SELECT 1 FROM (SELECT unnest(range(2, 1001)) AS d) WHERE d < p_size AND p_size % d = 0)
UNION ALL SELECT p_partkey, 'not-prime' FROM part WHERE p_size <= 1 OR EXISTS (
  SELECT 1 FROM (SELECT unnest(range(2, 1001)) AS d) WHERE d < p_size AND p_size % d = 0)
UNION ALL SELECT p_partkey, 'folder' || (p_partkey * 7919 % 4) FROM part
""")
def _(t):
    path, mixed = scratch_path(t.spark, "sink-dynamic"), scratch_path(t.spark, "sink-dynamic")
    label = F.when(numbers.is_prime(F.col("p_size")), "prime").otherwise("not-prime")
    files.write_by_key(t("part").select("p_partkey", label.alias("destination")), path, "destination")
    folder = F.concat(F.lit("folder"), F.pmod(F.col("p_partkey") * 7919, F.lit(4)))
    files.write_by_key(t("part").select("p_partkey", folder.alias("destination")), mixed, "destination")
    schema = "p_partkey long, destination string"
    return t.spark.read.schema(schema).parquet(path).unionByName(t.spark.read.schema(schema).parquet(mixed))


@query("sink_jdbc", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    url, table = jdbc_source.configured_url(t.spark), f"orders_{uuid.uuid4().hex[:12]}"
    orders = t("orders").select("o_orderkey", "o_orderstatus")
    typed = {"createTableColumnTypes": "o_orderstatus VARCHAR(8)"}
    jdbc.append(orders, url, table, batch_size=2000, partitions=4, properties=typed)
    return jdbc_source.read_table(t.spark, url, table)


@query("sink_table_dispositions", """
WITH people AS (SELECT c_custkey AS id, c_name AS name FROM customer), twice AS (SELECT unnest([1, 2]))
SELECT 'first' AS step, id, name FROM people UNION ALL SELECT 'appended', id, name FROM people, twice
UNION ALL SELECT 'refused', id, name FROM people, twice UNION ALL SELECT 'truncated', s_suppkey, s_name FROM supplier
""")
def _(t):
    """The table's rows after each write: to a new table, appended, refused as it has rows, and truncated."""
    table = f"people_{uuid.uuid4().hex[:12]}"
    people = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    seen = scratch_path(t.spark, "sink-table-steps")

    def note(step):
        t.spark.table(table).select("id", "name").write.parquet(f"{seen}/step={step}")

    tables.write_table(people, table, "empty", location=scratch_path(t.spark, "sink-table"))
    note("first")
    tables.write_table(people, table, "append")
    note("appended")
    try:
        tables.write_table(people, table, "empty")
    except tables.TableNotEmpty:
        note("refused")
    tables.write_table(suppliers, table, "truncate")
    note("truncated")
    return t.spark.read.schema("id long, name string, step string").parquet(seen).select("step", "id", "name")


@query("sink_format_fn", "SELECT name, year, country FROM persons", uses=("persons",))
def _(t):
    path = scratch_path(t.spark, "sink-format")
    _persons(t).select("name", "year", "country").write.parquet(path)
    return t.spark.read.parquet(path)


@query("sink_string_suffix", """
SELECT c_custkey, name || '_example' AS name, year, country || '_example' AS country FROM persons
""", uses=("persons",))
def _(t):
    path = scratch_path(t.spark, "sink-suffix")
    tables.suffix_strings(_persons(t).select("c_custkey", "name", "year", "country")).write.parquet(path)
    return t.spark.read.parquet(path)


@query("sink_dynamic_tables", """
SELECT 'group1' AS destination, name, year, NULL AS country FROM persons WHERE grp = 'group1'
UNION ALL SELECT 'group2', name, year, country FROM persons WHERE grp = 'group2'
UNION ALL SELECT 'after', name, year, country FROM persons WHERE year > 1997
UNION ALL SELECT 'before', name, year, country FROM persons WHERE year <= 1997
""", uses=("persons",))
def _(t):
    persons = _persons(t).select("name", "year", "country", "grp")
    schemas = E.create_rows(t.spark, [("group1", ["name", "year"])], "destination string, fields array<string>")
    by_group, by_year = scratch_path(t.spark, "sink-groups"), scratch_path(t.spark, "sink-years")
    destinations.write_to_destinations(persons, F.col("grp"), by_group, schemas)
    when = F.when(F.col("year") > 1997, "after").otherwise("before")
    destinations.write_to_destinations(persons.drop("grp"), when, by_year)
    columns = "name string, year int, country string"
    groups = destinations.read_destinations(t.spark, by_group, columns)
    return groups.unionByName(destinations.read_destinations(t.spark, by_year, columns)).select("destination", *persons.columns[:3])


@query("sink_routed_by_side_input", """
SELECT 'users' AS destination, name, year, NULL AS country FROM persons WHERE c_custkey % 2 = 0
UNION ALL SELECT 'countries', NULL, NULL, country FROM persons WHERE c_custkey % 2 = 1
""", uses=("persons",))
def _(t):
    is_user = F.col("c_custkey") % 2 == 0
    rows = _persons(t).select(
        F.when(is_user, F.col("name")).alias("name"),
        F.when(is_user, F.col("year")).alias("year"),
        F.when(~is_user, F.col("country")).alias("country"),
    )
    # Both maps, kind to table and table to schema, are side inputs.
    routing = E.create_rows(t.spark, [("users", "users"), ("countries", "countries")], "kind string, destination string")
    fields = [("users", ["name", "year"]), ("countries", ["country"])]
    schemas = E.create_rows(t.spark, fields, "destination string, fields array<string>")
    kind = F.when(F.col("year").isNotNull(), "users").otherwise("countries")
    routed = map_side_input(rows.withColumn("kind", kind), routing, "kind", "destination").drop("kind")
    path = scratch_path(t.spark, "sink-routed")
    destinations.write_to_destinations(routed, F.col("destination"), path, schemas)
    read = destinations.read_destinations(t.spark, path, "name string, year int, country string")
    return read.select("destination", "name", "year", "country")


@query("sink_partition_cluster", "SELECT name, date, country FROM person_dates", uses=("person_dates",))
def _(t):
    path = scratch_path(t.spark, "sink-clustered")
    dated = t.view("person_dates").select("name", "date", "country")
    # Months as folders keep their number small; the full date stays a column.
    tables.write_partitioned(dated.withColumn("month", F.trunc("date", "month")), path, "month", ["date", "country"])
    return t.spark.read.parquet(path).select("name", "date", "country")


@query("sink_failed_rows", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'no such field: extra' WHEN o_orderkey % 7 = 0 THEN 'missing required field: id'
  WHEN o_orderkey % 3 = 0 THEN 'wrong type in field: price' END AS error, 'orders' AS "table"
FROM orders
""")
def _(t):
    key = F.col("o_orderkey")
    price = F.when(key % 3 == 0, F.lit("dear")).otherwise(F.col("o_totalprice").cast("string"))
    row = F.to_json(
        F.struct(
            F.when(key % 7 != 0, key).alias("id"),
            price.alias("price"),
            F.when(key % 5 == 0, F.lit("x")).alias("extra"),
        )
    )
    rows = t("orders").select("o_orderkey", row.alias("row"))
    checked = tables.split_rejected(rows, "id long not null, price double", "orders")
    return checked.select("o_orderkey", "error", "table")


@query("sink_message_frame", """
SELECT 'rides' AS topic, CAST(passenger_count AS VARCHAR) AS key, ride_id, epoch_us(ts) AS event_us FROM rides
WHERE ride_status = 'dropoff'
""", uses=("rides",))
def _(t):
    path = scratch_path(t.spark, "sink-log")
    dropped = t.view("rides").where(F.col("ride_status") == "dropoff")
    frame = messages.log_frame(
        dropped, F.col("passenger_count"), F.to_json(F.struct("ride_id", "ride_status")), F.lit("rides"), F.col("ts")
    )
    messages.write_log(frame, path)
    read = t.spark.read.parquet(path)
    return read.select(
        "topic",
        F.decode("key", "UTF-8").alias("key"),
        F.get_json_object(F.decode("value", "UTF-8"), "$.ride_id").alias("ride_id"),
        F.unix_micros("timestamp").alias("event_us"),
    )


@query("sink_dynamic_topic", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 't2' ELSE 't1' END AS topic, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
FROM orders GROUP BY 1
""")
def _(t):
    path = scratch_path(t.spark, "sink-topics")
    topic = F.when(F.col("o_orderkey") % 2 == 0, "t2").otherwise("t1")
    messages.write_log(messages.log_frame(t("orders"), F.col("o_orderkey"), F.col("o_orderstatus"), topic), path)
    read = t.spark.read.parquet(path)
    return read.groupBy("topic").agg(F.count("*").alias("n"), F.sum(F.decode("key", "UTF-8").cast("long")).alias("keys"))


@query("sink_messages_attributes", """
SELECT ride_id AS text, CAST(passenger_count AS VARCHAR) AS passengers,
       CASE WHEN event_id % 2 = 0 THEN 'country' || (event_id % 4) END AS country FROM rides
""", uses=("rides",))
def _(t):
    path = scratch_path(t.spark, "sink-attributes")
    country = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("country"), F.col("event_id") % 4))
    attributes = {"passenger_count": F.col("passenger_count"), "country": country}
    messages.relay(messages.attributed(t.view("rides"), F.col("ride_id"), attributes)).write.parquet(path)
    read = t.spark.read.parquet(path)
    return read.select(
        F.decode("data", "UTF-8").alias("text"),
        F.col("attributes")["passenger_count"].alias("passengers"),
        F.col("attributes")["country"].alias("country"),
    )


@query("wide_cells_write", """
SELECT row_key, family, qualifier, ts_micros,
  CASE WHEN qualifier = 'field0' AND p_size > 25 THEN upper(value) ELSE value END AS value
FROM cells JOIN part ON row_key = printf('row_key%07d', p_partkey)
""", uses=("cells",))
def _(t):
    from millrace.plans.views import CELL_TS_MICROS

    key = F.col("p_partkey")
    updates = stores.set_cells(
        t("part").where("p_size > 25"),
        F.format_string("row_key%07d", key),
        F.lit("cf1"),
        [F.upper("p_name")],
        F.lit(CELL_TS_MICROS) + key * 1_000_000,
    )
    path = scratch_path(t.spark, "sink-cells")
    after = stores.apply_cells(t.view("cells"), updates.withColumn("seq", F.lit(1)), "seq")
    # Sorted by key, so that a key range reads few row groups.
    after.repartitionByRange(*stores.CELL_KEY).sortWithinPartitions(*stores.CELL_KEY).write.parquet(path)
    return t.spark.read.parquet(path)


APPLIED = """
judged AS (SELECT m.*, c.c_custkey IS NOT NULL AS found,
    CASE op WHEN 'insert' THEN c.c_custkey IS NULL WHEN 'update' THEN c.c_custkey IS NOT NULL ELSE true END AS valid
  FROM mutations m LEFT JOIN customer c ON m.id = c.c_custkey)"""

AFTER = """
SELECT coalesce(c.c_custkey, m.id) AS id,
  CASE WHEN m.op IS NULL THEN c_name ELSE m.first END AS first,
  CASE WHEN m.op IS NULL THEN c_mktsegment
       WHEN c.c_custkey IS NOT NULL AND m.op IN ('update', 'insert_or_update') AND NOT m.last_set THEN c_mktsegment
       ELSE m.last END AS last
FROM customer c FULL JOIN (SELECT * FROM {source} WHERE valid) m ON m.id = c.c_custkey
WHERE m.op IS NULL OR m.op <> 'delete'
"""


@query("mutate_apply", f"WITH {APPLIED.strip()} {AFTER.format(source='judged')}", uses=("mutations",))
def _(t):
    judged = stores.judge_mutations(t.view("mutation_target"), t.view("mutations"), "id")
    return stores.apply_mutations(t.view("mutation_target"), judged, "id", {"last": "last_set"})


@query("mutate_grouped", f"""
WITH {APPLIED.strip()}, grouped AS (SELECT * REPLACE (bool_and(valid) OVER (PARTITION BY group_id) AS valid) FROM judged)
{AFTER.format(source='grouped')}
""", uses=("mutations",))
def _(t):
    judged = stores.judge_mutations(t.view("mutation_target"), t.view("mutations"), "id")
    grouped = stores.judge_groups(judged, "group_id", "id")
    return stores.apply_mutations(t.view("mutation_target"), grouped, "id", {"last": "last_set"})


@query("entity_upsert", """
SELECT 'people' AS namespace, md5(name) AS key, name,
       printf('%.1f', CAST(year + CASE WHEN year > 1997 THEN 1 ELSE 0 END AS DOUBLE)) AS year FROM persons
""", uses=("persons",))
def _(t):
    persons = _persons(t)
    year = F.col("year").cast("double")
    existing = stores.entities(persons, F.col("name"), {"name": F.col("name"), "year": year}, "people")
    newer = stores.entities(
        persons.where("year > 1997"), F.col("name"), {"name": F.col("name"), "year": year + 1}, "people"
    )
    after = stores.upsert_entities(existing, newer)
    return after.select(
        "namespace", "key", F.col("properties")["name"].alias("name"), F.col("properties")["year"].alias("year")
    )


@query("sink_documents", "SELECT s_suppkey AS id, s_name AS name FROM supplier")
def _(t):
    path = scratch_path(t.spark, "sink-documents")
    suppliers = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    files.write_text(stores.documents(suppliers), path, "document")
    return t.spark.read.schema("id long, name string").json(path)
