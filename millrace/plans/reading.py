"""Queries of the sources. Files to read are first derived from the tables, in a new shared folder."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from millrace.operators import elementwise as E
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import avro, files, jdbc, messages, stores, tables, tfrecord


@query("src_create", "SELECT CAST(o_orderkey AS BIGINT) AS n, o_orderstatus FROM orders")
def _(t):
    """Created numbers, looked up among the orders."""
    last = t("orders").agg(F.max("o_orderkey")).first()[0]
    numbers = E.create_range(t.spark, (last or 0) + 1)
    return numbers.join(t("orders"), F.col("n") == F.col("o_orderkey")).select("n", "o_orderstatus")


@query("src_create_params", """
SELECT event_type, label, extra, count(*) AS n FROM events
JOIN (VALUES ('purchase', 'dropoff'), ('signup', 'pickup'), ('view', 'enroute')) v(event_type, label) USING (event_type),
     (VALUES (10), (1729)) x(extra)
GROUP BY ALL
""")
def _(t):
    labels = E.create_rows(
        t.spark,
        [("purchase", "dropoff"), ("signup", "pickup"), ("view", "enroute")],
        "event_type string, label string",
    )
    extras = E.create_rows(t.spark, [(10,)], "extra int").unionByName(
        E.create_range(t.spark, 0, 1729).select(F.col("n").cast("int").alias("extra"))
    )
    counted = t("events").groupBy("event_type").agg(F.count("*").alias("n"))
    labelled = counted.join(F.broadcast(labels), "event_type")
    from millrace.operators.joins import each_with_all

    return each_with_all(labelled, extras).select("event_type", "label", "extra", "n")


@query("src_text_lines", "SELECT line, count(*) AS n FROM lines GROUP BY line", uses=("lines",))
def _(t):
    path = scratch_path(t.spark, "text")
    t("documents").select("text").write.option("lineSep", "\n").text(path)
    lines = files.read_text(t.spark, path)
    return lines.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query("src_text_read_all", """
SELECT part, count(*) AS n FROM (SELECT doc_id % 4 AS part, unnest(string_split(text, chr(10))) FROM documents) GROUP BY part
""")
def _(t):
    path = scratch_path(t.spark, "text-parts")
    parts = t("documents").select((F.col("doc_id") % 4).alias("part"), "text")
    parts.write.partitionBy("part").option("lineSep", "\n").text(path)
    # Two paths and one glob in one request.
    lines = files.read_all_text(t.spark, [f"{path}/part=0", f"{path}/part=1", f"{path}/part=[23]"])
    part = F.regexp_extract("path", "part=([0-9]+)", 1).cast("long")
    return lines.groupBy(part.alias("part")).agg(F.count("*").alias("n"))


@query("src_match_files", """
SELECT lang, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents GROUP BY lang
""")
def _(t):
    path = scratch_path(t.spark, "text-by-lang")
    t("documents").select("lang", "text").write.partitionBy("lang").option("lineSep", "\n").text(path)
    found = files.match_files(t.spark, path)
    return found.groupBy(F.regexp_extract("path", "lang=([^/]+)", 1).alias("lang")).agg(F.sum("length").alias("bytes"))


@query("src_csv", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def _(t):
    path = scratch_path(t.spark, "csv")
    people = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    people.write.csv(path, header=True)
    return files.read_csv(t.spark, path, "id long, name string, balance double")


@query("src_json_multiline", "SELECT c_custkey AS id, c_name AS name FROM customer")
def _(t):
    path = scratch_path(t.spark, "json-documents")
    block = F.floor(F.col("c_custkey") / 50_000).cast("long").alias("block")
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    arrays = t("customer").groupBy(block).agg(F.to_json(F.collect_list(record)).alias("value"))
    # A file is one document.
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    read = files.read_json_document(t.spark, path, "id long, name string")
    return read.select("id", "name")


@query("src_avro_projected", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    """Whole orders in Avro files; the reader's schema keeps two fields."""
    path = scratch_path(t.spark, "records")
    avro.write_avro(t("orders"), path)
    kept = {
        "type": "record",
        "name": "Row",
        "fields": [{"name": "o_orderkey", "type": ["null", "long"]}, {"name": "o_orderstatus", "type": ["null", "string"]}],
    }
    return avro.read_avro(t.spark, path, reader_schema=json.dumps(kept))


@query("src_parquet", "SELECT p_partkey, p_name, p_retailprice FROM part")
def _(t):
    return files.read_records(t.spark, f"{t.directory}/part.parquet", ["p_partkey", "p_name", "p_retailprice"])


@query("src_tfrecord", "SELECT c_name || '|' || c_mktsegment AS text FROM customer")
def _(t):
    tfrecord.register(t.spark)
    path = scratch_path(t.spark, "tfrecord")
    record = F.encode(F.concat("c_name", F.lit("|"), "c_mktsegment"), "UTF-8").alias("record")
    t("customer").select(record).write.format("tfrecord").mode("append").save(path)
    read = t.spark.read.format("tfrecord").load(path)
    return read.select(F.decode("record", "UTF-8").alias("text"))


def _jdbc_customers(t):
    """Customers in a new table of the configured database."""
    from millrace.sinks import jdbc as jdbc_sink

    url, table = jdbc.configured_url(t.spark), f"customer_{uuid.uuid4().hex[:12]}"
    people = t("customer").select("c_custkey", "c_name", "c_acctbal")
    jdbc_sink.append(people, url, table, properties={"createTableColumnTypes": "c_name VARCHAR(64)"})
    return url, table


@query("src_jdbc", """
SELECT c_custkey || ': ' || c_name AS line, 'table' AS kind FROM customer
UNION ALL SELECT c_custkey || ': ' || c_name, 'query' FROM customer WHERE c_acctbal > 5000
""")
def _(t):
    url, table = _jdbc_customers(t)
    line = F.concat("c_custkey", F.lit(": "), "c_name").alias("line")
    whole = jdbc.read_table(t.spark, url, table).select(line, F.lit("table").alias("kind"))
    rich = jdbc.read_query(t.spark, url, f'SELECT * FROM {table} WHERE "c_acctbal" > 5000')
    return whole.unionByName(rich.select(line, F.lit("query").alias("kind")))


@query("src_jdbc_partitioned", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    url, table = _jdbc_customers(t)
    return jdbc.read_partitioned(t.spark, url, table, "c_custkey", rows_per_range=4000)


@query("src_jdbc_uneven", """
SELECT CASE WHEN c_custkey % 10 = 0 THEN c_custkey * 1000003 ELSE c_custkey END AS id, c_name AS name FROM customer
""")
def _(t):
    """Ids of which nine in ten lie close together and the others far apart, read in ranges of as many rows."""
    from millrace.sinks import jdbc as jdbc_sink

    url, table = jdbc.configured_url(t.spark), f"uneven_{uuid.uuid4().hex[:12]}"
    key = F.col("c_custkey")
    people = t("customer").select(F.when(key % 10 == 0, key * 1000003).otherwise(key).alias("id"), F.col("c_name").alias("name"))
    jdbc_sink.append(people, url, table, properties={"createTableColumnTypes": "name VARCHAR(64)"})
    return jdbc.read_even(t.spark, url, table, "id", rows_per_range=500)


def _saved_orders(t, columns):
    """Orders as a catalog table of a new name, stored in the shared folder."""
    name = f"orders_{uuid.uuid4().hex[:12]}"
    t("orders").select(*columns).write.option("path", scratch_path(t.spark, "table")).saveAsTable(name)
    return name


@query("src_table", """
SELECT reference, o_orderkey, o_orderstatus FROM orders, (VALUES ('name'), ('parts')) r(reference)
""")
def _(t):
    name = _saved_orders(t, ["o_orderkey", "o_orderstatus"])
    parts = (t.spark.catalog.currentCatalog(), t.spark.catalog.currentDatabase(), name)
    by_name = tables.read_table(t.spark, name).withColumn("reference", F.lit("name"))
    return by_name.unionByName(tables.read_table(t.spark, *parts).withColumn("reference", F.lit("parts")))


@query("src_typed_table", "SELECT o_orderkey AS station_id, o_orderstatus AS status FROM orders")
def _(t):
    stations = t("orders").select(F.col("o_orderkey").cast("int").alias("station_id"), F.col("o_orderstatus").alias("status"), "o_totalprice")
    return tables.read_typed(stations, "station_id long, status string")


@query("src_sql_query", """
SELECT c_mktsegment AS home, year(o_orderdate) AS year, round(avg(o_totalprice), 2) AS attendance
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 HAVING avg(o_totalprice) > 240000
""")
def _(t):
    averaged = tables.read_query(
        t.spark,
        """SELECT c_mktsegment AS home, year(o_orderdate) AS year, avg(o_totalprice) AS attendance
           FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2""",
        orders=t("orders"),
        customer=t("customer"),
    )
    return averaged.where(F.col("attendance") > 240000).withColumn("year", F.col("year").cast("long")).withColumn(
        "attendance", F.round("attendance", 2)
    )


@query("src_read_all_requests", """
SELECT 'by_status' AS request_id, o_orderstatus AS k, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'by_priority', o_orderpriority, count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'nations', n_name, n_nationkey FROM nation
""")
def _(t):
    requests = [
        ("by_status", "query", "SELECT o_orderstatus AS k, count(*) AS n FROM {orders} GROUP BY 1"),
        ("by_priority", "query", "SELECT o_orderpriority AS k, count(*) AS n FROM {orders} GROUP BY 1"),
        ("nations", "table", "nations"),
    ]
    nations = t("nation").select(F.col("n_name").alias("k"), F.col("n_nationkey").alias("n"))
    merged = tables.read_all(t.spark, requests, orders=t("orders"), nations=nations)
    return merged.select("request_id", F.from_json("row", "k string, n long").alias("r")).select("request_id", "r.*")


@query("src_pushdown_scan", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_shipdate > TIMESTAMP '1996-06-01' AND l_returnflag = 'A'
""")
def _(t):
    restriction = "l_shipdate > timestamp_ntz '1996-06-01 00:00:00' AND l_returnflag = 'A'"
    return tables.scan_pushed_down(t("lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"], restriction)


@query("src_message_log", """
SELECT topic, key, value, partition, "offset" FROM records
""", uses=("records",))
def _(t):
    return messages.decoded(t.view("records")).select("topic", "key", "value", "partition", "offset")


@query("src_bad_record_handler", """
SELECT value, CAST(1 AS BIGINT) AS n, 'good' AS kind FROM records WHERE value IS NULL OR contains(value, 'kafka_')
UNION ALL SELECT NULL, count(*), 'bad' FROM records WHERE NOT contains(value, 'kafka_')
""", uses=("records",))
def _(t):
    marked = messages.with_bad_records(t.view("records"))
    good = messages.decoded(messages.good_records(marked)).select("value", F.lit(1).cast("long").alias("n"), F.lit("good").alias("kind"))
    bad = messages.count_bad_records(marked).select(F.lit(None).cast("string").alias("value"), "n", F.lit("bad").alias("kind"))
    return good.unionByName(bad)


@query("src_messages_attributes", """
SELECT message_id, s.source, (epoch_us(ts) // 1000) * 1000 AS event_us,
  CASE WHEN age IS NOT NULL AND country IS NOT NULL THEN 'age ' || age || ' from ' || country
       WHEN age IS NOT NULL THEN 'age ' || age WHEN country IS NOT NULL THEN 'from ' || country
       ELSE 'no attributes' END AS line
FROM messages, (VALUES ('first'), ('second')) s(source)
""", uses=("rides", "messages"))
def _(t):
    merged = messages.union_sources({"first": t.view("messages"), "second": t.view("messages")})
    timed = messages.with_event_time(merged)
    line = messages.greeting(F.col("attributes")["age"], F.col("attributes")["country"])
    return timed.select("message_id", "source", F.unix_micros("event_time").alias("event_us"), line.alias("line"))


@query("src_dead_letter_parse", """
SELECT event_id, payload, CASE WHEN contains(payload, 'id=') THEN 'main' ELSE 'dead_letter' END AS output FROM (
  SELECT event_id, CASE WHEN event_id % 13 = 0 THEN event_type ELSE 'id=' || user_id || ' ' || event_type END AS payload
  FROM events)
""")
def _(t):
    whole = F.concat(F.lit("id="), "user_id", F.lit(" "), "event_type")
    payload = F.when(F.col("event_id") % 13 == 0, F.col("event_type")).otherwise(whole)
    rows = t("events").select("event_id", payload.alias("payload"))
    return messages.split_dead_letters(rows, F.col("payload").contains("id="))


@query("dedup_by_uuid", "SELECT DISTINCT message_id, ride_id FROM messages WHERE NOT malformed", uses=("rides", "messages"))
def _(t):
    unique = messages.drop_repeated(t.view("messages"), ["message_id"])
    from millrace.plans.views import RIDE_JSON_SCHEMA

    return E.decode_json(unique, "data", RIDE_JSON_SCHEMA, ["ride_id"]).select("message_id", "ride_id")


@query("wide_cells_render", """
SELECT row_key, CAST(0 AS BIGINT) AS chunk, string_agg(family || ':' || qualifier || '=' || value || ' @ ' ||
  strftime(make_timestamp(ts_micros), '%Y/%m/%d %H:%M:%S'), '; ' ORDER BY family, qualifier, ts_micros DESC) AS text
FROM cells GROUP BY row_key
""", uses=("cells",))
def _(t):
    return stores.render_rows(t.view("cells"))


@query("wide_key_range_regex", """
SELECT row_key, qualifier, value FROM cells
WHERE row_key >= 'row_key0000100' AND row_key < 'row_key9' AND contains(row_key, 'row_key')
  AND regexp_full_match(value, '.*a.*')
""", uses=("cells",))
def _(t):
    kept = stores.filter_cells(t.view("cells"), "row_key0000100", "row_key9", ".*a.*", "row_key")
    return kept.select("row_key", "qualifier", "value")


@query("src_snapshot_read", """
SELECT 'query' AS reader, c_custkey, c_name FROM customer
UNION ALL SELECT 'table', c_custkey, c_name FROM customer
""")
def _(t):
    path = scratch_path(t.spark, "snapshot")
    people = t("customer").select("c_custkey", "c_name", "c_acctbal")
    people.write.parquet(path)
    now = tables.pinned(t.spark, path)
    # Rows that come later do not show in readers of the snapshot.
    people.withColumn("c_name", F.lit("later")).write.mode("append").parquet(path)
    by_query = tables.read_query(t.spark, "SELECT 'query' AS reader, c_custkey, c_name FROM {c}", c=now)
    return by_query.unionByName(now.select(F.lit("table").alias("reader"), "c_custkey", "c_name"))


@query("entity_properties_render", """
SELECT s_suppkey, s_suppkey || ' {key: ' || s_suppkey || ', name: ' || s_name || ', nation: ' || s_nationkey || '}' AS line
FROM supplier
""")
def _(t):
    properties = F.create_map(
        F.lit("name"), "s_name", F.lit("nation"), F.col("s_nationkey").cast("string"), F.lit("key"), F.col("s_suppkey").cast("string")
    )
    return stores.render_entities(t("supplier").select("s_suppkey", properties.alias("p")), "s_suppkey", "p")


@query("src_documents", "SELECT c_custkey AS id, c_name AS name FROM customer")
def _(t):
    document = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment"))
    return stores.parse_documents(t("customer").select(document.alias("document")), "document", "id long, name string")
