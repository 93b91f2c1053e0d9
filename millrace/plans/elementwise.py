"""Queries of the element-wise operators."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import numbers, text
from millrace.operators import elementwise as E
from millrace.plans.registry import query


@query("map_double_square", """
SELECT p_partkey, p_size * 2 AS doubled, (p_size * 2) * (p_size * 2) AS squared FROM part
""")
def _(t):
    return E.double_and_square(t("part").select("p_partkey", "p_size"), "p_size").drop("p_size")


@query("flatmap_split", r"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split_regex(text, '[ \t\n\x0B\f\r]+')) AS word FROM documents) WHERE word <> '' GROUP BY word
""")
def _(t):
    return E.split_words(t("documents").select("text"), "text").groupBy("word").agg(F.count("*").alias("n"))


@query("flatmap_divisors", """
SELECT p_partkey, p_size AS n, CAST(d AS BIGINT) AS divisor, d || ' divides ' || p_size AS line
FROM part, (SELECT unnest(range(1, 1001)) AS d) WHERE d <= p_size AND p_size % d = 0
""")
def _(t):
    sizes = t("part").select("p_partkey", F.col("p_size").alias("n"))
    return E.explode_divisors(sizes, "n").withColumn("line", F.concat("divisor", F.lit(" divides "), "n"))


@query("filter_predicates", """
SELECT event_id, ride_status, passenger_count, meter_reading FROM rides
WHERE ride_status <> 'enroute' AND passenger_count > 2 AND meter_reading > 10
""", uses=("rides",))
def _(t):
    kept = t.view("rides").where(F.col("ride_status") != "enroute").where("passenger_count > 2")
    return kept.where(F.col("meter_reading") > 10).select("event_id", "ride_status", "passenger_count", "meter_reading")


@query("multi_outputs", """
SELECT o_orderkey AS n, unnest(list_filter([
  CASE WHEN o_orderkey % 3 = 0 THEN 'three' END, CASE WHEN o_orderkey % 5 = 0 THEN 'five' END,
  CASE WHEN o_orderkey % 15 = 0 THEN 'both' END, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END, 'all'],
  lambda x: x IS NOT NULL)) AS tag
FROM orders
""")
def _(t):
    n = F.col("n")
    return E.tagged(
        t("orders").select(F.col("o_orderkey").alias("n")),
        {
            "three": n % 3 == 0,
            "five": n % 5 == 0,
            "both": n % 15 == 0,
            "even": n % 2 == 0,
            "odd": n % 2 != 0,
            "all": F.lit(True),
        },
    )


class _BufferUntilFinish(E.PartitionFn):
    """Holds a batch and gives its rows out at the end of the batch with time zero."""

    def setup(self):
        self.held = None

    def process(self, batch: pd.DataFrame):
        self.held = batch
        return None

    def finish_batch(self):
        return self.held.assign(emitted_us=0)


@query("pardo_lifecycle", "SELECT event_id, user_id, CAST(0 AS BIGINT) AS emitted_us FROM events")
def _(t):
    rows = t("events").select("event_id", "user_id")
    return E.map_partitions(rows, _BufferUntilFinish, "event_id long, user_id long, emitted_us long")


@query("reshuffle", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(t):
    return E.redistribute(t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))


@query("flatten_union", """
SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
UNION ALL SELECT c_custkey, c_name FROM customer
""")
def _(t):
    customers = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return E.union_all(customers, suppliers, customers)


@query("flatten_iterables", """
SELECT vec_id, round(CAST(unnest(embedding) AS DOUBLE), 6) AS item FROM embeddings
""")
def _(t):
    flat = E.flatten_arrays(t("embeddings").select("vec_id", "embedding"), "embedding")
    return flat.withColumn("item", F.round(F.col("item").cast("double"), 6))


@query("json_decode_drop_bad", """
SELECT message_id, ride_id, ride_status, meter_reading, passenger_count FROM messages WHERE NOT malformed
""", uses=("rides", "messages"))
def _(t):
    from millrace.plans.views import RIDE_JSON_SCHEMA

    decoded = E.decode_json(t.view("messages"), "data", RIDE_JSON_SCHEMA, ["ride_id", "ride_status"])
    return decoded.select("message_id", "ride_id", "ride_status", "meter_reading", "passenger_count")


@query("parse_delimited", "SELECT c_custkey, name, year, country, grp FROM persons", uses=("persons",))
def _(t):
    fields = {"name": "string", "year": "int", "country": "string", "grp": "string"}
    return E.parse_delimited(t.view("person_lines"), "value", fields)


@query("map_to_fields", """
SELECT ride_id AS id, upper(ride_status) AS name, meter_reading AS reading, passenger_count + 1 AS seats FROM rides
""", uses=("rides",))
def _(t):
    return E.map_to_fields(
        t.view("rides"),
        {"id": "ride_id", "name": F.upper("ride_status"), "reading": "meter_reading", "seats": "passenger_count + 1"},
    )


@query("kv_pairs", "SELECT ride_status AS key, event_id AS value FROM rides", uses=("rides",))
def _(t):
    return E.key_by(t.view("rides"), F.col("ride_status"), F.col("event_id"))


@query("word_count", r"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_'']+')) AS word FROM documents) GROUP BY word
""")
def _(t):
    return t("documents").transform(E.word_count, "text")


@query("word_count_letters", r"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(string_split_regex(text, '[^\p{L}]+')) AS word FROM documents) WHERE word <> '' GROUP BY word
""")
def _(t):
    return t("documents").transform(E.word_count, "text", letters_only=True)


@query("apply_transform_count", """
SELECT CAST(o_orderkey % 2 AS BIGINT) AS key, count(*) AS n FROM orders GROUP BY 1
""")
def _(t):
    from millrace.operators.aggregate import count_per_key

    keyed = t("orders").select((F.col("o_orderkey") % 2).alias("key"))
    return keyed.transform(count_per_key, ["key"])


@query("template_filter_count", """
SELECT 'strict' AS comparison, count(*) AS n FROM customer WHERE CAST(trunc(abs(c_acctbal)) AS BIGINT) > 5000
UNION ALL SELECT 'inclusive', count(*) FROM customer WHERE CAST(trunc(abs(c_acctbal)) AS BIGINT) >= 5000
UNION ALL SELECT 'all', count(*) FROM customer
""")
def _(t):
    population = t("customer").select(F.abs("c_acctbal").cast("long").alias("population"))
    return E.count_comparisons(population, "population", 5000)


@query("custom_metrics", """
SELECT count(*) FILTER (ride_status = 'pickup') AS pickups, count(*) FILTER (ride_status = 'dropoff') AS dropoffs,
  count(*) FILTER (ride_status = 'enroute') AS enroutes,
  CAST(sum(CASE ride_status WHEN 'pickup' THEN 1 WHEN 'dropoff' THEN -1 ELSE 0 END * passenger_count) AS BIGINT) AS net_people,
  count(*) FILTER (ride_status = 'dropoff') AS cost_count,
  CAST(sum(CAST(trunc(meter_reading * 1000) AS BIGINT)) FILTER (ride_status = 'dropoff') AS BIGINT) AS cost_sum,
  min(CAST(trunc(meter_reading * 1000) AS BIGINT)) FILTER (ride_status = 'dropoff') AS cost_min,
  max(CAST(trunc(meter_reading * 1000) AS BIGINT)) FILTER (ride_status = 'dropoff') AS cost_max
FROM rides
""", uses=("rides",))
def _(t):
    return t.view("rides").agg(*E.metric_columns("ride_status", "passenger_count", "meter_reading"))


@query("prime_label", """
SELECT p_partkey, p_size, CASE WHEN p_size > 1 AND NOT EXISTS (
    SELECT 1 FROM (SELECT unnest(range(2, 1001)) AS d) WHERE d < p_size AND p_size % d = 0)
  THEN 'prime' ELSE 'not-prime' END AS label
FROM part
""")
def _(t):
    label = F.when(numbers.is_prime(F.col("p_size")), "prime").otherwise("not-prime")
    return t("part").select("p_partkey", "p_size", label.alias("label"))


@query("render_text", """
SELECT o_orderkey, printf('Key %d: %s costs %.2f', o_orderkey, o_orderpriority, o_totalprice) AS line,
       concat_ws(', ', o_orderstatus, o_orderpriority, CAST(o_custkey AS VARCHAR)) AS joined
FROM orders
""")
def _(t):
    return t("orders").select(
        "o_orderkey",
        F.format_string("Key %d: %s costs %.2f", "o_orderkey", "o_orderpriority", "o_totalprice").alias("line"),
        F.concat_ws(", ", "o_orderstatus", "o_orderpriority", F.col("o_custkey").cast("string")).alias("joined"),
    )


@query("regex_validate", """
SELECT page_id, regexp_full_match(path, 'gs://.*/.*') AS ok FROM (
  SELECT page_id, CASE page_id % 3 WHEN 0 THEN replace(url, 'http:', 'gs:')
    WHEN 1 THEN 'see ' || replace(url, 'http:', 'gs:') ELSE url END AS path FROM pages)
""")
def _(t):
    stored = F.replace("url", F.lit("http:"), F.lit("gs:"))
    path = (
        F.when(F.col("page_id") % 3 == 0, stored)
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit("see "), stored))
        .otherwise(F.col("url"))
    )
    return t("pages").select("page_id", text.matches_whole(path, text.STORAGE_PATH_PATTERN).alias("ok"))
