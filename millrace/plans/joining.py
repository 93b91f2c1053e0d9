"""Queries of joins and side inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import joins as J
from millrace.plans.registry import query


def _orders(t):
    return t("orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey", "o_orderstatus", "o_totalprice")


def _customers(t):
    return t("customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")


@query("join_cogroup", """
WITH o AS (SELECT o_custkey AS custkey, (rn - 1) // 8 AS chunk,
             string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS orders, count(*) AS n_orders
           FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1, 2),
c AS (SELECT c_custkey AS custkey, CAST(0 AS BIGINT) AS chunk, c_name AS names FROM customer)
SELECT custkey, chunk, coalesce(orders, '') AS orders, coalesce(n_orders, 0) AS n_orders, coalesce(names, '') AS names
FROM o FULL JOIN c USING (custkey, chunk)
""")
def _(t):
    inputs = {
        "orders": (_orders(t), "o_orderkey", ["o_orderkey"]),
        "names": (_customers(t), "c_name", ["c_name"]),
    }
    grouped = J.cogroup(inputs, "custkey", chunk_rows=8)
    return grouped.select(
        "custkey",
        "chunk",
        F.array_join(F.col("orders").cast("array<string>"), ",").alias("orders"),
        F.size("orders").cast("long").alias("n_orders"),
        F.array_join("names", ",").alias("names"),
    )


@query("join_inner", """
SELECT o_orderkey, c_name || ' ordered ' || o_orderkey AS line FROM orders JOIN customer ON o_custkey = c_custkey
""")
def _(t):
    joined = J.inner_join(_orders(t), _customers(t), "custkey")
    return joined.select("o_orderkey", F.concat("c_name", F.lit(" ordered "), "o_orderkey").alias("line"))


# Order keys that miss some customers and meet none, so that both sides have rows without a partner.
SHIFTED = "(SELECT CASE WHEN o_orderkey % 7 = 0 THEN -o_custkey ELSE o_custkey - o_custkey % 2 END AS o_custkey, o_orderkey FROM orders)"


def _shifted(t):
    key, number = F.col("custkey"), F.col("o_orderkey")
    return _orders(t).select(F.when(number % 7 == 0, -key).otherwise(key - key % 2).alias("custkey"), number)


@query("join_left_outer", f"""
SELECT c_custkey AS custkey, o_orderkey,
  CASE WHEN o_orderkey IS NULL THEN c_name || ' has no order' ELSE c_name || ' ordered ' || o_orderkey END AS line
FROM customer LEFT JOIN {SHIFTED} ON o_custkey = c_custkey
""")
def _(t):
    joined = J.left_join(_customers(t), _shifted(t), "custkey")
    line = F.when(F.col("o_orderkey").isNull(), F.concat("c_name", F.lit(" has no order"))).otherwise(
        F.concat("c_name", F.lit(" ordered "), "o_orderkey")
    )
    return joined.select("custkey", "o_orderkey", line.alias("line"))


@query("join_full_outer", f"""
SELECT coalesce(o_custkey, c_custkey) AS custkey, o_orderkey, c_name,
  CASE WHEN o_orderkey IS NULL THEN 'customer only' WHEN c_name IS NULL THEN 'order only' ELSE 'both' END AS side
FROM {SHIFTED} FULL JOIN customer ON o_custkey = c_custkey
""")
def _(t):
    side = F.when(F.col("o_orderkey").isNull(), "customer only").when(F.col("c_name").isNull(), "order only")
    joined = J.full_join(_shifted(t), _customers(t).select("custkey", "c_name"), "custkey")
    return joined.select("custkey", "o_orderkey", "c_name", side.otherwise("both").alias("side"))


def _names_and_jobs(t):
    names = t("customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("family"))
    jobs = (
        t("orders")
        .groupBy((F.col("o_custkey") - F.col("o_custkey") % 2).alias("custkey"))
        .agg(F.count("*").alias("job"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("salary"))
    )
    return {"names": names, "jobs": jobs}


JOBS = """jobs AS (SELECT o_custkey - o_custkey % 2 AS custkey, count(*) AS job,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS salary FROM orders GROUP BY 1)"""


@query("sql_left_join", f"WITH {JOBS} SELECT c_name AS name, job FROM customer LEFT JOIN jobs ON c_custkey = custkey")
def _(t):
    return t.spark.sql(
        "SELECT names.name, jobs.job FROM {names} names LEFT JOIN {jobs} jobs ON names.c_custkey = jobs.custkey",
        **_names_and_jobs(t),
    )


@query("sql_left_join_group", f"""
WITH {JOBS} SELECT c_mktsegment AS family, CAST(sum(salary) AS BIGINT) AS salary
FROM customer LEFT JOIN jobs ON c_custkey = custkey GROUP BY 1
""")
def _(t):
    return t.spark.sql(
        """SELECT names.family, sum(jobs.salary) AS salary
           FROM {names} names LEFT JOIN {jobs} jobs ON names.c_custkey = jobs.custkey GROUP BY names.family""",
        **_names_and_jobs(t),
    )


def _amounts(t):
    return t("orders").select("o_orderkey", F.col("o_orderpriority").alias("currency"), F.col("o_totalprice").alias("amount"))


def _rates(t, leave_out=None):
    """One rate per priority, from its share of the orders."""
    counted = t("orders").groupBy(F.col("o_orderpriority").alias("currency")).agg(F.count("*").alias("n"))
    rates = counted.select("currency", (F.col("n") % 100 / 100.0 + 0.5).alias("rate"))
    return rates.where(F.col("currency") != leave_out) if leave_out else rates


RATES = "rates AS (SELECT o_orderpriority AS currency, count(*) % 100 / 100.0 + 0.5 AS rate FROM orders GROUP BY 1)"


@query("side_map_join", f"""
WITH {RATES} SELECT o_orderkey, round(o_totalprice * rate, 4) AS converted
FROM orders JOIN rates ON currency = o_orderpriority
""")
def _(t):
    rated = J.map_side_input(_amounts(t), _rates(t), "currency", "rate")
    return rated.select("o_orderkey", F.round(F.col("amount") * F.col("rate"), 4).alias("converted"))


@query("side_map_default", f"""
WITH {RATES} SELECT o_orderkey, round(o_totalprice * coalesce(rate, 1.0), 4) AS converted
FROM orders LEFT JOIN (SELECT * FROM rates WHERE currency <> '5-LOW') ON currency = o_orderpriority
""")
def _(t):
    rated = J.map_side_input(_amounts(t), _rates(t, "5-LOW"), "currency", "rate", F.lit(1.0))
    return rated.select("o_orderkey", F.round(F.col("amount") * F.col("rate"), 4).alias("converted"))


@query("side_iter_cross", """
SELECT p_partkey, p_name || ' in ' || r_name AS line FROM part, region
""")
def _(t):
    """The side is the fixed list of the five regions."""
    pairs = J.each_with_all(t("part").select("p_partkey", "p_name"), t("region").select("r_name"))
    return pairs.select("p_partkey", F.concat("p_name", F.lit(" in "), "r_name").alias("line"))


@query("side_singleton", """
SELECT o_orderkey, o_totalprice - (SELECT min(o_totalprice) FROM orders) AS above FROM orders
""")
def _(t):
    lowest = t("orders").agg(F.min("o_totalprice").alias("lowest"))
    marked = J.singleton_side_input(t("orders"), lowest, "lowest", "lowest")
    return marked.select("o_orderkey", (F.col("o_totalprice") - F.col("lowest")).alias("above"))
