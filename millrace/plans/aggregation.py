"""Queries of the aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregate as A
from millrace.operators import elementwise as E
from millrace.plans.registry import query


@query("agg_count_global", "SELECT count(*) AS n FROM lineitem")
def _(t):
    return A.count_global(t("lineitem"))


@query("agg_count_per_key", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t):
    return A.count_per_key(t("lineitem"), ["l_returnflag", "l_linestatus"])


@query("agg_mean_global", "SELECT round(avg(l_quantity), 4) AS mean FROM lineitem")
def _(t):
    return A.mean_global(t("lineitem"), "l_quantity").select(F.round("mean", 4).alias("mean"))


@query("agg_top_n", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def _(t):
    largest = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return A.top_n(t("orders").select("o_orderkey", "o_totalprice"), 5, largest)


@query("agg_reduce_global", """
SELECT CAST(sum(p_size) AS BIGINT) AS total,
  (SELECT string_agg(p_brand, '. ' ORDER BY p_brand) FROM (SELECT DISTINCT p_brand FROM part)) AS brands
FROM part
""")
def _(t):
    per_brand = t("part").groupBy("p_brand").agg(F.sum("p_size").alias("size"))
    return per_brand.agg(
        F.sum("size").alias("total"), F.expr("listagg(p_brand, '. ') within group (order by p_brand)").alias("brands")
    )


@query("agg_join_per_key", """
SELECT p_brand, chunk, string_agg(p_name, '. ' ORDER BY p_name, p_partkey) AS text FROM (
  SELECT *, (row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) - 1) // 50 AS chunk FROM part)
GROUP BY p_brand, chunk
""")
def _(t):
    return A.join_values(t("part"), ["p_brand"], "p_name", ". ", ["p_name", "p_partkey"], chunk_rows=50)


def _numbers(t):
    """The distinct order keys."""
    return t("orders").where("o_orderkey > 0").select(F.col("o_orderkey").alias("n")).distinct()


_PROPER = """
WITH n AS (SELECT DISTINCT o_orderkey AS n FROM orders WHERE o_orderkey > 0),
low AS (SELECT n, d FROM (SELECT n, unnest(range(1, CAST(floor(sqrt(n)) AS BIGINT) + 1)) AS d FROM n) WHERE n % d = 0),
d AS (SELECT n, d FROM low UNION SELECT n, n // d FROM low)
"""


@query("agg_perfect_numbers", _PROPER + """
SELECT n, CAST(sum(d) AS BIGINT) AS divisor_sum FROM d GROUP BY n HAVING sum(d) = 2 * n
""")
def _(t):
    pairs = E.explode_divisors(_numbers(t), "n")
    sums = A.sum_per_key(pairs, ["n"], "divisor", "divisor_sum")
    return sums.where(F.col("divisor_sum") == 2 * F.col("n"))


@query("agg_combinefn_mean", """
SELECT l_returnflag, round(avg(l_quantity), 4) AS mean FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'all', round(avg(l_quantity), 4) FROM lineitem
""")
def _(t):
    rows = t("lineitem").select("l_returnflag", "l_quantity")
    keyed = A.combine_columns(rows, ["l_returnflag"], "l_quantity", A.MEAN_BY_COLUMNS, "mean")
    overall = A.combine_columns(rows, [], "l_quantity", A.MEAN_BY_COLUMNS, "mean").withColumn("l_returnflag", F.lit("all"))
    return keyed.unionByName(overall).withColumn("mean", F.round("mean", 4))


@query("agg_aggregate_by_key", _PROPER + "SELECT n, CAST(sum(d) AS BIGINT) AS divisor_sum FROM d GROUP BY n")
def _(t):
    pairs = E.explode_divisors(_numbers(t), "n")
    return A.combine_columns(pairs, ["n"], "divisor", A.SUM_FROM_ZERO, "divisor_sum")


@query("agg_combinefn_python", """
SELECT l_linestatus, round(avg(l_extendedprice), 4) AS mean, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem GROUP BY l_linestatus
""")
def _(t):
    """Combiners whose add and merge are Python functions, for accumulators that columns cannot say."""
    rows = t("lineitem").select("l_linestatus", "l_extendedprice", "l_linenumber")
    means = A.combine_per_key(rows, ["l_linestatus"], "l_extendedprice", A.MEAN, "mean").withColumn("mean", F.round("mean", 4))
    lines = A.aggregate_by_key(
        rows, ["l_linestatus"], "l_linenumber", 0, lambda acc, d: acc + int(d), lambda a, b: a + b, "bigint", "lines"
    )
    return means.join(lines, "l_linestatus")


@query("agg_sum_per_key", """
SELECT ride_status, CAST(sum(passenger_count) AS BIGINT) AS total, round(sum(meter_reading), 4) AS cost
FROM rides GROUP BY ride_status
""", uses=("rides",))
def _(t):
    return t.view("rides").groupBy("ride_status").agg(
        F.sum("passenger_count").alias("total"), F.round(F.sum("meter_reading"), 4).alias("cost")
    )


@query("agg_group_by_key", """
SELECT p_brand, chunk, p_brand || ': ' || string_agg(p_name, ', ' ORDER BY p_name, p_partkey) || ', etc.' AS line
FROM (SELECT *, (row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) - 1) // 50 AS chunk FROM part)
GROUP BY p_brand, chunk
""")
def _(t):
    return A.render_groups(t("part"), ["p_brand"], "p_name", ["p_name", "p_partkey"], chunk_rows=50)


@query("agg_sample_per_key", """
SELECT ride_status, passenger_count, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY ride_status, passenger_count
                               ORDER BY event_id * 7919 % 10007, event_id) AS rn FROM rides) WHERE rn <= 3
""", uses=("rides",))
def _(t):
    mixed = [F.pmod(F.col("event_id") * 7919, F.lit(10007)), F.col("event_id")]
    rows = t.view("rides").select("ride_status", "passenger_count", "event_id")
    return A.sample_per_key(rows, ["ride_status", "passenger_count"], mixed, 3)


@query("sql_agg_ratios", """
SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 4) AS avg_quantity,
  round(sum(l_extendedprice), 2) AS sum_price, epoch_us(max(l_shipdate)) AS last_us,
  round(avg(nullif(l_discount, 0)) / avg(l_tax), 6) AS ratio_of_avgs,
  round(sum(nullif(l_discount, 0)) / sum(l_tax), 6) AS ratio_of_sums
FROM lineitem GROUP BY l_returnflag
""")
def _(t):
    return t.spark.sql(
        """
        SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 4) AS avg_quantity,
          round(sum(l_extendedprice), 2) AS sum_price, unix_micros(cast(max(l_shipdate) AS timestamp)) AS last_us,
          round(try_divide(avg(nullif(l_discount, 0)), avg(l_tax)), 6) AS ratio_of_avgs,
          round(try_divide(sum(nullif(l_discount, 0)), sum(l_tax)), 6) AS ratio_of_sums
        FROM {lineitem} GROUP BY l_returnflag
        """,
        lineitem=t("lineitem"),
    )
