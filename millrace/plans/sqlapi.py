"""Queries of the SQL surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import elementwise as E
from millrace.operators import sqlapi as S
from millrace.plans.registry import query


@query("sql_group_count", "SELECT count(*) AS n, year, country FROM persons GROUP BY year, country", uses=("persons",))
def _(t):
    fields = {"name": "string", "year": "int", "country": "string", "grp": "string"}
    persons = E.parse_delimited(t.view("person_lines"), "value", fields)
    return S.sql_over(persons, "SELECT COUNT(*) AS n, year, country FROM rows GROUP BY year, country")


@query("sql_named_inputs", """
SELECT c_mktsegment AS family, o_orderpriority AS job, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
""")
def _(t):
    names = t("customer").select("c_custkey", F.col("c_mktsegment").alias("family"))
    jobs = t("orders").select("o_custkey", F.col("o_orderpriority").alias("job"))
    return S.sql_over_named(
        t.spark,
        """SELECT Names.family, Jobs.job, COUNT(*) AS n
           FROM Names JOIN Jobs ON Names.c_custkey = Jobs.o_custkey GROUP BY Names.family, Jobs.job""",
        {"Names": names, "Jobs": jobs},
    )


@query("sql_tumble", """
SELECT epoch_us(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')) AS period_us,
       CAST(sum(passenger_count) AS BIGINT) AS passengers
FROM rides WHERE ride_status = 'dropoff' GROUP BY 1
""", uses=("rides",))
def _(t):
    t.view("rides").createOrReplaceTempView("rides")
    return t.spark.sql(
        """SELECT unix_micros(window.start) AS period_us, sum(passenger_count) AS passengers
           FROM rides WHERE ride_status = 'dropoff' GROUP BY window(ts, '6 hours')"""
    )


@query("sql_hop", """
SELECT epoch_us(start) AS start_us, epoch_us(start + INTERVAL 1 DAY) AS end_us,
       round(sum(meter_reading) / nullif(sum(passenger_count), 0), 4) AS per_passenger
FROM (SELECT *, unnest([time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01'),
        time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 12 HOUR]) AS start
      FROM rides WHERE ride_status = 'dropoff')
GROUP BY start
""", uses=("rides",))
def _(t):
    return S.sql_over(
        t.view("rides"),
        """SELECT unix_micros(window.start) AS start_us, unix_micros(window.end) AS end_us,
                  round(try_divide(sum(meter_reading), sum(passenger_count)), 4) AS per_passenger
           FROM rows WHERE ride_status = 'dropoff' GROUP BY window(ts, '1 day', '12 hours')""",
    )


def _work(t):
    """Name, job and years worked: a supplier's line items."""
    names = t("supplier").select("s_suppkey", F.col("s_name").alias("name"))
    lines = t("lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"),
        F.col("l_returnflag").alias("job"),
        (F.col("l_quantity") / 10).alias("years_worked"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )
    return lines.join(names, "s_suppkey")


@query("sql_udf", """
SELECT s_name AS name, l_returnflag AS job, count(*) AS n, avg(l_quantity) / 10 >= 5.0 / 2 AS more
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
""")
def _(t):
    S.register_functions(t.spark)
    return S.sql_over(
        _work(t),
        """SELECT name, job, COUNT(*) AS n, is_senior(2 * AVG(years_worked * 10) / 10) AS more
           FROM rows GROUP BY name, job""",
    )


@query("sql_udaf", """
WITH work AS (SELECT s_name AS name, l_returnflag AS job, l_quantity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
jobs AS (SELECT name, job, count(*) AS n FROM work GROUP BY name, job)
SELECT name, round(sum(l_quantity) / 10, 2) AS total_years, sum(l_quantity) / 10 >= 5.0 AS more,
  (SELECT string_agg(job || ' x ' || n, ', ' ORDER BY job) FROM jobs WHERE jobs.name = work.name) AS jobs
FROM work GROUP BY name
""")
def _(t):
    """A Python aggregate cannot stand next to built-in ones, so each has its own grouping.

    It holds its group in one task; the jobs of a name are counted first, so a group has a row per job.
    """
    S.register_functions(t.spark)
    return S.sql_over(
        _work(t),
        """WITH totals AS (SELECT name, round(SUM(years_worked), 2) AS total_years, is_senior(SUM(years_worked)) AS more
                          FROM rows GROUP BY name),
           counted AS (SELECT name, concat(job, ' x ', count(*)) AS job FROM rows GROUP BY name, job),
           texts AS (SELECT name, joined_sorted(job) AS jobs FROM counted GROUP BY name)
           SELECT name, total_years, more, jobs FROM totals JOIN texts USING (name)""",
    )
