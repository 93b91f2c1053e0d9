"""Queries of the event-time windows and keyed buffers."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import buffers as B
from millrace.operators import windows as W
from millrace.operators.aggregate import sample_per_key
from millrace.plans.registry import query

def _passengers():
    return [F.sum("passenger_count").alias("passengers"), F.count("*").alias("n")]


MERGE = {"passengers": "sum", "n": "sum"}


@query("win_fixed", """
SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01')) AS window_start,
       epoch_us(time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 HOUR) AS window_end,
       ride_status, CAST(sum(passenger_count) AS BIGINT) AS passengers, count(*) AS n
FROM rides WHERE ride_status <> 'enroute' GROUP BY ALL
""", uses=("rides",))
def _(t):
    rides = t.view("rides").where(F.col("ride_status") != "enroute")
    return W.fixed_windows(rides, ["ride_status"], "ts", _passengers(), 3600)


@query("win_sliding", """
SELECT epoch_us(start) AS window_start, epoch_us(start + INTERVAL 6 HOUR) AS window_end, ride_status,
       CAST(sum(passenger_count) AS BIGINT) AS passengers, count(*) AS n
FROM (SELECT *, unnest([time_bucket(INTERVAL 2 HOUR, ts, TIMESTAMP '1970-01-01') - to_hours(2 * CAST(i AS INTEGER)) FOR i IN range(3)]) AS start
      FROM rides)
GROUP BY start, ride_status
""", uses=("rides",))
def _(t):
    return W.sliding_windows(t.view("rides"), ["ride_status"], "ts", _passengers(), MERGE, 6 * 3600, 2 * 3600)


@query("win_session", """
WITH marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
                FROM rides WINDOW w AS (PARTITION BY ride_id ORDER BY ts)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY ride_id ORDER BY ts, event_id) AS session FROM marked)
SELECT ride_id, epoch_us(min(ts)) AS window_start, epoch_us(max(ts) + INTERVAL 6 HOUR) AS window_end,
       CAST(sum(passenger_count) AS BIGINT) AS passengers, count(*) AS n
FROM numbered GROUP BY ride_id, session
""", uses=("rides",))
def _(t):
    return W.session_windows(t.view("rides"), ["ride_id"], "ts", _passengers(), MERGE, 6 * 3600)


@query("win_custom_by_value", """
WITH sized AS (SELECT *, passenger_count * 600000 AS size, epoch_ms(ts) AS ms FROM rides WHERE passenger_count > 0),
windowed AS (SELECT *, (ms - (ms + size) % size) * 1000 AS window_start, (ms - (ms + size) % size + size) * 1000 AS window_end
             FROM sized)
SELECT ride_id, window_start, window_end, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY ride_id, window_start, window_end ORDER BY event_id) AS rn FROM windowed)
WHERE rn = 1
""", uses=("rides",))
def _(t):
    sized = W.windows_by_value(t.view("rides"), "ts", F.col("passenger_count") * 600)
    sampled = sample_per_key(sized, ["ride_id", "window_start", "window_end"], [F.col("event_id").asc_nulls_last()])
    return sampled.select("ride_id", "window_start", "window_end", "event_id")


@query("state_batches_by_count", """
SELECT ride_status, batch, count(*) AS n, CAST(sum(passenger_count) AS BIGINT) AS passengers,
       count(*) = lim AS released
FROM (SELECT *, CASE ride_status WHEN 'enroute' THEN 100 ELSE 10 END AS lim,
        (row_number() OVER (PARTITION BY ride_status ORDER BY ts, event_id) - 1)
          // CASE ride_status WHEN 'enroute' THEN 100 ELSE 10 END AS batch FROM rides)
GROUP BY ride_status, batch, lim
""", uses=("rides",))
def _(t):
    limit = F.when(F.col("ride_status") == "enroute", 100).otherwise(10)
    batched = B.batches_by_count(t.view("rides"), ["ride_status"], ["ts", "event_id"], limit)
    return batched.groupBy("ride_status", "batch", "_limit").agg(
        F.count("*").alias("n"), F.sum("passenger_count").alias("passengers")
    ).select("ride_status", "batch", "n", "passengers", (F.col("n") == F.col("_limit")).alias("released"))


@query("state_batches_by_time", """
WITH RECURSIVE t AS (SELECT DISTINCT ride_status AS k, epoch_us(ts) // 1000000 AS s,
                       CASE ride_status WHEN 'enroute' THEN 43200 ELSE 3600 END AS delay FROM rides),
nx AS (SELECT a.k, a.s, a.delay, b.s AS nxt FROM t a ASOF LEFT JOIN t b ON a.k = b.k AND a.s + a.delay < b.s),
starts AS (SELECT nx.*, CAST(0 AS BIGINT) AS batch FROM nx JOIN (SELECT k, min(s) AS s FROM t GROUP BY k) f USING (k, s)
  UNION ALL SELECT nx.*, st.batch + 1 FROM starts st JOIN nx ON nx.k = st.k AND nx.s = st.nxt)
SELECT k AS ride_status, batch, s AS start_s, count(*) AS n, CAST(sum(passenger_count) AS BIGINT) AS passengers
FROM starts JOIN rides ON ride_status = k AND epoch_us(ts) // 1000000 BETWEEN s AND s + delay
GROUP BY ALL
""", uses=("rides",))
def _(t):
    delay = F.when(F.col("ride_status") == "enroute", 43200).otherwise(3600)
    sums = [F.count("*").alias("n"), F.sum("passenger_count").alias("passengers")]
    return B.batches_by_time(t.view("rides"), ["ride_status"], "ts", delay, sums, {"n": "sum", "passengers": "sum"})
