"""Queries of lateness, triggers and panes over the arrival log."""

from __future__ import annotations

from millrace.functions.times import SECOND
from millrace.operators import panes as P
from millrace.operators import triggers as T
from millrace.plans.registry import query

SIZE, LATENESS = 6 * 3600, 3600

# The arrival log with the window and the watermark each element sees; `kept` after the lateness rule.
JUDGED = f"""
judged AS (SELECT a.*, ts_us - ts_us % {SIZE * SECOND} AS window_start, ts_us - ts_us % {SIZE * SECOND} + {SIZE * SECOND} AS window_end,
    coalesce(wm >= ts_us - ts_us % {SIZE * SECOND} + {SIZE * SECOND}, false) AS late,
    coalesce(wm > ts_us - ts_us % {SIZE * SECOND} + {(SIZE + LATENESS) * SECOND}, false) AS dropped
  FROM arrivals a JOIN clock USING (batch_id)),
discarding AS (SELECT k, window_start, window_end, CASE WHEN late THEN batch_id ELSE -1 END AS pane,
    count(*) AS n, CAST(sum(cents) AS BIGINT) AS total, min(ts_us) AS first_us, max(ts_us) AS last_us
  FROM judged WHERE NOT dropped GROUP BY ALL),
panes AS (SELECT *, row_number() OVER (PARTITION BY k, window_start ORDER BY pane) - 1 AS pane_index,
    CASE WHEN pane < 0 THEN 'ON_TIME' ELSE 'LATE' END AS pane_timing FROM discarding)
"""
VIEWS = ("arrivals", "clock")
COLUMNS = ["k", "window_start", "window_end", "pane_index", "pane_timing", "n", "total", "first_us", "last_us"]


@query("pane_late_data", f"""
WITH {JUDGED.strip()} SELECT k, window_start, count(*) FILTER (NOT late) AS on_time,
  count(*) FILTER (late AND NOT dropped) AS late, count(*) FILTER (dropped) AS dropped FROM judged GROUP BY ALL
""", uses=VIEWS)
def _(t):
    return P.late_data(t.view("arrivals"), ["k"], "cents", SIZE, LATENESS)


@query("pane_default_trigger", f"WITH {JUDGED.strip()} SELECT {', '.join(COLUMNS)} FROM panes", uses=VIEWS)
def _(t):
    """The default trigger: a pane on time, then one for each late batch."""
    return P.default_panes(t.view("arrivals"), ["k"], "cents", SIZE, LATENESS).select(*COLUMNS)


@query("pane_discarding", f"WITH {JUDGED.strip()} SELECT {', '.join(COLUMNS)} FROM panes", uses=VIEWS)
def _(t):
    return P.default_panes(t.view("arrivals"), ["k"], "cents", SIZE, LATENESS).select(*COLUMNS)


@query("pane_accumulating", f"""
WITH {JUDGED.strip()} SELECT k, window_start, window_end, pane_index, pane_timing,
  CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(total) OVER w AS BIGINT) AS total,
  min(first_us) OVER w AS first_us, max(last_us) OVER w AS last_us
FROM panes WINDOW w AS (PARTITION BY k, window_start ORDER BY pane ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""", uses=VIEWS)
def _(t):
    return P.default_panes(t.view("arrivals"), ["k"], "cents", SIZE, LATENESS, accumulating=True).select(*COLUMNS)


@query("pane_info", f"""
WITH {JUDGED.strip()} SELECT k, window_start, window_end, pane_index, pane_timing, pane_index = 0 AS is_first,
  pane_index = max(pane_index) OVER (PARTITION BY k, window_start) AS is_last FROM panes
""", uses=VIEWS)
def _(t):
    panes = P.pane_info(P.default_panes(t.view("arrivals"), ["k"], "cents", SIZE, LATENESS), ["k"])
    return panes.select("k", "window_start", "window_end", "pane_index", "pane_timing", "is_first", "is_last")


@query("pane_output_timestamp", f"""
WITH {JUDGED.strip()} SELECT k, window_start, pane_index, first_us AS earliest, last_us AS latest, window_end - 1000 AS at_end
FROM panes
""", uses=VIEWS)
def _(t):
    panes = P.default_panes(t.view("arrivals"), ["k"], "cents", SIZE, LATENESS)
    named = [P.output_timestamp(panes, how).alias(name) for how, name in (("earliest", "earliest"), ("latest", "latest"), ("end", "at_end"))]
    return panes.select("k", "window_start", "pane_index", *named)


def _fold(t, trigger, accumulating=False):
    panes = P.trigger_panes(t.view("arrivals"), ["k"], "cents", trigger, SIZE, LATENESS, accumulating=accumulating)
    return panes.select(*COLUMNS)


HOUR = 3600 * SECOND


def _fold_sql(step: str, closed: str, fired: str, delay_ticks: int = 0, delay_at: str = "false", where: str = "true",
              accumulating: bool = False) -> str:
    """Check SQL of a trigger: walks the batches of a window one by one.

    ``closed`` says from the batch before (p) and the next one (b) that the pane went out
    in between, ``fired`` that it goes out with the batch c, ``step`` gives the next step,
    ``delay_at`` when the pane waits for the timer. A pane fires at its last batch, at its
    timer (the tick ``delay_ticks`` after its first batch) or when the window is over.
    """
    measures = "n, total, first_us, last_us"
    if accumulating:
        w = "OVER (PARTITION BY k, window_start ORDER BY pane_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        measures = (f"CAST(sum(n) {w} AS BIGINT) AS n, CAST(sum(total) {w} AS BIGINT) AS total, "
                    f"min(first_us) {w} AS first_us, max(last_us) {w} AS last_us")
    return f"""
WITH RECURSIVE {JUDGED.strip()},
b AS (SELECT k, window_start, window_end, batch_id, bool_and(late) AS late, count(*) AS n, CAST(sum(cents) AS BIGINT) AS total,
    min(ts_us) AS first_us, max(ts_us) AS last_us, row_number() OVER (PARTITION BY k, window_start ORDER BY batch_id) AS i
  FROM judged WHERE NOT dropped GROUP BY k, window_start, window_end, batch_id),
walk AS (
  SELECT c.*, {fired} AS fired FROM (SELECT b.*, n AS pending, batch_id AS start, 0 AS step, 0 AS pane_index FROM b WHERE i = 1) c
  UNION ALL
  SELECT c.*, {fired} AS fired FROM (
    SELECT b.*, b.n + CASE WHEN x THEN 0 ELSE pending END AS pending, CASE WHEN x THEN b.batch_id ELSE start END AS start,
           CASE WHEN x THEN {step} ELSE step END AS step, pane_index + CASE WHEN x THEN 1 ELSE 0 END AS pane_index
    FROM (SELECT p.k, p.window_start, p.i + 1 AS next, p.pending, p.start, p.step, p.pane_index,
                 p.late AS was_late, b.batch_id AS bid, p.fired OR ({closed}) AS x
          FROM walk p JOIN b ON b.k = p.k AND b.window_start = p.window_start AND b.i = p.i + 1) p
    JOIN b ON b.k = p.k AND b.window_start = p.window_start AND b.i = p.next) c),
grouped AS (SELECT k, window_start, window_end, CAST(pane_index AS BIGINT) AS pane_index,
    CAST(sum(n) AS BIGINT) AS n, CAST(sum(total) AS BIGINT) AS total, min(first_us) AS first_us, max(last_us) AS last_us,
    bool_or(NOT late) AS timely, bool_or(fired) AS fired, arg_max(late, batch_id) AS fired_late,
    bool_or({delay_at}) AS waits, min(start) + {delay_ticks} AS timer
  FROM walk c GROUP BY ALL),
after AS (SELECT batch_id AS tick, max(top) OVER (ORDER BY batch_id) AS wm
  FROM (SELECT batch_id, max(ts_us) AS top FROM arrivals GROUP BY batch_id)),
timed AS (SELECT g.*, CASE WHEN fired THEN NOT fired_late
    WHEN waits AND timer <= (SELECT max(tick) + 1 FROM after) THEN coalesce(a.wm < window_end, true) ELSE false END AS early
  FROM grouped g ASOF LEFT JOIN after a ON g.timer > a.tick)
SELECT k, window_start, window_end, pane_index,
  CASE WHEN early THEN 'EARLY' WHEN timely THEN 'ON_TIME' ELSE 'LATE' END AS pane_timing, {measures}
FROM timed WHERE {where}
"""


TWO_HOURS, ONE_HOUR = 13, 7  # ticks from a pane's first batch to the first tick after its timer


@query("pane_count_trigger", _fold_sql("0", "false", "pending >= 4"), uses=VIEWS)
def _(t):
    return _fold(t, T.repeatedly(T.AfterCount(4)))


@query("pane_or_finally", _fold_sql("0", "NOT p.late AND b.late", "c.late OR pending >= 4"), uses=VIEWS)
def _(t):
    return _fold(t, T.or_finally(T.AfterCount(4)))


@query("pane_processing_time", _fold_sql("0", f"b.batch_id - p.start >= {TWO_HOURS}", "false", TWO_HOURS, "true"), uses=VIEWS)
def _(t):
    return _fold(t, T.repeatedly(T.AfterDelay(2 * HOUR)))


@query("pane_after_first", _fold_sql("0", f"b.batch_id - p.start >= {TWO_HOURS}", "pending >= 2", TWO_HOURS, "true"), uses=VIEWS)
def _(t):
    return _fold(t, T.repeatedly(T.AfterFirst((T.AfterCount(2), T.AfterDelay(2 * HOUR)))))


@query("pane_after_each", _fold_sql(
    "(step + 1) % 4",
    f"(p.step = 1 AND b.batch_id - p.start >= {ONE_HOUR}) OR (p.step = 3 AND b.late)",
    "(step = 0 AND pending >= 3) OR step = 2 OR (step = 3 AND c.late)", ONE_HOUR, "step = 1"), uses=VIEWS)
def _(t):
    steps = (T.AfterCount(3), T.AfterDelay(HOUR), T.AfterCount(1), T.PastEnd())
    return _fold(t, T.repeatedly(T.AfterEach(steps)))


@query("pane_early_late", _fold_sql(
    "0", f"NOT p.late AND (b.late OR b.batch_id - p.start >= {TWO_HOURS})", "c.late AND pending >= 3",
    TWO_HOURS, "NOT c.late", accumulating=True), uses=VIEWS)
def _(t):
    return _fold(t, T.after_watermark(early=T.AfterDelay(2 * HOUR), late=T.AfterCount(3)), accumulating=True)


@query("pane_repeat_once", _fold_sql("0", "false", "pending >= 4", where="pane_index = 0"), uses=VIEWS)
def _(t):
    return _fold(t, T.once(T.repeatedly(T.AfterCount(4))))


@query("win_global_trigger", """
WITH RECURSIVE b AS (SELECT ride_status, s, n, total, first_us, last_us, row_number() OVER (PARTITION BY ride_status ORDER BY s) AS i
  FROM (SELECT ride_status, epoch_us(ts) // 1000000 AS s, count(*) AS n, CAST(sum(passenger_count) AS BIGINT) AS total,
          epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM rides GROUP BY 1, 2)),
walk AS (SELECT ride_status, i, n AS pending, s AS start, 0 AS pane_index FROM b WHERE i = 1
  UNION ALL SELECT p.ride_status, p.i + 1,
    CASE WHEN p.pending >= 100 OR b.s - p.start > 43200 THEN b.n ELSE p.pending + b.n END,
    CASE WHEN p.pending >= 100 OR b.s - p.start > 43200 THEN b.s ELSE p.start END,
    p.pane_index + CASE WHEN p.pending >= 100 OR b.s - p.start > 43200 THEN 1 ELSE 0 END
  FROM walk p JOIN b ON b.ride_status = p.ride_status AND b.i = p.i + 1)
SELECT ride_status, CAST(pane_index AS BIGINT) AS pane_index, CAST(sum(n) AS BIGINT) AS n, CAST(sum(total) AS BIGINT) AS total,
  min(first_us) AS first_us, max(last_us) AS last_us
FROM walk JOIN b USING (ride_status, i) GROUP BY ride_status, pane_index
""", uses=("rides",))
def _(t):
    """Per ride status a pane after 100 rides or 12 hours from its first."""
    trigger = T.repeatedly(T.AfterFirst((T.AfterCount(100), T.AfterDelay(12 * HOUR))))
    return P.global_panes(t.view("rides"), ["ride_status"], "passenger_count", trigger, "ts").drop("fired_seq", "pane_timing")
