"""Queries that run as streams to a sink and read it back.

The events come as several groups of files in the order of their times, one group to a
micro-batch, and a last element far ahead, which lets the watermark pass every window
but its own. So the check SQL covers all events.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import elementwise as E
from millrace.operators import triggers as T
from millrace.plans.registry import Tables, query
from millrace.session import scratch_path
from millrace.sinks.windowed import windowed_files
from millrace.sources import messages
from millrace.streaming import jobs as J
from millrace.streaming import processors as P
from millrace.streaming.lateness import panes_with_late_rows


GROUPS, FILES = 3, 2
ROWS_PER_FILE, MANY_ROWS = 1_000_000, 1000
FILES_AT_ONCE = 16
AHEAD = "INTERVAL 10 YEARS"


def _files_for(*parts):
    """Into how many files, one by each task, every part is written: as the largest part has rows, ``FILES`` at least.

    A micro-batch is to be one part, and a task without rows writes no file. So the smallest part must have many rows for
    each of its files too.
    """
    counts = [part.count() for part in parts]
    return max(FILES, min(-(-max(counts) // ROWS_PER_FILE), min(counts) // MANY_ROWS))


def _grouped_events(t):
    """The events in ``GROUPS`` groups of as many files by time, and a late drop-off ten years ahead, in folders.

    A file source takes files by their time of writing, so the folders are written one after the other.
    """
    root = scratch_path(t.spark, "events")
    events = t("events")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(seconds, [k / GROUPS for k in range(1, GROUPS)]).alias("cuts")).first().cuts or []
    bounds = [None, *cuts, None]
    groups = []
    for low, high in zip(bounds, bounds[1:]):
        group = events if low is None else events.where(seconds > low)
        # An event without a time goes with the first group.
        group = group if high is None else group.where(F.coalesce(seconds <= high, F.lit(low is None)))
        groups.append(group)
    files = _files_for(*groups)
    for k, group in enumerate(groups):
        group.repartition(files).write.parquet(f"{root}/group-{k}")
    last = events.where("event_type = 'purchase'").orderBy(F.col("ts").desc(), "event_id").limit(1)
    last.withColumn("ts", (F.col("ts") + F.expr(AHEAD)).cast(events.schema["ts"].dataType)).write.parquet(f"{root}/last")
    return root


class _Streamed(Tables):
    """The same views over a stream of the events' files, with or without the element ahead."""

    closing = True

    def __call__(self, name):
        if name != "events":
            raise ValueError(f"{name} does not come as a stream")
        schema = self.spark.read.parquet(f"{self.directory}/{name}.parquet").schema
        root = _grouped_events(Tables(self.spark, self.directory))
        files = max(FILES, len(self.spark.read.schema(schema).parquet(f"{root}/group-0").inputFiles()))
        return J.stream_files(self.spark, f"{root}/*" if self.closing else f"{root}/group-*", schema, files_per_batch=files)


class _Open(_Streamed):
    closing = False


def _stream(t, closing=True):
    return (_Streamed if closing else _Open)(t.spark, t.directory)


def _collect(t, writer_of):
    """Runs ``writer_of(path, checkpoint)`` to the end of the input; returns the path."""
    path = scratch_path(t.spark, "stream-out")
    J.run_available(writer_of(path, J.new_checkpoint(t.spark)))
    return path


KEPT = "WITH kept AS (SELECT * FROM rides WHERE ride_status {where})"


@query("stream_windowed_sum", KEPT.format(where="<> 'enroute'") + """
SELECT window_start, window_start + 3600000000 AS window_end, ride_status,
  'status ' || ride_status || ' with ' || sum(passenger_count) || ' passengers' AS line
FROM (SELECT *, epoch_us(ts) - epoch_us(ts) % 3600000000 AS window_start FROM kept) GROUP BY window_start, ride_status
""", uses=("rides",))
def _(t):
    rides = _stream(t).view("rides").where(F.col("ride_status") != "enroute")
    sums = J.windowed_aggregate(rides, "ts", ["ride_status"], [F.sum("passenger_count").alias("p")], 3600, 300)
    line = F.concat(F.lit("status "), "ride_status", F.lit(" with "), F.col("p"), F.lit(" passengers"))
    sentences = sums.select("window_start", "window_end", "ride_status", line.alias("line"))
    path = _collect(t, lambda out, checkpoint: J.append_files(sentences, out, checkpoint))
    return t.spark.read.parquet(path)


@query("sql_windowed_stream", KEPT.format(where="= 'dropoff'") + """
SELECT window_start, count(*) AS n, CAST(sum(CAST(round(meter_reading * 100) AS BIGINT)) // nullif(sum(passenger_count), 0) AS BIGINT) AS per_passenger,
  epoch_us(max(ts)) AS last_us
FROM (SELECT *, epoch_us(ts) - epoch_us(ts) % 21600000000 AS window_start FROM kept) GROUP BY window_start
""", uses=("rides",))
def _(t):
    """The window is put on the stream first; the SQL only groups by it."""
    rides = _stream(t).view("rides").where(F.col("ride_status") == "dropoff").withWatermark("ts", "300 seconds")
    windowed = rides.withColumn("w", F.window("ts", "6 hours"))
    windowed.createOrReplaceTempView("windowed_rides")
    result = t.spark.sql(
        """SELECT unix_micros(w.start) AS window_start, count(*) AS n,
                  sum(cast(round(meter_reading * 100) AS long)) div nullif(sum(passenger_count), 0) AS per_passenger,
                  unix_micros(max(ts)) AS last_us
           FROM windowed_rides GROUP BY w"""
    )
    path = _collect(t, lambda out, checkpoint: J.append_files(result, out, checkpoint))
    return t.spark.read.parquet(path)


@query("stream_windowed_files", """
SELECT strftime(close, '%Y-%m-%d') AS day, strftime(close, '%H-%M') AS close, key, count(*) AS n FROM (
  SELECT time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS close,
         ride_status || CASE WHEN passenger_count > 2 THEN '-group' ELSE '-small' END AS key FROM rides)
GROUP BY 1, 2, 3
""", uses=("rides",))
def _(t):
    key = F.concat("ride_status", F.when(F.col("passenger_count") > 2, "-group").otherwise("-small"))
    rides = _stream(t, closing=False).view("rides")
    path = _collect(t, lambda out, checkpoint: J.files_by_window(rides, "ts", key, out, checkpoint, 86400))
    # The folder names are dates and times of day: read them as text.
    names = "event_id long, day string, close string, key string"
    return t.spark.read.schema(names).parquet(path).groupBy("day", "close", "key").agg(F.count("*").alias("n"))


@query("stream_load_job", "SELECT ride_id, ride_status, meter_reading, passenger_count FROM rides", uses=("rides",))
def _(t):
    rides = _stream(t, closing=False).view("rides").select("ride_id", "ride_status", "meter_reading", "passenger_count")
    path = scratch_path(t.spark, "stream-out")
    # A load of five files every second, one micro-batch each.
    J.run_triggered(J.load_job(rides, path, J.new_checkpoint(t.spark), shards=5, every="1 second"))
    return t.spark.read.parquet(path).drop("load")


def _text_parts(t):
    path = scratch_path(t.spark, "watched")
    parts = t("documents").select((F.col("doc_id") % 4).alias("part"), "text")
    parts.write.partitionBy("part").option("lineSep", "\n").text(path)
    return path


@query("stream_file_match", """
SELECT part, count(*) AS n FROM (SELECT doc_id % 4 AS part, unnest(string_split(text, chr(10))) FROM documents) GROUP BY part
""")
def _(t):
    watched = f"{_text_parts(t)}/part=*"
    lines = t.spark.readStream.text(watched, lineSep="\n").select(F.col("_metadata.file_path").alias("file"))
    path = _collect(t, lambda out, checkpoint: J.append_files(lines, out, checkpoint))
    part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("long").alias("part")
    return t.spark.read.parquet(path).groupBy(part).agg(F.count("*").alias("n"))


@query("stream_paths_line_count", """
SELECT (SELECT count(*) FROM (SELECT unnest(string_split(text, chr(10))) FROM documents)) AS lines, CAST(0 AS BIGINT) AS window_start
""")
def _(t):
    """Messages that name files, one of them no path, are read, counted per window and summed.

    The messages come a second after the epoch; one much later closes their window.
    """
    root = _text_parts(t)
    named = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.col("path"))
    rows = named.withColumn("s", F.lit(1))
    noise = t.spark.range(1).select(F.lit("not a path").alias("path"), F.lit(2).alias("s"))
    closing = rows.orderBy("path").limit(1).withColumn("s", F.lit(7200))
    source = scratch_path(t.spark, "paths")
    for part in (rows.unionByName(noise), closing):
        part.select("path", F.timestamp_seconds("s").alias("ts")).write.mode("append").parquet(source)
    messages = J.stream_files(t.spark, source, "path string, ts timestamp")
    counted = J.count_lines_of_paths(messages, "path", "ts", r"[a-z0-9]+:.*/.*")
    sums = J.windowed_aggregate(counted, "ts", [], [F.sum("lines").alias("lines")], 300, 300)
    final = _collect(t, lambda out, checkpoint: J.append_files(sums, out, checkpoint))
    return t.spark.read.parquet(final).select("lines", "window_start")


@query("stream_session", KEPT.format(where="<> 'enroute'") + """
, marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
            FROM kept WINDOW w AS (PARTITION BY ride_id ORDER BY ts)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY ride_id ORDER BY ts, event_id) AS session FROM marked)
SELECT ride_id, epoch_us(min(ts)) AS window_start, epoch_us(max(ts)) + 21600000000 AS window_end, count(*) AS n
FROM numbered GROUP BY ride_id, session
""", uses=("rides",))
def _(t):
    rides = _stream(t).view("rides").where(F.col("ride_status") != "enroute")
    sessions = J.session_aggregate(rides, "ts", ["ride_id"], [F.count("*").alias("n")], 6 * 3600, 300)
    path = _collect(t, lambda out, checkpoint: J.append_files(sessions, out, checkpoint))
    return t.spark.read.parquet(path)


@query("stream_panes", """
SELECT ride_status, window_start, window_start + 21600000000 AS window_end, CAST(0 AS INTEGER) AS pane_index,
  'ON_TIME' AS pane_timing, count(*) AS n, CAST(sum(passenger_count) AS BIGINT) AS total
FROM (SELECT *, epoch_us(ts) - epoch_us(ts) % 21600000000 AS window_start FROM rides)
GROUP BY ride_status, window_start
""", uses=("rides",))
def _(t):
    """On-time panes through keyed state and timers."""
    panes = P.stream_panes(_stream(t).view("rides"), ["ride_status"], "ts", "passenger_count", T.default_trigger(), 6 * 3600, 3600)
    path = _collect(t, lambda out, checkpoint: J.append_files(panes, out, checkpoint))
    return t.spark.read.parquet(path)


SHARDS = 4


def _sharded(t):
    """Rides as (ride_status, shard, event_id), and behind them a null for each buffer, which releases the rest."""
    source = scratch_path(t.spark, "sharded")
    rides = t.view("rides").select("ride_status", F.pmod("event_id", F.lit(SHARDS)).alias("shard"), "event_id")
    files = _files_for(rides)
    rides.repartition(files).write.parquet(f"{source}/rides")
    ends = rides.select("ride_status", "shard").distinct().withColumn("event_id", F.lit(None).cast("long"))
    ends.coalesce(1).write.parquet(f"{source}/ends")
    return J.stream_files(t.spark, f"{source}/*", rides.schema, files_per_batch=files)


@query("stream_batches_by_count", f"""
SELECT ride_status, shard, batch, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT ride_status, event_id % {SHARDS} AS shard,
    (row_number() OVER (PARTITION BY ride_status, event_id % {SHARDS} ORDER BY event_id) - 1) // 100 AS batch FROM rides)
GROUP BY ALL
""", uses=("rides",))
def _(t):
    batches = P.stream_batches_by_count(_sharded(t), ["ride_status", "shard"], F.col("event_id"), F.lit(100))
    path = _collect(t, lambda out, checkpoint: J.append_files(batches, out, checkpoint))
    return t.spark.read.parquet(path).select("ride_status", "shard", "batch", F.size("items").cast("long").alias("n"))


BATCHES, WINDOW_H, LATENESS_H = 3, 6, 24

# The arrival of each element: the third of the time it belongs to; every tenth comes a third later, every twentieth two.
ARRIVAL = f"""
numbered AS (SELECT *, epoch_us(ts) AS us, (SELECT min(epoch_us(ts)) FROM rides) AS low, (SELECT max(epoch_us(ts)) FROM rides) AS high FROM rides),
arrived AS (SELECT *, us - us % {WINDOW_H * 3600_000_000} AS window_start,
    least({BATCHES} - 1, (us - low) * {BATCHES} // (high - low + 1)
      + CASE WHEN event_id % 20 = 7 THEN 2 WHEN event_id % 10 = 3 THEN 1 ELSE 0 END) AS batch FROM numbered),
clock AS (SELECT batch, coalesce(max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 1000 * 1000 AS wm
          FROM (SELECT batch, max(us) AS top FROM arrived GROUP BY batch)),
timed AS (SELECT *, CASE WHEN wm > window_start + {(WINDOW_H + LATENESS_H) * 3600_000_000} THEN 'DROPPED'
                         WHEN wm >= window_start + {WINDOW_H * 3600_000_000} THEN 'LATE' ELSE 'ON_TIME' END AS pane_timing
          FROM arrived JOIN clock USING (batch)),
panes AS (SELECT ride_status, window_start, pane_timing, CASE WHEN pane_timing <> 'ON_TIME' THEN batch END AS batch, count(*) AS n,
            CAST(sum(passenger_count) AS BIGINT) AS total FROM timed GROUP BY ALL)
"""


@query("stream_lateness", f"""
WITH {ARRIVAL.strip()}
SELECT ride_status, window_start, window_start + {WINDOW_H * 3600_000_000} AS window_end, pane_timing, n, total,
  CASE WHEN pane_timing <> 'DROPPED' THEN CAST(row_number() OVER (PARTITION BY ride_status, window_start, pane_timing = 'DROPPED'
    ORDER BY pane_timing = 'LATE', batch) - 1 AS INTEGER) END AS pane_index
FROM panes
""", uses=("rides",))
def _(t):
    """Three micro-batches with elements on time, late and too late; a fourth with one element far ahead ends all windows."""
    rides = t.view("rides").select("event_id", "ride_status", "ts", "passenger_count")
    low, high = rides.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    part = F.expr(f"(unix_micros(ts) - {low or 0}L) * {BATCHES} div {(high or 0) - (low or 0) + 1}L")
    behind = F.when(F.col("event_id") % 20 == 7, 2).when(F.col("event_id") % 10 == 3, 1).otherwise(0)
    arrived = rides.withColumn("batch", F.least(F.lit(BATCHES - 1), part + behind))
    root = scratch_path(t.spark, "arrived")
    batches = [arrived.where(F.col("batch") == batch).drop("batch") for batch in range(BATCHES)]
    files = _files_for(*batches)
    for batch, part in enumerate(batches):  # a file source takes files by their time of writing
        part.repartition(files).write.parquet(f"{root}/batch-{batch}")
    ahead = rides.orderBy(F.col("ts").desc(), "event_id").limit(1).withColumn("ts", F.col("ts") + F.expr(AHEAD))
    ahead.write.parquet(f"{root}/last")
    stream = J.stream_files(t.spark, f"{root}/*", rides.schema, files_per_batch=files)
    panes = panes_with_late_rows(stream, ["ride_status"], "ts", "passenger_count", WINDOW_H * 3600, LATENESS_H * 3600)
    path = _collect(t, lambda out, checkpoint: J.append_files(panes, out, checkpoint))
    return t.spark.read.schema(panes.schema).parquet(path)


@query("stream_batches_by_time", f"""
SELECT ride_status, event_id % {SHARDS} AS shard, CAST(event_id AS VARCHAR) AS item FROM rides
""", uses=("rides",))
def _(t):
    """Buffers whose first element sets a processing-time timer: when the stream is stopped, all have been released."""
    rides = t.view("rides").select("ride_status", F.pmod("event_id", F.lit(SHARDS)).alias("shard"), "event_id")
    source = scratch_path(t.spark, "sharded")
    files = _files_for(rides)
    rides.repartition(files * 2).write.parquet(source)
    stream = J.stream_files(t.spark, source, rides.schema, files_per_batch=files)
    delay = F.when(F.col("ride_status") == "enroute", 2).otherwise(1)
    batches = P.stream_batches_by_time(stream, ["ride_status", "shard"], F.col("event_id"), delay)
    out = scratch_path(t.spark, "stream-out")
    writer = J.append_files(batches, out, J.new_checkpoint(t.spark)).trigger(processingTime="3 seconds")
    running = writer.start()
    # Every timer is due two seconds after its micro-batch at the latest.
    J.stop_when_idle(running, idle_seconds=8, poll_seconds=0.25)
    released = t.spark.read.schema(batches.schema).parquet(out)
    return released.select("ride_status", "shard", F.explode("items").alias("item"))


METRICS = """
pickups count(*) FILTER (ride_status = 'pickup')
dropoffs count(*) FILTER (ride_status = 'dropoff')
enroutes count(*) FILTER (ride_status = 'enroute')
net_people sum(CASE ride_status WHEN 'pickup' THEN 1 WHEN 'dropoff' THEN -1 ELSE 0 END * passenger_count)
cost_count count(*) FILTER (ride_status = 'dropoff')
cost_sum sum(CAST(trunc(meter_reading * 1000) AS BIGINT)) FILTER (ride_status = 'dropoff')
cost_min min(CAST(trunc(meter_reading * 1000) AS BIGINT)) FILTER (ride_status = 'dropoff')
cost_max max(CAST(trunc(meter_reading * 1000) AS BIGINT)) FILTER (ride_status = 'dropoff')
"""
_METRIC_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS name, CAST({value} AS BIGINT) AS value FROM rides"
    for name, value in (line.split(" ", 1) for line in METRICS.strip().splitlines())
)


@query("stream_observed_metrics", f"""
WITH kinds AS (SELECT unnest(['batch', 'stream']) AS kind)
SELECT kind, 'row' AS name, event_id AS value FROM rides, kinds UNION ALL SELECT kind, name, value FROM ({_METRIC_SQL}), kinds
""", uses=("rides",))
def _(t):
    """Rides pass through a batch job and a stream; what each writes stands beside the metrics taken on the way."""
    metrics = E.metric_columns("ride_status", "passenger_count", "meter_reading")
    written, streamed = scratch_path(t.spark, "observed"), scratch_path(t.spark, "observed")
    passed, observation = E.observe_metrics(t.view("rides"), metrics, "rides")
    passed.select("event_id").write.parquet(written)

    def write(rows):
        return J.append_files(rows.select("event_id"), streamed, J.new_checkpoint(t.spark))

    rides = _stream(t, closing=False).view("rides")
    taken = {"batch": observation.get, "stream": J.run_observed(rides, "rides", metrics, write)}
    values = [(kind, name, value) for kind, found in taken.items() for name, value in found.items()]
    result = t.spark.createDataFrame(values, "kind string, name string, value long")
    for kind, path in (("batch", written), ("stream", streamed)):
        rows = t.spark.read.schema("event_id long").parquet(path)
        result = result.unionByName(rows.select(F.lit(kind).alias("kind"), F.lit("row").alias("name"), F.col("event_id").alias("value")))
    return result


@query("stream_named_files", """
SELECT strftime(close, '%Y/%m/%d/%H-%M') AS close, key, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS events FROM (
  SELECT event_id, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') + INTERVAL 1 DAY AS close,
         ride_status || CASE WHEN passenger_count > 2 THEN '-multiple' ELSE '-few' END AS key FROM rides)
GROUP BY 1, 2
""", uses=("rides",))
def _(t):
    """Files named by window close, key, pane and shard; the names are read back."""
    key = F.concat("ride_status", F.when(F.col("passenger_count") > 2, "-multiple").otherwise("-few"))
    rides = _stream(t, closing=False).view("rides")
    path = _collect(t, lambda out, checkpoint: windowed_files(rides, "ts", key, out, checkpoint, 86400, shards=2))
    rows = t.spark.read.schema("event_id long").option("recursiveFileLookup", "true").parquet(path)
    name = r"([0-9]{4}/[0-9]{2}/[0-9]{2}/[0-9]{2}-[0-9]{2})--(.+)-pane-[0-9]{6}-[0-9]{5}-of-[0-9]{5}\.parquet$"
    file = F.col("_metadata.file_path")
    named = rows.select(F.regexp_extract(file, name, 1).alias("close"), F.regexp_extract(file, name, 2).alias("key"), "event_id")
    return named.groupBy("close", "key").agg(F.count("*").alias("n"), F.sum("event_id").alias("events"))


@query("stream_dedup_by_uuid", """
SELECT md5('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS uuid, o_orderkey FROM orders
""")
def _(t):
    """Messages get an id from their content when they are written; copies come in the same and in a later micro-batch.

    Files and micro-batches are bounded in rows. Where one ends does not matter, as no message is late.
    """
    columns = ["o_orderkey", "o_orderstatus"]
    sent = messages.with_id(t("orders").select(*columns), columns)
    # All within the hour for which the ids are remembered.
    sent = sent.withColumn("ts", F.timestamp_seconds(F.lit(1_000_000) + F.pmod("o_orderkey", F.lit(1800))))
    root = scratch_path(t.spark, "messages")
    first = sent.unionByName(sent.where(F.col("o_orderkey") % 5 == 0))
    again = sent.where(F.col("o_orderkey") % 3 == 0)
    files = []
    for step, part in enumerate((first, again)):  # a file source takes files by their time of writing
        files.append(_files_for(part))
        part.repartition(files[-1]).write.parquet(f"{root}/step-{step}")
    stream = J.stream_files(t.spark, f"{root}/*", sent.schema, files_per_batch=min(files[0], FILES_AT_ONCE))
    once = messages.drop_repeated_stream(stream, "ts", "1 hour").select("uuid", "o_orderkey")
    path = _collect(t, lambda out, checkpoint: J.append_files(once, out, checkpoint))
    return t.spark.read.parquet(path)
