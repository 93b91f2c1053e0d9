"""The ways taken for hot keys and large sides give the same rows as the plain ones."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import buffers, scale


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, many copies of one value in it, and null keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), F.col("id") % 40)
    )
    return spark.range(6000).select("id", key.alias("k"), (F.col("id") % 5).alias("v")).repartition(6)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_position_over_ranges_equals_window(skewed):
    plain = skewed.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("long"))
    ranged = scale.position_in_key(skewed, ["k"], ["v", "id"])
    assert rows(ranged, "k", "id", "position") == rows(plain, "k", "id", "position")


def test_position_over_ranges_spreads_the_hot_key(spark, skewed):
    # Data this small would be put together in one partition again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ranged = scale.position_in_key(skewed, ["k"], ["v", "id"])
    largest = ranged.where("k = 'hot'").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert largest < 1000


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_split_join_equals_join(spark, skewed, how):
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("none", 4), (None, 5)], "k string, x int")
    want = rows(skewed.join(few, "k", how), "k", "id", "x")
    assert rows(scale.split_join(skewed, few, "k", how), "k", "id", "x") == want
    # The hot key may be the other side's, and the other side's null keys may be many.
    want = rows(few.join(skewed, "k", how), "k", "id", "x")
    assert rows(scale.split_join(few, skewed, "k", how), "k", "id", "x") == want


def test_null_keys_of_a_left_join_are_spread(spark, skewed):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nulls = skewed.withColumn("k", F.when(F.col("k") == "hot", None).otherwise(F.col("k")))
        joined = scale.split_join(nulls, spark.createDataFrame([("k1", 3)], "k string, x int"), "k", "left")
        most = joined.where("k is null").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert most[0] < 0.4 * most[1]


def test_hot_keys_of_either_side_can_be_split(spark, skewed):
    """The matched rows come from an inner join, of which adaptive execution splits both sides."""
    few = spark.createDataFrame([("hot", 1), ("k1", 3)], "k string, x int")
    plan = scale.split_join(few, skewed, "k", "left")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Join LeftAnti" in plan and "Join LeftOuter" not in plan


def test_batches_by_time_against_a_loop(spark):
    seconds = [(k, s) for k in ("a", "b") for s in range(0, 2000, 7 if k == "a" else 13)]
    frame = spark.createDataFrame(seconds, "k string, s long").withColumn("ts", F.timestamp_seconds("s")).repartition(5)
    got = buffers.batches_by_time(frame, ["k"], "ts", 60, [F.count("*").alias("n")], {"n": "sum"})
    want = {}
    for k in ("a", "b"):
        start, batch = None, -1
        for s in sorted(s for key, s in seconds if key == k):
            if start is None or s > start + 60:
                start, batch = s, batch + 1
            want[(k, batch, start)] = want.get((k, batch, start), 0) + 1
    assert {(r.k, r.batch, r.start_s): r.n for r in got.collect()} == want


def test_null_and_large_integer_keys(spark):
    from millrace.operators import aggregate

    big = (1 << 62) + 1
    frame = spark.createDataFrame([(big, 1), (None, 2), (big, 3), (None, 4), (7, 5)], "k long, v long").repartition(3)
    sums = aggregate.aggregate_by_key(frame, ["k"], "v", 0, lambda a, v: a + v, lambda a, b: a + b, "long", "s")
    assert {r.k: r.s for r in sums.collect()} == {big: 4, None: 6, 7: 5}
    timed = frame.withColumn("ts", F.timestamp_seconds("v"))
    buffered = buffers.batches_by_time(timed, ["k"], "ts", 1, [F.count("*").alias("n")], {"n": "sum"})
    assert rows(buffered, "k", "batch", "n") == sorted([(big, 0, 1), (big, 1, 1), (None, 0, 1), (None, 1, 1), (7, 0, 1)], key=str)
