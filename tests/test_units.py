"""Operators on small literal inputs with known results."""

import time

import pytest
from pyspark.sql import functions as F

from millrace.functions import numbers, text
from millrace.operators import aggregate as A
from millrace.operators import elementwise as E
from millrace.operators import joins as J
from millrace.operators import sqlapi as S
from millrace.operators import windows as W

def tiles(spark):
    """Twelve numbered tiles: shapes in groups of 6, 4 and 2 by remainder, sizes derived from the number."""
    n = F.col("id")
    shape = F.when(n % 2 == 0, "disc").when(n % 3 == 0, "bar").otherwise("cross")
    return spark.range(12).select(shape.alias("shape"), F.format_string("t%02d", n).alias("tile"))


def slots(spark, first, count, step, column):
    """Pairs (slot, text): ``count`` of them from slot ``first`` on, every third slot twice."""
    n = F.lit(first) + F.col("id") * step
    twice = F.explode(F.when(n % 3 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))))
    return spark.range(count).select(n.cast("int").alias("slot"), twice.alias("side")).select(
        "slot", F.concat(F.lit(column), F.col("slot"), "side").alias(column)
    )


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_counts_mean_top(spark):
    frame = tiles(spark)
    assert A.count_global(frame).first().n == 12
    assert A.count_global(frame.where("false")).first().n == 0
    assert rows(A.count_per_key(frame, ["shape"])) == [("bar", 2), ("cross", 4), ("disc", 6)]
    hundred = E.create_range(spark, 100)
    assert A.mean_global(hundred, "n").first().mean == 49.5
    assert [r.n for r in A.top_n(hundred, 5, [F.col("n").desc()]).collect()] == [99, 98, 97, 96, 95]


def test_create_with_extra(spark):
    assert rows(E.create_range(spark)) == [(n,) for n in range(10)]
    assert rows(E.create_range(spark, 3, 1729)) == [(0,), (1,), (2,), (1729,)]


def test_tagged_outputs(spark):
    n = F.col("n")
    split = E.tagged(E.create_range(spark, 100), {"3": n % 3 == 0, "5": n % 5 == 0, "15": n % 15 == 0, "all": F.lit(True)})
    parts = E.branches(split, ["3", "5", "15", "all"])
    assert [parts[k].count() for k in ("3", "5", "15", "all")] == [34, 20, 7, 100]


def test_divisors_and_primes(spark):
    n = E.create_range(spark, 101).where("n > 0")
    for row in n.select("n", numbers.divisors(F.col("n")).alias("d"), numbers.is_prime(F.col("n")).alias("p")).collect():
        exact = [d for d in range(1, row.n + 1) if row.n % d == 0]
        assert row.d == exact
        assert row.p == (len(exact) == 2)
    sums = A.sum_per_key(E.explode_divisors(n, "n"), ["n"], "divisor", "s")
    assert rows(sums.where("s = 2 * n").select("n")) == [(6,), (28,)]


def test_divisors_of_repeated_far_and_missing_numbers(spark, monkeypatch):
    some = [None, 0, -6, 1, 2, 12, 12, 12, 97, 65_535, 65_536, 65_537, 10**6, 10**6 + 3, 999_999_000_000, (1 << 40) - 1]
    monkeypatch.setattr(E, "PIECE_PAIRS", 5)
    for kind, top in (("long", 1 << 62), ("int", 1 << 31)):
        values = [(v, i) for i, v in enumerate(some) if v is None or v < top]
        frame = spark.createDataFrame(values, f"n {kind}, i int")
        for parts in (1, 3):
            got = E.explode_divisors(frame.repartition(parts), "n")
            assert [f.dataType.simpleString() for f in got.schema] == ["bigint" if kind == "long" else "int", "int", "bigint"]
            want = [(n, i, d) for n, i in values if n and n > 0 for d in divisors_of(n)]
            assert rows(got) == sorted(want)


def divisors_of(n):
    low = [d for d in range(1, int(n**0.5) + 2) if n % d == 0 and d * d <= n]
    return {*low, *(n // d for d in low)}


def test_divisors_of_neighbours_are_found_together(spark):
    """Five thousand numbers with a million candidates each: one by one they take minutes."""
    begin = time.monotonic()
    first = 10**12
    pairs = E.explode_divisors(spark.range(first, first + 5000).select(F.col("id").alias("n")), "n")
    got = {r.n: (r.s, r.c) for r in pairs.groupBy("n").agg(F.sum("divisor").alias("s"), F.count("*").alias("c")).collect()}
    assert time.monotonic() - begin < 60
    assert len(got) == 5000
    for n in (first, first + 39, first + 2520, first + 4999):
        exact = divisors_of(n)
        assert got[n] == (sum(exact), len(exact))


def test_combiner_mean_any_split(spark):
    numbers_ = E.create_range(spark, 10_000)
    for parts in (1, 7):
        result = A.combine_globally(numbers_.repartition(parts), "n", A.MEAN)
        assert result.first().result == 4999.5
    keyed = numbers_.withColumn("k", F.col("n") % 3)
    # A tiny holding bound gives several partials per key and task.
    means = A.combine_per_key(keyed, ["k"], "n", A.MEAN, held_keys=1)
    assert rows(means) == rows(keyed.groupBy("k").agg(F.avg("n").alias("result")))


@pytest.mark.parametrize("n", [10, 100])
def test_combiner_mean_of_nan_and_null(spark, n):
    """The mean is Spark's own whatever the number of values and however they are dealt out."""
    value = F.when(F.col("id") == 3, float("nan")).when(F.col("id") != 4, F.col("id").cast("double"))
    frame = spark.range(n).select((F.col("id") % 2).alias("k"), value.alias("v")).repartition(3)
    got = {r.k: r.result for r in A.combine_per_key(frame, ["k"], "v", A.MEAN).collect()}
    want = {r.k: r.m for r in frame.groupBy("k").agg(F.avg("v").alias("m")).collect()}
    assert got[1] != got[1] and want[1] != want[1]
    assert got[0] == want[0]


def test_combiner_keys(spark):
    key = F.when(F.col("id") % 3 == 0, float("nan")).otherwise((F.col("id") % 3).cast("double"))
    frame = spark.range(60).select(key.alias("k"), F.col("id").alias("v"), F.array("id").alias("a")).repartition(4)
    means = A.combine_per_key(frame, ["k"], "v", A.MEAN).collect()
    assert sorted(str(r.k) for r in means) == ["1.0", "2.0", "nan"]
    with pytest.raises(TypeError):
        A.combine_per_key(frame, ["a"], "v", A.MEAN)


def test_group_by_key_in_chunks(spark):
    frame = tiles(spark)
    whole = rows(A.render_groups(frame, ["shape"], "tile"))
    assert ("bar", 0, "bar: t03, t09, etc.") in whole and len(whole) == 3
    split = rows(A.group_values(frame, ["shape"], "tile", chunk_rows=4))
    assert ("disc", 0, ["t00", "t02", "t04", "t06"]) in split and ("disc", 1, ["t08", "t10"]) in split


def test_chunks_are_bounded_by_bytes_too(spark):
    from millrace.operators import scale

    frame = spark.range(40).select(F.lit(1).alias("k"), "id", F.repeat(F.lit("x"), 100).alias("v"))
    chunks = scale.chunk_in_key(frame, ["k"], ["id"], 1000, size=F.octet_length("v"), chunk_bytes=1000)
    assert rows(chunks.groupBy("chunk").count()) == [(i, 10) for i in range(4)]


def test_cogroup_and_joins(spark):
    left, right = slots(spark, 0, 5, 1, "lamp"), slots(spark, 3, 4, 2, "cable")
    grouped = J.cogroup({"lamp": (left, "lamp", ["lamp"]), "cable": (right, "cable", ["cable"])}, "slot")
    by_slot = {r.slot: (r.lamp, r.cable) for r in grouped.collect()}
    assert by_slot[3] == (["lamp3a", "lamp3b"], ["cable3a", "cable3b"])
    assert by_slot[4] == (["lamp4a"], []) and by_slot[9] == ([], ["cable9a", "cable9b"])
    assert set(by_slot) == {0, 1, 2, 3, 4, 5, 7, 9}
    # Slots 0, 1, 2, 3, 3, 4 with 0 twice; slots 3, 3, 5, 7, 9, 9: only slot 3 meets, two by two.
    assert J.inner_join(left, right, "slot").count() == 4
    assert J.left_join(left, right, "slot").count() == 4 + 5
    assert J.full_join(left, right, "slot").count() == 4 + 5 + 4


def test_cogroup_of_null_keys(spark):
    keyed = spark.range(3).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    grouped = J.cogroup({"x": (keyed, "v", ["v"]), "y": (keyed, "v", ["v"])}, "k")
    assert {r.k: (r.x, r.y) for r in grouped.collect()} == {None: ([0], [0]), 1: ([1], [1]), 2: ([2], [2])}


def test_side_inputs(spark):
    amounts = spark.range(1, 4).select(F.concat(F.lit("unit"), "id").alias("unit"), (F.col("id") * 1.5).alias("amount"))
    rates = spark.range(1, 3).select(F.concat(F.lit("unit"), "id").alias("unit"), (F.col("id") / 4).alias("rate"))
    product = (F.col("amount") * F.col("rate")).alias("v")
    rated = J.map_side_input(amounts, rates, "unit", "rate", F.lit(1.0))
    assert rows(rated.select("unit", product)) == [("unit1", 0.375), ("unit2", 1.5), ("unit3", 4.5)]
    with pytest.raises(Exception, match="key is not in the lookup"):
        J.map_side_input(amounts, rates, "unit", "rate").collect()
    twice = rates.unionByName(rates)
    with pytest.raises(Exception, match="duplicate key"):
        J.map_side_input(amounts, twice, "unit", "rate", F.lit(1.0)).collect()
    assert J.map_side_input(amounts, twice, "unit", "rate", F.lit(1.0), first_of_list=True).count() == 3
    levels = spark.range(4).select(F.col("id").alias("level"))
    assert rows(J.each_with_all(amounts, levels).groupBy("level").count()) == [(i, 3) for i in range(4)]
    with pytest.raises(Exception, match="more than 1000 rows"):
        J.each_with_all(amounts, spark.range(1001).select(F.col("id").alias("level"))).collect()
    one = spark.createDataFrame([(10,)], "x int")
    assert rows(J.singleton_side_input(amounts, one, "x", "x"), "x") == [(10,)] * 3
    for wrong in (one.unionByName(one), one.where("false")):
        with pytest.raises(Exception, match="a single element is needed"):
            J.singleton_side_input(amounts, wrong, "x", "x").collect()


def test_sql_and_functions(spark):
    S.register_functions(spark)
    step = F.col("id")
    work = spark.range(6).select(
        F.concat(F.lit("crew"), step % 2).alias("crew"),
        F.when(step < 4, F.concat(F.lit("task"), 9 - step)).alias("task"),
        (step * 0.75).alias("years"),
    )
    result = S.sql_over(
        work,
        """SELECT * FROM (SELECT crew, SUM(years) AS years, is_senior(SUM(years)) AS more FROM rows GROUP BY crew)
           JOIN (SELECT crew, joined_sorted(task) AS tasks FROM rows GROUP BY crew) USING (crew)""",
    )
    assert rows(result, "crew", "tasks", "years", "more") == [
        ("crew0", "task7, task9", 4.5, False),
        ("crew1", "task6, task8", 6.75, True),
    ]


def test_words(spark):
    lines = spark.createDataFrame([("It's a naïve  test, a_b 12",), ("",), ("  ",)], "line string")
    assert {r.word for r in E.word_count(lines, "line").collect()} == {"It's", "a", "naïve", "test", "a_b", "12"}
    assert {r.word for r in E.word_count(lines, "line", letters_only=True).collect()} == {"It", "s", "a", "naïve", "test", "b"}
    assert E.split_words(lines, "line").count() == 6
    whole = lines.select(text.matches_whole(F.lit("gs://b/x"), text.STORAGE_PATH_PATTERN), text.matches_whole(F.lit("see gs://b/x"), text.STORAGE_PATH_PATTERN))
    assert tuple(whole.first()) == (True, False)


def test_json_strict(spark):
    data = spark.createDataFrame([('{"a": 1}',), ("{bad",), ('{"b": 2}',)], "v string")
    assert rows(E.decode_json(data, "v", "a int", ["a"])) == [(1,)]
    with pytest.raises(Exception):
        E.decode_json(data, "v", "a int", [], strict=True).collect()


def test_session_gap_is_exclusive(spark):
    times = [0, 119, 239, 359, 1000]
    events = spark.createDataFrame([("k", t) for t in times], "k string, s long").withColumn("ts", F.timestamp_seconds("s"))
    sessions = W.session_windows(events, ["k"], "ts", [F.count("*").alias("n")], {"n": "sum"}, 120)
    # 119 s apart is one session, exactly 120 s apart is two.
    assert sorted(r.n for r in sessions.collect()) == [1, 1, 1, 2]


def test_sliding_when_slide_does_not_divide_size(spark):
    events = spark.range(200).select(F.lit("k").alias("k"), (F.col("id") * 7).alias("s")).withColumn("ts", F.timestamp_seconds("s"))
    got = W.sliding_windows(events, ["k"], "ts", [F.count("*").alias("n")], {"n": "sum"}, 50, 20)
    plain = events.groupBy(F.window("ts", "50 seconds", "20 seconds"), "k").agg(F.count("*").alias("n"))
    want = rows(plain.select(F.unix_micros("window.start").alias("w"), "n"))
    assert rows(got.select("window_start", "n")) == want


def test_metrics_of_a_pass_through(spark):
    rides = spark.createDataFrame(
        [("pickup", 3, 0.0), ("dropoff", 2, 1.5), ("dropoff", 1, 2.25), ("enroute", 9, 4.0)], "s string, p int, c double"
    )
    passed, observation = E.observe_metrics(rides, E.metric_columns("s", "p", "c"))
    assert passed.count() == 4
    got = observation.get
    assert (got["pickups"], got["dropoffs"], got["enroutes"], got["net_people"]) == (1, 2, 1, 0)
    assert (got["cost_count"], got["cost_sum"], got["cost_min"], got["cost_max"]) == (2, 3750, 1500, 2250)


def test_partition_life_cycle(spark):
    class Log(E.PartitionFn):
        def setup(self):
            self.calls = ["setup"]

        def start_batch(self):
            self.calls.append("start")

        def process(self, batch):
            self.calls.append("process")

        def finish_batch(self):
            import pandas as pd

            return pd.DataFrame({"calls": [",".join(self.calls)]})

    seen = E.map_partitions(spark.range(5).coalesce(1), Log, "calls string")
    assert rows(seen) == [("setup,start,process",)]


def test_combiners_by_column(spark):
    from millrace.operators import aggregate as A

    rows = [("a", 1.0), ("a", None), ("b", float("nan")), ("b", 2.0), (None, 3.0), (None, None), ("c", None), ("a", 2.5)]
    frame = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.result for r in A.combine_columns(frame, ["k"], "v", A.MEAN_BY_COLUMNS).collect()}
    want = {r.k: r.m for r in frame.groupBy("k").agg(F.avg("v").alias("m")).collect()}
    assert str(sorted(got.items(), key=str)) == str(sorted(want.items(), key=str))
    assert A.combine_columns(frame.limit(0), [], "v", A.MEAN_BY_COLUMNS).collect()[0].result is None
    assert A.combine_columns(frame.limit(0), [], "v", A.SUM_FROM_ZERO).first().result == 0
    variance = A.ColumnCombiner(
        add=lambda v: {"n": v, "s": v, "q": v * v},
        merge={"n": F.count, "s": F.sum, "q": F.sum},
        extract=lambda p: p["q"] / p["n"] - (p["s"] / p["n"]) ** 2,
    )
    some = frame.where("k = 'a'")
    assert abs(A.combine_columns(some, [], "v", variance).first().result - some.agg(F.var_pop("v")).first()[0]) < 1e-9
    with pytest.raises(ValueError):
        A.combine_columns(frame, ["k"], "v", A.ColumnCombiner(lambda v: {"x": v}, {"y": F.sum}, lambda p: p["x"]))
