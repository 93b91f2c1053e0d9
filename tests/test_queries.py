"""Every registered query against DuckDB on the small tables, and the shape of some plans."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.oracle import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLES])
def test_query(spark, duck, sf_dir, name):
    problem, rows = compare(spark, duck, QUERIES[name], ORACLES[name], sf_dir)
    assert problem is None
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["window_start", "window_end", "ride_status"]


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins(spark, sf_dir):
    for name in ("side_iter_cross", "side_singleton", "join_cogroup", "pane_default_trigger"):
        assert not re.search("CartesianProduct|NestedLoop", plan(spark, sf_dir, name))


def test_groups_are_folded_before_the_shuffle(spark, sf_dir):
    for name in ("win_fixed", "win_sliding", "win_session", "word_count", "dedup_by_uuid"):
        assert re.search(r"Exchange hashpartitioning.*\n.*Aggregate.*(partial_|keys=)", plan(spark, sf_dir, name))


def test_samples_are_cut_before_the_shuffle(spark, sf_dir):
    text = plan(spark, sf_dir, "agg_sample_per_key")
    assert re.search(r"WindowGroupLimit.*Partial", text)
    assert "TakeOrderedAndProject" in plan(spark, sf_dir, "agg_top_n")


def test_events_need_no_single_partition(spark, sf_dir):
    for name in ("win_fixed", "win_session", "state_batches_by_count", "win_custom_by_value"):
        assert "SinglePartition" not in plan(spark, sf_dir, name)


def test_custom_windows_round_times_and_take_null_ids_last(spark, tmp_path):
    times = ["2024-01-01 00:09:59.999499", "2024-01-01 00:09:59.9995", "1969-12-31 23:49:59.9995", "1969-12-31 23:50:00.0005", "1960-05-05 05:05:05"]
    made = [(None if i % 3 == 1 else i, t, i % 2, '{"k": %d}' % k) for i, (t, k) in enumerate((t, k) for t in times for k in (1, 2, 8))]
    frame = spark.createDataFrame(made, "event_id long, ts string, user_id long, props string")
    typed = frame.selectExpr("event_id", "cast(ts AS timestamp_ntz) AS ts", "user_id", "'view' AS event_type", "1.5D AS value", "props")
    typed.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    here = duckdb.connect()
    here.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    problem, found = compare(spark, here, QUERIES["win_custom_by_value"], ORACLES["win_custom_by_value"], str(tmp_path))
    assert problem is None
    assert found == 10


def test_perfect_numbers_among_many_neighbours(spark, tmp_path):
    """Not by a trial of each key, of which there are 20,000 with 5,800 candidates each."""
    keys = spark.range(33_540_000, 33_560_000).select(F.col("id").alias("o_orderkey"))
    keys.write.parquet(str(tmp_path / "orders.parquet"))
    found = QUERIES["agg_perfect_numbers"](spark, str(tmp_path))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "sequence(" not in text
    assert [tuple(r) for r in found.collect()] == [(33_550_336, 67_100_672)]
