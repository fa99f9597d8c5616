"""What the plans may and may not contain: these hold the scale properties in place."""

import re

import pytest

from catalog import tape
from catalog.queries import QUERIES
from tapekeeper.operators import dedup, gaps, heal, trend
from tests.helpers import ids_of

WRITING = {name for name in QUERIES if name.startswith(("stream_", "stored_", "two_", "compacted_", "healed_p", "reseeded_"))}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_cross_join_and_no_python_per_row(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert banned not in text


def test_scan_reads_only_the_columns_used(spark, sf_dir):
    text = plan(trend.minute_price(tape.trades(spark, sf_dir)))
    read = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"ts", "event_type", "value", "props"}


def test_time_bound_reaches_the_scan(spark, sf_dir):
    text = plan(QUERIES["current_prices"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts,2024-01-28T00:00)" in re.search(r"PushedFilters: \[(.*?)\]", text).group(1)


def test_buckets_shrink_before_the_moving_average_shuffle(spark, sf_dir):
    text = plan(trend.moving_averages(tape.trades(spark, sf_dir)))
    assert text.count("Exchange") == 2
    assert "partial_sum" in text.split("Exchange")[-1]
    assert text.count("Sort [") == 1


def test_dedup_combines_before_its_only_shuffle(spark, sf_dir):
    text = plan(dedup.dedup_latest(tape.trades(spark, sf_dir)))
    assert text.count("Exchange") == 1
    assert "partial_max" in text.split("Exchange")[1]


def test_gap_search_never_moves_ids_by_symbol_alone(spark):
    text = plan(gaps.gap_ranges(ids_of(spark, "A", [1, 5]), window=None))
    assert "partial_collect_set" in text
    by_symbol = re.findall(r"hashpartitioning\(symbol#\d+, \d+\).*\n(.*)\n", text)
    assert by_symbol and all("block" in line and "ids" not in line for line in by_symbol)


def test_heal_joins_on_symbol_and_span_without_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan_rows = gaps.plan_heal(gaps.gap_ranges(ids_of(spark, "A", [1, 5]), window=None))
        text = plan(heal.heal(plan_rows, ids_of(spark, "A", [2, 3])))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"SortMergeJoin \[symbol#\d+, _span#\d+L\], \[symbol#\d+, _span#\d+L\], Inner", text)


def test_a_pinned_plan_spares_the_history_a_shuffle(spark, tmp_path):
    from tapekeeper.plans.cycles import run_heal
    ids_of(spark, "A", range(1, 3000)).write.parquet(str(tmp_path / "history"))
    history = spark.read.parquet(str(tmp_path / "history"))
    cycle = run_heal(ids_of(spark, "A", [1, 5, 9]), history, as_of="2024-03-01 12:00:00", pin=True)
    text = plan(cycle.rows)
    assert "BroadcastHashJoin" in text and "hashpartitioning(symbol" not in text.split("Subquery")[0]
    assert cycle.rows.count() == 6
    assert plan(cycle.audit).count("FileScan") <= 2 * plan(cycle.rows).count("FileScan")


def test_latest_sorts_no_raw_rows(spark):
    from tapekeeper.operators.latest import latest_by
    text = plan(latest_by(ids_of(spark, "A", [1, 5]), ["symbol"], ["price"], ["trade_time", "trade_id"]))
    first = text[text.rindex("partial_max(trade_time"):] if "partial_max(trade_time" in text else ""
    assert first and "SortAggregate" not in first


def test_health_cycle_counts_the_tape_once(spark):
    from tapekeeper.plans.cycles import run_health
    rows = run_health(ids_of(spark, "A", [1, 5]), ["A"], "2024-03-01 12:00:00")
    rows.collect()
    assert "ReusedExchange" in plan(rows)
