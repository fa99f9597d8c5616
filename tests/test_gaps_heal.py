"""Missing ids, gap ranges, healing and its audit on hand-written tapes."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import Window, functions as F

from tapekeeper.operators.dedup import merge_rows
from tapekeeper.operators.gaps import gap_ranges, missing_ids, page_plan, plan_heal
from tapekeeper.operators.heal import heal, heal_audit
from tapekeeper.plans.cycles import healed_view, run_heal
from tests.helpers import NOW, ids_of, tape_of, trade, tuples


def brute(ids):
    ids = sorted(set(ids))
    return [(a + 1, b - 1, b - a - 1) for a, b in zip(ids, ids[1:]) if b - a > 1]


@pytest.mark.parametrize("bucket", [2, 3, 8, 1024])
def test_ranges_equal_brute_force_for_any_bucket(spark, bucket):
    pick = random.Random(bucket)
    hot = [i for i in range(600) if pick.random() < 0.5] + [5000, 5000, 70000]
    cold = [3, 4, 9, 1 << 40]
    tape = ids_of(spark, "HOT", hot).union(ids_of(spark, "COLD", cold))
    want = sorted([("HOT", *g) for g in brute(hot)] + [("COLD", *g) for g in brute(cold)], key=repr)
    assert tuples(gap_ranges(tape, window=None, bucket=bucket)) == want


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=st.lists(st.integers(0, 90), min_size=1, max_size=40), bucket=st.sampled_from([2, 5, 64]))
def test_closed_form_equals_sum_of_ranges_and_of_lag(spark, ids, bucket):
    tape = ids_of(spark, "A", ids)
    total = sum(g[2] for g in brute(ids))
    ranges = gap_ranges(tape, window=None, bucket=bucket).agg(F.coalesce(F.sum("missing"), F.lit(0))).first()[0]
    before = F.lag("trade_id").over(Window.partitionBy("symbol").orderBy("trade_id"))
    lagged = tape.select("symbol", "trade_id").distinct().select((F.col("trade_id") - before - 1).alias("m"))
    assert ranges == total
    assert missing_ids(tape, window=None).first()["missing"] == total
    assert (lagged.filter("m > 0").agg(F.sum("m")).first()[0] or 0) == total


def test_one_row_and_duplicates_make_no_gap(spark):
    assert tuples(gap_ranges(ids_of(spark, "A", [7]), window=None)) == []
    tape = ids_of(spark, "A", [1, 2, 2, 2, 3])
    assert tuples(gap_ranges(tape, window=None)) == []
    assert tuples(missing_ids(tape, window=None)) == [("A", 0)]


def test_hole_across_the_window_edge_is_not_seen(spark):
    tape = tape_of(spark, trade("A", 1, time="2024-03-01 11:40:00"), trade("A", 5), trade("A", 6))
    assert tuples(gap_ranges(tape, as_of=NOW, window="15 minutes")) == []
    assert tuples(gap_ranges(tape, as_of=NOW, window="30 minutes")) == [("A", 2, 4, 3)]


def test_lookback_is_strict(spark):
    tape = tape_of(spark, trade("A", 1, time="2024-03-01 11:45:00"), trade("A", 3))
    assert tuples(gap_ranges(tape, as_of=NOW, window="15 minutes")) == []


def test_only_configured_symbols(spark):
    tape = ids_of(spark, "A", [1, 3]).union(ids_of(spark, "B", [1, 4]))
    assert tuples(gap_ranges(tape, " a ,, 'x'", NOW)) == [("A", 2, 2, 1)]
    listed = spark.createDataFrame([("B",)], "symbol string")
    assert tuples(gap_ranges(tape, listed, NOW)) == [("B", 2, 3, 2)]


def test_pages(spark):
    gaps = spark.createDataFrame([("A", 10, 14, 5), ("A", 20, 20, 1), ("A", 100, 900, 801)],
                                 "symbol string, gap_start long, gap_end long, missing long")
    pages = tuples(page_plan(plan_heal(gaps, 800), 2))
    assert pages == [("A", 10, 14, 10), ("A", 10, 14, 12), ("A", 10, 14, 14), ("A", 20, 20, 20)]


def test_a_wide_gap_opens_in_stages(spark):
    gaps = spark.createDataFrame([("A", 1, 20_000, 20_000)],
                                 "symbol string, gap_start long, gap_end long, missing long")
    pages = [r.from_id for r in page_plan(plan_heal(gaps), 2).orderBy("from_id").collect()]
    assert pages == list(range(1, 20_001, 2))


@pytest.mark.parametrize("span", [1, 3, 256])
def test_heal_equals_brute_force(spark, span):
    pick = random.Random(span)
    history = ids_of(spark, "A", range(1, 800)).union(ids_of(spark, "B", range(1, 50)))
    kept = [i for i in range(1, 800) if pick.random() < 0.6]
    tape = ids_of(spark, "A", kept)
    healed = heal(plan_heal(gap_ranges(tape, window=None)), history, span)
    want = [i for i in range(kept[0], kept[-1]) if i not in set(kept)]
    assert [r.trade_id for r in healed.orderBy("trade_id").collect()] == want
    assert healed.columns == history.columns


def test_heal_then_check_finds_nothing(spark):
    history = ids_of(spark, "A", range(1, 40))
    tape = ids_of(spark, "A", [1, 2, 9, 10, 11, 30, 39])
    cycle = run_heal(tape, history, as_of=NOW)
    view = healed_view(tape, cycle)
    assert tuples(missing_ids(view, window=None)) == [("A", 0)]
    assert view.count() == 39
    again = merge_rows(view, cycle.rows.select(*view.columns))
    assert again.count() == 39


def test_a_pinned_plan_gives_the_same_rows_and_audit(spark):
    history = ids_of(spark, "A", range(1, 40))
    tape = ids_of(spark, "A", [1, 2, 9, 30])
    lazy, pinned = run_heal(tape, history, as_of=NOW), run_heal(tape, history, as_of=NOW, pin=True)
    assert tuples(pinned.rows) == tuples(lazy.rows)
    assert tuples(pinned.audit) == tuples(lazy.audit)


def test_oversized_gap_is_skipped_and_not_audited(spark):
    tape = ids_of(spark, "A", [1, 100]).union(ids_of(spark, "B", [1, 3]))
    history = ids_of(spark, "A", range(1, 101)).union(ids_of(spark, "B", range(1, 4)))
    cycle = run_heal(tape, history, as_of=NOW, max_gap=50)
    assert [r.action for r in cycle.plan.orderBy("symbol").collect()] == ["SKIPPED", "HEAL"]
    assert tuples(cycle.audit) == [("backfill", "ALL", "BACKFILLED", 1.0), ("backfill", "B", "BACKFILLED", 1.0)]


def test_gap_of_exactly_the_limit_is_healed(spark):
    gaps = gap_ranges(ids_of(spark, "A", [1, 52]), window=None)
    assert plan_heal(gaps, 50).first()["action"] == "HEAL"


def test_history_without_the_ids(spark):
    tape = ids_of(spark, "A", [1, 5])
    cycle = run_heal(tape, ids_of(spark, "A", [1]), as_of=NOW)
    assert tuples(cycle.audit) == [("backfill", "A", "BACKFILLED", 0.0), ("backfill", "ALL", "OK", 0.0)]


def test_no_gap_and_no_history_source(spark):
    tape = ids_of(spark, "A", [1, 2])
    assert tuples(run_heal(tape, tape, as_of=NOW).audit) == [("backfill", "ALL", "OK", 0.0)]
    off = run_heal(tape, None, as_of=NOW)
    assert tuples(off.audit) == [("backfill", "ALL", "DISABLED", 0.0)]
    assert healed_view(tape, off) is tape


def test_audit_counts_each_symbol(spark):
    plan = plan_heal(gap_ranges(ids_of(spark, "A", [1, 4, 6]).union(ids_of(spark, "B", [1, 3])), window=None))
    healed = heal(plan, ids_of(spark, "A", [2, 3, 5]).union(ids_of(spark, "B", [2])))
    assert tuples(heal_audit(plan, healed)) == [
        ("backfill", "A", "BACKFILLED", 3.0), ("backfill", "ALL", "BACKFILLED", 4.0),
        ("backfill", "B", "BACKFILLED", 1.0)]


def test_a_gap_wider_than_half_a_million_is_healed(spark):
    tape = ids_of(spark, "A", [1, 600_000])
    history = ids_of(spark, "A", [2]).union(spark.range(3, 600_000).select(
        F.lit("A").alias("symbol"), F.col("id").alias("trade_id"), F.lit(1).cast("decimal(18,8)").alias("price"),
        F.lit(1).cast("decimal(18,8)").alias("quantity"), F.current_timestamp().alias("trade_time"),
        F.current_timestamp().alias("ingested_at")))
    cycle = run_heal(tape, history, as_of=NOW)
    assert cycle.rows.count() == 599_998
    assert tuples(cycle.audit) == [("backfill", "A", "BACKFILLED", 599_998.0), ("backfill", "ALL", "BACKFILLED", 599_998.0)]
