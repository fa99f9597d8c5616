"""Checks, alert values, rule evaluation, bands and the check log."""

import pytest

from pyspark.sql import functions as F

from tapekeeper.functions.time import seconds_between
from tapekeeper.functions.values import BANDS, band, percent_of, round_even
from tapekeeper.operators import alerts
from tapekeeper.operators.health import check_freshness, check_symbol_stalls, check_trade_gaps, failing
from tapekeeper.plans.cycles import run_health
from tapekeeper.sinks.tables import append_checks, read_checks, rewrite_retained
from tests.helpers import NOW, at, ids_of, log_of, tape_of, trade, tuples


def test_empty_tape(spark):
    empty = tape_of(spark, trade("A", 1)).limit(0)
    assert tuples(run_health(empty, "a,b", NOW)) == [
        ("freshness", "ALL", "STALE", 999999.0),
        ("symbol_stall", "A", "STALLED", 999999.0), ("symbol_stall", "B", "STALLED", 999999.0),
        ("trade_gap", "A", "OK", 0.0), ("trade_gap", "B", "OK", 0.0)]


@pytest.mark.parametrize("time,age,fresh,stall", [
    ("2024-03-01 11:58:00", 120.0, "OK", "OK"),
    ("2024-03-01 11:57:59", 121.0, "STALE", "OK"),
    ("2024-03-01 11:55:00", 300.0, "STALE", "OK"),
    ("2024-03-01 11:54:59", 301.0, "STALE", "STALLED"),
    ("2024-03-01 12:00:30", -30.0, "OK", "OK"),
])
def test_thresholds_are_strict_and_ages_may_be_negative(spark, time, age, fresh, stall):
    tape = tape_of(spark, trade("A", 1, time=time))
    assert tuples(check_freshness(tape, NOW)) == [("freshness", "ALL", fresh, age)]
    assert tuples(check_symbol_stalls(tape, ["A"], NOW)) == [("symbol_stall", "A", stall, age)]


def test_age_counts_second_boundaries(spark):
    row = spark.range(1).select(seconds_between(
        F.lit("2024-03-01 11:59:58.900").cast("timestamp"), F.lit("2024-03-01 12:00:00.100").cast("timestamp")))
    assert row.first()[0] == 2


def test_gaps_of_configured_symbols(spark):
    tape = ids_of(spark, "A", [1, 4]).union(ids_of(spark, "Z", [1, 9]))
    assert tuples(check_trade_gaps(tape, ["A", "B"], NOW)) == [
        ("trade_gap", "A", "GAP_DETECTED", 2.0), ("trade_gap", "B", "OK", 0.0)]
    assert tuples(failing(check_trade_gaps(tape, ["A", "B"], NOW))) == [("trade_gap", "A", "GAP_DETECTED", 2.0)]


LOG = [
    ("freshness", "ALL", "OK", 5.0, "2024-03-01 11:50:00"),
    ("freshness", "ALL", "STALE", 500.0, "2024-03-01 11:55:00"),
    ("symbol_stall", "A", "STALLED", 400.0, "2024-03-01 11:55:00"),
    ("symbol_stall", "B", "STALLED", 400.0, "2024-03-01 11:50:00"),
    ("symbol_stall", "B", "OK", 1.0, "2024-03-01 11:55:00"),
    ("symbol_stall", "C", "STALLED", 400.0, "2024-03-01 10:00:00"),
    ("trade_gap", "A", "GAP_DETECTED", 3.0, "2024-03-01 11:50:00"),
    ("trade_gap", "A", "OK", 0.0, "2024-03-01 11:55:00"),
    ("backfill", "A", "BACKFILLED", 3.0, "2024-03-01 11:52:00"),
    ("backfill", "ALL", "BACKFILLED", 3.0, "2024-03-01 11:52:00"),
]


def states(spark, log, as_of=NOW):
    rows = alerts.evaluate(alerts.alert_values(log, as_of), alerts.rules_frame(spark)).collect()
    return {r.uid.removeprefix("health-"): (r.value, r.state) for r in rows}


def test_alerts_follow_the_latest_status(spark):
    assert states(spark, log_of(spark, *LOG)) == {
        "freshness-stale": (1.0, "FIRING"), "monitor-heartbeat": (300.0, "OK"),
        "symbol-stalled": (1.0, "FIRING"), "trade-gap": (0.0, "OK")}


def test_heartbeat_fires_past_its_threshold_and_is_silent_at_cold_start(spark):
    log = log_of(spark, ("freshness", "ALL", "OK", 5.0, "2024-03-01 11:49:00"))
    assert states(spark, log)["monitor-heartbeat"] == (660.0, "OK")
    assert states(spark, log, "2024-03-01 12:00:01")["monitor-heartbeat"] == (661.0, "FIRING")
    assert states(spark, log, "2024-06-01 00:00:00")["monitor-heartbeat"][1] == "FIRING"
    cold = states(spark, log.limit(0))
    assert cold["monitor-heartbeat"] == (None, "OK")
    assert {state for _, state in cold.values()} == {"OK"}


def test_displays(spark):
    log = log_of(spark, *LOG)
    assert tuples(alerts.latest_freshness(log)) == [(500.0,)]
    assert tuples(alerts.latest_status(log, "symbol_stall", "age_s")) == [
        ("A", 400.0, "STALLED"), ("B", 1.0, "OK"), ("C", 400.0, "STALLED")]
    assert tuples(alerts.gap_status(log)) == [
        ("A", 0.0, "OK", 3.0, "BACKFILLED"), ("ALL", None, None, 3.0, "BACKFILLED")]
    series = alerts.check_series(log, "freshness", "2024-03-01 11:50:00", "2024-03-01 11:55:00")
    assert [r.value for r in series.orderBy("time").collect()] == [5.0, 500.0]


def test_bands_include_their_lower_bound(spark):
    values = spark.createDataFrame([(79.9,), (80.0,), (95.0,), (99.99,), (100.0,), (None,)], "v double")
    got = [r[0] for r in values.select(band(F.col("v"), *BANDS["pct_of_peak"])).collect()]
    assert got == ["green", "yellow", "orange", "orange", "red", None]


def test_ratio_and_rounding(spark):
    row = spark.range(1).select(
        percent_of(F.lit(1), F.lit(0)).alias("zero"), percent_of(F.lit(1), F.lit(8)).alias("eighth"),
        round_even(F.lit(2.5), 0).alias("even")).first()
    assert (row.zero, row.eighth, row.even) == (None, 12.5, 2.0)


def test_log_append_and_retention(spark, tmp_path):
    path, kept = str(tmp_path / "checks"), str(tmp_path / "kept")
    tape = ids_of(spark, "A", [1, 2])
    append_checks(run_health(tape, ["A"], NOW), path, "2024-01-20 00:00:00")
    append_checks(run_health(tape, ["A"], NOW), path, NOW)
    assert read_checks(spark, path).count() == 6
    assert alerts.retain(read_checks(spark, path), NOW).count() == 3
    assert read_checks(spark, path, NOW, days=30).count() == 3
    rewrite_retained(spark, path, kept, NOW)
    rows = read_checks(spark, kept).collect()
    assert len(rows) == 3
    assert {r.checked_at.timestamp() for r in rows} == {at(NOW).timestamp()}


def test_append_stamps_now_by_default(spark, tmp_path):
    append_checks(run_health(ids_of(spark, "A", [1]), ["A"]), str(tmp_path))
    assert read_checks(spark, str(tmp_path)).filter("checked_at > now() - interval 1 hour").count() == 3
