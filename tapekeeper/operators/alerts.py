"""Alert values from the check log, rule evaluation, and the health displays."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapekeeper.functions.time import between, instant, seconds_between, span
from tapekeeper.operators.latest import latest_by
from tapekeeper.schema import BACKFILL, FRESHNESS, GAP_DETECTED, STALE, STALLED, SYMBOL_STALL, TRADE_GAP

# Rule id, severity, and the threshold a value must exceed to fire.
RULES = (
    ("health-freshness-stale", "critical", 0.0),
    ("health-monitor-heartbeat", "critical", 660.0),
    ("health-symbol-stalled", "warning", 0.0),
    ("health-trade-gap", "warning", 0.0),
)
FRESHNESS_RULE, HEARTBEAT_RULE, STALL_RULE, GAP_RULE = (uid for uid, _, _ in RULES)


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(u).alias("uid"), F.lit(s).alias("severity"), F.lit(float(t)).alias("threshold"))
                     for u, s, t in rules])
    return spark.range(1).select(F.inline(rows))


def alert_values(checks: DataFrame, as_of=None, lookback="1 hour") -> DataFrame:
    """(uid, value), one row per rule that has data.

    Reads the log once: the newest status per (check, symbol) within the lookback, then the four
    values from that small table. The heartbeat looks at the whole log, so a monitor that died long
    ago still shows; with no row at all it has no value.
    """
    recent = F.col("checked_at") > instant(as_of) - span(lookback)
    watched = checks.filter(F.col("check_name").isin(FRESHNESS, SYMBOL_STALL, TRADE_GAP))
    newest = watched.groupBy("check_name", "symbol").agg(
        F.max(F.when(recent, F.struct("checked_at", "status"))).alias("now"),
        F.max("checked_at").alias("at"))
    is_fresh = F.col("check_name") == FRESHNESS
    beat = F.max(F.when(is_fresh, F.col("at")))

    def bad(check, status):
        return F.count_if((F.col("check_name") == check) & (F.col("now.status") == status)).cast("double")

    overall = F.max(F.when(is_fresh, F.col("now")))["status"]
    values = newest.agg(
        F.coalesce((overall == STALE).cast("double"), F.lit(0.0)).alias(FRESHNESS_RULE),
        seconds_between(beat, instant(as_of)).cast("double").alias(HEARTBEAT_RULE),
        bad(SYMBOL_STALL, STALLED).alias(STALL_RULE),
        bad(TRADE_GAP, GAP_DETECTED).alias(GAP_RULE))
    return values.unpivot([], [uid for uid, _, _ in RULES], "uid", "value").filter(F.col("value").isNotNull())


def evaluate(values: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules with their value and state: FIRING strictly above the threshold, OK otherwise or without data."""
    joined = rules.join(values, "uid", "left")
    state = F.when(F.col("value") > F.col("threshold"), F.lit("FIRING")).otherwise(F.lit("OK"))
    return joined.select("uid", "severity", "threshold", "value", state.alias("state"))


def latest_status(checks: DataFrame, check_name: str, value_name: str = "value") -> DataFrame:
    """Newest value and status per symbol of one check."""
    one = checks.filter(F.col("check_name") == check_name)
    return latest_by(one, ["symbol"], ["value", "status"], ["checked_at"]).withColumnRenamed("value", value_name)


def gap_status(checks: DataFrame) -> DataFrame:
    """Per symbol: newest gap detection next to newest backfill; either side may be missing."""
    both = checks.filter(F.col("check_name").isin(TRADE_GAP, BACKFILL))
    newest = latest_by(both, ["check_name", "symbol"], ["value", "status"], ["checked_at"])

    def of(check, column, name):
        return F.max(F.when(F.col("check_name") == check, F.col(column))).alias(name)

    return newest.groupBy("symbol").agg(
        of(TRADE_GAP, "value", "missing_trades"), of(TRADE_GAP, "status", "gap_status"),
        of(BACKFILL, "value", "backfilled"), of(BACKFILL, "status", "backfill_status"))


def latest_freshness(checks: DataFrame) -> DataFrame:
    """The newest freshness value: a top-1 by time."""
    fresh = checks.filter(F.col("check_name") == FRESHNESS)
    return fresh.orderBy(F.desc("checked_at")).limit(1).select("value")


def check_series(checks: DataFrame, check_name: str, low, high) -> DataFrame:
    """(time, symbol, value) of one check inside a time range, both ends included."""
    one = between(checks.filter(F.col("check_name") == check_name), "checked_at", low, high)
    return one.select(F.col("checked_at").alias("time"), "symbol", "value")


def retain(checks: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Rows still within the retention period."""
    return checks.filter(F.col("checked_at") > instant(as_of) - span(f"{days} days"))
