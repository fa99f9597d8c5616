"""The three checks of a tape: overall freshness, stalled symbols, missing ids.

Each returns (check_name, symbol, status, value); the log writer adds the time.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tapekeeper.functions.symbols import complete, symbols_frame
from tapekeeper.functions.time import instant, seconds_between
from tapekeeper.operators.gaps import missing_ids
from tapekeeper.schema import (
    ALL_SYMBOLS, FRESHNESS, FRESHNESS_SECONDS, GAP_DETECTED, GAP_WINDOW, NEVER_SEEN_SECONDS, OK, STALE,
    STALL_SECONDS, STALLED, SYMBOL_STALL, TRADE_GAP)


def check_rows(df: DataFrame, name: str, symbol: Column, bad: Column, status: str, value: Column, *more: str) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"), symbol.alias("symbol"),
        F.when(bad, F.lit(status)).otherwise(F.lit(OK)).alias("status"), value.cast("double").alias("value"), *more)


def seen_partial(trades: DataFrame) -> DataFrame:
    """Newest trade time per symbol of one block of trades."""
    return trades.groupBy("symbol").agg(F.max("trade_time").alias("newest"))


def seen_merge(partials: DataFrame) -> DataFrame:
    """Newest trade time per symbol from any number of partials."""
    return partials.groupBy("symbol").agg(F.max("newest").alias("newest"))


def last_seen(trades: DataFrame) -> DataFrame:
    """Rows and newest trade time per symbol: the one pass that freshness and stalls share.

    A last-seen table (symbol, newest) does as well as the trades themselves.
    """
    time = "newest" if "newest" in trades.columns else "trade_time"
    return trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.max(time).alias("newest"))


def check_freshness(trades: DataFrame, as_of=None, threshold=FRESHNESS_SECONDS) -> DataFrame:
    """One ALL row: STALE when the newest trade is older than the threshold or there is none."""
    age = F.coalesce(seconds_between(F.col("newest"), instant(as_of)).cast("double"), F.lit(NEVER_SEEN_SECONDS))
    overall = last_seen(trades).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("newest").alias("newest"))
    aged = overall.withColumn("age", age)
    bad = (F.col("rows") == 0) | (F.col("age") > threshold)
    return check_rows(aged, FRESHNESS, F.lit(ALL_SYMBOLS), bad, STALE, F.col("age"))


def check_symbol_stalls(trades: DataFrame, symbols, as_of=None, threshold=STALL_SECONDS) -> DataFrame:
    """One row per configured symbol: STALLED when its newest trade is too old or it never traded."""
    age = seconds_between(F.col("newest"), instant(as_of)).cast("double")
    # "rows" is read so that this pass is the same plan as the freshness check's and runs once.
    seen = last_seen(trades).select("symbol", F.when(F.col("rows") > 0, age).alias("age"))
    every = complete(symbols_frame(trades.sparkSession, symbols), seen, {"age": NEVER_SEEN_SECONDS})
    return check_rows(every, SYMBOL_STALL, F.col("symbol"), F.col("age") > threshold, STALLED, F.col("age"))


def check_trade_gaps(trades: DataFrame, symbols, as_of=None, window=GAP_WINDOW) -> DataFrame:
    """One row per configured symbol: GAP_DETECTED when ids are missing within the window."""
    missing = missing_ids(trades, symbols, as_of, window)
    every = complete(symbols_frame(trades.sparkSession, symbols), missing, {"missing": 0})
    return check_rows(every, TRADE_GAP, F.col("symbol"), F.col("missing") > 0, GAP_DETECTED, F.col("missing"))


def failing(checks: DataFrame) -> DataFrame:
    """Check rows that are not OK."""
    return checks.filter(F.col("status") != OK)
