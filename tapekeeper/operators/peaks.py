"""All-time peaks kept as partial maxima.

A partial is just a number, and max ignores order and repetition, so partials may be written
twice or late without harm. They are always read through ``peak_merge``.
"""

from pyspark.sql import DataFrame, functions as F

from tapekeeper.functions.time import since
from tapekeeper.functions.values import percent_of, round_even
from tapekeeper.operators.latest import latest, latest_by
from tapekeeper.schema import PEAK_WINDOW

# argMax order: by time, then by id where two trades share a millisecond.
LAST_TRADE = ["trade_time", "trade_id"]


def peak_partial(trades: DataFrame) -> DataFrame:
    """Partial maximum per symbol of one block of trades (batch or stream)."""
    return trades.groupBy("symbol").agg(F.max(F.col("price").cast("double")).alias("peak"))


def peak_merge(*partials: DataFrame) -> DataFrame:
    """All-time peak per symbol from any number of partial tables."""
    merged = partials[0]
    for more in partials[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy("symbol").agg(F.max("peak").alias("peak"))


def peak_seed(candles: DataFrame) -> DataFrame:
    """Peak partials from candle highs ``(symbol, high)``, for the time before the tape began."""
    return candles.groupBy("symbol").agg(F.max("high").alias("peak")).filter(F.col("peak").isNotNull())


def current_prices(trades: DataFrame, as_of=None, lookback=PEAK_WINDOW) -> DataFrame:
    """Price of the newest trade per symbol within the lookback."""
    recent = since(trades, "trade_time", as_of, lookback)
    return latest_by(recent, ["symbol"], ["price"], LAST_TRADE).withColumnRenamed("price", "current_price")


def pct_of_peak(trades: DataFrame, peaks: DataFrame, as_of=None, lookback=PEAK_WINDOW) -> DataFrame:
    """Current price against the all-time peak, for symbols that have both; rounded by ``pct_display``."""
    now = current_prices(trades, as_of, lookback)
    joined = now.join(peak_merge(peaks).withColumnRenamed("peak", "peak_price"), "symbol")
    return joined.withColumn("pct_of_peak", percent_of(F.col("current_price"), F.col("peak_price")))


def pct_display(rows: DataFrame) -> DataFrame:
    """The same table with two decimals."""
    return rows.withColumns({c: round_even(F.col(c), 2) for c in ("current_price", "peak_price", "pct_of_peak")})


def pct_of_peak_one(trades: DataFrame, peaks: DataFrame, symbol: str, as_of=None, lookback=PEAK_WINDOW) -> DataFrame:
    """The gauge of one symbol: a single row, NULL when it did not trade or has no peak."""
    peak = peaks.filter(F.col("symbol") == symbol).agg(F.max("peak")).scalar()
    recent = since(trades.filter(F.col("symbol") == symbol), "trade_time", as_of, lookback)
    return recent.agg(latest("price", LAST_TRADE)).select(
        percent_of(F.col("price"), peak).alias("pct_of_peak"))
