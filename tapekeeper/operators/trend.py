"""Bucketed prices and rolling averages."""

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tapekeeper.functions.time import interval_start
from tapekeeper.functions.values import exact_mean
from tapekeeper.schema import MOVING_AVERAGE_SIZES


def price_by_interval(trades: DataFrame, interval: str) -> DataFrame:
    """Mean price per (interval start, symbol)."""
    return trades.groupBy(interval_start(F.col("trade_time"), interval).alias("time"), "symbol").agg(
        exact_mean(F.col("price")).alias("price"))


def minute_price(trades: DataFrame, unit: str = "minute") -> DataFrame:
    """Mean price per (minute, symbol); ``unit`` may be any date_trunc unit."""
    return trades.groupBy(F.date_trunc(unit, "trade_time").alias("time"), "symbol").agg(
        exact_mean(F.col("price")).alias("price"))


def moving_averages(trades: DataFrame, sizes=MOVING_AVERAGE_SIZES, unit: str = "minute",
                    scale: int = 17) -> DataFrame:
    """Bucket means with one rolling mean per size: ``rolling_means`` over the trades' buckets."""
    return rolling_means(minute_price(trades, unit), sizes, scale)


def rolling_means(buckets: DataFrame, sizes=MOVING_AVERAGE_SIZES, scale: int = 17) -> DataFrame:
    """Buckets (time, symbol, price) with one rolling mean per size, all from a single sort.

    Each frame is the current bucket and the N before it, so N+1 rows. Frames count buckets:
    silent buckets are not filled in, the first N are partial, and buckets without a price count for nothing. Trades are reduced to buckets
    before the window, so its input is bounded by time and not by traffic.

    Every mean is the difference of two running sums, so a frame of 1440 buckets costs no more than
    one of 15. The sums are decimals with ``scale`` digits: differences of doubles would drift, and
    with 17 digits the result equals the double average to its last place or so.
    """
    w = Window.partitionBy("symbol").orderBy("time")
    money = T.DecimalType(27, scale)  # summed (37) and subtracted (38), it keeps every digit
    total = F.sum(F.col("price").cast(money)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    filled = F.count("price").over(w.rowsBetween(Window.unboundedPreceding, 0))
    buckets = buckets.withColumns({"_total": F.coalesce(total, F.lit(0).cast(money)), "_filled": filled})
    means = {}
    for n in sizes:
        earlier = F.coalesce(F.lag("_total", n + 1).over(w), F.lit(0).cast(money))
        rows = F.col("_filled") - F.coalesce(F.lag("_filled", n + 1).over(w), F.lit(0))
        means[f"ma_{n}"] = F.try_divide((F.col("_total") - earlier).cast("double"), rows.cast("double"))
    return buckets.withColumns(means).drop("_total", "_filled")


def moving_average(trades: DataFrame, size: int = 60, unit: str = "minute", scale: int = 17) -> DataFrame:
    """(time, symbol, moving_avg) for one size."""
    return moving_averages(trades, [size], unit, scale).select(
        "time", "symbol", F.col(f"ma_{size}").alias("moving_avg"))


def series_stats(series: DataFrame, value: str = "price", time: str = "time", keys=("symbol",)) -> DataFrame:
    """Per series: last non-null value, maximum and minimum."""
    return series.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.max_by(value, time).alias("last"), F.max(value).alias("max"), F.min(value).alias("min"))
