"""History records and candles, handed over as data by whatever fetched them."""

from pyspark.sql import DataFrame, functions as F

from tapekeeper.sources.intake import type_trades

# Fixed value: zero-based position of the high in a candle array.
CANDLE_HIGH = 2


def from_history(df: DataFrame) -> DataFrame:
    """(symbol, id, price, qty, time in ms) records to typed trades plus ``reason``."""
    return type_trades(df.select(
        "symbol", F.col("id").alias("trade_id"), "price", F.col("qty").alias("quantity"),
        F.col("time").alias("trade_time")))


def from_klines(df: DataFrame, column: str = "klines") -> DataFrame:
    """(symbol, JSON array of candles) to one (symbol, high) row per candle; highs that are no number are NULL."""
    candles = F.from_json(F.col(column), "array<array<string>>")
    return df.select("symbol", F.explode(candles).alias("k")).select(
        "symbol", F.try_element_at("k", F.lit(CANDLE_HIGH + 1)).try_cast("double").alias("high"))
