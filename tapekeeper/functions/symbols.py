"""The configured symbol list: a short operator-written setting, or a table of symbols."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def parse_symbols(setting) -> list[str]:
    """A comma-separated setting, or a list, as trimmed, upper-cased symbols without empties, each once."""
    parts = setting.split(",") if isinstance(setting, str) else setting
    return list(dict.fromkeys(symbol for part in parts if (symbol := part.strip().upper())))


def symbols_frame(spark: SparkSession, symbols) -> DataFrame:
    """One row per configured symbol, from a DataFrame (passed through), a setting text or a list."""
    if isinstance(symbols, DataFrame):
        return symbols.select("symbol")
    listed = F.array(*[F.lit(s) for s in parse_symbols(symbols)]).cast("array<string>")
    return spark.range(1).select(F.explode(listed).alias("symbol"))


def only_symbols(df: DataFrame, symbols=None) -> DataFrame:
    """Rows of the configured symbols; None keeps every row. A setting becomes a filter the scan can use."""
    if symbols is None:
        return df
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol"), "symbol", "left_semi")
    return df.filter(F.col("symbol").isin(parse_symbols(symbols)))


def complete(symbols: DataFrame, facts: DataFrame, defaults: dict) -> DataFrame:
    """Every configured symbol once, with ``defaults`` where ``facts`` (one row per symbol) has none."""
    joined = symbols.join(facts, "symbol", "left")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()})
