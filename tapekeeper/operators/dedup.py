"""Duplicate handling: the same trade may be written any number of times."""

from pyspark.sql import DataFrame, functions as F

from tapekeeper.schema import KEY, VERSION


def dedup_latest(df: DataFrame, keys=KEY, version=VERSION, tiebreak=()) -> DataFrame:
    """One row per key: the highest version wins, then ``tiebreak``, then the other columns in order.

    A plain max over a struct, so copies of a key collapse before the shuffle and one key with
    very many copies costs no task more than one row per input partition. The order is total:
    any rerun picks the same row.
    """
    lead = [version, *tiebreak]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    winner = F.max(F.struct(*lead, *rest)).alias("_winner")
    picked = df.groupBy(*keys).agg(winner)
    return picked.select(*[F.col(c) if c in keys else F.col(f"_winner.{c}").alias(c) for c in df.columns])


def merge_rows(trades: DataFrame, extra: DataFrame, keys=KEY, version=VERSION) -> DataFrame:
    """Upsert: rows of both inputs, one per key; running it again with the same rows changes nothing."""
    return dedup_latest(trades.unionByName(extra), keys, version)


def dedup_check(trades: DataFrame) -> DataFrame:
    """Raw rows against distinct ids per symbol."""
    return trades.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("raw_rows"), F.countDistinct("trade_id").alias("unique_trades"))


def final_counts(trades: DataFrame) -> DataFrame:
    """Rows per symbol once duplicates are resolved."""
    return trades.select(*KEY).distinct().groupBy("symbol").agg(F.count(F.lit(1)).alias("final_rows"))


def exact_count(trades: DataFrame) -> DataFrame:
    """Distinct trades over all symbols."""
    return trades.agg(F.countDistinct(*KEY).alias("unique_trades"))


def exact_volume(trades: DataFrame) -> DataFrame:
    """Traded quantity and turnover per symbol, each trade counted once."""
    kept = dedup_latest(trades)
    return kept.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("trades"),
        F.sum("quantity").alias("volume"),
        F.sum(F.col("price") * F.col("quantity")).alias("turnover"))
