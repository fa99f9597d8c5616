"""The value at the latest time, for the whole input or per group."""

from pyspark.sql import Column, DataFrame, functions as F


def latest(value: str, order: list[str]) -> Column:
    """Aggregate: ``value`` of the row that is last by ``order``; later names break ties, so retries agree."""
    ranking = order[0] if len(order) == 1 else F.struct(*order)
    return F.max_by(value, ranking).alias(value)


def latest_by(df: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """One row per key with each of ``values`` taken from the last row by ``order``.

    The newest time per key is a plain hash aggregation over all rows; only the rows of that time
    are then ranked, so nothing sorts the input.
    """
    newest = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.max(order[0]).alias("_newest"))
    same = F.col(order[0]).eqNullSafe(F.col("_newest"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    last = df.join(newest, same, "left_semi")
    return last.groupBy(*keys).agg(*[latest(v, order) for v in values])
