"""Counts, throughput and latency percentiles."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapekeeper.functions.time import since
from tapekeeper.functions.values import round_even

# The percentiles reported.
QUANTILES = (0.50, 0.95, 0.99)


def symbol_summary(trades: DataFrame) -> DataFrame:
    """Rows (duplicates included) and highest price per symbol."""
    return trades.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.max("price").alias("max_price"))


def symbols(trades: DataFrame) -> DataFrame:
    """Distinct symbols."""
    return trades.select("symbol").distinct()


def symbols_list(trades: DataFrame) -> DataFrame:
    """Distinct symbols in order, as a selector shows them."""
    return symbols(trades).orderBy("symbol")


def throughput(trades: DataFrame, as_of=None, seconds: int = 60) -> DataFrame:
    """Rows landed in the last ``seconds`` and the rounded rate per second."""
    recent = since(trades, "ingested_at", as_of, f"{seconds} seconds")
    rows = F.count(F.lit(1))
    return recent.agg(rows.alias("rows"), round_even(rows / seconds, 0).alias("rows_per_sec"))


def latency_ms() -> Column:
    """Milliseconds from the trade to its write."""
    return F.unix_millis("ingested_at") - F.unix_millis("trade_time")


def latency_stats(trades: DataFrame, as_of=None, interval="2 minutes", exact: bool = True) -> DataFrame:
    """Row count, percentiles and maximum of write latency over the lookback, as one row.

    ``exact=False`` uses Spark's sketch, in one pass.
    """
    lat = since(trades, "ingested_at", as_of, interval).select(latency_ms().alias("lat"))
    names = [f"p{round(q * 100)}_ms" for q in QUANTILES]
    if not exact:
        sketch = F.percentile_approx("lat", list(QUANTILES), 10_000)
        return lat.agg(F.count("lat").alias("events"), F.max("lat").alias("max_ms"), sketch.alias("_q")).select(
            "events", *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)], "max_ms")
    counts = value_counts(lat, "lat")
    totals = counts.agg(F.sum("n").alias("events"), F.max("v").alias("max_ms")).select(
        "events", "max_ms", F.lit(None).cast("double").alias("q"), F.lit(None).cast("double").alias("value"))
    found = quantiles_of(counts, QUANTILES).select(
        F.lit(None).cast("long").alias("events"), F.lit(None).cast("long").alias("max_ms"), "q", "value")
    return totals.unionByName(found).agg(
        F.coalesce(F.max("events"), F.lit(0)).alias("events"),
        *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n) for q, n in zip(QUANTILES, names)],
        F.max("max_ms").alias("max_ms"))


def latency_display(stats: DataFrame) -> DataFrame:
    """The percentiles with one decimal."""
    return stats.withColumns({c: round_even(F.col(c), 1) for c in stats.columns if c.startswith("p")})


def value_counts(df: DataFrame, column: str, width: int = 1 << 14) -> DataFrame:
    """(bin, v, n): rows per integer value, laid out by bins of ``width`` neighbouring values."""
    value = F.col(column).cast("long")
    counts = df.filter(value.isNotNull()).groupBy(value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    # The null test is the one the joins below would infer; stated here, every reader shares one shuffle.
    return counts.withColumn("bin", F.floor(F.col("v") / width)).filter("bin IS NOT NULL").repartition("bin")


def quantiles_of(counts: DataFrame, quantiles) -> DataFrame:
    """Exact interpolated quantiles ``(q, value)`` from value counts, never gathering them in one place.

    Running totals over the bins, a tiny table, say which bin holds each wanted rank and how many
    rows come before it; running totals inside the bins, at most ``width`` values each, say where.
    """
    bins = counts.groupBy("bin").agg(F.sum("n").alias("n"))
    running = bins.select(
        "bin", "n", F.sum("n").over(Window.orderBy("bin")).alias("upto"),
        F.sum("n").over(Window.partitionBy()).alias("total"))

    def ranks(q):
        position = F.lit(q) * (F.col("total") - 1)
        part = position - F.floor(position)
        return [F.struct(F.lit(q).alias("q"), part.alias("part"), rank.alias("rank"), F.lit(upper).alias("upper"))
                for upper, rank in ((False, F.floor(position)), (True, F.ceil(position)))]

    asked = F.array(*[rank for q in quantiles for rank in ranks(q)])
    wanted = running.select("bin", (F.col("upto") - F.col("n")).alias("before"), "upto", F.inline(asked)).filter(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("upto")))

    inside = Window.partitionBy("bin").orderBy("v")
    values = counts.select("bin", "v", "n", F.sum("n").over(inside).alias("v_upto"))
    place = F.col("rank") - F.col("before")
    found = wanted.join(values, "bin").filter((place < F.col("v_upto")) & (place >= F.col("v_upto") - F.col("n")))
    low = F.max(F.when(~F.col("upper"), F.col("v")))
    high = F.max(F.when(F.col("upper"), F.col("v")))
    return found.groupBy("q").agg((low + (high - low) * F.max("part")).alias("value"))
