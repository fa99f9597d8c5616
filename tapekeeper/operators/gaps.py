"""Missing ids: how many per symbol, which ranges, and the pages needed to fetch them."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from tapekeeper.functions.symbols import only_symbols
from tapekeeper.functions.time import since
from tapekeeper.schema import GAP_WINDOW, HEAL_WINDOW, PAGE_SIZE

# Ids per gap-search bucket: bounds both the array a group can build and the work of one row.
BUCKET = 1024


def _recent(trades: DataFrame, symbols, as_of, window) -> DataFrame:
    kept = only_symbols(trades, symbols)
    return kept if window is None else since(kept, "trade_time", as_of, window)


def missing_ids(trades: DataFrame, symbols=None, as_of=None, window=GAP_WINDOW) -> DataFrame:
    """(symbol, missing) over the lookback, zero included, for symbols that traded in it.

    Span minus distinct ids equals the sum of the holes between neighbours, without sorting a symbol.
    """
    ids = _recent(trades, symbols, as_of, window)
    span = F.max("trade_id") - F.min("trade_id") + 1
    return ids.groupBy("symbol").agg((span - F.countDistinct("trade_id")).alias("missing"))


def gap_ranges(trades: DataFrame, symbols=None, as_of=None, window=HEAL_WINDOW, bucket: int = BUCKET, by=()) -> DataFrame:
    """(*by, symbol, gap_start, gap_end, missing) for every hole between two ids of the lookback, for each value of ``by`` apart.

    Ids are grouped by (symbol, id div bucket): one shuffle, duplicates dropped before it, at most
    ``bucket`` ids per group however hot the symbol. Holes inside a bucket show in its sorted ids.
    Holes between buckets need only each bucket's first and last id; those are compared inside
    blocks of ``bucket`` buckets, and the blocks' first and last ids along the symbol. The first id
    of a symbol has no predecessor and never opens a gap.
    """
    size, own = int(bucket), [*by, "symbol"]
    ids = _recent(trades, symbols, as_of, window).select(
        *own, "trade_id", F.expr(f"trade_id div {size}").alias("bucket"))
    runs = ids.groupBy(*own, "bucket").agg(F.collect_set("trade_id").alias("ids"))

    run = runs.select(*own, F.array_sort("ids").alias("ids"))
    steps = F.zip_with("ids", F.slice("ids", F.lit(2), F.size("ids")), lambda left, right: F.struct(
        left.alias("before"), right.alias("after")))
    inside = run.select(*own, F.inline(F.filter(steps, lambda s: s["after"] - s["before"] > 1)))

    ends = runs.select(
        *own, "bucket", F.expr(f"bucket div {size}").alias("block"),
        F.array_min("ids").alias("first"), F.array_max("ids").alias("last")).repartition(*own, "block")
    between = ends.select(*own, F.lag("last").over(
        Window.partitionBy(*own, "block").orderBy("bucket")).alias("before"), F.col("first").alias("after"))

    blocks = ends.groupBy(*own, "block").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    across = blocks.select(*own, F.lag("last").over(
        Window.partitionBy(*own).orderBy("block")).alias("before"), F.col("first").alias("after"))

    neighbours = inside.unionByName(between).unionByName(across).filter(F.col("after") - F.col("before") > 1)
    return neighbours.select(
        *own, (F.col("before") + 1).alias("gap_start"), (F.col("after") - 1).alias("gap_end"),
        (F.col("after") - F.col("before") - 1).alias("missing"))


def plan_heal(gaps: DataFrame, max_gap: int | None = None) -> DataFrame:
    """Gaps with an action: HEAL, or, if the caller sets a limit, SKIPPED for wider ones, kept so they can be reported."""
    wide = F.lit(False) if max_gap is None else F.col("missing") > max_gap
    return gaps.withColumn("action", F.when(wide, F.lit("SKIPPED")).otherwise(F.lit("HEAL")))


def explode_steps(df: DataFrame, name: str, first: Column, last: Column, step: int) -> DataFrame:
    """One row per value first, first+step, ... up to last, as column ``name``.

    A wide range opens in two stages, so no row ever holds more than 4096 steps per stage.
    """
    block = step * 4096
    opened = df.withColumn("_block", F.explode(F.sequence(first, last, F.lit(block).cast("long"))))
    until = F.least(last, F.col("_block") + (block - 1))
    return opened.withColumn(
        name, F.explode(F.sequence(F.col("_block"), until, F.lit(step).cast("long")))).drop("_block")


def page_plan(plan: DataFrame, page: int = PAGE_SIZE) -> DataFrame:
    """(symbol, gap_start, gap_end, from_id): where each page of a healed gap starts."""
    gaps = plan.filter("action = 'HEAL'").select("symbol", "gap_start", "gap_end")
    return explode_steps(gaps, "from_id", F.col("gap_start"), F.col("gap_end"), page)
