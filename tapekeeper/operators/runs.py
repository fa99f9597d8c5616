"""Which ids a tape has, as maximal runs: a state that batches add to and that merges by adjacency.

A set of ids as runs is the same whatever the order of batches and however often one comes, so partial states may be
written twice, late and out of order, like the peaks. Gaps of any age are read from the state; trades are not looked at.
"""

from pyspark.sql import DataFrame, Window, functions as F

# Ids of a block: runs are merged inside blocks first, so that only what touches a block's border meets along a symbol.
BLOCK = 1 << 20

# Ids that one group lists.
BUCKET = 1024


def id_runs(trades: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(symbol, first_id, last_id): the maximal runs of ids inside each bucket of them; copies vanish before the shuffle."""
    ids = trades.select("symbol", "trade_id", F.floor(F.col("trade_id") / F.lit(bucket)).alias("bucket")).filter("trade_id is not null")
    lists = ids.groupBy("symbol", "bucket").agg(F.array_sort(F.collect_set("trade_id")).alias("ids"))
    # Where an id does not follow the one before it a run begins, and one ends where the next does not follow.
    steps = F.transform("ids", lambda x, i: F.struct(
        x.alias("id"), F.coalesce(x - F.get("ids", i - 1) > 1, F.lit(True)).alias("begins"),
        F.coalesce(F.get("ids", i + 1) - x > 1, F.lit(True)).alias("ends")))
    marked = lists.select("symbol", F.explode(F.array(steps)).alias("steps"))
    of = lambda flag: F.transform(F.filter("steps", lambda s: s[flag]), lambda s: s["id"])
    return marked.select("symbol", F.inline(F.arrays_zip(of("begins").alias("first_id"), of("ends").alias("last_id"))))


def _joined(runs: DataFrame, *keys: str) -> DataFrame:
    """Runs of one key that touch or overlap as one, by a running maximum of the ends."""
    along = Window.partitionBy(*keys).orderBy("first_id", "last_id")
    reached = F.max("last_id").over(along.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("first_id") - reached > 1), 1).otherwise(0)
    numbered = runs.withColumn("begins_", begins).withColumn("run_", F.sum("begins_").over(along))
    return numbered.groupBy(*keys, "run_").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id")).drop("run_")


def merge_runs(*partials: DataFrame, block: int = BLOCK) -> DataFrame:
    """(symbol, first_id, last_id): the maximal runs of the union of any partial states.

    Runs are cut at the borders of blocks and merged block by block; of the results only those that touch
    a border, two per block at most, are merged along the symbol. However many runs a symbol has, no task sees
    more than a block of them, or two per block.
    """
    runs = partials[0]
    for more in partials[1:]:
        runs = runs.unionByName(more)
    at = lambda column: F.floor(F.col(column) / F.lit(block))
    cut = runs.select("symbol", "first_id", "last_id", F.explode(F.sequence(at("first_id"), at("last_id"))).alias("block"))
    pieces = cut.select("symbol", "block", F.greatest("first_id", F.col("block") * block).alias("first_id"),
                        F.least("last_id", F.col("block") * block + (block - 1)).alias("last_id"))
    inside = _joined(pieces, "symbol", "block")
    touches = (F.col("first_id") == F.col("block") * block) | (F.col("last_id") == F.col("block") * block + (block - 1))
    across = _joined(inside.filter(touches).drop("block"), "symbol")
    return inside.filter(~touches).drop("block").unionByName(across)


def gaps_between(runs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(symbol, gap_start, gap_end, missing) between the maximal runs of a merged state.

    A run meets the one before it in its block; blocks' first and last runs meet along the symbol.
    """
    placed = runs.withColumn("block", F.floor(F.col("first_id") / F.lit(block)))
    before = F.lag("last_id").over(Window.partitionBy("symbol", "block").orderBy("first_id"))
    between = placed.select("symbol", before.alias("before"), F.col("first_id").alias("after"))
    ends = placed.groupBy("symbol", "block").agg(F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"))
    across = ends.select("symbol", F.lag("last_id").over(Window.partitionBy("symbol").orderBy("block")).alias("before"),
                         F.col("first_id").alias("after"))
    return between.unionByName(across).filter("before is not null").select(
        "symbol", (F.col("before") + 1).alias("gap_start"), (F.col("after") - 1).alias("gap_end"),
        (F.col("after") - F.col("before") - 1).alias("missing"))


def missing_in(runs: DataFrame) -> DataFrame:
    """(symbol, missing): ids lacking between a symbol's first and last, zero included."""
    held = F.sum(F.col("last_id") - F.col("first_id") + 1)
    return runs.groupBy("symbol").agg((F.max("last_id") - F.min("first_id") + 1 - held).alias("missing"))
