"""Connected components of a link table, by alternating star contractions."""

from pyspark.sql import DataFrame, functions as F

from tapekeeper.llm.shared import written


def _stars(links: DataFrame, upward: bool) -> DataFrame:
    """One contraction. Upward: each node hands its smallest neighbour to its larger ones; else to its smaller ones and itself."""
    if upward:
        seen = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = seen.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    met = seen.join(least, "a")
    if upward:
        moved = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links(a, b)`` that is not itself that smallest.

    Any orderable ids. Links may repeat, point either way or at themselves; null ends are ignored.
    Each round is written to the shared folder, so plans stay short; rounds grow with the logarithm
    of a component's size. No step gathers a component: hubs meet their rows in a join on the node,
    which Spark may split.
    """
    links = written(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "links")
    state = None
    while True:
        links = written(_stars(_stars(links, True), False), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = now
