"""Filling gaps from a history table, and the audit of what was filled."""

from pyspark.sql import DataFrame, functions as F

from tapekeeper.functions.time import instant
from tapekeeper.operators.gaps import explode_steps
from tapekeeper.schema import ALL_SYMBOLS, BACKFILL, BACKFILLED, DISABLED, OK

# Ids per join bucket: a gap opens into missing/SPAN+1 rows, a history row meets at most SPAN/2 gaps.
SPAN = 256


def heal(plan: DataFrame, history: DataFrame, span: int = SPAN) -> DataFrame:
    """History rows whose id lies in a gap marked HEAL, each once.

    A range join spelled as an equi-join on (symbol, id div span): it hashes evenly even when one
    symbol holds most ids. Before it the history is cut to the ids between the first and the last gap,
    which its files' statistics can skip. Over a written plan Spark sees how small the gaps are and
    broadcasts them, so the history is not shuffled; a large plan makes it a shuffled join. Gaps never
    overlap, so an id matches one gap at most.
    """
    gaps = plan.filter("action = 'HEAL'").select("symbol", "gap_start", "gap_end")
    first, last = gaps.agg(F.min("gap_start")).scalar(), gaps.agg(F.max("gap_end")).scalar()
    history = history.filter((F.col("trade_id") >= first) & (F.col("trade_id") <= last))
    return rows_in_gaps(gaps, history, span)


def rows_in_gaps(gaps: DataFrame, history: DataFrame, span: int = SPAN, by=()) -> DataFrame:
    """History rows whose id lies in a gap, with the columns ``by`` of the gap: an equi-join on (symbol, id div span)."""
    opened = explode_steps(gaps, "_span", F.expr(f"gap_start div {span}"), F.expr(f"gap_end div {span}"), 1)
    rows = history.withColumn("_span", F.expr(f"trade_id div {span}"))
    inside = F.col("trade_id").between(F.col("gap_start"), F.col("gap_end"))
    return rows.join(opened, ["symbol", "_span"]).filter(inside).select(*history.columns, *by)


def heal_audit(plan: DataFrame, healed: DataFrame) -> DataFrame:
    """Check rows of one heal cycle: a total for ALL and one row per symbol with a HEAL gap.

    A symbol whose gaps got no rows is still BACKFILLED with 0; skipped gaps add no symbol row.
    """
    tried = plan.filter("action = 'HEAL'").select("symbol", F.lit(0).cast("long").alias("n"))
    got = healed.select("symbol", F.lit(1).cast("long").alias("n"))
    none = plan.sparkSession.range(1).select(F.lit(None).cast("string").alias("symbol"), F.lit(0).cast("long").alias("n"))
    per_symbol = tried.unionByName(got).unionByName(none).groupBy("symbol").agg(F.sum("n").alias("n"))
    sums = per_symbol.rollup("symbol").agg(F.sum("n").alias("n"), F.grouping("symbol").alias("is_total"))
    is_total = F.col("is_total") == 1
    status = F.when(is_total & (F.col("n") == 0), F.lit(OK)).otherwise(F.lit(BACKFILLED))
    return sums.filter(is_total | F.col("symbol").isNotNull()).select(
        F.lit(BACKFILL).alias("check_name"), F.when(is_total, F.lit(ALL_SYMBOLS)).otherwise(F.col("symbol")).alias("symbol"),
        status.alias("status"), F.col("n").cast("double").alias("value"))


def heal_disabled(spark) -> DataFrame:
    """The single check row of a cycle that has no history source."""
    return spark.range(1).select(
        F.lit(BACKFILL).alias("check_name"), F.lit(ALL_SYMBOLS).alias("symbol"),
        F.lit(DISABLED).alias("status"), F.lit(0.0).alias("value"))


def stamp(rows: DataFrame, as_of=None) -> DataFrame:
    """Healed rows with their write time, which is also their dedup version."""
    return rows.drop("ingested_at").withColumn("ingested_at", instant(as_of))
