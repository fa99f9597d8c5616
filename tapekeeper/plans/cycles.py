"""One monitoring cycle and one healing cycle, each a single lazy plan for a scheduler to run."""

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapekeeper.functions.symbols import only_symbols, symbols_frame
from tapekeeper.functions.time import instant, span
from tapekeeper.operators.dedup import merge_rows
from tapekeeper.operators.gaps import gap_ranges, plan_heal
from tapekeeper.operators.heal import heal, heal_audit, heal_disabled, rows_in_gaps, stamp
from tapekeeper.operators.health import check_freshness, check_rows, check_symbol_stalls, check_trade_gaps
from tapekeeper.operators.health import seen_partial
from tapekeeper.operators.peaks import peak_partial
from tapekeeper.operators.runs import gaps_between, id_runs
from tapekeeper.schema import (
    ALL_SYMBOLS, BACKFILL, BACKFILLED, FRESHNESS, FRESHNESS_SECONDS, GAP_DETECTED, GAP_WINDOW, HEAL_WINDOW, NEVER_SEEN_SECONDS,
    STALE, STALL_SECONDS, STALLED, SYMBOL_STALL, TRADE_GAP)
from tapekeeper.sinks.history import StoredHistory
from tapekeeper.sinks.tables import read_seen, write_batch, write_peaks, write_runs, write_seen
from tapekeeper.sources.tables import scan_trades


def run_health(trades: DataFrame, symbols, as_of=None, freshness=FRESHNESS_SECONDS, stall=STALL_SECONDS,
               gap_window=GAP_WINDOW, seen: DataFrame | None = None) -> DataFrame:
    """All check rows of one cycle; write them with one ``append_checks``.

    With ``seen``, the last-seen table, freshness and stalls don't look at the trades, which then
    need to reach back no further than the gap window.
    """
    newest = trades if seen is None else seen
    return (check_freshness(newest, as_of, freshness)
            .unionByName(check_symbol_stalls(newest, symbols, as_of, stall))
            .unionByName(check_trade_gaps(trades, symbols, as_of, gap_window)))


def run_stored_health(spark: SparkSession, path: str, seen_path: str, symbols, as_of=None, freshness=FRESHNESS_SECONDS,
                      stall=STALL_SECONDS, gap_window=GAP_WINDOW) -> DataFrame:
    """The same over the stored tables: a few day folders for the gaps, and the last-seen table for the rest."""
    recent = scan_trades(spark, path, as_of, gap_window)
    return run_health(recent, symbols, as_of, freshness, stall, gap_window, read_seen(spark, seen_path))


class HealCycle(NamedTuple):
    plan: DataFrame | None    # gaps with HEAL or SKIPPED
    rows: DataFrame | None    # trades to write, stamped
    audit: DataFrame          # check rows
    cycle_id: str = ""        # under which the rows are stored


def run_heal(trades: DataFrame, history: DataFrame | StoredHistory | None, symbols=None, as_of=None, window=HEAL_WINDOW,
             max_gap: int | None = None, pin: bool | None = None, runs: DataFrame | None = None) -> HealCycle:
    """Find gaps, fetch their rows from history and audit it. No history: DISABLED. Wider gaps than ``max_gap``, if set, are skipped.

    ``pin`` writes the plan to the session's checkpoint folder (the default where one is set), so
    that rows and audit, run one after the other, agree on a tape that keeps growing, gaps are
    searched once, and the join with the history knows how few they are. Whoever owns that folder clears it. With ``runs``, the
    merged state of ids, gaps of any age come from it, and the trades and the window are not looked at. A stored history
    opens only the files that the gaps meet.
    """
    spark, cycle = trades.sparkSession, uuid.uuid4().hex
    if history is None:
        return HealCycle(None, None, heal_disabled(spark), cycle)
    gaps = gap_ranges(trades, symbols, as_of, window) if runs is None else gaps_between(only_symbols(runs, symbols))
    plan = plan_heal(gaps, max_gap)
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if pin and not folder:
        raise ValueError("set spark.checkpoint.dir to pin the plan of a healing cycle")
    if folder and pin is not False:
        plan.write.parquet(f"{folder}/heal-{cycle}")
        plan = spark.read.schema(plan.schema).parquet(f"{folder}/heal-{cycle}")
    healed = history.fill(plan) if isinstance(history, StoredHistory) else heal(plan, history)
    return HealCycle(plan, stamp(healed, as_of), heal_audit(plan, healed), cycle)


def store_heal(cycle: HealCycle, path: str, peaks_path: str | None = None, seen_path: str | None = None,
               runs_path: str | None = None) -> None:
    """Write a cycle's rows beside all that is stored, and fold their peaks, newest times and runs of ids.

    Each cycle is a writer of its own, so no cycle replaces another's rows; storing the same cycle
    again replaces just its own.
    """
    if cycle.rows is None:
        return
    writer = f"heal-{cycle.cycle_id}"
    write_batch(cycle.rows, path, writer)
    if peaks_path is not None:
        write_peaks(peak_partial(cycle.rows), peaks_path, writer)
    if seen_path is not None:
        write_seen(seen_partial(cycle.rows), seen_path, writer)
    if runs_path is not None:
        write_runs(id_runs(cycle.rows), runs_path, writer)


def healed_view(trades: DataFrame, cycle: HealCycle) -> DataFrame:
    """The tape as read after the healed rows were merged in."""
    return trades if cycle.rows is None else merge_rows(trades, cycle.rows.select(*trades.columns))


def run_cycles(trades: DataFrame, history: DataFrame, symbols, first, last, every, freshness=FRESHNESS_SECONDS, stall=STALL_SECONDS,
               window=HEAL_WINDOW) -> DataFrame:
    """The check rows, ``checked_at`` included, of a monitor and healer that ran ``every`` so often from ``first`` to ``last``.

    One plan for all cycles, keyed by the cycle's number, instead of a plan for each: a cycle sees the trades up to its time,
    and looks for gaps in the ``window`` before it. A trade goes to the cycles in whose window it lies, so the work is the tape times
    window over interval. Newest times are running maxima over one row per symbol and cycle.
    """
    spark, micros = trades.sparkSession, F.unix_micros(F.col("trade_time"))
    start, step, width, end = (int(x) for x in spark.range(1).select(
        F.unix_micros(instant(first)), F.unix_micros(instant(first) + span(every)) - F.unix_micros(instant(first)),
        F.unix_micros(instant(first) + span(window)) - F.unix_micros(instant(first)), F.unix_micros(instant(last))).first())
    cycles = max(0, (end - start) // step + 1)
    if not cycles:
        return spark.createDataFrame([], "check_name string, symbol string, status string, value double, checked_at timestamp")
    time = F.timestamp_micros(F.lit(start) + F.col("cycle") * step)
    # Of a trade the first cycle that sees it, and the last in whose window it lies.
    low = F.greatest(F.lit(0), F.ceil((micros - start) / F.lit(float(step)))).cast("long")
    high = F.least(F.lit(cycles - 1), F.ceil((micros - start + width) / F.lit(float(step))) - 1).cast("long")
    placed = trades.select("symbol", "trade_id", "trade_time", low.alias("low"), high.alias("high"))

    seen = placed.filter(F.col("low") < cycles).groupBy("symbol", F.col("low").alias("cycle")).agg(F.max("trade_time").alias("newest"))
    every_cycle = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cycles - 1).cast("long"))).alias("cycle")
    grid = symbols_frame(spark, symbols).select("symbol", every_cycle)
    so_far = lambda *keys: F.max("newest").over(Window.partitionBy(*keys).orderBy("cycle"))
    age = F.coalesce((F.unix_timestamp(time) - F.unix_timestamp("newest")).cast("double"), F.lit(NEVER_SEEN_SECONDS))
    by_symbol = grid.join(seen, ["symbol", "cycle"], "left").withColumn("newest", so_far("symbol")).withColumn("age", age)
    overall = spark.range(1).select(every_cycle).join(
        seen.groupBy("cycle").agg(F.max("newest").alias("newest")), "cycle", "left").withColumn("newest", so_far()).withColumn("age", age)

    looked = only_symbols(placed, symbols).filter(F.col("high") >= F.col("low")).select(
        "symbol", "trade_id", F.explode(F.sequence("low", "high")).alias("cycle"))
    gaps = gap_ranges(looked, window=None, by=["cycle"])
    missing = gaps.groupBy("cycle", "symbol").agg(F.sum("missing").alias("missing"))
    back = rows_in_gaps(gaps, history.select("symbol", "trade_id"), by=["cycle"]).groupBy("cycle", "symbol").agg(F.count(F.lit(1)).alias("n"))
    counted = grid.join(missing, ["cycle", "symbol"], "left").join(back, ["cycle", "symbol"], "left").withColumns(
        {"missing": F.coalesce("missing", F.lit(0)), "n": F.coalesce("n", F.lit(0))})
    total = counted.groupBy("cycle").agg(F.sum("n").alias("n"))

    def rows(df, name, symbol, bad, status, value):
        with_time = df.withColumn("checked_at", time)
        return check_rows(with_time, name, symbol, bad, status, value, "checked_at")

    everybody = F.lit(ALL_SYMBOLS)
    return (rows(overall, FRESHNESS, everybody, F.col("age") > freshness, STALE, F.col("age"))
            .unionByName(rows(by_symbol, SYMBOL_STALL, F.col("symbol"), F.col("age") > stall, STALLED, F.col("age")))
            .unionByName(rows(counted, TRADE_GAP, F.col("symbol"), F.col("missing") > 0, GAP_DETECTED, F.col("missing")))
            .unionByName(rows(counted.filter("missing > 0"), BACKFILL, F.col("symbol"), F.lit(True), BACKFILLED, F.col("n")))
            .unionByName(rows(total, BACKFILL, everybody, F.col("n") > 0, BACKFILLED, F.col("n"))))
