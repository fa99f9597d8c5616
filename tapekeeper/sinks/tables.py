"""Writing the stored tables: micro-batches of trades, state tables, the check log, and their rewrites.

Every stored batch lies in folders named after its writer and the writer's batch number, and only a
batch of the same writer and number ever replaces it. A stream's writer is its query id, which lives
in its checkpoint; a healing cycle, a seed and a compaction are writers of their own each time.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapekeeper.functions.time import instant, span, utc_day
from tapekeeper.operators.alerts import retain
from tapekeeper.operators.dedup import dedup_latest
from tapekeeper.operators.health import seen_merge
from tapekeeper.operators.peaks import peak_merge
from tapekeeper.operators.runs import merge_runs
from tapekeeper.operators.sketches import merge_latency
from tapekeeper.schema import CHECKS, KEY, LATENCY, PEAKS, RETENTION_DAYS, RUNS, SEEN, STORED_CHECKS, STORED_TRADES, TRADES


def new_writer(kind: str) -> str:
    """A writer name that nobody had before."""
    return f"{kind}-{uuid.uuid4().hex}"


def plain_timestamps(spark: SparkSession) -> None:
    """From now on parquet writes of the session keep min/max of timestamps, so time filters can skip row groups."""
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def write_batch(trades: DataFrame, path: str, writer: str, batch_id: int = 0, as_of=None) -> None:
    """Write one batch so that writing it again changes nothing.

    Rows go to (trade_date, writer, batch_id) folders and replace only those. Late rows land in
    their own day. The rebalance lets Spark split a day that holds most of the batch and join small
    ones; the sort gives row groups tight id ranges.
    """
    stamped = trades if "ingested_at" in trades.columns else trades.withColumn("ingested_at", instant(as_of))
    rows = stamped.select(*TRADES.names).withColumns(
        {"trade_date": utc_day(F.col("trade_time")), "writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")})
    rows = rows.hint("rebalance", "trade_date").sortWithinPartitions("trade_date", "writer", "batch_id", *KEY)
    plain_timestamps(trades.sparkSession)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("trade_date", "writer", "batch_id").parquet(path))


def bounded(stored: DataFrame, as_of=None, window=None, low=None, high=None) -> DataFrame:
    """Stored rows newer than ``as_of - window`` and from ``low`` to ``high``, both included, where given.

    A filter on the timestamp alone prunes no day folder, so the matching day bound is added here.
    """
    if window is not None:
        start = instant(as_of) - span(window)
        stored = stored.filter((F.col("trade_date") >= utc_day(start)) & (F.col("trade_time") > start))
    if low is not None:
        stored = stored.filter((F.col("trade_date") >= utc_day(instant(low))) & (F.col("trade_time") >= instant(low)))
    if high is not None:
        stored = stored.filter((F.col("trade_date") <= utc_day(instant(high))) & (F.col("trade_time") <= instant(high)))
    return stored


def read_stored(spark: SparkSession, path: str, as_of=None, window=None, low=None, high=None) -> DataFrame:
    """Stored trades with duplicates resolved, optionally only those of a range; other days are not read.

    Equal versions go to the later writer by name, then its later batch. A trade's time never
    changes, so bounding the rows before resolving duplicates is exact, and copies meet within their day.
    """
    stored = bounded(spark.read.schema(STORED_TRADES).parquet(path), as_of, window, low, high)
    kept = dedup_latest(stored, [*KEY, "trade_date"], tiebreak=["writer", "batch_id"])
    return kept.drop("trade_date", "writer", "batch_id")


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite the stored trades to a new place, deduplicated; streams may go on writing there."""
    write_batch(read_stored(spark, path), target, new_writer("compact"))


def overwrite_batch(rows: DataFrame, path: str, writer: str, batch_id: int = 0, by=()) -> None:
    """Write rows as one batch folder of a writer, or one for each value of ``by``, replacing only that batch."""
    plain_timestamps(rows.sparkSession)
    rows = rows.withColumns({"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")})
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by, "writer", "batch_id").parquet(path))


def write_peaks(partials: DataFrame, path: str, writer: str, batch_id: int = 0) -> None:
    """Add peak partials to the state table."""
    overwrite_batch(partials.select(*PEAKS.names), path, writer, batch_id)


def seed_peaks(seed: DataFrame, path: str) -> None:
    """Add a seed to the state table. Seeds add up by maximum: seeding again never lowers or removes a peak."""
    write_peaks(seed, path, new_writer("seed"))


def read_peaks(spark: SparkSession, path: str) -> DataFrame:
    """All-time peak per symbol: the only way to read the state table."""
    return peak_merge(spark.read.schema(PEAKS).parquet(path))


def compact_peaks(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite the state table to a new place with one row per symbol."""
    write_peaks(read_peaks(spark, path), target, new_writer("compact"))


def write_seen(partials: DataFrame, path: str, writer: str, batch_id: int = 0) -> None:
    """Add newest trade times to the last-seen table."""
    overwrite_batch(partials.select(*SEEN.names), path, writer, batch_id)


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """Newest trade time per symbol: the only way to read the last-seen table."""
    return seen_merge(spark.read.schema(SEEN).parquet(path))


def write_runs(runs: DataFrame, path: str, writer: str, batch_id: int = 0) -> None:
    """Add id runs of one block of trades to the state table."""
    overwrite_batch(runs.select(*RUNS.names), path, writer, batch_id)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Maximal id runs per symbol: the only way to read the state table."""
    return merge_runs(spark.read.schema(RUNS).parquet(path))


def compact_runs(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite the state table to a new place with maximal runs only."""
    write_runs(read_runs(spark, path), target, new_writer("compact"))


def write_latency(partials: DataFrame, path: str, writer: str, batch_id: int = 0) -> None:
    """Add latency sketches to the state table, a folder per UTC day and batch."""
    overwrite_batch(partials.select(*LATENCY.names).coalesce(1), path, writer, batch_id, ["day"])


def read_latency(spark: SparkSession, path: str, low=None, high=None) -> DataFrame:
    """The sketches of the UTC days from ``low`` to ``high``, both included, where given; other days are not read."""
    stored = spark.read.schema(LATENCY).parquet(path)
    stored = stored if low is None else stored.filter(F.col("day") >= F.lit(low).cast("date"))
    return stored if high is None else stored.filter(F.col("day") <= F.lit(high).cast("date"))


def compact_latency(spark: SparkSession, path: str, target: str) -> None:
    """Rewrite the state table to a new place with one sketch per day."""
    write_latency(merge_latency(read_latency(spark, path), "day"), target, new_writer("compact"))


def append_checks(checks: DataFrame, path: str, as_of=None) -> None:
    """Append check rows to the log, stamped with one time, one folder per UTC day."""
    rows = checks.withColumn("checked_at", instant(as_of)).select(*CHECKS.names)
    rows = rows.withColumn("check_date", utc_day(F.col("checked_at"))).hint("rebalance")  # few rows: joined into one file
    plain_timestamps(checks.sparkSession)
    rows.write.mode("append").partitionBy("check_date").parquet(path)


def read_checks(spark: SparkSession, path: str, as_of=None, days: int | None = None) -> DataFrame:
    """The check log; with ``days`` only rows that recent, and only their day folders are read."""
    stored = spark.read.schema(STORED_CHECKS).parquet(path)
    if days is not None:
        first_day = utc_day(instant(as_of) - span(f"{days} days"))
        stored = retain(stored.filter(F.col("check_date") >= first_day), as_of, days)
    return stored.drop("check_date")


def rewrite_retained(spark: SparkSession, path: str, target: str, as_of=None, days: int = RETENTION_DAYS) -> None:
    """Copy the check rows still within retention to a new place; expired day folders are not read."""
    kept = read_checks(spark, path, as_of, days).withColumn("check_date", utc_day(F.col("checked_at")))
    plain_timestamps(spark)
    kept.hint("rebalance", "check_date").write.mode("errorifexists").partitionBy("check_date").parquet(target)
