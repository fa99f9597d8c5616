"""Committed tables: batches that become visible as a whole, reads of a snapshot, an index by day, and merges of small files.

A batch's files are written first, under a name nobody knows, and then one row per file goes to the log in a single
small file: that file's appearance is the commit. Readers take their file names from the log and never list the data.
Files are never changed or replaced in place, so what a reader has opened stays whole whatever is written or merged.

``fold`` moves the log into an index by day and begins a new epoch of the log; a read then opens the index of
the days it needs and the log of the last two epochs. All of it is plain Parquet, read and written by Spark.
"""

import datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tapekeeper.functions.time import instant, span, utc_day
from tapekeeper.operators.dedup import dedup_latest
from tapekeeper.schema import CHECKS, KEY, RETENTION_DAYS, TRADES, VERSION
from tapekeeper.sinks.tables import new_writer, plain_timestamps


class Table(NamedTuple):
    """What a committed table holds: rows with a time, and, where rows are versions of a key, key and version."""

    schema: T.StructType
    time: str
    key: tuple[str, ...] = ()
    version: str = ""
    number: str = ""    # a whole-number column whose range is kept per file


TRADE_TABLE = Table(TRADES, "trade_time", tuple(KEY), VERSION, "trade_id")
CHECK_TABLE = Table(CHECKS, "checked_at")

# Batches of a level that a day may have before they are merged into one of the next.
FAN = 8

# Of a stored row: who wrote it and in which batch.
ORIGIN = "writer string, batch_id bigint"

# A file: where it is, the day its rows are of, their times and numbers, and how often they have been merged.
FILE = ("file string, day date, low_time timestamp, high_time timestamp, low_number bigint, high_number bigint, "
        "rows bigint, level int")
ENTRY = f"commit string, {ORIGIN}, kind string, {FILE}"

# Where rows without a time are kept.
NO_DAY = datetime.date(1000, 1, 1)

# A file that joins the table, one that leaves it, and a batch without rows.
ADD, DROP, EMPTY = "add", "drop", "empty"


def _read(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Rows of the folders that exist."""
    found = None
    for path in paths:
        try:
            rows = spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], schema) if found is None else found


class Head(NamedTuple):
    epoch: int                       # of the log that commits go to
    days: list[datetime.date]        # that the index has


def head(spark: SparkSession, path: str) -> Head:
    """The newest index; before the first fold there is none."""
    last = _read(spark, [f"{path}/heads"], "epoch bigint, days array<date>").orderBy(F.desc("epoch")).limit(1).collect()
    return Head(last[0].epoch, last[0].days) if last else Head(0, [])


def _folded(spark: SparkSession, path: str, at: Head) -> DataFrame:
    """How far each writer's batches are in the index."""
    return _read(spark, [f"{path}/folded/epoch={at.epoch}"], ORIGIN)


def _log(spark: SparkSession, path: str, at: Head) -> DataFrame:
    """Log rows that the index does not have: of this epoch, and what came late to the one before.

    A writer's batches come in the order of their numbers, so what lies beyond its last one in the index is new. Of two commits
    of one batch, by a writer that did not know of its first, the first by name counts.
    """
    rows = _read(spark, [f"{path}/log/epoch={epoch}" for epoch in {at.epoch, max(0, at.epoch - 1)}], ENTRY)
    known = _folded(spark, path, at).withColumnRenamed("batch_id", "last_")
    new = rows.join(known, "writer", "left").filter("last_ is null or batch_id > last_").drop("last_")
    first = F.min("commit").over(Window.partitionBy("writer", "batch_id"))
    return new.withColumn("first_", first).filter("commit = first_").select(*_names(ENTRY)).distinct()


def entries(spark: SparkSession, path: str, low: datetime.date | None = None, high: datetime.date | None = None,
            at: Head | None = None, log: DataFrame | None = None) -> DataFrame:
    """The files of the table now, with the columns of ENTRY; only those of the days from ``low`` to ``high``, where given.

    Of the index only those days' folders are opened. The log is small: what has been committed since the last folds.
    """
    at = at or head(spark, path)
    log = _log(spark, path, at) if log is None else log
    base = f"{path}/index/epoch={at.epoch}"
    folders = [f"{base}/day={day}" for day in at.days if (low is None or day >= low) and (high is None or day <= high)]
    rows = log.filter(F.col("kind") == ADD)
    if folders:
        rows = rows.unionByName(spark.read.schema(ENTRY).option("basePath", base).parquet(*folders).select(*_names(ENTRY)))
    if low is not None:
        rows = rows.filter(F.col("day") >= F.lit(low))
    if high is not None:
        rows = rows.filter(F.col("day") <= F.lit(high))
    return rows.join(log.filter(F.col("kind") == DROP).select("file").distinct(), "file", "left_anti").select(*_names(ENTRY))


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def is_committed(spark: SparkSession, path: str, writer: str, batch_id: int) -> bool:
    """Whether the writer's batch is in the table."""
    at = head(spark, path)
    indexed = _folded(spark, path, at).filter((F.col("writer") == writer) & (F.col("batch_id") >= batch_id))
    logged = _log(spark, path, at).filter((F.col("writer") == writer) & (F.col("batch_id") == batch_id))
    return not indexed.isEmpty() or not logged.isEmpty()


def last_batch(spark: SparkSession, path: str, writer: str) -> int:
    """The number of the writer's last batch in the table, -1 if there is none."""
    at = head(spark, path)
    known = _folded(spark, path, at).select("writer", "batch_id").unionByName(_log(spark, path, at).select("writer", "batch_id"))
    return known.filter(F.col("writer") == writer).agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]


def stage(rows: DataFrame, path: str, writer: str, batch_id: int = 0, level: int = 0, table: Table = TRADE_TABLE) -> DataFrame:
    """Writes the batch's files and returns their log rows: until ``commit`` nobody sees them.

    Days are rebalanced, so a day that holds most of a batch gets several files and small ones one; rows without a
    time have a day folder of their own, and no time range. Rows are sorted by key, so number ranges are tight.
    """
    spark, name = rows.sparkSession, new_writer("commit")
    origin = {} if "writer" in rows.columns else {"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")}
    placed = rows.withColumns(origin).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields], "writer", "batch_id",
        F.coalesce(utc_day(F.col(table.time)), F.lit(NO_DAY)).alias("day"))
    plain_timestamps(spark)
    placed.hint("rebalance", "day").sortWithinPartitions("day", *table.key).write.partitionBy("day").parquet(f"{path}/data/{name}")
    number = F.col(table.number) if table.number else F.lit(None).cast("bigint")
    try:
        written = spark.read.schema(stored_schema(table)).parquet(f"{path}/data/{name}")
    except AnalysisException as error:  # a batch without rows may leave no folder
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        written = spark.createDataFrame([], stored_schema(table))
        files = spark.createDataFrame([], FILE)
    else:
        files = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.coalesce(F.min(utc_day(F.col(table.time))), F.lit(NO_DAY)).alias("day"), F.min(table.time).alias("low_time"), F.max(table.time).alias("high_time"),
            F.min(number).alias("low_number"), F.max(number).alias("high_number"), F.count(F.lit(1)).alias("rows"),
            F.lit(level).alias("level"))
    named = [F.lit(name).alias("commit"), F.lit(writer).alias("writer"), F.lit(batch_id).cast("long").alias("batch_id")]
    return files.select(*named, F.lit(ADD).alias("kind"), *_names(FILE))


def commit(staged: DataFrame, path: str, writer: str, batch_id: int = 0, dropped: list[str] = ()) -> None:
    """Makes staged files visible, all at once, and takes the ``dropped`` out in the same moment.

    The log rows of a commit are one file. If a fold has ended since the epoch was looked up, the next one might not see them
    there, so they are written again to the present epoch; the same commit twice counts once.
    """
    spark = staged.sparkSession
    rows = [tuple(r) for r in staged.select(*_names(ENTRY)).collect()]  # one per file of the batch
    name = rows[0][0] if rows else new_writer("commit")
    gone = [(name, writer, batch_id, DROP, file, *[None] * 7) for file in dropped]  # days of no use: a drop holds everywhere
    empty = [(name, writer, batch_id, EMPTY, *[None] * 8)] if not rows and not gone else []
    plain_timestamps(spark)
    while True:
        epoch = head(spark, path).epoch
        spark.createDataFrame(rows + gone + empty, ENTRY).coalesce(1).write.mode("append").parquet(f"{path}/log/epoch={epoch}")
        if head(spark, path).epoch == epoch:
            return


def commit_batch(rows: DataFrame, path: str, writer: str, batch_id: int = 0, as_of=None, table: Table = TRADE_TABLE) -> bool:
    """Writes and commits a batch unless it is committed already; tells which."""
    if is_committed(rows.sparkSession, path, writer, batch_id):
        return False
    if table.version and table.version not in rows.columns:
        rows = rows.withColumn(table.version, instant(as_of))
    commit(stage(rows, path, writer, batch_id, 0, table), path, writer, batch_id)
    return True


def stored_schema(table: Table) -> T.StructType:
    return T.StructType(table.schema.fields + [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())])


class Snapshot(NamedTuple):
    """The files a table had when it was opened. Reading it again gives the same rows, whatever has been committed since."""

    spark: SparkSession
    table: Table
    files: list[str]
    low: object = None
    high: object = None

    def scan(self) -> DataFrame:
        """All stored rows inside the snapshot's bounds, raw."""
        schema = stored_schema(self.table)
        rows = self.spark.read.schema(schema).parquet(*self.files) if self.files else self.spark.createDataFrame([], schema)
        if self.low is not None:
            rows = rows.filter(F.col(self.table.time) >= instant(self.low))
        if self.high is not None:
            rows = rows.filter(F.col(self.table.time) <= instant(self.high))
        return rows

    def read(self) -> DataFrame:
        """The rows with versions resolved: equal ones go to the later writer by name, then its later batch."""
        rows = self.scan()
        if self.table.key:
            rows = dedup_latest(rows, list(self.table.key), self.table.version, ["writer", "batch_id"])
        return rows.drop("writer", "batch_id")


def _days(spark: SparkSession, low, high) -> tuple:
    day = lambda value: None if value is None else spark.range(1).select(utc_day(instant(value))).first()[0]
    return day(low), day(high)


def snapshot(spark: SparkSession, path: str, as_of=None, window=None, low=None, high=None, table: Table = TRADE_TABLE) -> Snapshot:
    """The table as it is now, or its rows from ``low`` to ``high`` or of the ``window`` before ``as_of``.

    Files outside the range are not opened, nor is the index of other days. A trade's time never changes, so
    its copies lie in the same day and bounding rows before resolving versions is exact.
    """
    if window is not None:
        low = spark.range(1).select((instant(as_of) - span(window) + F.expr("INTERVAL 0.000001 SECOND")).cast("string")).first()[0]
    found = entries(spark, path, *_days(spark, low, high))
    if low is not None:
        found = found.filter(F.col("high_time") >= instant(low))
    if high is not None:
        found = found.filter(F.col("low_time") <= instant(high))
    return Snapshot(spark, table, sorted(r.file for r in found.select("file").collect()), low, high)


def fold(spark: SparkSession, path: str) -> None:
    """Moves what the log has into a new index by day and begins the log's next epoch. One fold at a time.

    The log's files are listed once, so what is indexed and what is marked as indexed agree. Commits that arrive meanwhile
    stay in the log of the epoch before, which readers and the next fold look into as well.
    """
    at = head(spark, path)
    log = _log(spark, path, at)
    live, new = entries(spark, path, at=at, log=log), at.epoch + 1
    plain_timestamps(spark)
    live.hint("rebalance", "day").write.partitionBy("day").parquet(f"{path}/index/epoch={new}")
    marks = _folded(spark, path, at).unionByName(log.select("writer", "batch_id"))
    marks.groupBy("writer").agg(F.max("batch_id").alias("batch_id")).coalesce(1).write.parquet(f"{path}/folded/epoch={new}")
    days = sorted(r.day for r in live.select("day").distinct().collect())
    spark.createDataFrame([(new, days)], "epoch bigint, days array<date>").coalesce(1).write.mode("append").parquet(f"{path}/heads")


def merge(spark: SparkSession, path: str, fan: int = FAN, table: Table = TRADE_TABLE) -> int:
    """Merges a day's batches of a level into one of the next where it has ``fan`` or more; returns how many files went in.

    So a day has fewer than ``fan`` batches of each level, and levels grow with the logarithm of its batches. Versions are
    resolved among the rows merged, which changes no read. The files merged leave the table in the commit that adds their
    successor, and stay where they are for snapshots that are open. Streams may go on writing; one merge at a time.
    """
    gone = 0
    while True:
        files = entries(spark, path)
        full = files.groupBy("day", "level").agg(F.countDistinct("commit").alias("n")).filter(F.col("n") >= fan)
        lowest = full.groupBy("day").agg(F.min("level").alias("level"))
        chosen = files.join(lowest, ["day", "level"]).select("file", "level").collect()
        if not chosen:
            return gone
        level = min(r.level for r in chosen)
        names = sorted(r.file for r in chosen if r.level == level)
        rows = spark.read.schema(stored_schema(table)).parquet(*names)
        if table.key:
            rows = dedup_latest(rows, list(table.key), table.version, ["writer", "batch_id"])
        writer = new_writer("merge")
        commit(stage(rows, path, writer, 0, level + 1, table), path, writer, 0, names)
        gone += len(names)


def expire(spark: SparkSession, path: str, as_of=None, days: int = RETENTION_DAYS) -> int:
    """Takes whole days out that ended before the retention period; no row is read or copied. Returns how many files went."""
    first = spark.range(1).select(utc_day(instant(as_of) - span(f"{days} days"))).first()[0]
    names = [r.file for r in entries(spark, path, NO_DAY + datetime.timedelta(1), first - datetime.timedelta(1)).select("file").collect()]
    if names:
        writer = new_writer("expire")
        commit(spark.createDataFrame([], ENTRY), path, writer, 0, names)
    return len(names)
