"""Batches of a committed table that close on rows or on time, whichever comes first.

What a stream brings is staged as it comes: its files are written, and noted as waiting, but nobody sees them. Once enough rows wait, or the
first of them has waited long enough, all that waits becomes one batch, visible as a whole. So readers find few, full
batches when much comes in, and rows no older than the bound when little does.
"""

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapekeeper.functions.time import instant
from tapekeeper.sinks.commits import ENTRY, TRADE_TABLE, Table, commit, last_batch, stage
from tapekeeper.sinks.tables import new_writer, plain_timestamps

# A staged file and when its rows came.
WAITING = f"{ENTRY}, staged_at timestamp"


def _waiting(spark: SparkSession, path: str, writer: str, last: int) -> DataFrame:
    """Log rows of what the writer has staged since its last visible batch. Each batch's waiting rows have a folder of their own, so a read
    lists no more than one batch's."""
    try:
        return spark.read.schema(WAITING).parquet(_folder(path, writer, last))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], WAITING)


def _folder(path: str, writer: str, last: int) -> str:
    return f"{path}/waiting/{writer}/{last}"


def waiting_rows(spark: SparkSession, path: str, writer: str) -> int:
    """How many rows of the writer are staged and not yet visible."""
    rows = _waiting(spark, path, writer, last_batch(spark, path, writer))
    return rows.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def close_waiting(spark: SparkSession, path: str, writer: str, rows: int = 1, within: float = 0.0, now: datetime | None = None) -> bool:
    """Makes what waits visible if it is ``rows`` or more, or has waited ``within`` seconds; tells whether it did.

    With the defaults all that waits becomes visible: for the end of a stream.
    """
    return _close(spark, path, writer, last_batch(spark, path, writer), rows, within, now or datetime.now(timezone.utc))


def _close(spark: SparkSession, path: str, writer: str, last: int, rows: int, within: float, now: datetime) -> bool:
    found = _waiting(spark, path, writer, last)
    total, first, number = found.agg(F.sum("rows"), F.unix_micros(F.min("staged_at")), F.max("batch_id")).first()
    if total is None or (total < rows and now.timestamp() - first / 1e6 < within):
        return False
    one = {"commit": F.lit(new_writer("commit")), "batch_id": F.lit(number).cast("long")}
    commit(found.drop("staged_at").withColumns(one), path, writer, number)
    return True


def add_waiting(batch: DataFrame, path: str, writer: str, batch_id: int, rows: int, within: float, now: datetime | None = None,
                table: Table = TRADE_TABLE) -> bool:
    """Stages a micro-batch and closes what waits if it is due; tells whether it closed.

    A micro-batch that is done again after a crash replaces its own waiting rows; if it had already become visible it adds
    nothing. Micro-batches of a writer come one after the other, by number; the batch has the number of the last one that brought
    rows. A batch has ``rows`` rows or up to a micro-batch more, unless time closed it.
    """
    spark, now = batch.sparkSession, now or datetime.now(timezone.utc)
    last = last_batch(spark, path, writer)
    if batch_id <= last:
        return False
    if table.version and table.version not in batch.columns:
        batch = batch.withColumn(table.version, instant(now))
    staged = stage(batch, path, writer, batch_id, 0, table).withColumn("staged_at", instant(now))
    plain_timestamps(spark)
    (staged.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
           .parquet(_folder(path, writer, last)))
    return _close(spark, path, writer, last, rows, within, now)
