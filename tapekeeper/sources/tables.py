"""Reading the tape: the trade stream, and the stored tables with day pruning."""

from pyspark.sql import DataFrame, SparkSession

from tapekeeper.schema import STORED_TRADES
from tapekeeper.sinks.tables import bounded


def read_trades(spark: SparkSession, source: str, schema=None, **options) -> DataFrame:
    """An unbounded stream of messages, from the earliest, resuming where its checkpoint left off.

    ``source`` is ``"kafka"`` (options as that connector takes them; needs its package) or a file
    format with ``path`` and an explicit ``schema``. Batches close on size or time: for Kafka set
    ``minOffsetsPerTrigger`` with ``maxTriggerDelay`` and cap them with ``maxOffsetsPerTrigger``;
    for files cap them with ``maxFilesPerTrigger`` and set the writer's flush interval.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        return reader.options(**{"startingOffsets": "earliest", **options}).load()
    if schema is None:
        raise ValueError("a file stream needs an explicit schema")
    return reader.schema(schema).options(**options).load()


def scan_trades(spark: SparkSession, path: str, as_of=None, window=None, low=None, high=None) -> DataFrame:
    """Stored trades, raw (duplicates included), optionally only those of a lookback or range; other days are not read."""
    return bounded(spark.read.schema(STORED_TRADES).parquet(path), as_of, window, low, high)
