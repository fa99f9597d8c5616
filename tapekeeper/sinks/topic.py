"""Publishing trades keyed by symbol."""

from pyspark.sql import DataFrame, functions as F

from tapekeeper.schema import TRADE_AVRO, TRADE_MESSAGE


def to_messages(trades: DataFrame) -> DataFrame:
    """Trades as message records: prices as exact text, time as epoch milliseconds."""
    return trades.select(
        "symbol", "trade_id", F.col("price").cast("string").alias("price"),
        F.col("quantity").cast("string").alias("quantity"),
        F.unix_millis("trade_time").alias("trade_time"))


def to_topic(trades: DataFrame, schema_id: int | None = None) -> DataFrame:
    """(key, value) rows for a topic: the key is the symbol, so a symbol's trades share a topic partition.

    Without ``schema_id`` the value is JSON text; with it, the Avro envelope (needs spark-avro).
    """
    record = F.struct(*TRADE_MESSAGE.names)
    if schema_id is None:
        value = F.to_json(record).cast("binary")
    else:
        from pyspark.sql.avro.functions import to_avro

        value = F.concat(F.unhex(F.lit(f"00{schema_id:08x}")), to_avro(record, TRADE_AVRO))
    return to_messages(trades).select(F.col("symbol").cast("binary").alias("key"), value.alias("value"))


def publish(trades: DataFrame, servers: str, topic: str, schema_id: int | None = None) -> None:
    """Write a batch to the topic; needs the Kafka package on the cluster."""
    (to_topic(trades, schema_id).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def write_ordered(trades: DataFrame, path: str) -> None:
    """The same promise on files: rows of a symbol in id order from file to file, a hot symbol over many files."""
    trades.repartitionByRange("symbol", "trade_id").sortWithinPartitions("symbol", "trade_id").write.parquet(path)
