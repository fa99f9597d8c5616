"""Streaming intake: the effectively-once writer, the live peak, bounded dedup and ingest lag."""

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tapekeeper.functions.time import instant
from tapekeeper.operators.health import seen_partial
from tapekeeper.operators.peaks import peak_partial
from tapekeeper.operators.runs import id_runs
from tapekeeper.operators.sketches import latency_partial
from tapekeeper.schema import KEY
from tapekeeper.sinks.closing import add_waiting
from tapekeeper.sinks.commits import commit_batch
from tapekeeper.sinks.tables import overwrite_batch, write_batch, write_latency, write_peaks, write_runs, write_seen
from tapekeeper.sources.intake import REASON, split_valid


PROGRESS = "query_id string, batch_id bigint, at timestamp, input_rows bigint, millis bigint, behind bigint"

# Fixed value: where Spark keeps the running stream's id.
QUERY_ID = "sql.streaming.queryId"


def write_trades(stream: DataFrame, path: str, checkpoint: str, flush: str | None = "2 seconds",
                 peaks_path: str | None = None, quarantine_path: str | None = None,
                 seen_path: str | None = None, committed: bool = False, runs_path: str | None = None,
                 latency_path: str | None = None) -> StreamingQuery:
    """Write a stream of typed trades, one folder per micro-batch, and return the running query.

    With ``committed`` the target is a committed table: a batch becomes visible as a whole, and a replayed one, known by writer and
    number, is not written again.

    Offsets are committed only after the batch is written, and a replayed batch overwrites its own
    folders, so a crash at any point loses and repeats nothing once reads resolve duplicates. The
    writer is the query's id, which its checkpoint keeps over restarts: other streams, a fresh
    checkpoint, healing and compaction all write beside it. ``flush`` is the batch interval (None:
    drain what is there, then stop); batch size is set on the source. With ``peaks_path`` each batch
    also leaves its peak partials, with ``seen_path`` its newest times, with ``runs_path`` its runs of ids, with ``latency_path`` its sketches of
    write latency, with ``quarantine_path`` its unusable rows. No watermark: rows may arrive at any age.
    """
    several = any(p is not None for p in (peaks_path, quarantine_path, seen_path, runs_path, latency_path))

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        if several:
            batch = batch.persist()  # read once per target; lost blocks are recomputed from the source
        try:
            good, bad = split_valid(batch) if REASON in batch.columns else (batch, None)
            if latency_path is not None and "ingested_at" not in good.columns:
                good = good.withColumn("ingested_at", instant(datetime.now(timezone.utc)))  # one time for rows and latency
            (commit_batch if committed else write_batch)(good, path, writer, batch_id)
            if peaks_path is not None:
                write_peaks(peak_partial(good), peaks_path, writer, batch_id)
            if seen_path is not None:
                write_seen(seen_partial(good), seen_path, writer, batch_id)
            if runs_path is not None:
                write_runs(id_runs(good), runs_path, writer, batch_id)
            if latency_path is not None:
                write_latency(latency_partial(good), latency_path, writer, batch_id)
            if quarantine_path is not None and bad is not None:
                overwrite_batch(bad, quarantine_path, writer, batch_id)
        finally:
            if several:
                batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if flush is None else writer.trigger(processingTime=flush)
    return writer.start()


def with_heartbeat(stream: DataFrame) -> DataFrame:
    """The stream, with a source that has something new every second and adds no row: batches come also while nothing comes in."""
    beats = stream.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load().filter("false")
    return stream.unionByName(beats.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]))


def write_closing(stream: DataFrame, path: str, checkpoint: str, rows: int = 10_000, within: float = 2.0,
                  every: str | None = "1 second") -> StreamingQuery:
    """Write a stream of typed trades into a committed table whose batches close on ``rows`` or ``within`` seconds, whichever comes first.

    Rows are staged ``every`` so often, in micro-batches that the source caps (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``), and
    offsets follow the staged rows, so a crash loses none of them and shows none twice. A heartbeat keeps the time
    bound while nothing comes in. With ``every`` None what is there is drained; ``close_waiting`` shows the rest.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        add_waiting(batch, path, batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID), batch_id, rows, within)

    writer = (stream if every is None else with_heartbeat(stream)).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def peak_stream(stream: DataFrame) -> DataFrame:
    """Continuously maintained peak per symbol; run it in update or complete mode. State: one number per symbol."""
    return peak_partial(stream)


def write_live_peaks(stream: DataFrame, path: str, checkpoint: str, flush: str | None = "2 seconds") -> StreamingQuery:
    """The peak as a streaming aggregate in update mode: the state holds a number per symbol, and each batch writes the peaks it raised
    or saw as partials. A query that stops goes on from its state; a replayed batch replaces its own partials."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_peaks(batch, path, f"live-{batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)}", batch_id)

    writer = peak_stream(stream).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if flush is None else writer.trigger(processingTime=flush)).start()


def append_progress(spark: SparkSession, query: StreamingQuery, path: str) -> None:
    """Adds what a query still knows of its recent batches to a stored table: (query_id, batch_id, at, input_rows, millis, behind).

    ``behind`` is how many messages the source had beyond the batch, over all partitions; null for sources without such offsets. Call it now and
    then while a query runs, or when it has ended; a batch may come more than once.
    """
    rows = []
    for progress in query.recentProgress:
        told = json.loads(progress.json)
        ends = [(_offsets(s.get("endOffset")), _offsets(s.get("latestOffset"))) for s in told.get("sources", [])]
        behind = [sum(latest.values()) - sum(end.get(k, 0) for k in latest) for end, latest in ends if latest]
        rows.append((told["id"], told["batchId"], told["timestamp"], told["numInputRows"], told.get("batchDuration"), sum(behind) if behind else None))
    listed = spark.createDataFrame(rows, "query_id string, batch_id bigint, at string, input_rows bigint, millis bigint, behind bigint")
    listed.withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Each batch once, as last told."""
    rows = spark.read.schema(PROGRESS).parquet(path)
    last = rows.groupBy("query_id", "batch_id").agg(F.max(F.struct("input_rows", "at", "millis", "behind")).alias("last"))
    return last.select("query_id", "batch_id", "last.*")


def _offsets(offset) -> dict:
    """(topic, partition) -> offset of a source that counts so; empty for others."""
    found = json.loads(offset) if isinstance(offset, str) else offset
    if not isinstance(found, dict) or not all(isinstance(parts, dict) for parts in found.values()):
        return {}
    return {(topic, part): at for topic, parts in found.items() for part, at in parts.items()}


def dedup_stream(stream: DataFrame, delay: str) -> DataFrame:
    """Drops repeats of a trade that arrive within ``delay`` of it, with state bounded by that delay.

    Trades older than the watermark, the newest trade time less ``delay``, are LOST here: Spark drops
    them. So this is only for live readers that cannot resolve duplicates themselves, never the way
    into the stored table, whose writer takes rows of any age and whose reads keep the exact rule.
    """
    return stream.withWatermark("trade_time", delay).dropDuplicatesWithinWatermark(KEY)


def stream_lag(spark: SparkSession, progress: dict) -> DataFrame:
    """(source, topic, partition, current_offset, latest_offset, lag) from a query's ``lastProgress``.

    Offsets come as nested topic -> partition -> offset maps; a source with other offsets gives no row.
    """
    progress = progress if isinstance(progress, dict) else json.loads(progress.json)
    rows = [(s.get("description"), _text(s.get("endOffset")), _text(s.get("latestOffset")))
            for s in progress.get("sources", [])]
    shape = "map<string,map<string,bigint>>"
    sources = spark.createDataFrame(rows, "source string, at string, latest string").select(
        "source", F.from_json("at", shape).alias("at"), F.from_json("latest", shape).alias("latest"))
    topics = sources.select("source", "at", F.explode("latest").alias("topic", "newest"))
    parts = topics.select("source", "topic", F.col("at")[F.col("topic")].alias("at"),
                          F.explode("newest").alias("partition", "latest_offset"))
    current = F.coalesce(F.col("at")[F.col("partition")], F.lit(0))
    return parts.select("source", "topic", F.col("partition").cast("int").alias("partition"),
                        current.alias("current_offset"), "latest_offset",
                        (F.col("latest_offset") - current).alias("lag"))


def _text(offset):
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset)
