"""Batches that close on rows or time, whichever comes first."""

import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tapekeeper.schema import TRADES
from tapekeeper.sinks import commits
from tapekeeper.sinks.closing import add_waiting, close_waiting, waiting_rows
from tapekeeper.streaming.trades import write_closing
from tests.helpers import ids_of

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def ids_in(spark, path):
    return sorted(r.trade_id for r in commits.snapshot(spark, path).scan().collect())


def add(spark, path, number, ids, seconds=0.0, rows=5, within=10.0):
    return add_waiting(ids_of(spark, "A", ids), path, "w", number, rows, within, T0 + timedelta(seconds=seconds))


def test_rows_close_a_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not add(spark, path, 0, [1, 2]) and not add(spark, path, 1, [3, 4])
    assert ids_in(spark, path) == [] and waiting_rows(spark, path, "w") == 4
    assert add(spark, path, 2, [5, 6]) and ids_in(spark, path) == [1, 2, 3, 4, 5, 6]
    assert [(r.batch_id, r.rows) for r in commits.entries(spark, path).groupBy("batch_id").agg(F.sum("rows").alias("rows")).collect()] == [(2, 6)]
    assert waiting_rows(spark, path, "w") == 0 and not close_waiting(spark, path, "w")
    commits.fold(spark, path)
    assert not add(spark, path, 3, [7]) and ids_in(spark, path) == [1, 2, 3, 4, 5, 6]
    assert close_waiting(spark, path, "w") and ids_in(spark, path)[-1] == 7


def test_time_closes_a_batch_also_when_nothing_comes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not add(spark, path, 0, [1])
    assert not add(spark, path, 1, [], 9.9) and ids_in(spark, path) == []
    assert add(spark, path, 2, [], 10.0) and ids_in(spark, path) == [1]
    assert not add(spark, path, 3, [], 30.0)
    # The clock of a batch begins with its first rows.
    assert not add(spark, path, 4, [2], 40.0) and not add(spark, path, 5, [3], 49.0) and add(spark, path, 6, [4], 50.5)
    assert ids_in(spark, path) == [1, 2, 3, 4]


def test_replayed_micro_batches_count_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):  # staged, then done again
        assert not add(spark, path, 0, [1, 2])
    assert waiting_rows(spark, path, "w") == 2
    assert add(spark, path, 1, [3, 4, 5])
    assert not add(spark, path, 1, [3, 4, 5])  # visible already
    commits.fold(spark, path)
    assert not add(spark, path, 1, [3, 4, 5])
    assert ids_in(spark, path) == [1, 2, 3, 4, 5] and waiting_rows(spark, path, "w") == 0


def test_writers_wait_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not add(spark, path, 0, [1, 2, 3])
    assert not add_waiting(ids_of(spark, "A", [9]), path, "other", 0, 5, 10.0, T0)
    assert add(spark, path, 1, [4, 5]) and ids_in(spark, path) == [1, 2, 3, 4, 5]
    assert waiting_rows(spark, path, "other") == 1


def test_a_stream_that_falls_silent_shows_its_rows_in_time(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "t")
    ids_of(spark, "A", range(3)).write.parquet(source)
    query = write_closing(spark.readStream.schema(TRADES).parquet(source), path, str(tmp_path / "c"), rows=1000, within=4.0)
    try:
        until = time.time() + 90
        while time.time() < until and not ids_in(spark, path):
            time.sleep(1)
    finally:
        query.stop()
    # Too few for the bound on rows, and none of age when staged: a later, empty micro-batch has shown them.
    assert ids_in(spark, path) == [0, 1, 2] and query.lastProgress["batchId"] > 0
