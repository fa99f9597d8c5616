"""History laid out for lookups, and latency sketches as a state."""

import random

import pytest
from pyspark.sql import functions as F

from tapekeeper.operators import sketches
from tapekeeper.operators.heal import heal
from tapekeeper.operators.stats import latency_ms
from tapekeeper.plans.cycles import run_heal
from tapekeeper.schema import LATENCY, TRADES
from tapekeeper.sinks.history import StoredHistory
from tapekeeper.sinks.tables import compact_latency, read_latency, write_latency
from tapekeeper.streaming.trades import write_trades
from tests.helpers import NOW, ids_of, tape_of, trade, tuples

PLAN = "symbol string, gap_start long, gap_end long, missing long, action string"


def plan_of(spark, *gaps):
    return spark.createDataFrame([(s, a, b, b - a + 1, action) for s, a, b, action in gaps], PLAN)


def test_two_far_gaps_open_two_files(spark, tmp_path):
    stored = StoredHistory(spark, str(tmp_path / "h"))
    rows = ids_of(spark, "A", range(1, 1001)).unionByName(ids_of(spark, "B", range(1, 101)))
    assert stored.load(rows, 50) == 22
    plan = plan_of(spark, ("A", 3, 5, "HEAL"), ("A", 995, 999, "HEAL"), ("A", 400, 700, "SKIPPED"))
    assert len(stored.files(plan.filter("action = 'HEAL'"))) == 2
    filled = stored.fill(plan)
    assert tuples(filled) == tuples(heal(plan, rows)) and filled.columns == TRADES.names
    # The files are given to the scan; none other is listed.
    assert len(filled.inputFiles()) == 2


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_files_found_by_any_step(spark, tmp_path, step):
    rnd = random.Random(step)
    stored = StoredHistory(spark, str(tmp_path / "h"))
    ids = sorted(rnd.sample(range(-200, 400), 300))
    stored.load(ids_of(spark, "A", ids).unionByName(ids_of(spark, "B", ids[:90])), 20)
    held = [(r.file, r.symbol, r.first_id, r.last_id) for r in stored.index().collect()]
    for low, high in ((-500, -300), (-200, 399), (-3, 3), (50, 50), (401, 10**6)):
        gaps = spark.createDataFrame([("B", low, high)], "symbol string, gap_start long, gap_end long")
        assert stored.files(gaps, step) == sorted({f for f, s, a, b in held if s == "B" and a <= high and b >= low})


def test_loads_that_overlap_give_each_row_once(spark, tmp_path):
    stored = StoredHistory(spark, str(tmp_path / "h"))
    plan = plan_of(spark, ("A", 1, 9, "HEAL"))
    assert stored.fill(plan).count() == 0  # nothing loaded yet
    stored.load(tape_of(spark, trade("A", 1, "10"), trade("A", 2, "20"), *[trade("A", 3, "30")] * 40))
    stored.load(tape_of(spark, trade("A", 2, "21"), trade("A", 3, "31", written="2024-02-01 00:00:00"), trade("A", 4, "40"),
                        (None, 5, *trade("A", 5)[2:]), ("A", None, *trade("A", 5)[2:])))
    stored.load(spark.createDataFrame([], TRADES))
    # Equal versions go to the later load, otherwise the higher version wins.
    assert sorted((r.trade_id, int(r.price)) for r in stored.fill(plan).collect()) == [(1, 10), (2, 21), (3, 30), (4, 40)]
    assert stored.fill(plan_of(spark)).count() == 0


def test_a_key_with_very_many_copies_does_not_fill_a_file(spark, tmp_path):
    stored = StoredHistory(spark, str(tmp_path / "h"))
    copies = spark.range(5000).select(F.lit("A").alias("symbol"), F.when(F.col("id") < 2500, 7).otherwise(F.col("id")).alias("trade_id"))
    rows = copies.join(tape_of(spark, trade("A", 0)).drop("symbol", "trade_id"))
    assert stored.load(rows, 500) == 6
    assert stored.index().agg(F.sum("rows"), F.max("rows")).first()[0] == 2501


def test_a_cycle_over_a_stored_history(spark, tmp_path):
    stored = StoredHistory(spark, str(tmp_path / "h"))
    history = ids_of(spark, "A", range(1, 40))
    stored.load(history, 10)
    live = ids_of(spark, "A", [1, 2, 5, 39])
    for one, other in zip(run_heal(live, stored, as_of=NOW)[:3], run_heal(live, history, as_of=NOW)[:3]):
        assert tuples(one) == tuples(other)


def latencies(spark, values, day="2024-03-01"):
    start = F.lit(f"{day} 10:00:00+00:00").cast("timestamp")
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    return rows.select(start.alias("trade_time"), F.timestamp_millis(F.unix_millis(start) + F.col("v")).alias("ingested_at"))


def test_rank_error_of_merged_sketches(spark):
    rnd = random.Random(4)
    values = sorted(int(rnd.lognormvariate(5, 1.5)) for _ in range(60_000)) + [10**7]
    shuffled = rnd.sample(values, len(values))
    parts = [sketches.latency_partial(latencies(spark, shuffled[k::7])) for k in range(7)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    got = sketches.latency_of(merged).first()
    assert (got.events, got.max_ms) == (60_001, 10**7)
    for q, value in ((0.5, got.p50_ms), (0.95, got.p95_ms), (0.99, got.p99_ms)):
        low, high = sum(v < value for v in values), sum(v <= value for v in values)
        assert low / len(values) - sketches.RANK_ERROR <= q <= high / len(values) + sketches.RANK_ERROR
    assert max(len(r.sketch) for r in merged.collect()) < 64 * 1024  # however many rows


def test_replayed_batches_days_and_compaction(spark, tmp_path):
    path, packed = str(tmp_path / "l"), str(tmp_path / "p")
    first = sketches.latency_partial(latencies(spark, [1, 2, 3]).unionByName(latencies(spark, [50], "2024-03-02")))
    for _ in range(2):
        write_latency(first, path, "w", 0)
    write_latency(sketches.latency_partial(latencies(spark, [10])), path, "w", 1)
    compact_latency(spark, path, packed)
    for place in (path, packed):
        days = sketches.latency_of(read_latency(spark, place), "day")
        assert [(str(r.day), r.events, r.max_ms) for r in days.orderBy("day").collect()] == [("2024-03-01", 4, 10), ("2024-03-02", 1, 50)]
        later = read_latency(spark, place, low="2024-03-02")
        assert "PartitionFilters: [isnotnull(day" in later._jdf.queryExecution().toString()
        assert sketches.latency_of(later).first().max_ms == 50
        assert sketches.latency_of(read_latency(spark, place, high="2024-02-01")).first().events == 0


def test_no_latency(spark):
    times = spark.createDataFrame([(None, None)], "trade_time timestamp, ingested_at timestamp")
    assert sketches.latency_partial(times).count() == 0
    assert tuple(sketches.latency_of(spark.createDataFrame([], LATENCY)).first()) == (0, None, None, None, None)


def test_a_stream_leaves_its_sketches(spark, tmp_path):
    tape_of(spark, trade("A", 1), trade("A", 2)).drop("ingested_at").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("symbol string, trade_id long, price decimal(18,8), quantity decimal(18,8), trade_time timestamp").parquet(
        str(tmp_path / "in"))
    write_trades(stream, str(tmp_path / "t"), str(tmp_path / "c"), flush=None, latency_path=str(tmp_path / "l")).awaitTermination()
    got = sketches.latency_of(read_latency(spark, str(tmp_path / "l"))).first()
    stored = spark.read.parquet(str(tmp_path / "t")).agg(F.max(latency_ms())).first()[0]
    assert (got.events, got.max_ms) == (2, stored)
