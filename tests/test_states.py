"""States kept beside the tape, runs of ids and minute sums, against computing everything anew."""

import random

import pytest
from pyspark.sql import functions as F

from catalog import queries as catalog
from tapekeeper.operators import buckets, runs
from tapekeeper.operators.gaps import gap_ranges, missing_ids
from tapekeeper.operators.trend import minute_price
from tapekeeper.plans.cycles import run_cycles, run_heal, run_health
from tapekeeper.schema import RUNS
from tapekeeper.sinks import commits
from tapekeeper.sinks.tables import compact_runs, read_runs, write_runs
from tests.helpers import NOW, ids_of, tape_of, trade, tuples


def brute(pairs):
    """Maximal runs of (symbol, id) pairs."""
    found = []
    for symbol, i in sorted(set(pairs)):
        if found and found[-1][0] == symbol and found[-1][2] == i - 1:
            found[-1][2] = i
        else:
            found.append([symbol, i, i])
    return sorted(map(tuple, found))


@pytest.mark.parametrize("block", [4, 64, runs.BLOCK])
def test_runs_of_batches_in_any_order_and_twice(spark, block):
    rnd = random.Random(block)
    pairs = [(s, i) for s in "AB" for i in range(-30, 3000) if rnd.random() < 0.8 and not 500 < i < 1600] + [("C", 10**12)]
    batches = [[p for p in pairs if rnd.random() < 0.4] for _ in range(5)] + [pairs[::2], pairs[1::2]]
    partials = [runs.id_runs(spark.createDataFrame(b + b[:50], "symbol string, trade_id long"), 16) for b in (*batches, batches[0])]
    merged = runs.merge_runs(*partials, block=block)
    assert tuples(merged) == sorted(brute(pairs), key=repr)
    tape = spark.createDataFrame(pairs, "symbol string, trade_id long")
    assert tuples(runs.gaps_between(merged, block)) == tuples(gap_ranges(tape, window=None))
    assert tuples(runs.missing_in(merged)) == tuples(missing_ids(tape, window=None))


def test_no_ids(spark):
    empty = spark.createDataFrame([], RUNS)
    assert runs.merge_runs(empty).count() == runs.gaps_between(empty).count() == runs.missing_in(empty).count() == 0
    assert runs.id_runs(spark.createDataFrame([("A", None)], "symbol string, trade_id long")).count() == 0


def test_a_cycle_finds_old_gaps_in_the_state(spark, tmp_path):
    path, packed = str(tmp_path / "runs"), str(tmp_path / "packed")
    old = ids_of(spark, "A", [1, 2, 5, 6], time="2024-01-01 00:00:00")
    for again in range(2):
        write_runs(runs.id_runs(old), path, "w", 0)
    write_runs(runs.id_runs(ids_of(spark, "A", [7, 9])), path, "w", 1)
    compact_runs(spark, path, packed)
    assert tuples(read_runs(spark, path)) == tuples(read_runs(spark, packed)) == [("A", 1, 2), ("A", 5, 7), ("A", 9, 9)]
    history = ids_of(spark, "A", range(1, 10))
    cycle = run_heal(old, history, as_of=NOW, runs=read_runs(spark, packed))
    assert sorted(r.trade_id for r in cycle.rows.collect()) == [3, 4, 8]


def bucket_rows(spark, state):
    return sorted((r.symbol, str(r.minute), r.price) for r in buckets.price_from_buckets(
        buckets.read_buckets(spark, state)).withColumnRenamed("time", "minute").collect())


def test_sums_follow_copies_corrections_and_merges(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    batches = [
        [trade("A", 1, "10"), trade("A", 2, "20"), trade("B", 1, "5", time="2024-03-01 11:58:10")],
        [trade("A", 2, "20"), trade("A", 3, "60")],
        [trade("A", 1, "40", written="2024-03-02 00:00:00"), trade("B", 2, "7", time="2024-01-01 00:00:00")],
    ]
    for number, rows in enumerate(batches):
        commits.commit_batch(tape_of(spark, *rows), path, "w", number)
        assert buckets.refresh_buckets(spark, path, state) > 0
        want = minute_price(commits.snapshot(spark, path).read())
        assert bucket_rows(spark, state) == sorted((r.symbol, str(r.time), r.price) for r in want.collect())
    assert buckets.refresh_buckets(spark, path, state) == 0
    before = bucket_rows(spark, state)
    commits.merge(spark, path, 2)
    buckets.refresh_buckets(spark, path, state)
    assert bucket_rows(spark, state) == before
    assert {r.minute.month for r in buckets.read_buckets(spark, state, low="2024-02-01").collect()} == {3}


def test_cycles_in_one_plan_equal_cycles_one_by_one(spark):
    tape = tape_of(spark, *[trade("A", i, time=f"2024-03-{d:02} {h:02}:00:00") for i, (d, h) in enumerate(
        (d, h) for d in (1, 2, 3) for h in (0, 7, 8, 23)) if i % 4 != 2], trade("B", 5, time="2024-03-02 00:00:00"))
    history = ids_of(spark, "A", range(0, 11))
    found = run_cycles(tape, history, "A,B,C", "2024-03-02 00:00:00", "2024-03-04 00:00:00", "1 day", 600, 1800, "2 days")
    for day in (2, 3, 4):
        now = f"2024-03-{day:02} 00:00:00"
        known = tape.filter(F.col("trade_time") <= F.lit(f"{now}+00:00").cast("timestamp"))
        want = run_health(known, "A,B,C", now, 600, 1800, "2 days").unionByName(
            run_heal(known, history, "A,B,C", now, "2 days", pin=False).audit)
        mine = found.filter(F.col("checked_at") == F.lit(f"{now}+00:00").cast("timestamp")).drop("checked_at")
        assert tuples(mine) == tuples(want)


def test_all_events_arrive_with_or_without_a_time(spark, tmp_path):
    import datetime
    times = [None, None, datetime.datetime(1999, 1, 1), datetime.datetime(2023, 12, 1), *[datetime.datetime(2024, 1, d) for d in range(1, 29)]]
    rows = [(i, t, 1, "click", 2.0, '{"k": 95}') for i, t in enumerate(times)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(
        f"{tmp_path}/events.parquet")
    folder = f"{tmp_path}/in"
    assert list(catalog.arrivals(spark, str(tmp_path), folder)) == list(range(catalog.PARTS))
    assert sorted(r.event_id for r in spark.read.parquet(folder).collect()) == list(range(len(times)))
