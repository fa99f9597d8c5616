"""Committed tables: visibility, replays, snapshots, the day index, folds, merges and expiry."""

import datetime

from pyspark.sql import functions as F

from tapekeeper.operators.dedup import dedup_latest
from tapekeeper.schema import CHECKS, TRADES
from tapekeeper.sinks import commits
from tapekeeper.sources.tables import read_trades
from tapekeeper.streaming.trades import write_trades
from tests.helpers import ids_of, log_of, tape_of, trade, tuples


def ids(snapshot):
    return sorted(r.trade_id for r in snapshot.read().collect())


def day_batches(spark, path, days, per_day, first=1):
    """For each day some batches of one trade each, by one writer."""
    number = first
    for day in days:
        for _ in range(per_day):
            commits.commit_batch(ids_of(spark, "A", [number], time=f"2024-03-{day:02} 12:00:00"), path, "w", number)
            number += 1
    return number


def test_a_batch_is_seen_as_a_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.snapshot(spark, path).read().count() == 0
    commits.commit_batch(ids_of(spark, "A", [1, 2]), path, "w", 0)
    before = commits.snapshot(spark, path)
    two_days = tape_of(spark, trade("A", 3), trade("A", 4, time="2024-02-01 00:00:00"))
    staged = commits.stage(two_days, path, "w", 1)
    assert staged.count() == 2 and ids(commits.snapshot(spark, path)) == [1, 2]
    commits.commit(staged, path, "w", 1)
    assert ids(commits.snapshot(spark, path)) == [1, 2, 3, 4] and ids(before) == [1, 2]


def test_a_replay_commits_once_before_and_after_a_fold(spark, tmp_path):
    path = str(tmp_path / "t")
    for again in range(2):
        assert commits.commit_batch(ids_of(spark, "A", [1, 2]), path, "w", 3) is (again == 0)
    commits.fold(spark, path)
    assert commits.commit_batch(ids_of(spark, "A", [1, 2]), path, "w", 3) is False
    assert commits.commit_batch(ids_of(spark, "A", [9]), path, "other", 3) is True
    assert commits.snapshot(spark, path).scan().count() == 3


def test_two_attempts_that_do_not_know_of_each_other_count_once(spark, tmp_path):
    path = str(tmp_path / "t")
    both = [commits.stage(ids_of(spark, "A", [1, 2]), path, "w", 0) for _ in range(2)]
    for staged in both:
        commits.commit(staged, path, "w", 0)
    assert commits.snapshot(spark, path).scan().count() == 2
    commits.fold(spark, path)
    commits.commit(both[0], path, "w", 0)
    assert commits.snapshot(spark, path).scan().count() == 2


def test_commits_during_a_fold_are_kept(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    commits.commit_batch(ids_of(spark, "A", [1]), path, "w", 0)
    listed = commits._log

    def and_then_another(session, where, at):
        rows = listed(session, where, at)
        if not done:
            done.append(commits.commit(commits.stage(ids_of(spark, "A", [2]), path, "w", 1), path, "w", 1))
        return rows

    done = []
    monkeypatch.setattr(commits, "_log", and_then_another)
    commits.fold(spark, path)
    monkeypatch.undo()
    assert ids(commits.snapshot(spark, path)) == [1, 2]
    commits.fold(spark, path)
    assert ids(commits.snapshot(spark, path)) == [1, 2]
    commits.fold(spark, path)
    assert ids(commits.snapshot(spark, path)) == [1, 2] and commits.is_committed(spark, path, "w", 1)


def test_a_commit_to_a_folded_epoch_is_written_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    commits.commit_batch(ids_of(spark, "A", [1]), path, "w", 0)
    staged = commits.stage(ids_of(spark, "A", [2]), path, "w", 1)
    look, stalled = commits.head, []

    def stall(session, where):
        found = look(session, where)
        if not stalled:
            stalled.append(1)
            monkeypatch.setattr(commits, "head", look)
            for _ in range(3):
                commits.fold(spark, path)
            monkeypatch.setattr(commits, "head", stall)
        return found

    monkeypatch.setattr(commits, "head", stall)
    commits.commit(staged, path, "w", 1)
    monkeypatch.undo()
    assert ids(commits.snapshot(spark, path)) == [1, 2]
    commits.fold(spark, path)
    assert commits.snapshot(spark, path).scan().count() == 2


def test_a_day_is_read_from_its_files_and_its_index_only(spark, tmp_path):
    path = str(tmp_path / "t")
    day_batches(spark, path, (1, 2, 3), 2)
    commits.fold(spark, path)
    day_batches(spark, path, (2,), 1, 7)
    found = commits.snapshot(spark, path, low="2024-03-02 00:00:00", high="2024-03-02 23:00:00")
    assert ids(found) == [3, 4, 7]
    assert len(found.files) == 3 and all("day=2024-03-02" in f for f in found.scan().inputFiles())
    day = datetime.date(2024, 3, 2)
    opened = commits.entries(spark, path, day, day).inputFiles()
    assert opened and not any("/index/" in f and "day=2024-03-02" not in f for f in opened)
    late = commits.snapshot(spark, path, as_of="2024-03-03 13:00:00", window="2 hours")
    assert ids(late) == [5, 6] and len(late.files) == 2


def test_rows_without_a_time_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = ids_of(spark, "A", [1]).unionByName(ids_of(spark, "A", [2]).withColumn("trade_time", F.lit(None).cast("timestamp")))
    commits.commit_batch(rows, path, "w", 0)
    commits.fold(spark, path)
    assert ids(commits.snapshot(spark, path)) == [1, 2]
    assert ids(commits.snapshot(spark, path, low="2000-01-01 00:00:00")) == [1]


def test_merges_bound_the_files_of_a_day_and_change_no_read(spark, tmp_path):
    path = str(tmp_path / "t")
    number = day_batches(spark, path, (1,), 13)
    commits.commit_batch(tape_of(spark, trade("A", 5, "77", time="2024-03-01 12:00:00", written="2024-03-09 00:00:00")), path, "heal-1")
    before = commits.snapshot(spark, path)
    want = tuples(before.read())
    assert commits.merge(spark, path, fan=3) > 13
    per_level = commits.entries(spark, path).groupBy("day", "level").agg(F.countDistinct("commit").alias("n")).collect()
    assert all(r.n < 3 for r in per_level) and len(per_level) <= 3
    assert tuples(commits.snapshot(spark, path).read()) == want == tuples(before.read())
    commits.fold(spark, path)
    assert tuples(commits.snapshot(spark, path).read()) == want
    assert commits.merge(spark, path, fan=3) == 0
    assert commits.commit_batch(ids_of(spark, "A", [3]), path, "w", number - 1) is False


def test_a_stream_writes_on_while_batches_are_merged(spark, tmp_path):
    source, path, marks = (str(tmp_path / n) for n in ("source", "t", "marks"))
    for round_ in range(3):
        for part in range(2):
            number = 1 + 2 * round_ + part
            ids_of(spark, "A", [number, number + 1]).coalesce(1).write.mode("append").parquet(source)
        write_trades(read_trades(spark, "parquet", TRADES, path=source, maxFilesPerTrigger=1), path, marks, flush=None,
                     committed=True).awaitTermination()
        commits.merge(spark, path, fan=2)
        if round_ == 1:
            commits.fold(spark, path)
    assert tuples(commits.snapshot(spark, path).read()) == tuples(dedup_latest(spark.read.schema(TRADES).parquet(source)))


def test_expired_days_leave_without_being_read(spark, tmp_path):
    path = str(tmp_path / "t")
    table = commits.CHECK_TABLE
    for day in (1, 10, 20, 21):
        rows = log_of(spark, ("freshness", "ALL", "OK", 1.0, f"2024-03-{day:02} 12:00:00"))
        commits.commit_batch(rows, path, f"cycle-{day}", table=table)
    commits.fold(spark, path)
    old = commits.snapshot(spark, path, table=table)
    assert commits.expire(spark, path, "2024-03-21 13:00:00", 10) == 2
    assert [r.checked_at.day for r in commits.snapshot(spark, path, table=table).read().orderBy("checked_at").collect()] == [20, 21]
    assert old.read().count() == 4 and set(old.read().columns) == set(CHECKS.names)
    commits.fold(spark, path)
    assert commits.expire(spark, path, "2024-03-21 13:00:00", 10) == 0 and commits.snapshot(spark, path, table=table).read().count() == 2


def test_a_batch_without_rows_is_committed_too(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.commit_batch(ids_of(spark, "A", [1]).filter("false"), path, "w", 0) is True
    assert commits.commit_batch(ids_of(spark, "A", [1]), path, "w", 0) is False
    commits.fold(spark, path)
    assert commits.is_committed(spark, path, "w", 0) and commits.snapshot(spark, path).files == []
