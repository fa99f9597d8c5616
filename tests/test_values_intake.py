"""Dedup, trends, peaks, statistics and intake on hand-written rows."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tapekeeper.functions.time import interval_start
from tapekeeper.operators import dedup, peaks, stats, trend
from tapekeeper.operators.latest import latest_by
from tapekeeper.schema import TRADE_MESSAGE
from tapekeeper.sinks.topic import to_topic, write_ordered
from tapekeeper.sources import frames, intake, records
from tests.helpers import NOW, at, ids_of, tape_of, trade, tuples


def test_highest_version_wins_and_dedup_is_idempotent(spark):
    tape = tape_of(spark, trade("A", 1, "5", written="2024-03-01 12:00:01"),
                   trade("A", 1, "6", written="2024-03-01 12:00:02"), trade("A", 2, "7"))
    once = dedup.dedup_latest(tape)
    assert [(r.trade_id, r.price) for r in once.orderBy("trade_id").collect()] == [(1, 6), (2, 7)]
    assert tuples(dedup.dedup_latest(once)) == tuples(once)
    assert once.columns == tape.columns


def test_equal_versions_are_settled_the_same_way_every_time(spark):
    rows = [trade("A", 1, str(p)) for p in range(50)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        kept = dedup.dedup_latest(tape_of(spark, *rows).repartition(4)).collect()
        assert [r.price for r in kept] == [49]


def test_tiebreak_column_comes_before_the_rest(spark):
    tape = tape_of(spark, trade("A", 1, "9"), trade("A", 1, "3")).withColumn(
        "batch_id", F.when(F.col("price") == 3, 2).otherwise(1))
    assert dedup.dedup_latest(tape, tiebreak=["batch_id"]).first()["price"] == 3


def test_volume_counts_a_trade_once(spark):
    tape = tape_of(spark, trade("A", 1, "2", "0.1"), trade("A", 1, "2", "0.1", written="2024-03-01 12:00:00"),
                   trade("A", 2, "2", "0.2"))
    row = dedup.exact_volume(tape).first()
    assert (row.trades, row.volume, row.turnover) == (2, Decimal("0.3"), Decimal("0.6"))


def test_latest_breaks_time_ties_by_id(spark):
    tape = tape_of(spark, trade("A", 1, "5"), trade("A", 3, "7"), trade("A", 2, "6"))
    assert tuples(latest_by(tape, ["symbol"], ["price"], ["trade_time", "trade_id"])) == [("A", Decimal(7))]


def minute(i):
    return f"2024-03-01 {i // 60:02d}:{i % 60:02d}:30"


def test_moving_average_frame_holds_n_plus_one_buckets(spark):
    prices = [1, 2, 4, 8, 16]
    tape = tape_of(spark, *[trade("A", i, str(p), time=minute(i * 7)) for i, p in enumerate(prices)])
    got = [r.moving_avg for r in trend.moving_average(tape, 2).orderBy("time").collect()]
    assert got == [1.0, 1.5, 7 / 3, 14 / 3, 28 / 3]


def test_moving_averages_equal_a_plain_window(spark):
    pick = random.Random(4)
    values = [f"{pick.uniform(1e-6, 90000):.8f}" for _ in range(200)]
    tape = tape_of(spark, *[trade("AB"[i % 2], i, v, time=minute(i * 3)) for i, v in enumerate(values)])
    rows = trend.moving_averages(tape, [3, 15, 1440]).orderBy("symbol", "time").collect()
    for symbol in "AB":
        mine = [r for r in rows if r.symbol == symbol]
        for n in (3, 15, 1440):
            for i, r in enumerate(mine):
                frame = [x.price for x in mine[max(0, i - n):i + 1]]
                assert r[f"ma_{n}"] == pytest.approx(sum(frame) / len(frame), rel=1e-13)


def test_intervals_are_aligned_to_the_epoch(spark):
    row = spark.range(1).select(interval_start(F.lit("2024-03-01 12:44:59").cast("timestamp"), "15 minutes"))
    assert row.first()[0].timestamp() == at("2024-03-01 12:30:00").timestamp()


def test_series_stats_skip_nulls(spark):
    series = spark.createDataFrame([("A", 1, 5.0), ("A", 2, 7.0), ("A", 3, None)], "symbol string, time int, price double")
    assert tuples(trend.series_stats(series)) == [("A", 7.0, 7.0, 5.0)]


def test_duplicates_do_not_move_a_peak(spark):
    tape = tape_of(spark, trade("A", 1, "5"), trade("A", 2, "4"))
    partial = peaks.peak_partial(tape)
    assert tuples(peaks.peak_merge(partial, partial, peaks.peak_partial(tape.union(tape)))) == [("A", 5.0)]


def test_pct_of_peak_needs_both_sides(spark):
    tape = tape_of(spark, trade("A", 1, "5"), trade("A", 2, "4"), trade("B", 1, "9"),
                   trade("C", 1, "9", time="2024-02-01 00:00:00"))
    seed = spark.createDataFrame([("A", 16.0), ("A", 10.0), ("C", 10.0)], "symbol string, peak double")
    assert tuples(peaks.pct_display(peaks.pct_of_peak(tape, seed, NOW))) == [("A", Decimal("4.00"), 16.0, 25.0)]
    assert tuples(peaks.pct_of_peak_one(tape, seed, "A", NOW)) == [(25.0,)]
    assert tuples(peaks.pct_of_peak_one(tape, seed, "B", NOW)) == [(None,)]
    assert tuples(peaks.pct_of_peak_one(tape, seed, "C", NOW)) == [(None,)]


def test_candle_highs(spark):
    klines = json.dumps([[1, "2", "30.5", "1"], [2, "2", "41.25", "1"], [3, "2"], [4, "2", "oops"]])
    rows = records.from_klines(spark.createDataFrame([("A", klines), ("B", "[]")], "symbol string, klines string"))
    assert [r.high for r in rows.collect()] == [30.5, 41.25, None, None]
    assert tuples(peaks.peak_seed(rows)) == [("A", 41.25)]


@pytest.mark.parametrize("width", [4, 1 << 14])
@pytest.mark.parametrize("size", [1, 2, 101, 500])
def test_quantiles_equal_brute_force(spark, width, size):
    import numpy as np

    values = [random.Random(size).choice([3, 3, 40]) + i % 37 * 11 - 100 for i in range(size)]
    df = spark.createDataFrame([(v,) for v in values], "x long")
    got = dict(tuples(stats.quantiles_of(stats.value_counts(df, "x", width), [0.5, 0.95, 0.99])))
    for q, value in got.items():
        assert value == pytest.approx(float(np.percentile(values, q * 100)), rel=1e-12)
    assert len(got) == 3


def test_latency_of_nothing_and_sketch(spark):
    tape = tape_of(spark, *[trade("A", i, time="2024-03-01 11:59:00", written=f"2024-03-01 11:59:{i:02d}")
                            for i in range(1, 60)])
    exact = stats.latency_stats(tape, NOW).first()
    rough = stats.latency_stats(tape, NOW, exact=False).first()
    assert (exact.events, exact.p50_ms, exact.max_ms) == (59, 30000.0, 59000)
    assert (rough.events, rough.p50_ms, rough.max_ms) == (59, 30000.0, 59000)
    none = stats.latency_stats(tape, "2025-01-01 00:00:00").first()
    assert tuple(none) == (0, None, None, None, None)


def test_throughput(spark):
    tape = tape_of(spark, *[trade("A", i) for i in range(150)], trade("A", 999, time="2024-03-01 11:58:00"))
    assert tuples(stats.throughput(tape, "2024-03-01 11:59:30")) == [(150, 2.0)]


FRAME = {"e": "trade", "s": "A", "t": 12, "p": "1.10", "q": "2", "T": 1709294340123}


def test_frame_shapes(spark):
    raw = [json.dumps({"stream": "x", "data": FRAME}), json.dumps(FRAME), '{"result":null,"id":1}', "garbage",
           json.dumps({k: v for k, v in FRAME.items() if k != "p"}), json.dumps({**FRAME, "t": "x1"}),
           json.dumps({**FRAME, "e": "kline"})]
    good, bad = intake.split_valid(frames.parse_frames(spark.createDataFrame([(r,) for r in raw], "raw string")))
    rows = good.collect()
    assert len(rows) == 2
    assert {(r.symbol, r.trade_id, r.price, r.trade_time.timestamp()) for r in rows} == {
        ("A", 12, Decimal("1.10"), 1709294340.123)}
    assert sorted(r.reason for r in bad.collect()) == ["bad trade_id", "missing price", "not a JSON object"]


@pytest.mark.parametrize("price,want,reason", [
    ("NaN", None, "bad price"), ("abc", None, "bad price"), ("12345678901.0", None, "bad price"),
    (None, None, "missing price"), ("1.123456789", Decimal("1.12345679"), None), ("64123.45000000", Decimal("64123.45"), None),
])
def test_decimals(spark, price, want, reason):
    row = intake.type_trades(spark.createDataFrame([("A", 1, price, "1", 0)], TRADE_MESSAGE)).first()
    assert (row.price, row.reason) == (want, reason)


def test_contract(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("grade", T.IntegerType())])
    df = spark.createDataFrame([("1", "a", "x"), ("q", "b", "y"), (None, "c", "z")], "id string, name string, extra string")
    rows = tuples(intake.enforce_contract(df, schema, {"grade": 4}))
    assert rows == sorted([(1, "a", 4, None), (None, "b", 4, "bad id"), (None, "c", 4, "missing id")], key=repr)
    assert {r.reason for r in intake.enforce_contract(df, schema).collect()} >= {"missing grade"}


def test_envelope(spark):
    body = json.dumps({"symbol": "A", "trade_id": 5, "price": "1.5", "quantity": "2", "trade_time": 1000}).encode()
    messages = [b"\x00\x00\x00\x01\x02" + body, b"\x01\x00\x00\x01\x02" + body, b"\x00\x00", b"\x00\x00\x00\x00\x07" + body,
                b"\x00\x00\x00\x01\x02nonsense"]
    df = spark.createDataFrame([(bytearray(m),) for m in messages], "value binary")
    assert frames.split_envelope(df).first()["schema_id"] == 258
    ddl = "symbol string, trade_id bigint, price string, quantity string, trade_time bigint"
    good, bad = intake.split_valid(frames.decode_trades(df, {258: ddl}, decode=frames.json_payload))
    assert [(r.symbol, r.trade_id, r.price) for r in good.collect()] == [("A", 5, Decimal("1.5"))]
    assert sorted(r.reason for r in bad.collect())[:3] == ["bad magic byte", "missing symbol", "short message"]
    assert "unknown schema id" in {r.reason for r in bad.collect()}


def test_history_records(spark):
    df = spark.createDataFrame([("A", 5, "1.5", "2", 1000), ("A", 6, "1.5", "zzz", 1000)],
                               "symbol string, id long, price string, qty string, time long")
    rows = records.from_history(df).orderBy("trade_id").collect()
    assert [(r.trade_id, r.reason) for r in rows] == [(5, None), (6, "bad quantity")]


def test_topic_rows_are_keyed_by_symbol_and_ordered_on_files(spark, tmp_path):
    tape = ids_of(spark, "B", [3, 1, 2]).union(ids_of(spark, "A", [9, 8]))
    row = to_topic(tape).first()
    assert bytes(row.key) == b"B"
    assert json.loads(bytes(row.value))["price"] == "1.00000000"
    write_ordered(tape, str(tmp_path / "out"))
    files = spark.read.parquet(str(tmp_path / "out")).select("symbol", "trade_id", F.input_file_name().alias("f"))
    ranges = sorted((r.lo, r.hi) for r in files.groupBy("f").agg(
        F.min(F.struct("symbol", "trade_id")).alias("lo"), F.max(F.struct("symbol", "trade_id")).alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("raw", [
    json.dumps(FRAME) + " xyz", json.dumps(FRAME) + json.dumps(FRAME), json.dumps(FRAME) + "," + json.dumps(FRAME),
    json.dumps({"data": json.dumps(FRAME)}), "[1]", '"text"', "", json.dumps({"data": None}), json.dumps(FRAME) + "]"])
def test_text_that_is_not_one_object_is_set_aside(spark, raw):
    rows = frames.parse_frames(spark.createDataFrame([(raw,)], "raw string")).collect()
    assert [r.reason for r in rows] == ["not a JSON object"]


def test_symbol_lists_are_cleaned_like_settings():
    from tapekeeper.functions.symbols import parse_symbols
    assert parse_symbols([" btc ", "ETH", "", "eth"]) == parse_symbols(" btc ,ETH,,eth") == ["BTC", "ETH"]


def test_buckets_without_a_price_count_for_nothing(spark):
    tape = tape_of(spark, *[trade("A", i, p, time=minute(i)) for i, p in ((1, "2"), (2, "3"), (3, "4"))])
    tape = tape.withColumn("price", F.when(F.col("trade_id") != 2, F.col("price")))
    got = [r.moving_avg for r in trend.moving_average(tape, 2).orderBy("time").collect()]
    assert got == [2.0, 2.0, 3.0]
