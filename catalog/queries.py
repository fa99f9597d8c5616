"""Registered queries: each reads the given tables whole and returns a lazy DataFrame.

Queries that write a table or drive a stream (the sinks and streaming section) run that step first
and return a DataFrame over what was written.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from catalog import tape
from catalog.tape import AS_OF, SYMBOLS
from tapekeeper.functions.values import BANDS, band, percent_of
from tapekeeper.operators import alerts, buckets, dedup, gaps, heal as healing, health, latest, peaks, runs, sketches, stats, trend
from tapekeeper.functions.time import to_utc_clock
from tapekeeper.plans.cycles import healed_view, run_heal, run_health, run_stored_health, store_heal
from tapekeeper.schema import MONEY, TRADE_MESSAGE
from tapekeeper.sinks import closing, commits, tables, topic
from tapekeeper.sinks.history import StoredHistory
from tapekeeper.sources import frames, intake, records, versions
from tapekeeper.sources.tables import scan_trades
from tapekeeper.streaming import trades as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Lookbacks suited to events minutes apart; the library's defaults are minutes.
WINDOW, SINCE = "3 days", "2024-01-28 00:00:00"
WHOLE = "31 days"


def query(fn):
    """Register under the function's name, with timestamps as plain wall-clock values in UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        plain = {f.name: to_utc_clock(F.col(f.name))
                 for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)}
        return df.withColumns(plain) if plain else df

    QUERIES[fn.__name__] = run
    return fn


# --- counts and buckets -------------------------------------------------------------------------

@query
def symbol_summary(spark, sf):
    return stats.symbol_summary(tape.trades(spark, sf))


@query
def symbols_list(spark, sf):
    return stats.symbols_list(tape.trades(spark, sf))


@query
def price_by_interval(spark, sf):
    return trend.price_by_interval(tape.trades(spark, sf), "30 minutes")


@query
def price_in_range(spark, sf):
    from tapekeeper.functions.time import between
    rows = tape.trades(spark, sf, since="2024-01-10 06:00:00")
    kept = between(rows, "trade_time", "2024-01-10 06:00:00", "2024-01-20 18:30:00")
    return trend.price_by_interval(kept, "1 hour")


@query
def minute_price(spark, sf):
    return trend.minute_price(tape.trades(spark, sf))


@query
def series_stats(spark, sf):
    return trend.series_stats(trend.price_by_interval(tape.trades(spark, sf), "30 minutes"))


def rounded(df, *names):
    """Averages to eight decimals, about as far as two engines agree on sums of doubles; the nudge keeps halves from going either way."""
    return df.withColumns({c: F.round(F.col(c) + 1e-11, 8) for c in names})


@query
def moving_average(spark, sf):
    return rounded(trend.moving_average(tape.trades(spark, sf), 60, "hour"), "moving_avg")


@query
def moving_averages(spark, sf):
    rows = trend.moving_averages(tape.trades(spark, sf))
    return rounded(rows, *[c for c in rows.columns if c.startswith("ma_")])


@query
def latency_stats(spark, sf):
    return rounded(stats.latency_stats(tape.trades(spark, sf), AS_OF, WHOLE), "p50_ms", "p95_ms", "p99_ms")


@query
def latency_display(spark, sf):
    return stats.latency_display(stats.latency_stats(tape.trades(spark, sf), AS_OF, WHOLE))


@query
def throughput(spark, sf):
    return stats.throughput(tape.trades(spark, sf), AS_OF, 31 * 86400)


# --- duplicates ---------------------------------------------------------------------------------

@query
def dedup_latest(spark, sf):
    return dedup.dedup_latest(tape.trades(spark, sf))


@query
def dedup_order_lines(spark, sf):
    lines = tape.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return dedup.dedup_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def dedup_check(spark, sf):
    return dedup.dedup_check(tape.trades(spark, sf))


@query
def final_counts(spark, sf):
    return dedup.final_counts(tape.trades(spark, sf))


@query
def exact_count(spark, sf):
    return dedup.exact_count(tape.trades(spark, sf))


@query
def exact_volume(spark, sf):
    return dedup.exact_volume(tape.trades(spark, sf)).withColumn("turnover", F.col("turnover").cast("decimal(38,8)"))


@query
def merged_rows(spark, sf):
    resent = tape.trades(spark, sf).filter("quantity >= 50").withColumn(
        "ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
    return dedup.merge_rows(tape.trades(spark, sf), resent)


# --- gaps and healing ---------------------------------------------------------------------------

@query
def missing_ids(spark, sf):
    return gaps.missing_ids(tape.dense_trades(spark, sf), window=None)


@query
def gap_ranges(spark, sf):
    return gaps.gap_ranges(tape.dense_trades(spark, sf), window=None)


@query
def gap_ranges_recent(spark, sf):
    return gaps.gap_ranges(tape.dense_trades(spark, sf), SYMBOLS, AS_OF, WINDOW)


@query
def order_gap_ranges(spark, sf):
    return gaps.gap_ranges(tape.order_tape(spark, sf), window=None)


def _plan(spark, sf, max_gap=None):
    return gaps.plan_heal(gaps.gap_ranges(tape.dense_trades(spark, sf), window=None), max_gap)


@query
def plan_heal(spark, sf):
    return _plan(spark, sf, 5)


@query
def page_plan(spark, sf):
    return gaps.page_plan(_plan(spark, sf), 2)


@query
def heal(spark, sf):
    return healing.heal(_plan(spark, sf), tape.history(spark, sf))


@query
def order_heal(spark, sf):
    plan = gaps.plan_heal(gaps.gap_ranges(tape.order_tape(spark, sf), window=None))
    return healing.heal(plan, tape.order_history(spark, sf))


@query
def heal_audit(spark, sf):
    plan = _plan(spark, sf)
    return healing.heal_audit(plan, healing.heal(plan, tape.history(spark, sf)))


@query
def heal_cycle(spark, sf):
    return run_heal(tape.dense_trades(spark, sf), tape.history(spark, sf), SYMBOLS, AS_OF, WHOLE).audit


@query
def healed_tape(spark, sf):
    stored = tape.dense_trades(spark, sf)
    cycle = run_heal(stored, tape.history(spark, sf), SYMBOLS, AS_OF, WHOLE)
    return gaps.missing_ids(healed_view(stored, cycle), window=None)


# --- health checks ------------------------------------------------------------------------------

@query
def configured_symbols(spark, sf):
    """Rows per symbol of an operator-written list, cleaned of spaces, case and empties."""
    from tapekeeper.functions.symbols import only_symbols
    return stats.symbol_summary(only_symbols(tape.trades(spark, sf), [" click", "View ", "", "GHOST"]))


@query
def freshness(spark, sf):
    return health.check_freshness(tape.trades(spark, sf), AS_OF)


@query
def symbol_stalls(spark, sf):
    return health.check_symbol_stalls(tape.trades(spark, sf), SYMBOLS, AS_OF, 3600)


@query
def trade_gaps(spark, sf):
    return health.check_trade_gaps(tape.dense_trades(spark, sf), SYMBOLS, AS_OF, WINDOW)


@query
def health_cycle(spark, sf):
    return run_health(tape.dense_trades(spark, sf), SYMBOLS, AS_OF, 120, 3600, WHOLE)


@query
def failing_checks(spark, sf):
    return health.failing(run_health(tape.dense_trades(spark, sf), SYMBOLS, AS_OF, 120, 3600, WHOLE))


# --- peaks --------------------------------------------------------------------------------------

@query
def candle_highs(spark, sf):
    return records.from_klines(tape.daily_candles(spark, sf))


@query
def peak_seed(spark, sf):
    return peaks.peak_seed(records.from_klines(tape.daily_candles(spark, sf)))


@query
def peaks_merged(spark, sf):
    seed = peaks.peak_seed(records.from_klines(tape.daily_candles(spark, sf)))
    return peaks.peak_merge(seed, peaks.peak_partial(tape.trades(spark, sf)))


@query
def current_prices(spark, sf):
    return peaks.current_prices(tape.trades(spark, sf, since=SINCE), AS_OF, WINDOW)


@query
def latest_price(spark, sf):
    return latest.latest_by(tape.trades(spark, sf), ["symbol"], ["price", "quantity"], ["trade_time", "trade_id"])


def pct_of_peak_rows(spark, sf):
    seed = peaks.peak_seed(records.from_klines(tape.daily_candles(spark, sf)))
    return peaks.pct_of_peak(tape.trades(spark, sf, since=SINCE), seed, AS_OF, WINDOW)


@query
def pct_of_peak(spark, sf):
    return pct_of_peak_rows(spark, sf)


@query
def pct_display(spark, sf):
    return peaks.pct_display(pct_of_peak_rows(spark, sf))


@query
def pct_of_peak_one(spark, sf):
    partials = peaks.peak_partial(tape.trades(spark, sf))
    return peaks.pct_of_peak_one(tape.trades(spark, sf, since=SINCE), partials, "CLICK", AS_OF, WINDOW)


@query
def peak_bands(spark, sf):
    """Each half hour's mean price against the symbol's peak, with its display colour."""
    rows = tape.trades(spark, sf)
    series = trend.price_by_interval(rows, "30 minutes")
    joined = series.join(peaks.peak_partial(rows), "symbol")
    pct = percent_of(F.col("price"), F.col("peak"))
    return joined.select("time", "symbol", pct.alias("pct"), band(pct, *BANDS["pct_of_peak"]).alias("colour"))


# --- check log and alerts -----------------------------------------------------------------------

@query
def check_log(spark, sf):
    return tape.check_log(spark, sf)


@query
def latest_status(spark, sf):
    return alerts.latest_status(tape.check_log(spark, sf), "symbol_stall", "age_s")


@query
def latest_freshness(spark, sf):
    return alerts.latest_freshness(tape.check_log(spark, sf))


@query
def alert_values(spark, sf):
    return alerts.alert_values(tape.check_log(spark, sf), AS_OF, "12 hours")


@query
def alert_eval(spark, sf):
    values = alerts.alert_values(tape.check_log(spark, sf), AS_OF, "12 hours")
    return alerts.evaluate(values, alerts.rules_frame(spark))


@query
def gap_status(spark, sf):
    return alerts.gap_status(tape.check_log(spark, sf))


@query
def check_series(spark, sf):
    return alerts.check_series(tape.check_log(spark, sf), "trade_gap", "2024-01-05 00:00:00", "2024-01-25 12:00:00")


@query
def retained_checks(spark, sf):
    return alerts.retain(tape.check_log(spark, sf), "2024-02-12 00:00:00", 30)


@query
def check_bands(spark, sf):
    """Every logged check with the colour its panel gives it."""
    log = tape.check_log(spark, sf)
    value, name = F.col("value"), F.col("check_name")
    colour = (F.when(name == "freshness", band(value, *BANDS["freshness_lag"]))
              .when(name == "symbol_stall", band(value, *BANDS["symbol_age"]))
              .when(name == "trade_gap", band(value, *BANDS["missing_trades"])))
    return log.select("check_name", "symbol", "checked_at", "value", colour.alias("colour"))


# --- intake -------------------------------------------------------------------------------------

def raw_frames(spark, sf) -> DataFrame:
    """Every event as the frame an exchange might send; its type and quantity decide the shape.

    Signups come bare, the others wrapped. Views of quantity below 5 are subscription replies,
    errors below 5 are cut off, purchases below 5 lack a price, clicks below 5 have a bad one.
    """
    ev = tape.as_trades(tape.table(spark, sf, "events"))
    small = F.col("quantity") < 5

    def is_small(symbol):
        return small & (F.col("symbol") == symbol)

    price = F.when(is_small("CLICK"), F.lit("n/a")).when(
        ~F.coalesce(is_small("PURCHASE"), F.lit(False)), F.col("price").cast("string"))
    parts = {"e": F.lit('"trade"'), "s": _quoted(F.col("symbol")), "t": F.col("trade_id").cast("string"),
             "p": _quoted(price), "q": _quoted(F.col("quantity").cast("string")),
             "T": F.unix_millis("trade_time").cast("string")}
    body = F.concat(F.lit("{"), F.concat_ws(",", *[
        F.concat(F.lit(f'"{key}":'), value) for key, value in parts.items()]), F.lit("}"))
    wrapped = F.concat(F.lit('{"stream":"x","data":'), body, F.lit("}"))
    raw = (F.when(is_small("VIEW"), F.lit('{"result":null,"id":1}'))
           .when(is_small("ERROR"), F.expr("'{\"stream\":'"))
           .when(F.col("symbol") == "SIGNUP", body).otherwise(wrapped))
    return ev.select(raw.alias("raw"))


def _quoted(text):
    return F.concat(F.lit('"'), text, F.lit('"'))


@query
def parsed_frames(spark, sf):
    return intake.split_valid(frames.parse_frames(raw_frames(spark, sf)))[0].drop("raw")


@query
def quarantine(spark, sf):
    bad = intake.split_valid(frames.parse_frames(raw_frames(spark, sf)))[1]
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def history_rows(spark, sf):
    """Orders as fetched history records."""
    orders = tape.table(spark, sf, "orders")
    fetched = orders.select(
        F.lit("ORDERS").alias("symbol"), F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.when(F.col("o_orderstatus") == "P", F.lit("NaN")).otherwise(F.lit("1.5")).alias("qty"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("time"))
    return records.from_history(fetched)


@query
def contract(spark, sf):
    """Events offered under another writer's schema: no quantity, an extra field, some ids no number."""
    ev = tape.as_trades(tape.table(spark, sf, "events"))
    offered = ev.select(
        "symbol", F.when(F.col("quantity") < 5, F.lit("x")).otherwise(F.col("trade_id").cast("string")).alias("trade_id"),
        F.when(F.col("quantity") < 95, F.col("price").cast("string")).alias("price"),
        F.unix_millis("trade_time").alias("trade_time"), F.lit("extra").alias("venue"))
    return intake.enforce_contract(offered, TRADE_MESSAGE, {"quantity": "0"})


def _messages(spark, sf) -> DataFrame:
    """Events as enveloped messages: schema id 7 for most, 9 for errors, a wrong first byte for quantity 0."""
    ev = topic.to_messages(tape.as_trades(tape.table(spark, sf, "events")))
    magic = F.when(F.col("quantity").cast(MONEY) == 0, F.lit("01")).otherwise(F.lit("00"))
    schema_id = F.when(F.col("symbol") == "ERROR", F.lit("00000009")).otherwise(F.lit("00000007"))
    payload = F.to_json(F.struct(*TRADE_MESSAGE.names))
    return ev.select(F.concat(F.unhex(F.concat(magic, schema_id)), F.encode(payload, "UTF-8")).alias("value"))


@query
def envelope(spark, sf):
    opened = frames.split_envelope(_messages(spark, sf))
    return opened.select("magic", "schema_id", F.decode("payload", "UTF-8").alias("payload"), "reason")


@query
def decoded_messages(spark, sf):
    ddl = "symbol string, trade_id bigint, price string, quantity string, trade_time bigint"
    return frames.decode_trades(_messages(spark, sf), {7: ddl}, decode=frames.json_payload).drop("raw")


@query
def topic_rows(spark, sf):
    keyed = topic.to_topic(tape.as_trades(tape.table(spark, sf, "events")))
    return keyed.select(F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"))


# --- sinks and streaming ------------------------------------------------------------------------

# Parts in which the events arrive, one after the other, and files of a part that a micro-batch takes.
PARTS, FILES = 4, 8


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the session's checkpoint folder, which all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        import tempfile
        base = tempfile.mkdtemp(prefix="tape-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def trades_stream(spark, folder) -> DataFrame:
    """A folder of events as a stream of trades."""
    from tapekeeper.sources.tables import read_trades
    events = read_trades(spark, "parquet", tape.SCHEMAS["events"], path=folder, maxFilesPerTrigger=FILES)
    return tape.redeliver(tape.as_trades(events))


def arrivals(spark, sf, folder, where="true"):
    """Writes the events part by part, earlier times first, and yields after each: what has come in so far lies in the folder.

    The parts are equal spans between the first and the last time; events without a time come first. All rows are written.
    """
    rows = tape.table(spark, sf, "events").filter(where)
    total, low, high = rows.agg(F.count(F.lit(1)), F.min("ts"), F.max("ts")).first()
    share = F.try_divide(F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(low).cast("timestamp")),
                         F.unix_micros(F.lit(high).cast("timestamp")) - F.unix_micros(F.lit(low).cast("timestamp")))
    part = F.coalesce(F.least(F.floor(share * PARTS), F.lit(PARTS - 1)), F.lit(0))
    for number in range(PARTS):
        mine = rows.withColumn("part", part).filter(F.col("part") == number).drop("part")
        mine.hint("rebalance").sortWithinPartitions("ts").write.mode("append").parquet(folder)
        yield number
    if spark.read.schema(tape.SCHEMAS["events"]).parquet(folder).count() != total:
        raise RuntimeError("not all events have come in")


def drain(stream, out, marks="offsets", **more) -> None:
    """Everything the stream has into the stored tables under ``out``."""
    query = streaming.write_trades(stream, f"{out}/trades", f"{out}/{marks}", flush=None, **more)
    query.awaitTermination()


def query_of(spark, checkpoint) -> str:
    """The id of the stream that a checkpoint belongs to."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def stream_in(spark, sf, out, source="events", marks="offsets", where="true", **more) -> None:
    """The events streamed into the stored tables under ``out`` as they arrive, by a stream that stops and goes on."""
    for _ in arrivals(spark, sf, f"{out}/{source}", where):
        drain(trades_stream(spark, f"{out}/{source}"), out, marks, **more)


@query
def stream_write(spark, sf):
    """The whole tape through the streaming writer in several batches, read back with duplicates resolved."""
    out = scratch(spark, "stream")
    stream_in(spark, sf, out)
    return tables.read_stored(spark, f"{out}/trades")


@query
def stream_batches(spark, sf):
    """How the streamed tape lies: writers, and whether each wrote more than one batch."""
    out = scratch(spark, "batches")
    stream_in(spark, sf, out)
    return scan_trades(spark, f"{out}/trades").agg(
        F.countDistinct("writer").alias("writers"), (F.countDistinct("batch_id") > 1).alias("several_batches"),
        F.count(F.lit(1)).alias("rows"))


@query
def two_streams(spark, sf):
    """Two streams with checkpoints of their own into one table."""
    out = scratch(spark, "two")
    for number, where in enumerate(("event_id % 2 = 0", "event_id % 2 = 1")):
        stream_in(spark, sf, out, f"events{number}", f"offsets{number}", where)
    return tables.read_stored(spark, f"{out}/trades")


@query
def compacted_then_streamed(spark, sf):
    """A compacted table that a fresh stream goes on writing to."""
    out = scratch(spark, "compacted")
    stream_in(spark, sf, f"{out}/old", where="event_id % 3 = 0")
    tables.compact(spark, f"{out}/old/trades", f"{out}/trades")
    stream_in(spark, sf, out, where="event_id % 3 <> 0")
    return tables.read_stored(spark, f"{out}/trades")


def _heal_in_two(spark, sf, out) -> None:
    """The dense tape stored, then its gaps healed by two cycles, symbol by symbol, each stored with its peaks."""
    tables.write_batch(tape.dense_trades(spark, sf), f"{out}/trades", tables.new_writer("load"))
    for symbols in (SYMBOLS[:2], SYMBOLS[2:]):
        recent = scan_trades(spark, f"{out}/trades", AS_OF, WHOLE)
        cycle = run_heal(recent, tape.history(spark, sf), symbols, AS_OF, WHOLE)
        store_heal(cycle, f"{out}/trades", f"{out}/peaks", f"{out}/seen")


@query
def stored_heals(spark, sf):
    """Ids still missing after two stored healing cycles."""
    out = scratch(spark, "heals")
    _heal_in_two(spark, sf, out)
    return gaps.missing_ids(tables.read_stored(spark, f"{out}/trades"), window=None)


@query
def healed_peaks(spark, sf):
    """The peaks that stored healing cycles folded: those of the rows they brought back."""
    out = scratch(spark, "healed-peaks")
    _heal_in_two(spark, sf, out)
    return tables.read_peaks(spark, f"{out}/peaks")


def _seed(spark, sf) -> DataFrame:
    return peaks.peak_seed(records.from_klines(tape.daily_candles(spark, sf)))


@query
def stream_peaks(spark, sf):
    """The peak table after seeding it and streaming the whole tape past it."""
    out = scratch(spark, "peaks")
    tables.seed_peaks(_seed(spark, sf), f"{out}/peaks")
    stream_in(spark, sf, out, peaks_path=f"{out}/peaks")
    return tables.read_peaks(spark, f"{out}/peaks")


@query
def reseeded_peaks(spark, sf):
    """Peaks seeded, compacted, and seeded again with less, then with one symbol only: none falls or goes."""
    out = scratch(spark, "reseeded")
    tables.seed_peaks(_seed(spark, sf), f"{out}/first")
    tables.compact_peaks(spark, f"{out}/first", f"{out}/peaks")
    tables.seed_peaks(_seed(spark, sf).withColumn("peak", F.col("peak") / 2), f"{out}/peaks")
    tables.seed_peaks(_seed(spark, sf).filter("symbol = 'CLICK'"), f"{out}/peaks")
    return tables.read_peaks(spark, f"{out}/peaks")


@query
def stream_dedup(spark, sf):
    """Rows per symbol after the bounded streaming dedup, its state evicted as the batches pass."""
    out = scratch(spark, "dedup")
    for _ in arrivals(spark, sf, f"{out}/events"):
        kept = streaming.dedup_stream(trades_stream(spark, f"{out}/events"), "1 day")
        (kept.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/offsets")
             .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{out}/rows").groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))


@query
def stored_scan(spark, sf):
    """The tape written as one batch and scanned with day pruning."""
    out = scratch(spark, "scan")
    tables.write_batch(tape.trades(spark, sf), out, "load")
    return scan_trades(spark, out, AS_OF, WINDOW).drop("trade_date", "writer", "batch_id")


@query
def stored_range(spark, sf):
    """A range of the stored tape with duplicates resolved; days outside are not read."""
    out = scratch(spark, "range")
    tables.write_batch(tape.trades(spark, sf), out, "load")
    return tables.read_stored(spark, out, low="2024-01-10 06:00:00", high="2024-01-20 18:30:00")


@query
def stored_default_times(spark, sf):
    """Trades without a write time, and a check cycle, stored with the clock's: rows by whether it lies in the last hour."""
    out = scratch(spark, "times")
    tables.write_batch(tape.trades(spark, sf).drop("ingested_at"), f"{out}/trades", "load")
    tables.append_checks(run_health(tape.dense_trades(spark, sf), SYMBOLS, AS_OF, 120, 3600, WHOLE), f"{out}/checks")
    stamps = scan_trades(spark, f"{out}/trades").select("ingested_at").unionByName(
        tables.read_checks(spark, f"{out}/checks").select(F.col("checked_at").alias("ingested_at")))
    recent = F.col("ingested_at").between(F.expr("now() - INTERVAL 1 HOUR"), F.expr("now() + INTERVAL 1 MINUTE"))
    return stamps.groupBy(recent.alias("recent")).agg(F.count(F.lit(1)).alias("rows"))


@query
def stored_health(spark, sf):
    """A health cycle over the stored dense tape: gaps from its recent days, newest times from the last-seen table."""
    from tapekeeper.operators.health import seen_partial
    out = scratch(spark, "health")
    stored = tape.dense_trades(spark, sf)
    tables.write_batch(stored, f"{out}/trades", "load")
    tables.write_seen(seen_partial(stored), f"{out}/seen", "load")
    return run_stored_health(spark, f"{out}/trades", f"{out}/seen", SYMBOLS, AS_OF, 120, 3600, WINDOW)


@query
def stored_checks(spark, sf):
    """A health cycle appended to the log and read back."""
    out = scratch(spark, "checks")
    cycle = run_health(tape.dense_trades(spark, sf), SYMBOLS, AS_OF, 120, 3600, WHOLE)
    tables.append_checks(cycle, out, AS_OF)
    return tables.read_checks(spark, out)


# --- committed tables and states kept beside them -------------------------------------------------

@query
def snapshot_reads(spark, sf):
    """What readers see while two batches are written: rows by symbol before, between and after, and in a snapshot opened early."""
    out = scratch(spark, "snapshots")
    rows = tape.trades(spark, sf)
    halves = [rows.filter("trade_id % 2 = 0"), rows.filter("trade_id % 2 = 1")]
    commits.commit_batch(halves[0], out, "load", 0)
    early = commits.snapshot(spark, out)
    staged = commits.stage(halves[1], out, "load", 1)
    seen = {"staged": commits.snapshot(spark, out)}
    commits.commit(staged, out, "load", 1)
    commits.commit_batch(halves[1], out, "load", 1)  # replayed: already there
    commits.fold(spark, out)
    seen |= {"committed": commits.snapshot(spark, out), "early": early}
    steps = [s.scan().groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")).withColumn("step", F.lit(step)) for step, s in seen.items()]
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


@query
def indexed_range(spark, sf):
    """A range of a committed, folded tape; only files of its days are opened."""
    out = scratch(spark, "indexed")
    commits.commit_batch(tape.trades(spark, sf), out, "load")
    commits.fold(spark, out)
    return commits.snapshot(spark, out, low="2024-01-10 06:00:00", high="2024-01-20 18:30:00").read()


@query
def merged_while_streaming(spark, sf):
    """The whole tape streamed into a committed table whose small batches are merged, and its log folded, between the parts."""
    out = scratch(spark, "merged")
    for _ in arrivals(spark, sf, f"{out}/events"):
        drain(trades_stream(spark, f"{out}/events"), out, committed=True)
        commits.merge(spark, f"{out}/trades", 2)
        commits.fold(spark, f"{out}/trades")
    return commits.snapshot(spark, f"{out}/trades").read()


@query
def closed_batches(spark, sf):
    """The whole tape into two committed tables: a fast source whose batches close on rows, and a slow one whose batches close on time.
    For each: rows visible in the end, and whether its batches closed as they should."""
    out = scratch(spark, "closed")
    part = tape.table(spark, sf, "events").count() // PARTS
    bounds = {"fast": (part * 3 // 2, 3600.0), "slow": (1 << 60, 0.0)}
    for _ in arrivals(spark, sf, f"{out}/events"):
        for name, (rows, within) in bounds.items():
            query = streaming.write_closing(trades_stream(spark, f"{out}/events"), f"{out}/{name}", f"{out}/{name}-offsets", rows, within, None)
            query.awaitTermination()
    closing.close_waiting(spark, f"{out}/fast", query_of(spark, f"{out}/fast-offsets"))
    found = []
    for name, (bound, _) in bounds.items():
        batches = commits.entries(spark, f"{out}/{name}").groupBy("batch_id").agg(F.sum("rows").alias("rows"))
        # Of the fast source all batches but the last hold the bound's rows; of the slow one each micro-batch is a batch.
        last = F.max("batch_id").over(Window.partitionBy())
        full = (F.col("rows") >= bound) | (F.col("batch_id") == last) if name == "fast" else F.col("rows") < bound
        steps = commits.snapshot(spark, f"{out}/{name}").scan().agg(F.countDistinct("batch_id")).scalar()
        whole = batches.select("rows", full.alias("full")).agg(
            F.sum("rows").alias("rows"), F.every("full").alias("full"), F.count(F.lit(1)).alias("batches"))
        fewer = F.col("batches") < steps if name == "fast" else F.col("batches") == steps
        found.append(whole.select(F.lit(name).alias("source"), "rows", (F.col("full") & fewer).alias("closed_as_bound")))
    return found[0].unionByName(found[1])


@query
def expired_checks(spark, sf):
    """The check log as a committed table, after the days beyond retention were taken out whole."""
    out = scratch(spark, "expired")
    commits.commit_batch(tape.check_log(spark, sf), out, "monitor", table=commits.CHECK_TABLE)
    commits.fold(spark, out)
    commits.expire(spark, out, "2024-02-12 00:00:00", 30)
    return commits.snapshot(spark, out, table=commits.CHECK_TABLE).read()


def _runs_written(spark, sf, out) -> None:
    """The dense tape's runs of ids, written as three batches out of order and one of them twice."""
    rows = tape.dense_trades(spark, sf)
    for batch in (2, 0, 1, 0):
        mine = rows.filter(F.pmod(F.xxhash64("symbol", "trade_id"), F.lit(3)) == batch)
        tables.write_runs(runs.id_runs(mine), out, "load" if batch else f"again-{uuid.uuid4().hex}", batch)


@query
def run_state_gaps(spark, sf):
    """The gaps of the whole tape from its runs of ids, which came in batches out of order and twice."""
    out = scratch(spark, "runs")
    _runs_written(spark, sf, out)
    return runs.gaps_between(tables.read_runs(spark, out))


@query
def run_state_healed(spark, sf):
    """Ids still missing by the state of runs after a healing cycle that took its gaps from the state."""
    out = scratch(spark, "healed-runs")
    _runs_written(spark, sf, f"{out}/runs")
    tables.compact_runs(spark, f"{out}/runs", f"{out}/compact")
    cycle = run_heal(tape.dense_trades(spark, sf), tape.history(spark, sf), SYMBOLS, AS_OF, runs=tables.read_runs(spark, f"{out}/compact"))
    store_heal(cycle, f"{out}/trades", runs_path=f"{out}/compact")
    return runs.missing_in(tables.read_runs(spark, f"{out}/compact"))


def _bucket_state(spark, sf, out) -> None:
    """Minute sums refreshed after each of two batches, a correction of some prices, and a merge."""
    rows = tape.trades(spark, sf)
    fixed = rows.filter("quantity >= 50").withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")).withColumn(
        "price", F.col("price") + F.lit(1).cast(MONEY))
    for number, batch in enumerate((rows.filter("trade_id % 3 = 0"), rows.filter("trade_id % 3 <> 0"), fixed)):
        commits.commit_batch(batch, f"{out}/trades", "load", number)
        buckets.refresh_buckets(spark, f"{out}/trades", f"{out}/state")
    commits.merge(spark, f"{out}/trades", 2)
    buckets.refresh_buckets(spark, f"{out}/trades", f"{out}/state")


@query
def bucket_state_price(spark, sf):
    """Mean price per minute from the state of sums, each trade counted once in its last version."""
    out = scratch(spark, "buckets")
    _bucket_state(spark, sf, out)
    return buckets.price_from_buckets(buckets.read_buckets(spark, f"{out}/state"))


@query
def bucket_state_average(spark, sf):
    """The rolling mean of hours from the state of sums."""
    out = scratch(spark, "bucket-average")
    _bucket_state(spark, sf, out)
    hours = buckets.price_from_buckets(buckets.read_buckets(spark, f"{out}/state"), "hour")
    rows = trend.rolling_means(hours, [60]).select("time", "symbol", F.col("ma_60").alias("moving_avg"))
    return rounded(rows, "moving_avg")


@query
def latency_state(spark, sf):
    """Write latency per day from sketches that a stream left and a compaction merged: exact counts and maxima, and whether each
    percentile's rank among the day's rows is as wanted but for the stated rank error."""
    out = scratch(spark, "latency")
    stream_in(spark, sf, out, latency_path=f"{out}/latency")
    tables.compact_latency(spark, f"{out}/latency", f"{out}/packed")
    found = sketches.latency_of(tables.read_latency(spark, f"{out}/packed", "2024-01-03", "2024-01-27"), "day")
    raw = tape.trades(spark, sf).select(F.to_date("ingested_at").alias("day"), stats.latency_ms().alias("lat"))
    names = {q: f"p{round(q * 100)}_ms" for q in stats.QUANTILES}
    ranks = raw.join(found, "day").groupBy("day", "events", "max_ms", *names.values()).agg(*[
        F.count_if(side).alias(f"{end}_{name}") for name in names.values()
        for end, side in (("below", F.col("lat") < F.col(name)), ("upto", F.col("lat") <= F.col(name)))])
    slack = F.col("events") * F.lit(sketches.RANK_ERROR) + 1
    return ranks.select("day", "events", "max_ms", *[
        ((F.col(f"below_{name}") <= F.col("events") * q + slack) & (F.col(f"upto_{name}") >= F.col("events") * q - slack)).alias(f"{name}_holds")
        for q, name in names.items()])


# Rows of a file of the stored histories here, small so that the given tables fill several.
HISTORY_ROWS = 2048


@query
def indexed_heal(spark, sf):
    """The rows that fill the dense tape's gaps, from a history laid out for lookups that came in two overlapping loads."""
    stored = StoredHistory(spark, scratch(spark, "history"))
    rows = tape.history(spark, sf)
    for part in (rows.filter("quantity < 60"), rows.filter("quantity >= 40")):
        stored.load(part, HISTORY_ROWS)
    return stored.fill(_plan(spark, sf))


@query
def indexed_order_heal(spark, sf):
    """Order lines' gaps filled from an indexed history in a healing cycle that takes its gaps from the state of runs."""
    out = scratch(spark, "order-history")
    lines, stored = tape.order_tape(spark, sf), StoredHistory(spark, f"{out}/history")
    stored.load(tape.order_history(spark, sf), HISTORY_ROWS)
    tables.write_runs(runs.id_runs(lines), f"{out}/runs", "load")
    cycle = run_heal(lines, stored, runs=tables.read_runs(spark, f"{out}/runs"))
    return cycle.rows.drop("ingested_at")


@query
def live_peaks(spark, sf):
    """The peak table after seeding it and a streaming aggregate over the whole tape that stopped and went on with its state."""
    out = scratch(spark, "live-peaks")
    tables.seed_peaks(_seed(spark, sf), f"{out}/peaks")
    for _ in arrivals(spark, sf, f"{out}/events"):
        streaming.write_live_peaks(trades_stream(spark, f"{out}/events"), f"{out}/peaks", f"{out}/offsets", None).awaitTermination()
    return tables.read_peaks(spark, f"{out}/peaks")


@query
def stream_progress(spark, sf):
    """What the stored table of progress says of a stream of the whole tape: queries, events taken, whether in several batches."""
    out = scratch(spark, "progress")
    for _ in arrivals(spark, sf, f"{out}/events"):
        query = streaming.write_trades(trades_stream(spark, f"{out}/events"), f"{out}/trades", f"{out}/offsets", flush=None)
        query.awaitTermination()
        streaming.append_progress(spark, query, f"{out}/progress")
    return streaming.read_progress(spark, f"{out}/progress").agg(
        F.countDistinct("query_id").alias("queries"), F.sum("input_rows").alias("events"),
        (F.count_if(F.col("input_rows") > 0) > 1).alias("several_batches"))


# Record schemas of four writers: without quantity, as the contract, with more and narrower, and with another type of time.
def _record(*kinds) -> str:
    import json
    return json.dumps({"type": "record", "name": "Trade", "fields": [
        {"name": name, "type": kind, **({"default": default[0]} if default else {})} for name, kind, *default in kinds]})


READER = _record(("symbol", "string"), ("trade_id", "long"), ("price", "string"), ("quantity", "string", "0"), ("trade_time", "long"))
WRITERS = {
    1: _record(("symbol", "string"), ("trade_id", "long"), ("price", "string"), ("trade_time", "long")),
    2: READER,
    3: _record(("venue", "string"), ("symbol", "string"), ("trade_id", "int"), ("price", "string"), ("quantity", "string"), ("trade_time", "long")),
    4: _record(("symbol", "string"), ("trade_id", "long"), ("price", "string"), ("quantity", "string"), ("trade_time", "string")),
}


@query
def versioned_messages(spark, sf):
    """Events as messages of four schema versions by their type: three are read as one, the fourth is refused and says why."""
    ev = tape.as_trades(tape.table(spark, sf, "events"))
    number = F.when(F.col("symbol") == "SIGNUP", 1).when(F.col("symbol") == "PURCHASE", 3).when(F.col("symbol") == "ERROR", 4).otherwise(2)
    quantity = F.when(number != 1, F.col("quantity").cast("string"))  # to_json leaves nulls out
    body = F.to_json(F.struct("symbol", "trade_id", F.col("price").cast("string").alias("price"), quantity.alias("quantity"),
                              F.unix_millis("trade_time").alias("trade_time"), F.when(number == 3, F.lit("x")).alias("venue")))
    header = F.unhex(F.concat(F.lit("0000000"), number.cast("string")))
    value = F.concat(F.unhex(F.lit("00")), header, F.encode(body, "UTF-8"))
    return versions.decode_versions(ev.select(value.alias("value")), WRITERS, READER, set_aside=True).drop("raw")
