"""The tape the registered queries run on, derived by Spark from the ``events`` table.

symbol = event_type in upper case, price = value, quantity = props.k, trade_time = ts in milliseconds, and a write
delay that varies by row. The full tape is the *history*. *trades* is the full tape with each trade
of quantity 90 or more delivered a second time five seconds later. Only for the work on gaps,
healing and health there is a *dense* tape with losses: trades of quantity below 3 and every trade
of the daily hour 03 are missing, so its ids have short and long holes.
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tapekeeper.functions.time import from_utc_clock, to_millis
from tapekeeper.plans.cycles import run_cycles
from tapekeeper.schema import MONEY, TRADES

AS_OF = "2024-01-31 00:00:00"
SYMBOLS = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW", "GHOST"]

# How often the monitor ran, and how far back it looked.
CYCLE_EVERY, CYCLE_WINDOW = "1 day", "2 days"

# Events per numbering bucket.
SPAN = 1 << 16


# Columns of the given tables; stating them saves a footer-reading job per read.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def as_trades(events: DataFrame) -> DataFrame:
    """Events as trades numbered by event_id: unique and rising, but not dense per symbol.

    ``json_tuple`` yields a value, so filters on the quantity do not parse the text again.
    """
    events = events.select("event_id", "ts", "event_type", "value", F.json_tuple("props", "k").alias("k"))
    trade_time = to_millis(from_utc_clock(F.col("ts")))
    late = (F.lit(20) + (F.col("event_id") * 37) % 500).cast("long")
    return events.select(
        F.upper("event_type").alias("symbol"), F.col("event_id").alias("trade_id"),
        F.col("value").cast(MONEY).alias("price"),
        F.col("k").cast(MONEY).alias("quantity"),
        trade_time.alias("trade_time"),
        F.timestamp_millis(F.unix_millis(trade_time) + late).alias("ingested_at"))


def number_by_symbol(trades: DataFrame) -> DataFrame:
    """Renumbers trade_id 1, 2, 3, ... per symbol in its present order.

    Row numbers are taken inside (symbol, id range) buckets and shifted by the rows in earlier
    buckets, so no symbol is ever sorted as a whole.
    """
    bucketed = trades.withColumn("_bucket", F.expr(f"trade_id div {SPAN}"))
    sizes = bucketed.groupBy("symbol", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("symbol").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("symbol", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("symbol", "_bucket").orderBy("trade_id")
    numbered = bucketed.withColumn("_row", F.row_number().over(inside)).join(starts, ["symbol", "_bucket"])
    return numbered.withColumn("trade_id", F.col("_start") + F.col("_row")).select(*TRADES.names)


def keep_live(history: DataFrame) -> DataFrame:
    return history.filter((F.col("quantity") >= 3) & (F.hour("trade_time") != 3))


def redeliver(live: DataFrame) -> DataFrame:
    """Adds the second deliveries, in one pass over the rows."""
    delays = F.when(F.col("quantity") >= 90, F.array(F.lit(0), F.lit(5))).otherwise(F.array(F.lit(0)))
    written = F.col("ingested_at") + F.col("_delay") * F.expr("INTERVAL 1 SECOND")
    return live.withColumn("_delay", F.explode(delays)).withColumn("ingested_at", written).select(*TRADES.names)


def history(spark, sf_dir) -> DataFrame:
    """Every trade, densely numbered."""
    return number_by_symbol(as_trades(table(spark, sf_dir, "events")))


def live(spark, sf_dir) -> DataFrame:
    """What got through, with holes."""
    return keep_live(history(spark, sf_dir))


def dense_trades(spark, sf_dir) -> DataFrame:
    """The stored tape, duplicates included, with dense numbering: for gap work."""
    return redeliver(live(spark, sf_dir))


def trades(spark, sf_dir, since: str | None = None) -> DataFrame:
    """The stored tape under event ids: every event, straight off the scan.

    ``since`` is a lower bound the scan may use; callers still apply their exact lookback.
    """
    events = table(spark, sf_dir, "events")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    return redeliver(as_trades(events))


def daily_candles(spark, sf_dir) -> DataFrame:
    """(symbol, klines): one JSON array of [open time, open, high, ...] per symbol, one candle per day.

    Highs are a quarter above the day's best price, so the seeded peak exceeds the tape.
    """
    base = as_trades(table(spark, sf_dir, "events"))
    days = base.groupBy("symbol", F.to_date("trade_time").alias("day")).agg(
        F.max(F.col("price") * F.lit("1.25").cast("decimal(4,2)")).alias("high"), F.min("price").alias("low"))
    candle = F.array(
        F.unix_millis(F.col("day").cast("timestamp")).cast("string"), F.col("low").cast("string"),
        F.col("high").cast("string"), F.col("low").cast("string"))
    return days.groupBy("symbol").agg(F.to_json(F.collect_list(candle)).alias("klines"))


def check_log(spark, sf_dir) -> DataFrame:
    """The check log that a monitor of this tape left: the library's health and healing cycles at the end of each of its days."""
    whole = F.date_trunc("day", F.col("ts"))
    first, last = (f"{t:%Y-%m-%d} 00:00:00" if t else AS_OF for t in table(spark, sf_dir, "events").agg(
        F.min(whole) + F.expr("INTERVAL 1 DAY"), F.max(whole) + F.expr("INTERVAL 1 DAY")).first())
    return run_cycles(dense_trades(spark, sf_dir), history(spark, sf_dir), SYMBOLS, first, last, CYCLE_EVERY, 600, 1800, CYCLE_WINDOW)


def order_tape(spark, sf_dir) -> DataFrame:
    """Order lines as a tape of one hot symbol: the id is the order key, so lines repeat it and
    orders without lines are holes."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.lit("ORDERS").alias("symbol"), F.col("l_orderkey").alias("trade_id"),
        F.col("l_extendedprice").cast(MONEY).alias("price"), F.col("l_quantity").cast(MONEY).alias("quantity"),
        from_utc_clock(F.col("l_shipdate")).alias("trade_time"),
        from_utc_clock(F.col("l_shipdate")).alias("ingested_at"))


def order_history(spark, sf_dir) -> DataFrame:
    """Every order, as the history of ``order_tape``."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.lit("ORDERS").alias("symbol"), F.col("o_orderkey").alias("trade_id"),
        F.col("o_totalprice").cast(MONEY).alias("price"), F.lit(1).cast(MONEY).alias("quantity"),
        from_utc_clock(F.col("o_orderdate")).alias("trade_time"),
        from_utc_clock(F.col("o_orderdate")).alias("ingested_at"))
