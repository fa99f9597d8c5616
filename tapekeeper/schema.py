"""Schemas and closed value sets. Sources never infer a schema; they use these."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 8)

# What travels on the topic: prices as exact decimal text, time as epoch milliseconds.
TRADE_MESSAGE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("price", T.StringType()),
    T.StructField("quantity", T.StringType()),
    T.StructField("trade_time", T.LongType()),
])

# Fixed value: the same record as an Avro contract, for connectors that need the JSON form.
TRADE_AVRO = """
{"type": "record", "name": "Trade", "fields": [
  {"name": "symbol", "type": "string"},
  {"name": "trade_id", "type": "long"},
  {"name": "price", "type": "string"},
  {"name": "quantity", "type": "string"},
  {"name": "trade_time", "type": "long"}]}
"""

# A usable trade, before it has been written anywhere.
TRADE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("price", MONEY),
    T.StructField("quantity", MONEY),
    T.StructField("trade_time", T.TimestampType()),
])

# The fact table: ingested_at is filled at write time and is also the dedup version.
TRADES = T.StructType(TRADE.fields + [T.StructField("ingested_at", T.TimestampType())])

# As stored: partitioned by UTC day, then by who wrote the rows and in which of its batches.
STORED_TRADES = T.StructType(TRADES.fields + [
    T.StructField("trade_date", T.DateType()),
    T.StructField("writer", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

PEAKS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("peak", T.DoubleType()),
])

# Newest trade per symbol: partial maxima, like the peaks.
SEEN = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("newest", T.TimestampType()),
])

# Maximal runs of ids that a tape has: partial sets, merged by adjacency.
RUNS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("first_id", T.LongType()),
    T.StructField("last_id", T.LongType()),
])

# Latency sketch state: partials of a UTC day of writing, merged on read.
LATENCY = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("events", T.LongType()),
    T.StructField("max_ms", T.LongType()),
    T.StructField("sketch", T.BinaryType()),
])

CHECKS = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("checked_at", T.TimestampType()),
])

STORED_CHECKS = T.StructType(CHECKS.fields + [T.StructField("check_date", T.DateType())])

KEY = ["symbol", "trade_id"]
VERSION = "ingested_at"

# Names written to the check log.
FRESHNESS, SYMBOL_STALL, TRADE_GAP, BACKFILL = "freshness", "symbol_stall", "trade_gap", "backfill"
OK, STALE, STALLED = "OK", "STALE", "STALLED"
GAP_DETECTED, BACKFILLED, DISABLED = "GAP_DETECTED", "BACKFILLED", "DISABLED"
ALL_SYMBOLS = "ALL"
NEVER_SEEN_SECONDS = 999999.0

# Default thresholds and window lengths.
FRESHNESS_SECONDS = 120
STALL_SECONDS = 300
GAP_WINDOW = "10 minutes"
HEAL_WINDOW = "15 minutes"
PEAK_WINDOW = "10 minutes"
PAGE_SIZE = 1000
RETENTION_DAYS = 30
MOVING_AVERAGE_SIZES = (15, 60, 240, 720, 1440)
