"""Price sums per symbol and minute, kept as a state over a committed table instead of being computed from all trades.

Plain partial sums would count copies twice, and a later version of a trade would stay beside the earlier. So a refresh asks
the table which files are new, which minutes these touch, and computes those minutes anew from the
table with versions resolved; of the state's rows the newest of a minute counts. The cost is that of the days
touched, whatever the length of the tape.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapekeeper.functions.time import utc_day
from tapekeeper.schema import MONEY
from tapekeeper.sinks.commits import TRADE_TABLE, Snapshot, entries, stored_schema
from tapekeeper.sinks.tables import plain_timestamps

# Sums of prices of a minute: total of those that have a price and how many, in the state's version ``round``.
BUCKETS = "symbol string, minute timestamp, total decimal(38,8), filled bigint, rows bigint, round bigint, day date"
SEEN = "file string, round bigint"


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def refresh_buckets(spark: SparkSession, path: str, state: str) -> int:
    """Brings the state up to what the committed table at ``path`` holds now; returns how many files were new to it.

    One refresh at a time. The minutes are written first and the files noted last: a refresh that dies is done again, as
    a later round, with the same result. Files that a merge made hold no new rows but are read once more, as new.
    """
    seen = _stored(spark, f"{state}/files", SEEN)
    done = seen.agg(F.coalesce(F.max("round"), F.lit(0))).first()[0]
    files = entries(spark, path).select("file", "day")
    new = files.join(seen, "file", "left_anti").collect()
    if not new:
        return 0
    days = {r.day for r in new}
    minute = F.date_trunc("minute", "trade_time")
    touched = spark.read.schema(stored_schema(TRADE_TABLE)).parquet(*sorted(r.file for r in new)).select(
        "symbol", minute.alias("minute")).distinct()
    present = [r.file for r in files.filter(F.col("day").isin(days)).collect()]
    rows = Snapshot(spark, TRADE_TABLE, sorted(present)).read().withColumn("minute", minute)
    same = rows["symbol"].eqNullSafe(touched["symbol"]) & rows["minute"].eqNullSafe(touched["minute"])
    sums = rows.join(touched, same, "left_semi").groupBy("symbol", "minute").agg(
        F.sum(F.col("price").cast(MONEY)).cast("decimal(38,8)").alias("total"), F.count("price").alias("filled"), F.count(F.lit(1)).alias("rows"))
    plain_timestamps(spark)
    sums.select("*", F.lit(done + 1).cast("bigint").alias("round"), utc_day(F.col("minute")).alias("day")).hint("rebalance").write.mode(
        "append").partitionBy("day").parquet(f"{state}/buckets")
    spark.createDataFrame([(r.file, done + 1) for r in new], SEEN).coalesce(1).write.mode("append").parquet(f"{state}/files")
    return len(new)


def read_buckets(spark: SparkSession, state: str, low=None, high=None) -> DataFrame:
    """(symbol, minute, total, filled, rows): the newest row of each minute, of the UTC days from ``low`` to ``high`` where given."""
    found = _stored(spark, f"{state}/buckets", BUCKETS)
    found = found if low is None else found.filter(F.col("day") >= F.lit(low).cast("date"))
    found = found if high is None else found.filter(F.col("day") <= F.lit(high).cast("date"))
    newest = found.groupBy("symbol", "minute").agg(F.max(F.struct("round", "total", "filled", "rows")).alias("last"))
    return newest.select("symbol", "minute", "last.total", "last.filled", "last.rows")


def price_from_buckets(buckets: DataFrame, unit: str = "minute") -> DataFrame:
    """(time, symbol, price): mean price per minute, or any longer date_trunc unit."""
    wide = buckets.groupBy(F.date_trunc(unit, "minute").alias("time"), "symbol").agg(F.sum("total").alias("total"), F.sum("filled").alias("filled"))
    return wide.select("time", "symbol", F.try_divide(F.col("total").cast("double"), F.col("filled").cast("double")).alias("price"))
