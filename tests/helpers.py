"""Small hand-written tapes."""

from datetime import datetime, timezone
from decimal import Decimal

from tapekeeper.schema import CHECKS, TRADES

NOW = "2024-03-01 12:00:00"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def trade(symbol, trade_id, price="1", quantity="1", time="2024-03-01 11:59:00", written=None):
    return (symbol, trade_id, Decimal(price), Decimal(quantity), at(time), at(written or time))


def tape_of(spark, *rows):
    return spark.createDataFrame(list(rows), TRADES)


def ids_of(spark, symbol, ids, **kw):
    return tape_of(spark, *[trade(symbol, i, **kw) for i in ids])


def log_of(spark, *rows):
    return spark.createDataFrame([(*r[:4], at(r[4])) for r in rows], CHECKS)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
