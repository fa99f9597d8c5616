"""Turning text fields into typed trades, with unusable rows set aside and labelled."""

from pyspark.sql import Column, DataFrame, functions as F

from tapekeeper.functions.values import exact_decimal
from tapekeeper.schema import TRADE_MESSAGE

REASON = "reason"


def first_reason(*tests: tuple[Column, str]) -> Column:
    """Label of the first test that holds, NULL when none does."""
    return F.coalesce(*[F.when(test, F.lit(label)) for test, label in tests])


def type_trades(raw: DataFrame, keep=()) -> DataFrame:
    """Text or loosely typed trade fields to exact types, plus ``reason`` for rows that cannot be used.

    ``raw`` has the message columns in any type. A reason already present is kept.
    """
    earlier = F.col(REASON) if REASON in raw.columns else F.lit(None).cast("string")
    typed = raw.select(
        F.col("symbol").cast("string").alias("symbol"),
        F.col("trade_id").cast("string").try_cast("long").alias("trade_id"),
        exact_decimal(F.col("price").cast("string")).alias("price"),
        exact_decimal(F.col("quantity").cast("string")).alias("quantity"),
        F.col("trade_time").cast("string").try_cast("long").alias("_ms"),
        F.coalesce(earlier, first_reason(
            *[(F.col(name).isNull(), f"missing {name}") for name in TRADE_MESSAGE.names])).alias(REASON),
        *keep)
    reason = F.coalesce(F.col(REASON), first_reason(
        (F.col("trade_id").isNull(), "bad trade_id"),
        (F.col("price").isNull(), "bad price"),
        (F.col("quantity").isNull(), "bad quantity"),
        (F.col("_ms").isNull(), "bad trade_time")))
    return typed.select("symbol", "trade_id", "price", "quantity",
                        F.timestamp_millis("_ms").alias("trade_time"), reason.alias(REASON), *keep)


def split_valid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows without the reason column, quarantined rows with it)."""
    return rows.filter(F.col(REASON).isNull()).drop(REASON), rows.filter(F.col(REASON).isNotNull())


def enforce_contract(df: DataFrame, schema, defaults=None) -> DataFrame:
    """Rows conformed to ``schema``, plus ``reason``.

    A field the writer did not have takes its default, extra fields are dropped, and a value that
    does not convert, or a missing one without default, gives the row a reason.
    """
    defaults = defaults or {}
    columns, tests = [], []
    for field in schema.fields:
        name = field.name
        fill = F.lit(defaults.get(name)).cast(field.dataType)
        if name not in df.columns:
            columns.append(fill.alias(name))
            if name not in defaults:
                tests.append((F.lit(True), f"missing {name}"))
            continue
        value = F.col(name).try_cast(field.dataType)
        columns.append(F.when(F.col(name).isNull(), fill).otherwise(value).alias(name))
        tests.append((F.col(name).isNotNull() & value.isNull(), f"bad {name}"))
        if name not in defaults:
            tests.append((F.col(name).isNull(), f"missing {name}"))
    reason = first_reason(*tests) if tests else F.lit(None).cast("string")
    return df.select(*columns, reason.alias(REASON))
