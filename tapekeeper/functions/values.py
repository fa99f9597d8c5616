"""Exact decimals, ratios, rounding and colour bands."""

from pyspark.sql import Column, functions as F

from tapekeeper.schema import MONEY

# Fixed values: (inclusive lower bound, colour) steps of each display; below the first bound is the base colour.
BANDS = {
    "pct_of_peak": ("green", ((80, "yellow"), (95, "orange"), (100, "red"))),
    "freshness_lag": ("green", ((120, "red"),)),
    "symbol_age": ("green", ((300, "red"),)),
    "missing_trades": ("green", ((1, "orange"), (100, "red"))),
}


def exact_decimal(text: Column) -> Column:
    """Text to DECIMAL(18,8) without passing through a float; NULL when it is no number or does not fit."""
    return text.try_cast(MONEY)


def exact_mean(amount: Column) -> Column:
    """Mean of a decimal column as a double: the sum stays exact, so row order cannot change the result."""
    return F.sum(amount).cast("double") / F.count(amount)


def percent_of(part: Column, whole: Column) -> Column:
    """part / whole * 100 as a double; NULL for a zero whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def round_even(value: Column, digits: int) -> Column:
    """Round half to even, for display only."""
    return F.bround(value, digits)


def band(value: Column, base: str, steps) -> Column:
    """Colour of the highest step whose lower bound is reached; NULL stays NULL."""
    colour = F.lit(base)
    for bound, name in steps:
        colour = F.when(value >= bound, F.lit(name)).otherwise(colour)
    return F.when(value.isNotNull(), colour)
