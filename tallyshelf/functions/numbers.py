"""Text to exact numbers, and numbers to display text. Column expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.columns import NULL_TOKENS

# Exact to eight decimals below 10^19, and its sums fit a decimal too, so they don't depend on order.
AMOUNT_TYPE = "decimal(27,8)"
AMOUNT_BOUND = 1e19
# Wide enough to see what AMOUNT_TYPE rounds.
FINE_TYPE = "decimal(38,18)"
# What stands for amounts too small for AMOUNT_TYPE: they stay on their side of zero.
LEAST_AMOUNT, HALF_AMOUNT = "0.00000001", 5e-9
# A digit that AMOUNT_TYPE rounds away.
FINE_DECIMALS = r"\.[0-9]{8}[0-9]*[1-9]"

# Only used for the few texts with an exponent: the double cast also takes '1e5d'.
EXPONENT_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+\s*$"


def is_token(name: str, tokens: Sequence[str]) -> Column:
    listed = ", ".join(f"'{t}'" for t in tokens)
    return F.expr(f"`{name}` IN ({listed})")


def blank_to_null(name: str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Text column `name` with the texts that stand for a missing value as NULL."""
    return F.when(~is_token(name, tokens), F.col(f"`{name}`")) if tokens else F.col(f"`{name}`")


def amount(df: DataFrame, name: str) -> Column:
    """Column `name` as AMOUNT_TYPE; NULL for null, NaN, infinities and anything that is not a number.

    No number turns into zero: what is finer than AMOUNT_TYPE becomes its least amount, with its sign.
    """
    held = _rounded(df, name)
    if df.schema[name].dataType.simpleString() == AMOUNT_TYPE or isinstance(df.schema[name].dataType, T.IntegralType):
        return held
    # The cheap test comes first: doubles are there, texts are only read as such if the amount is zero.
    written, least = F.col(f"`{name}`").try_cast("double"), F.lit(LEAST_AMOUNT).cast(AMOUNT_TYPE)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        tiny = (written > -HALF_AMOUNT) & (written < HALF_AMOUNT) & (written != 0)
    else:
        tiny = (held == 0) & (written != 0)
    return F.when(tiny, F.when(written > 0, least).otherwise(-least)).otherwise(held)


def inexact(df: DataFrame, name: str) -> Column:
    """True where the number as written has more decimals than AMOUNT_TYPE holds."""
    dtype = df.schema[name].dataType
    if dtype.simpleString() == AMOUNT_TYPE or isinstance(dtype, T.IntegralType):
        return F.lit(False)
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        # The nearest double of a whole number of least amounts is itself again; large doubles have no finer decimals.
        return F.coalesce((F.abs(c) < 9e7) & (F.rint(c * 1e8) / 1e8 != c), F.lit(False))
    held = _rounded(df, name)
    fine = F.coalesce(c.try_cast(FINE_TYPE), c.try_cast("double").try_cast(FINE_TYPE))
    rounded = (held != fine) | ((held == 0) & (c.try_cast("double") != 0))
    if not isinstance(dtype, T.StringType):
        return F.coalesce(rounded, F.lit(False))
    plain = (F.length(c) > 9) & c.rlike(FINE_DECIMALS) & held.isNotNull()
    return F.coalesce(F.when(F.lower(c).contains("e"), rounded).otherwise(plain), F.lit(False))


def _rounded(df: DataFrame, name: str) -> Column:
    """The decimal cast itself rejects 'nan', 'inf', '5d' and '1,234', so plain numbers need no pattern match."""
    c = F.col(f"`{name}`")
    dtype = df.schema[name].dataType
    if dtype.simpleString() == AMOUNT_TYPE:
        return c
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c).try_cast(AMOUNT_TYPE)
    if not isinstance(dtype, T.StringType):
        return c.try_cast(AMOUNT_TYPE)
    exponent = F.when(c.rlike(EXPONENT_NUMBER), c.try_cast("double").try_cast(AMOUNT_TYPE))
    return F.when(F.lower(c).contains("e"), exponent).otherwise(c.try_cast(AMOUNT_TYPE))


def unreadable(df: DataFrame, name: str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """True where a value is there but is no amount."""
    c = F.col(f"`{name}`")
    there = c.isNotNull()
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType) and tokens:
        there = there & ~is_token(name, tokens)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        there = there & ~F.isnan(c)
        # Doubles below the bound are held, so none needs the cast.
        return there & (F.abs(c) >= F.lit(AMOUNT_BOUND))
    return there & _rounded(df, name).isNull()


def amount_or_zero(df: DataFrame, name: str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Missing becomes 0 first; text that is present but no number stays NULL."""
    c = F.col(f"`{name}`")
    missing = c.isNull()
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType) and tokens:
        missing = missing | is_token(name, tokens)
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(c)
    return F.when(missing, F.lit(0).cast(AMOUNT_TYPE)).otherwise(amount(df, name))


def money_text(c: Column) -> Column:
    """Dollars and cents; halves round away from zero, as a cell format does."""
    sign = F.when(c < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.lit("$"), F.format_number(F.round(F.abs(c), 2), 2))


def thousands_text(c: Column) -> Column:
    return F.format_number(F.round(c, 0), 0)


def integral_text(c: Column) -> Column:
    """An exact amount without needless digits: 12, 2.5, 12345678.25."""
    whole = F.floor(c).cast("bigint").cast("string")
    return F.when(c == F.floor(c), whole).otherwise(F.rtrim(c.cast("string"), F.lit("0")))
