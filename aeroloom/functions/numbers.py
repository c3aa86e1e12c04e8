"""Numeric parsing and exact rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def numeric(col: Column, data_type: T.DataType) -> Column:
    """Value as double; text that is not a number, and types that are none, give null."""
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    if isinstance(data_type, T.StringType):
        text = F.trim(col)
        return F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.lit(None).cast("double")


def fixed(col: Column, digits: int = 1) -> Column:
    """Text with ``digits`` decimals, rounded on the exact binary value, half to even."""
    return F.call_function("format_number", col.cast("double"), F.lit("0." + "0" * digits if digits else "0"))


def exact_round(col: Column, digits: int = 1) -> Column:
    """Rounding of the exact binary value, half to even (Spark's ``round`` looks at the decimal text).

    Infinite values and NaN stay as they are.
    """
    value = col.cast("double")
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(odd, value).otherwise(fixed(F.when(~odd, value), digits).cast("double"))


def round_double(col: Column, digits: int) -> Column:
    """Spark's ``round`` of a double, which goes by its decimal text, without that text unless the value lies close to a tie.

    Elsewhere the nearest whole number of units is plain, and its quotient is the double nearest to that decimal.  Values
    whose product would lose the digits that show a tie are left to ``round``.
    """
    unit = F.lit(float(10 ** digits))
    scaled = col * unit
    plain = (F.abs(scaled) < 1e9) & (F.abs(F.abs(scaled - F.rint(scaled)) - 0.5) > 1e-5)
    return F.when(plain, F.rint(scaled) / unit + 0.0).otherwise(F.round(col, digits))
