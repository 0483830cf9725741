"""Number expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.functions.text import strip_unicode

# Plain decimal notation with an optional exponent. Keeps out what a Java parse also takes
# (`12d`, `1f`, `NaN`, `Infinity`, hexadecimal floats).
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
LARGEST_DOUBLE = 1.7976931348623157e308


def parsed_number(text: Column) -> Column:
    """Text to double; null for anything not in plain notation. An exponent may give infinity."""
    stripped = strip_unicode(text)
    return F.when(stripped.rlike(NUMBER), stripped.try_cast("double"))


def number(text: Column) -> Column:
    """Text to double; null for anything that is not a finite number."""
    value = parsed_number(text)
    return F.when(finite(value), value)


def finite(value: Column) -> Column:
    """Not null, not infinite, not NaN (which compares above every number).

    Two plain comparisons, so on a stored column they reach the Parquet reader.
    """
    return (value >= F.lit(-LARGEST_DOUBLE)) & (value <= F.lit(LARGEST_DOUBLE))


def whole_number(text: Column, value: Column | None = None) -> Column:
    """Text to bigint, cut towards zero. Integer text is exact over the whole bigint range.

    `value` is the same text as a double, where that is at hand already.
    """
    value = parsed_number(text) if value is None else value
    return F.coalesce(strip_unicode(text).try_cast("bigint"), value.try_cast("bigint"))


def is_text(df: DataFrame, name: str) -> bool:
    """True when the column holds text rather than numbers."""
    return isinstance(df.schema[name].dataType, T.StringType)


def once(value: Column) -> Column:
    """`value`, computed by a generator instead of a projection; use it alone in a `select`.

    Catalyst moves a filter below a projection and copies the projected expression into every place
    that uses it. For a parse that is read by several checks, that is one parse per check.
    """
    return F.explode(F.array(value))


def exact_sum(df: DataFrame, name: str, scale: int | None = None) -> Column:
    """Sum of one column.

    With `scale` the values are added as decimals, so the result does not depend on the order in
    which partitions arrive, and then given back as double. Integer columns are summed as they are.
    """
    if scale is None:
        return F.sum(F.col(name))
    return F.sum(F.col(name).cast(T.DecimalType(20, scale))).cast("double")


def all_of(conditions: list[Column]) -> Column:
    """Conjunction; true for an empty list."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    """Disjunction; false for an empty list."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
