"""Tolerant parsing and arithmetic. Missing is always SQL NULL, never NaN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layouts tried, in this order, after ISO timestamps.
DATE_FORMATS = ("yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "d-M-yyyy", "d MMM yyyy")

# The JVM reads a type suffix as part of a number; such text is not a number here.
_JVM_SUFFIX = r"[0-9.]\s*[dDfF]\s*$"


def col(name: str) -> Column:
    """Column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_to_number(text: Column) -> Column:
    """Text as DOUBLE; NULL when it does not parse or spells NaN."""
    parsed = text.try_cast("double")
    # The pattern is only tried on the few texts that end like a suffix.
    ending = F.lower(F.right(F.rtrim(text), F.lit(1))).isin("d", "f")
    return F.when(~(F.isnan(parsed) | (ending & text.rlike(_JVM_SUFFIX))), parsed)


def number(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as DOUBLE, parsed leniently if it is text."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col(name)), col(name).cast("double"))
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        return text_to_number(col(name))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return col(name).cast("double")
    return col(name).try_cast("double")


def number_or(df: DataFrame, name: str, default: float | None = None) -> Column:
    """Like :func:`number`, or a constant when ``df`` has no such column."""
    if name in df.columns:
        return number(df, name)
    return F.lit(default).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as DOUBLE; NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def half_even(value: Column, places: int = 0) -> Column:
    """Banker's rounding, the rule of the reported figures."""
    return F.bround(value, places)


def clamp(value: Column, low: float, high: float) -> Column:
    """Value kept within [low, high]; NULL stays NULL."""
    bounded = F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high)))
    return F.when(value.isNotNull(), bounded)


def wall_clock(value: Column) -> Column:
    """TIMESTAMP_NTZ of the value as written, without its zone; NULL if unreadable."""
    return value.try_cast("timestamp_ntz")


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Timestamp from ISO text or the first of ``formats`` that fits."""
    attempts = [F.try_to_date(text, fmt).cast("timestamp_ntz") for fmt in formats]
    return F.coalesce(wall_clock(text), *attempts)


def yes_no(text: Column) -> Column:
    """1.0 / 0.0 for yes, true, 1 / no, false, 0 in any case; otherwise NULL."""
    word = F.lower(F.trim(text))
    return F.when(word.isin("yes", "true", "1"), F.lit(1.0)).when(
        word.isin("no", "false", "0"), F.lit(0.0)
    )


def male_flag(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin("male", "m"), F.lit(1.0)).when(
        word.isin("female", "f"), F.lit(0.0)
    )


def time_key(moment: Column) -> Column:
    """A LONG that orders TIMESTAMP_NTZ values as they read on the wall clock.

    Built from calendar parts, so no time zone can reorder it. A LONG lets
    aggregates stay on the hash path where a struct key would force a sort.
    """
    days = F.unix_date(moment.cast("date")).cast("long")
    seconds = F.hour(moment) * 3600 + F.minute(moment) * 60
    micros = (F.extract(F.lit("SECONDS"), moment) * 1_000_000).cast("long")
    return days * 86_400_000_000 + seconds.cast("long") * 1_000_000 + micros
