"""Scalar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_pii_column(df: DataFrame, column: str) -> DataFrame:
    """Adds <column>_HASHED, a 64-bit hash as text; one that is there already is replaced."""
    return df.drop(f"{column}_HASHED").withColumn(f"{column}_HASHED", F.xxhash64(F.col(column)).cast("string"))


def salted_sha256(column: Column, salt: str) -> Column:
    return F.sha2(F.concat(column.cast("string"), F.lit(salt)), 256)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    turn = value * (2 * math.pi / period)
    return F.sin(turn), F.cos(turn)


def iso_weekday(ts: Column) -> Column:
    """1 for Monday to 7."""
    return F.weekday(ts) + 1


def first_digit(amount: Column) -> Column:
    """The first of 1..9 in the amount's text (Benford), null if there is none."""
    return F.regexp_extract(F.abs(amount).cast("string"), "[1-9]", 0).try_cast("int")


def leading_digit(amount: Column) -> Column:
    """The other reading: the text's first character, null unless it is 1..9."""
    return F.substring(F.regexp_replace(F.abs(amount).cast("string"), "[^1-9].*", ""), 1, 1).try_cast("int")


def is_multiple(amount: Column, of: int) -> Column:
    return (amount % of == 0).cast("byte")


def finite(column: Column) -> Column:
    """The column, null where it is NaN or infinite."""
    return F.when(~F.isnan(column) & (F.abs(column) != float("inf")), column)


def n_unique(column: Column) -> Column:
    """Distinct values, null counted as one."""
    return F.countDistinct(column) + F.max(F.when(column.isNull(), 1).otherwise(0))
