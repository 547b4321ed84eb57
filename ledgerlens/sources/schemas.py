"""Schemas of the inputs, and checks of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: CSV columns in order; the header has `Account` twice, so names come from here.
TRANSACTIONS_CSV = T.StructType([
    T.StructField("Timestamp", T.TimestampType()), T.StructField("From Bank", T.StringType()), T.StructField("Account", T.StringType()), T.StructField("To Bank", T.StringType()), T.StructField("Account_duplicated_0", T.StringType()),
    T.StructField("Amount Received", T.DoubleType()), T.StructField("Receiving Currency", T.StringType()), T.StructField("Amount Paid", T.DoubleType()), T.StructField("Payment Currency", T.StringType()), T.StructField("Payment Format", T.StringType()), T.StructField("Is Laundering", T.IntegerType()),
])
ACCOUNTS_CSV = T.StructType([T.StructField(c, T.StringType()) for c in ("Bank Name", "Bank ID", "Account Number", "Entity ID", "Entity Name")])


def require_columns(df: DataFrame, names: list[str], what: str = "table") -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")


def numeric_columns(df: DataFrame, excluded: list[str] | None = None, contains: list[str] | None = None) -> list[str]:
    """Numeric and boolean columns, without the excluded names and without those that contain a given text in any case."""
    words = [w.lower() for w in contains or []]
    return [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in (excluded or []) and not any(w in f.name.lower() for w in words)]
