"""Transactions and accounts as views over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import hash_pii_column


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    number = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    value = F.col("value").cast("double")
    rows = e.select(
        F.col("event_id").alias("txn_id"), F.col("ts").cast("timestamp").alias("Timestamp"), (F.col("user_id") % 10).cast("string").alias("From Bank"), F.col("user_id").cast("string").alias("Account"),
        (number % 10).cast("string").alias("To Bank"), number.cast("string").alias("Account_duplicated_0"),
        F.when(F.col("event_id") % 4 == 0, F.floor(value / 10) * 100).otherwise(value).cast("double").alias("Amount Paid"),
        (value * (1 - (F.col("event_id") % 5) / 100.0)).cast("double").alias("Amount Received"),
        F.when(F.col("event_id") % 3 == 0, "USD").when(F.col("event_id") % 3 == 1, "EUR").otherwise("INR").alias("Payment Currency"),
        F.col("event_type").alias("Payment Format"), F.when((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0), 1).otherwise(0).alias("Is Laundering"),
    )
    return hash_pii_column(rows, "Account")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_custkey % 7 <> 3")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("Account Number"), (F.col("c_custkey") % 300).cast("string").alias("Entity ID"), F.col("c_nationkey").cast("string").alias("Bank ID"), F.col("n_name").alias("Bank Name")
    )


#: The same views for DuckDB, with short names.
TXN_SQL = """txn AS (SELECT event_id AS txn_id, CAST(ts AS TIMESTAMP) AS ts, CAST(user_id % 10 AS varchar) AS fb, CAST(user_id AS varchar) AS acc,
 CAST(CAST(regexp_extract(props,'[0-9]+',0) AS int) % 10 AS varchar) AS tb, CAST(CAST(regexp_extract(props,'[0-9]+',0) AS int) AS varchar) AS cp,
 CAST(CASE WHEN event_id % 4 = 0 THEN floor(CAST(value AS double)/10)*100 ELSE value END AS double) AS amt,
 CAST(CAST(value AS double) * (1 - (event_id % 5)/100.0) AS double) AS rcv,
 CASE event_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'INR' END AS cur, event_type AS fmt,
 CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 1 ELSE 0 END AS y FROM events)"""
ACCT_SQL = """acct AS (SELECT CAST(c_custkey AS varchar) AS num, CAST(c_custkey % 300 AS varchar) AS entity, CAST(c_nationkey AS varchar) AS bank, n_name AS bank_name
 FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 3)"""
