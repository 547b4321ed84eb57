"""The batch features that have a streaming form: dealings per account and hour, and each dealing against the account's last one."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

ROW = "Account string, txn_id long, at timestamp, amount double, prev_amount_paid double, minutes_since_last_txn double, is_rush_txn boolean"


def hourly_counts(stream: DataFrame, late: str = "2 hours") -> DataFrame:
    """Account, hour, txn_in_hour, paid; rows later than the watermark are dropped, as in any windowed stream."""
    w = stream.withWatermark("Timestamp", late).groupBy("Account", F.window("Timestamp", "1 hour"))
    return w.agg(F.count("*").alias("txn_in_hour"), F.sum("Amount Paid").alias("paid")).select("Account", F.col("window.start").alias("hour"), "txn_in_hour", "paid")


def _next(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last_at, last_amount = state.get if state.exists else (None, None)
    pdf = pd.concat(list(batches)).sort_values(["at", "txn_id"])
    out = []
    for txn, at, amount in zip(pdf["txn_id"], pdf["at"], pdf["amount"]):
        us = at.value // 1000
        gap = None if last_at is None else (us - last_at) // 1_000_000
        out.append((key[0], txn, at, amount, last_amount, 0.0 if gap is None else gap / 60, gap is not None and gap < 60))
        last_at, last_amount = us, amount
    state.update((last_at, last_amount))
    yield pd.DataFrame(out, columns=[x.split()[0] for x in ROW.split(", ")])


def sequence_features(stream: DataFrame) -> DataFrame:
    """Each dealing with the amount and the minutes since the account's dealing before; the state is one row an account."""
    rows = stream.select("Account", "txn_id", F.col("Timestamp").alias("at"), F.col("`Amount Paid`").alias("amount"))
    return rows.groupBy("Account").applyInPandasWithState(_next, ROW, "at long, amount double", "append", GroupStateTimeout.NoTimeout)
