"""Exploratory risk queries. Thresholds are parameters with the published values; ties are broken by the keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import n_unique, ratio
from ..functions.windows import TIME, micros



def _rows() -> Column:
    return F.count("*").alias("rows")


def _fraud() -> Column:
    return F.sum("Is Laundering").alias("fraud")


def _paid() -> Column:
    return F.col("`Amount Paid`")


def _received() -> Column:
    return F.col("`Amount Received`")


def _y() -> Column:
    return F.col("`Is Laundering`")


def _top(df: DataFrame, by: str, n: int | None, *keys: str) -> DataFrame:
    return df.orderBy(F.col(by).desc(), *keys).limit(n) if n else df


def monthly_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.year(TIME).alias("year"), F.month(TIME).alias("month")).agg(_rows(), _fraud())


def day_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(F.dayofmonth(TIME).alias("day")).agg(_rows(), _fraud())


def class_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("Is Laundering").agg(_rows())


def time_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min(micros()).alias("min_us"), F.max(micros()).alias("max_us"), (F.max(micros()) - F.min(micros())).alias("span_us"))


def unique_parties(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("Account").alias("senders"), F.countDistinct("Account_duplicated_0").alias("receivers"))


def hour_profile(df: DataFrame) -> DataFrame:
    return df.groupBy(F.hour(TIME).alias("hour")).agg(_rows(), _fraud()).withColumn("fraud_rate_percent", F.col("fraud") / F.col("rows") * 100)


def riskiest_hour(df: DataFrame) -> DataFrame:
    """The hour other than 0 of the highest rate, and its rate over that of hour 0."""
    p = hour_profile(df)
    zero = p.filter("hour = 0").agg(F.max("fraud_rate_percent").alias("zero_rate"))
    return p.filter("hour <> 0").orderBy(F.col("fraud_rate_percent").desc(), "hour").limit(1).join(F.broadcast(zero)).withColumn("times_hour_0", ratio(F.col("fraud_rate_percent"), F.col("zero_rate"))).drop("zero_rate")


def amount_stats(df: DataFrame, column: str = "Amount Paid") -> DataFrame:
    x = F.col(f"`{column}`")
    return df.groupBy("Is Laundering").agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.percentile(x, F.lit(0.5)).alias("median"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))


def fan_in(df: DataFrame, parties: int = 20, amount: float = 10_000, n: int | None = 20) -> DataFrame:
    g = df.groupBy("Account_duplicated_0").agg(F.countDistinct("Account").alias("senders"), F.sum(_received()).alias("received"), F.max(_y()).alias("is_laundering"))
    return _top(g.filter((F.col("senders") > parties) & (F.col("received") > amount)), "senders", n, "Account_duplicated_0")


def fan_out(df: DataFrame, parties: int = 50, amount: float = 10_000, n: int | None = 20) -> DataFrame:
    g = df.groupBy("Account").agg(F.countDistinct("Account_duplicated_0").alias("receivers"), F.sum(_paid()).alias("paid"), F.max(_y()).alias("is_laundering"))
    return _top(g.filter((F.col("receivers") > parties) & (F.col("paid") > amount)), "receivers", n, "Account")


def risk_by(df: DataFrame, column: str, more_than: int) -> DataFrame:
    return df.groupBy(column).agg(_rows(), _fraud(), F.avg(_paid()).alias("mean_paid")).filter(F.col("rows") > more_than).withColumn("fraud_rate", F.col("fraud") / F.col("rows"))


def currency_risk(df: DataFrame, more_than: int = 100) -> DataFrame:
    return risk_by(df, "Payment Currency", more_than)


def format_risk(df: DataFrame, more_than: int = 50) -> DataFrame:
    return risk_by(df, "Payment Format", more_than)


def multi_format_accounts(df: DataFrame, least: int = 5, n: int | None = 20) -> DataFrame:
    g = df.groupBy("Account").agg(F.countDistinct("Payment Format").alias("formats"), _rows())
    return _top(g.filter(F.col("formats") >= least), "rows", n, "Account")


def bank_flow(df: DataFrame, by: str = "laundered_volume", n: int | None = 20) -> DataFrame:
    """Corridors by laundered volume or by fraud_rate."""
    g = df.groupBy("From Bank", "To Bank").agg(_rows(), F.sum(_paid()).alias("volume"), _fraud(), F.coalesce(F.sum(F.when(_y() == 1, _paid())), F.lit(0.0)).alias("laundered_volume"))
    g = g.withColumns({"fraud_rate": F.col("fraud") / F.col("rows"), "volume_rate": ratio(F.col("laundered_volume"), F.col("volume"))}).filter("volume > 0")
    return _top(g, by, n, "From Bank", "To Bank")


def turbo_accounts(df: DataFrame, per_day: float = 50, n: int | None = 20) -> DataFrame:
    g = df.groupBy("Account").agg(F.countDistinct(F.to_date(TIME)).alias("days"), _rows()).withColumn("per_day", F.col("rows") / F.col("days"))
    return _top(g.filter(F.col("per_day") > per_day), "per_day", n, "Account")


def round_accounts(df: DataFrame, more_than: int = 50, share: float = 0.8) -> DataFrame:
    g = df.groupBy("Account").agg(_rows(), F.avg((F.floor(_paid()) == _paid()).cast("int")).alias("round_share"))
    return g.filter((F.col("rows") > more_than) & (F.col("round_share") > share))


def whale_entities(accounts: DataFrame, more_than: int = 50, n: int | None = 20) -> DataFrame:
    g = accounts.groupBy("Entity ID").agg(F.count("*").alias("accounts"), n_unique(F.col("`Bank ID`")).alias("banks"), F.array_join(F.array_sort(F.collect_set("Bank Name")), ",").alias("bank_names"))
    return _top(g.filter(F.col("accounts") > more_than), "accounts", n, "Entity ID")


def bank_hoppers(accounts: DataFrame, more_than: int = 3, n: int | None = 20) -> DataFrame:
    g = accounts.groupBy("Entity ID").agg(F.count("*").alias("accounts"), n_unique(F.col("`Bank ID`")).alias("banks")).withColumn("dispersion", F.col("banks") / F.col("accounts"))
    return _top(g.filter((F.col("accounts") > more_than) & (F.col("banks") > more_than)), "dispersion", n, "Entity ID")


def account_dirtiness(df: DataFrame, accounts: DataFrame) -> DataFrame:
    """accounts with dirty: 1 where the account sent a laundering payment."""
    dirty = df.groupBy(F.col("Account").alias("Account Number")).agg(F.max(_y()).alias("dirty"))
    return accounts.join(dirty, "Account Number", "left").fillna(0, ["dirty"])


def bank_toxicity(df: DataFrame, accounts: DataFrame, more_than: int = 100, n: int | None = 20) -> DataFrame:
    g = account_dirtiness(df, accounts).groupBy("Bank ID", "Bank Name").agg(F.count("*").alias("accounts"), F.sum("dirty").alias("dirty_accounts")).withColumn("toxicity", F.col("dirty_accounts") / F.col("accounts"))
    return _top(g.filter(F.col("accounts") > more_than), "toxicity", n, "Bank ID")


def entity_risk(df: DataFrame, accounts: DataFrame, n: int | None = 20, quirk: bool = False) -> DataFrame:
    """quirk: total_banks counts distinct entities, as once published; else banks."""
    banks = n_unique(F.col("`Entity ID`" if quirk else "`Bank ID`"))
    g = account_dirtiness(df, accounts).groupBy("Entity ID").agg(F.count("*").alias("accounts"), banks.alias("total_banks"), F.max("dirty").alias("is_dirty"), F.sum("dirty").alias("dirty_accounts"))
    return _top(g, "dirty_accounts", n, "Entity ID")


def linkage(df: DataFrame, accounts: DataFrame) -> DataFrame:
    """Distinct senders and receivers that are not among the accounts."""
    known = accounts.select(F.col("Account Number").alias("number"))
    lost = lambda c: df.select(F.col(c).alias("number")).distinct().join(known, "number", "left_anti")
    return lost("Account").agg(F.count("*").alias("n")).select(F.lit("senders").alias("side"), "n").unionByName(lost("Account_duplicated_0").agg(F.count("*").alias("n")).select(F.lit("receivers").alias("side"), "n"))


def score_separation(df: DataFrame, score: str) -> DataFrame:
    """Rows, fraud, mean and largest score by class, and how far the means lie apart."""
    s = F.col(score)
    of = lambda made, y: made(F.when(_y() == y, s))
    g = df.agg(_rows(), _fraud(), F.avg(_y()).alias("fraud_rate"), of(F.avg, 1).alias("mean_fraud"), of(F.avg, 0).alias("mean_legit"), of(F.max, 1).alias("max_fraud"), of(F.max, 0).alias("max_legit"), F.max(s).alias("max_score"))
    return g.withColumn("separation", F.col("mean_fraud") - F.col("mean_legit"))


def score_distribution(df: DataFrame, score: str) -> DataFrame:
    s = F.col(score)
    g = df.agg(F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"), F.percentile(s, F.array(F.lit(0.95), F.lit(0.99))).alias("p"))
    return g.select("mean", "std", "min", "max", F.col("p")[0].alias("p95"), F.col("p")[1].alias("p99"))


def validate_features(df: DataFrame, words: tuple[str, ...] = ("rolling", "burst", "entropy", "anomaly"), most: int = 5) -> DataFrame:
    """Rows, columns, nulls of up to `most` columns whose names hold one of the words, and rows by class: one pass."""
    critical = [c for c in df.columns if any(w in c.lower() for w in words)][:most]
    facts = {"rows": F.count("*"), "columns": F.max(F.lit(len(df.columns))), "class_0": F.count_if(_y() == 0), "class_1": F.count_if(_y() == 1)} | {f"nulls_{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in critical}
    return df.agg(*[v.cast("long").alias(k) for k, v in facts.items()])
