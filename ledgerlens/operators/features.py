"""Behavioural features of an account's dealings.

Every function takes transactions (with Account_HASHED and txn_id) and adds columns. Windows are counted in rows unless said otherwise, want to be full, and
end at the row before where a feature must not see its own row. Columns of one window level are made in one projection, so that Spark sorts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import cyclical, first_digit, is_multiple, iso_weekday, leading_digit, n_unique, ratio
from ..functions.windows import ACCOUNT, DAY_US, REFERENCE, TIME, WindowProfile, before, changed, full, lag1, micros, ordered, upto, whole, within
from ..sources.schemas import require_columns

EPS = 1e-6


def _paid() -> Column:
    return F.col("`Amount Paid`")


def _received() -> Column:
    return F.col("`Amount Received`")


def _other() -> Column:
    return F.col("Account_duplicated_0")


def add_base_features(df: DataFrame) -> DataFrame:
    ts = F.col(TIME)
    hour, day = cyclical(F.hour(ts), 24), cyclical(iso_weekday(ts), 7)
    df = df.withColumns({
        "hour_sin": hour[0], "hour_cos": hour[1], "day_of_week_sin": day[0], "day_of_week_cos": day[1],
        "first_digit": first_digit(_paid()), "is_round_100": is_multiple(_paid(), 100), "is_round_1000": is_multiple(_paid(), 1000),
        "account_first_txn": F.min(TIME).over(whole()), "txn_rank_in_account_history": F.row_number().over(ordered()),
        "days_since_last_txn": F.coalesce(F.floor((micros() - F.lag(micros()).over(ordered())) / DAY_US), F.lit(0)),
    })
    age = micros() - micros("account_first_txn")
    return df.withColumns({"account_tenure_days": F.floor(age / DAY_US), "has_7d_history": (age >= 7 * DAY_US).cast("byte"), "has_28d_history": (age >= 28 * DAY_US).cast("byte")})


def add_calendar_variants(df: DataFrame) -> DataFrame:
    """The exploratory variants: day of month as a cycle, the other first digit, days since the last dealing as a fraction."""
    month = cyclical(F.dayofmonth(TIME), 31)
    gap = F.coalesce((micros() - F.lag(micros()).over(ordered())) / DAY_US, F.lit(0.0))
    return df.withColumns({"day_of_month_sin": month[0], "day_of_month_cos": month[1], "leading_digit": leading_digit(_paid()), "days_since_last_txn_exact": gap})


def precompute_entity_stats(accounts: DataFrame) -> DataFrame:
    """Account Number, Entity ID, entity_account_count, entity_bank_count."""
    stats = accounts.groupBy("Entity ID").agg(F.count("*").alias("entity_account_count"), n_unique(F.col("`Bank ID`")).alias("entity_bank_count"))
    return accounts.join(stats, "Entity ID", "left").select("Account Number", "Entity ID", "entity_account_count", "entity_bank_count")


def add_entity_features(df: DataFrame, accounts: DataFrame, compat: bool = False) -> DataFrame:
    """Left join on the account. An account that is listed twice counts once, with its least entity, unless compat."""
    stats = precompute_entity_stats(accounts)
    if not compat:
        stats = stats.groupBy("Account Number").agg(F.min(F.struct("Entity ID", "entity_account_count", "entity_bank_count")).alias("s")).select("Account Number", "s.*")
    return df.join(stats.withColumnRenamed("Account Number", "number"), F.col("Account") == F.col("number"), "left").drop("number")


def compute_rolling_features(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    n, frame = profile.n500, before(profile.n500)
    stat = lambda made: F.coalesce(full(n, made, _paid(), frame), F.lit(0.0))
    # the nearest rank to the middle of n sorted values
    values = F.array_sort(F.collect_list(_paid()).over(frame))
    df = df.withColumns({
        "txn_count_total": F.count(TIME).over(whole()),
        **{f"txn_count_{name}": F.count("*").over(before(k)) for name, k in (("24h", profile.n24), ("7d", profile.n168), ("28d", n))},
        "total_amount_paid_28d": stat(F.sum(_paid())), "total_amount_received_28d": F.coalesce(full(n, F.sum(_received()), _received(), frame), F.lit(0.0)),
        "mean_amount_paid_28d": stat(F.avg(_paid())), "std_amount_paid_28d": stat(F.stddev_samp(_paid())), "max_amount_paid_28d": stat(F.max(_paid())),
        "median_amount_paid_28d": F.coalesce(F.when(F.count(_paid()).over(frame) >= n, F.try_element_at(values, F.lit(int((n - 1) * 0.5 + 0.5) + 1))), F.lit(0.0)),
        "baseline": F.coalesce(full(n, F.avg(_paid()), _paid(), frame), F.lit(1.0)),
    })
    return df.withColumn("amount_vs_baseline_ratio", _paid() / (F.col("baseline") + EPS)).drop("baseline")


def compute_time_window_features(df: DataFrame) -> DataFrame:
    """Counts, volumes and statistics over true time windows (t - d, t]."""
    hour = Window.partitionBy(ACCOUNT).orderBy(micros()).rangeBetween(-DAY_US // 24 + 1, 0)
    w28 = within(28)
    return df.withColumns({
        "txn_count_1h": F.count("*").over(hour), "txn_count_24h": F.count("*").over(within(1)), "txn_count_7d": F.count("*").over(within(7)), "txn_count_28d": F.count("*").over(w28),
        "total_amount_paid_28d": F.sum(_paid()).over(w28), "total_amount_received_28d": F.sum(_received()).over(w28), "mean_amount_paid_28d": F.avg(_paid()).over(w28),
        "std_amount_paid_28d": F.stddev_samp(_paid()).over(w28), "median_amount_paid_28d": F.percentile(_paid(), F.lit(0.5)).over(w28), "max_amount_paid_28d": F.max(_paid()).over(w28),
    })


def compute_advanced_features(df: DataFrame) -> DataFrame:
    """Flow ratio, bank switches within days, and the sequence features. Needs the rolling features."""
    require_columns(df, ["total_amount_paid_28d", "total_amount_received_28d"], "rolling features")
    df = df.withColumns({
        "inflow_outflow_ratio_28d": ratio(F.col("total_amount_received_28d"), F.col("total_amount_paid_28d") + EPS), "bank_switch": changed("To Bank").cast("int"),
        "prev_amount_paid": lag1(_paid()), "is_rush_txn": F.coalesce(micros() - F.lag(micros()).over(ordered()) < 60_000_000, F.lit(False)).cast("byte"), "prev_was_sender": lag1((_paid() > 0).cast("byte")),
    })
    df = df.withColumns({f"switches_{d}": F.sum("bank_switch").over(within(d)) for d in (7, 28)})
    return df.withColumns({f"counterparty_diversity_{d}d": F.coalesce(lag1(f"switches_{d}"), F.lit(0)) for d in (7, 28)}).drop("switches_7", "switches_28").withColumnRenamed("bank_switch", "is_bank_switch")


def compute_derived_features(df: DataFrame) -> DataFrame:
    mean, c = F.col("mean_amount_paid_28d"), F.col
    return df.withColumns({
        "txn_velocity_ratio": c("txn_count_24h") / (c("txn_count_7d") + 1), "amount_deviation_from_avg": ratio(_paid() - mean, mean + 1), "amount_vs_max_ratio": ratio(_paid(), c("max_amount_paid_28d") + 1),
        "avg_txn_size_28d": c("total_amount_paid_28d") / (c("txn_count_28d") + 1), "amount_cv_28d": ratio(c("std_amount_paid_28d"), mean + EPS),
    })


def compute_burst_score(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    n = F.col("txn_in_hour")
    df = df.withColumn("hour_window", F.date_trunc("hour", TIME)).withColumn("txn_in_hour", F.count("*").over(Window.partitionBy(ACCOUNT, "hour_window")))
    df = df.withColumn("hour_base", F.coalesce(full(profile.n500, F.avg(n), n, upto(profile.n500)), F.lit(1.0)))
    df = df.withColumns({"burst_score_1h": n / (F.col("hour_base") + 1) - 1, "burst": (n > 2 * F.col("hour_base")).cast("int")})
    return df.withColumn("burst_count_24h", F.coalesce(full(profile.n24, F.sum("burst"), F.col("burst"), upto(profile.n24)), F.lit(0))).drop("hour_window", "hour_base", "burst")


def compute_timegap_statistics(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    gap, frame, n = F.col("minutes_since_last_txn"), upto(profile.n500), profile.n500
    df = df.withColumn("minutes_since_last_txn", F.coalesce(F.floor((micros() - F.lag(micros()).over(ordered())) / 1_000_000) / 60, F.lit(0.0)))
    df = df.withColumns({f"{name}_timegap_minutes_28d": full(n, made(gap), gap, frame) for name, made in (("avg", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev_samp))})
    avg = F.col("avg_timegap_minutes_28d")
    return df.withColumns({"timegap_consistency_28d": F.coalesce(F.col("std_timegap_minutes_28d") / (avg + 1), F.lit(0.0)), "timegap_acceleration": (gap - avg) / (avg + 1)})


def compute_velocity_metrics(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    v = F.col("amount_paid_last_100")
    df = df.withColumn("amount_paid_last_100", full(profile.n100, F.sum(_paid()), _paid(), upto(profile.n100)))
    last = lag1(v)
    df = df.withColumns({"txn_velocity_delta": F.coalesce(v - last, F.lit(0.0)), "amount_velocity_pct_change": F.coalesce(ratio(v - last, last + EPS), F.lit(0.0)), "first_difference": v - last})
    return df.withColumn("amount_acceleration_2nd_order", F.coalesce(F.col("first_difference") - lag1("first_difference"), F.lit(0.0))).drop("first_difference")


def compute_concentration_metrics(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    r, prior, n = F.col("is_repeat"), before(profile.n500), profile.n500
    df = df.withColumn("is_repeat", F.coalesce((_other() == lag1(_other())).cast("int"), F.lit(0)))
    cv = full(n, F.stddev_samp(_paid()), _paid(), prior) / (full(n, F.avg(_paid()), _paid(), prior) + EPS)
    return df.withColumns({
        "concentration_ratio_7d": full(profile.n120, F.sum(r), r, upto(profile.n120)) / profile.n120, "concentration_ratio_28d": full(n, F.sum(r), r, upto(n)) / n, "amount_concentration_cv_28d": F.coalesce(cv, F.lit(0.0)),
    }).drop("is_repeat")


def compute_round_number_patterns(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    df = df.withColumns({f"is_multiple_{k}": is_multiple(_paid(), k) for k in (100, 500, 1000)})
    hundred, thousand, w50, w5 = F.col("is_multiple_100"), F.col("is_multiple_1000"), upto(profile.n50), upto(profile.n5)
    return df.withColumns({
        "round_100_ratio_50txns": full(profile.n50, F.avg(hundred), hundred, w50), "round_1000_ratio_50txns": full(profile.n50, F.avg(thousand), thousand, w50),
        "consecutive_round_density_5txn": full(profile.n5, F.sum(hundred), hundred, w5) / profile.n5,
    })


FLAGS = ("flag_high_burst", "flag_large_gap", "flag_extreme_consistency", "flag_high_concentration", "flag_heavy_structuring")


def compute_anomaly_cascade_features(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    """Five flags and their sum, null where a flag is null. Needs bursts, gaps, concentration and round numbers."""
    tests = (F.col("burst_score_1h") > 2, F.col("minutes_since_last_txn") > 1440, F.col("timegap_consistency_28d") < 0.2, F.col("amount_concentration_cv_28d") > 1.5, F.col("round_1000_ratio_50txns") > 0.7)
    df = df.withColumns({name: test.cast("byte") for name, test in zip(FLAGS, tests)})
    df = df.withColumn("anomaly_cascade_score", sum(F.col(f).cast("int") for f in FLAGS))
    many = (F.col("anomaly_cascade_score") >= 2).cast("int")
    return df.withColumn("cascade_frequency_28d", full(profile.n500, F.avg(many), many, upto(profile.n500)))


def add_advanced_rolling_features(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    for step in (compute_burst_score, compute_timegap_statistics, compute_velocity_metrics, compute_concentration_metrics, compute_round_number_patterns, compute_anomaly_cascade_features):
        df = step(df, profile)
    return df


def compute_counterparty_entropy(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """-sum p ln p over the account's receivers, of all its rows. source: the plain rows that df was made from, so that its windows are not planned twice."""
    pairs = (source or df).groupBy(ACCOUNT, "Account_duplicated_0").agg(F.count("*").alias("n"))
    totals = pairs.groupBy(ACCOUNT).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    # -sum n/t ln(n/t) = ln t - sum(n ln n) / t: one pass over the pairs
    entropy = totals.select(ACCOUNT, (F.log("total") - F.col("nlogn") / F.col("total")).alias("counterparty_entropy_28d"))
    return df.join(entropy, ACCOUNT, "left").fillna(0.0, ["counterparty_entropy_28d"])


def _receivers(df: DataFrame) -> DataFrame:
    """Distinct receivers per account, null counted as one: an aggregate and a join, as windows cannot count distinct values."""
    return df.groupBy(ACCOUNT).agg(n_unique(_other()).alias("receivers"))


def compute_counterparty_switching_metrics(df: DataFrame, profile: WindowProfile = REFERENCE, source: DataFrame | None = None) -> DataFrame:
    s = F.col("is_counterparty_switch")
    df = df.join(_receivers(source or df), ACCOUNT, "left").withColumnRenamed("receivers", "num_unique_receivers_28d")
    df = df.withColumn("is_counterparty_switch", changed("Account_duplicated_0").cast("byte"))
    df = df.withColumns({"counterparty_switch_rate_50txns": full(profile.n50, F.avg(s), s, upto(profile.n50)), "total_counterparty_switches_28d": full(profile.n500, F.sum(s), s, upto(profile.n500))})
    return df.withColumn("counterparty_recycling_ratio_28d", F.col("num_unique_receivers_28d") / (F.col("total_counterparty_switches_28d") + 1))


def compute_network_balance_ratios(df: DataFrame) -> DataFrame:
    needed = ["total_amount_paid_28d", "total_amount_received_28d", "txn_count_28d"]
    require_columns(df, needed, "rolling features")
    paid, received, n, b = F.col(needed[0]), F.col(needed[1]), F.col(needed[2]), F.col("inflow_outflow_balance_28d")
    df = df.withColumns({
        "inflow_outflow_balance_28d": received / (paid + EPS), "net_flow_28d": received - paid, "average_flow_magnitude_28d": (received + paid) / 2, "inflow_outflow_txn_ratio_28d": n / (n + EPS),
    })
    return df.withColumns({"passthrough_likelihood_28d": 1 - F.abs(b - 1) / (b + 1), "balance_volatility_daily": F.abs(F.coalesce(b - lag1(b), F.lit(0.0)))})


def compute_temporal_counterparty_patterns(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    late = F.col("is_end_of_day_txn")
    df = df.withColumn("hour_of_day", F.hour(TIME).cast("byte")).withColumn("is_end_of_day_txn", (F.col("hour_of_day") >= 17).cast("byte"))
    return df.withColumn("end_of_day_txn_count_7d", full(profile.n200, F.sum(late), late, upto(profile.n200)))


def compute_relationship_asymmetry(df: DataFrame, profile: WindowProfile = REFERENCE, compat: bool = False) -> DataFrame:
    """Pair keys, dealings per pair. The undirected key hashes both ends, so that both directions meet, unless compat (hash against plain id)."""
    other = _other() if compat else F.xxhash64(_other()).cast("string")
    other = F.when(_other().isNotNull(), other)
    a, pair = F.col(ACCOUNT), "account_pair_directed"
    df = df.withColumns({pair: F.concat(a, F.lit("|"), _other()), "account_pair_undirected": F.concat(F.least(a, other), F.lit("|"), F.when(other.isNotNull(), F.greatest(a, other)))})
    df = df.withColumn("txns_in_directed_pair", F.count("*").over(whole(ACCOUNT, "Account_duplicated_0")))
    often = (F.col("txns_in_directed_pair") > 5).cast("int")
    return df.withColumns({
        "asymmetric_pair_evidence_28d": full(profile.n500, F.sum(often), often, upto(profile.n500, ACCOUNT, "Account_duplicated_0")),
        "amount_asymmetry_with_counterparty": F.coalesce(ratio(_paid(), lag1(_paid(), ACCOUNT, "Account_duplicated_0") + EPS), F.lit(1.0)),
    })


def compute_network_centrality_proxy(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    source = source or df
    senders = source.groupBy("Account_duplicated_0").agg(n_unique(F.col(ACCOUNT)).alias("in_degree_approximation")).withColumnRenamed("Account_duplicated_0", "receiver")
    df = df.join(_receivers(source).withColumnRenamed("receivers", "out_degree_approximation"), ACCOUNT, "left").join(senders, _other().eqNullSafe(F.col("receiver")), "left").drop("receiver")
    return df.withColumn("betweenness_centrality_proxy", F.sqrt(F.col("out_degree_approximation") * F.col("in_degree_approximation")))


def add_counterparty_entropy_features(df: DataFrame, profile: WindowProfile = REFERENCE, source: DataFrame | None = None) -> DataFrame:
    df = compute_counterparty_switching_metrics(compute_counterparty_entropy(df, source), profile, source)
    df = compute_temporal_counterparty_patterns(compute_network_balance_ratios(df), profile)
    return compute_network_centrality_proxy(compute_relationship_asymmetry(df, profile), source)


def compute_account_network_features(df: DataFrame, profile: WindowProfile = REFERENCE, fix_repeat_rate: bool = False) -> DataFrame:
    """How often the next dealing goes to the same bank. The 28d rate has the 7d window's length below, as published, unless fix_repeat_rate."""
    s, short, long = F.col("is_same_bank"), profile.n120, profile.n500
    df = df.withColumn("is_same_bank", F.coalesce((F.col("`To Bank`") == lag1("`To Bank`")).cast("int"), F.lit(0)))
    rate = lambda n, below: F.coalesce(full(n, F.sum(s), s, before(n)) / below, F.lit(0.0))
    df = df.withColumns({"bank_repeat_rate_7d": rate(short, short), "bank_repeat_rate_28d": rate(long, long if fix_repeat_rate else short)})
    return df.withColumns({f"bank_diversity_proxy_{d}": 1 - F.col(f"bank_repeat_rate_{d}") for d in ("7d", "28d")}).drop("is_same_bank")


def compute_corridor_risk_score(df: DataFrame, profile: WindowProfile = REFERENCE) -> DataFrame:
    """Amounts of the corridor's dealings before this one."""
    df = df.withColumn("corridor", F.concat(F.col("`From Bank`"), F.lit("_to_"), F.col("`To Bank`")))
    frame, n = before(profile.n500, "corridor"), profile.n500
    return df.withColumns({"corridor_mean_amount_28d": F.coalesce(full(n, F.avg(_paid()), _paid(), frame), F.lit(0.0)), "corridor_std_amount_28d": F.coalesce(full(n, F.stddev_samp(_paid()), _paid(), frame), F.lit(0.0))})
