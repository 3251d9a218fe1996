"""Customer analytics: lifetime value, churn, RFM, cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.constants import RFM_OTHER, RFM_SEGMENTS
from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import dsum, rows
from fleetlake.operators import scale
from fleetlake.session import materialise

CHURN = ([30, 90, 180], ["Active", "At Risk", "Lapsing", "Churned"])


def rfm_raw(df: DataFrame, customer: str, date: str, ident: str, amount: str, as_of: str) -> DataFrame:
    """Days since the last purchase, number of purchases and money per customer."""
    return df.groupBy(F.col(customer)).agg(
        fn.days_between(F.max(date), F.lit(as_of).cast("date")).alias("recency_days"),
        F.count_distinct(ident).alias("frequency"),
        dsum(amount).alias("monetary"),
    )


def rfm_scores(raw: DataFrame, customer: str, legacy_scores: bool = False) -> DataFrame:
    """Quintile scores 1-5 (5 is best) and the segment.

    ``legacy_scores`` numbers the quintiles from the best customer down, so 1 is best.
    """
    if legacy_scores:
        orders = {"r_score": ["recency_days", customer], "f_score": ["-frequency", customer], "m_score": ["-monetary", customer]}
    else:
        orders = {"r_score": ["-recency_days", customer], "f_score": ["frequency", customer], "m_score": ["monetary", customer]}
    df = materialise(raw, "rfm")  # measured and read once per score
    for name, order in orders.items():
        df = scale.ntile(df, [], order, {name: 5})
    r, f = F.col("r_score"), F.col("f_score")
    segment = F.when(F.lit(False), F.lit(RFM_OTHER))
    for label, r_least, f_least, r_below, f_below in RFM_SEGMENTS:
        rule = F.lit(True)
        for column, least, under in ((r, r_least, r_below), (f, f_least, f_below)):
            rule = rule & (column >= least) if least is not None else rule
            rule = rule & (column < under) if under is not None else rule
        segment = segment.when(rule, label)
    segment = segment.otherwise(RFM_OTHER)
    return df.withColumns({"rfm_total": r + f + F.col("m_score"), "rfm_segment": segment})


def churn_segment(days_inactive: Column | str) -> Column:
    return fn.case_bucket(days_inactive, *CHURN)


def cohorts(df: DataFrame, customer: str, ts: str, active: Column | None = None) -> DataFrame:
    """Active customers per first month and months since then.

    One row per customer and active month first, so a busy customer weighs nothing in
    the join; ``active`` restricts what counts as activity, not what counts as first.
    """
    month = fn.month_start(ts)
    first = df.groupBy(customer).agg(fn.month_start(F.min(ts)).alias("cohort_month"))
    used = df if active is None else df.where(active)
    months = used.select(customer, month.alias("activity_month")).distinct()
    joined = months.join(first, customer)
    since = fn.months_between("cohort_month", "activity_month")
    return joined.groupBy("cohort_month", since.alias("months_since_first")).agg(rows().alias("active_customers"))


def lifetime_value(invoices: DataFrame) -> DataFrame:
    """Spend, order value and span per customer with rank and quintile (best first)."""
    ltv = invoices.groupBy("customer_id").agg(
        F.count_distinct("invoice_id").alias("total_invoices"),
        dsum("total_amount").alias("total_spend"),
        fn.davg("total_amount").alias("avg_order_value"),
        dsum("paid_amount").alias("total_paid"),
        F.min("invoice_date").alias("first_purchase"),
        F.max("invoice_date").alias("last_purchase"),
    )
    ltv = ltv.withColumn("customer_age_days", fn.days_between("first_purchase", "last_purchase"))
    ltv = materialise(ltv, "ltv")
    ranked = scale.ranks(ltv, [], "-total_spend", rank="ltv_rank")
    tiled = scale.ntile(ranked, [], ["-total_spend", "customer_id"], {"ltv_quintile": 5})
    return tiled.withColumn("annualised_spend", fn.ratio("total_spend", "customer_age_days") * F.lit(365.0))
