"""Money reports over invoice, expense and trip frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import dsum, pct, rows, zero
from fleetlake.operators import joins
from fleetlake.operators.aggregates import share_of_total

AGEING = ([0, 30, 60, 90], ["Current", "1-30 Days", "31-60 Days", "61-90 Days", "90+ Days"])


def billing(df: DataFrame, *keys) -> DataFrame:
    """Invoice count, billed, collected and outstanding per key."""
    return df.groupBy(*keys).agg(
        rows().alias("invoice_count"),
        dsum("total_amount").alias("total_billed"),
        dsum("paid_amount").alias("total_collected"),
        dsum("outstanding").alias("outstanding"),
    )


def monthly_billing(invoices: DataFrame) -> DataFrame:
    return billing(invoices, fn.month_start("invoice_date").alias("month"))


def ageing_bucket(due: str, as_of: str):
    """Days-overdue bucket of a due date."""
    return fn.case_bucket(fn.days_between(due, F.lit(as_of).cast("date")), *AGEING)


def fleet_pnl(fleets: DataFrame, revenue: DataFrame, fuel: DataFrame, maint: DataFrame, opex: DataFrame, salaries: list[str]) -> DataFrame:
    """Profit and loss per fleet; every cost is one row per fleet before the joins.

    ``opex`` holds ``fleet_id, category, amount``; the listed categories count as salaries.
    """
    is_salary = F.col("category").isin(*salaries)
    costs = opex.groupBy("fleet_id").agg(
        fn.sum_if(is_salary, "amount").alias("salary_cost"), fn.sum_if(~is_salary, "amount").alias("other_opex")
    )
    df = joins.preaggregated(fleets, "fleet_id", [revenue, fuel, maint, costs])
    cols = ["revenue", "fuel_cost", "maint_cost", "salary_cost", "other_opex"]
    df = df.withColumns({c: zero(c) for c in cols})
    net = F.col("revenue") - F.col("fuel_cost") - F.col("maint_cost") - F.col("salary_cost") - F.col("other_opex")
    return df.withColumn("net_profit", net).withColumn("profit_margin_pct", pct("net_profit", "revenue"))


def with_month_growth(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Previous month's value next to each month (one row per month and key)."""
    w = Window.partitionBy(*(keys or [])).orderBy("month")
    return df.withColumn("prev", F.lag(value).over(w))


def method_share(invoices: DataFrame) -> DataFrame:
    """Totals, collection rate and share per payment method."""
    per = billing(invoices, "payment_method")
    per = per.withColumn("collection_rate_pct", pct("total_collected", "total_billed"))
    return share_of_total(per, "total_billed", "share_of_total_pct")
