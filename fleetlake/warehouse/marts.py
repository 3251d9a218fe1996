"""Facts and marts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import count_if, davg, dsum, pct, ratio, rows, zero, zero_int
from fleetlake.plans import customers
from fleetlake.warehouse import dims


def fact_trips(trips: DataFrame, vehicle_dim: DataFrame, driver_dim: DataFrame) -> DataFrame:
    """Trip facts with surrogate keys (-1 for unknown members), unit revenues and flags."""
    df = dims.lookup(trips, vehicle_dim, "vehicle_id", "vehicle_key")
    df = dims.lookup(df, driver_dim, "driver_id", "driver_key")
    return df.select(
        "trip_id", dims.date_key("pickup_datetime").alias("date_key"), "vehicle_key", "driver_key", "customer_id",
        F.to_date("pickup_datetime").alias("trip_date"), "duration_days", "distance_km", "trip_fare",
        ratio("trip_fare", "duration_days").alias("revenue_per_day"), ratio("trip_fare", "distance_km").alias("revenue_per_km"),
        (F.col("status") == "Completed").alias("is_completed"), (F.col("status") == "Cancelled").alias("is_cancelled"), "with_driver",
        (F.col("pickup_datetime") < F.col("booking_datetime")).alias("_dq_timeline"),
    )


def fact_invoices(invoices: DataFrame) -> DataFrame:
    """Invoice facts with date keys and payment flags."""
    return invoices.select(
        "invoice_id", "customer_id", dims.date_key("invoice_date").alias("date_key"), dims.date_key("due_date").alias("due_date_key"), "invoice_date",
        "total_amount", "paid_amount", "outstanding", (F.col("outstanding") == 0).alias("is_paid"), pct("paid_amount", "total_amount").alias("paid_pct"),
    )


def fact_telematics(tel: DataFrame) -> DataFrame:
    """Telematics facts with date key and event totals."""
    return tel.select(
        "telem_id", "driver_id", dims.date_key("trip_date").alias("date_key"), "safety_score", (F.col("harsh_brakes") + F.col("harsh_accels")).alias("harsh_events"),
        "idle_minutes", "speeding_km", F.col("accident").cast("int").alias("accident"), F.col("complaint").cast("int").alias("complaint"), "rating",
    )


def fact_payments(invoices: DataFrame) -> DataFrame:
    """One row per invoice on which something was paid."""
    paid = invoices.where(F.col("paid_amount") > 0)
    return paid.select(
        "invoice_id", "customer_id", dims.date_key("invoice_date").alias("date_key"), "payment_method", "paid_amount", (F.col("outstanding") == 0).alias("settles_invoice")
    )


def fact_fuel(fuel: DataFrame, vehicle_dim: DataFrame) -> DataFrame:
    """Fuel facts with vehicle key and unit cost."""
    df = dims.lookup(fuel, vehicle_dim, "vehicle_id", "vehicle_key")
    return df.select(
        "fuel_id", "vehicle_key", dims.date_key("fill_date").alias("date_key"), "fuel_type", "litres", "km_driven", "fuel_cost", ratio("fuel_cost", "litres").alias("cost_per_litre")
    )


def fact_maintenance(maint: DataFrame, vehicle_dim: DataFrame) -> DataFrame:
    """Service facts with vehicle key and due date key."""
    df = dims.lookup(maint, vehicle_dim, "vehicle_id", "vehicle_key")
    return df.select(
        "maint_id", "vehicle_key", dims.date_key("maintenance_date").alias("date_key"), dims.date_key("next_due_date").alias("due_date_key"), "maintenance_type", "total_cost",
        (F.col("status") == "Scheduled").alias("is_scheduled"),
    )


def daily_revenue(facts: DataFrame) -> DataFrame:
    """Trips, cancellations and revenue per day."""
    return facts.groupBy("date_key").agg(
        rows().alias("trips"), count_if(F.col("is_cancelled")).alias("cancelled"), fn.sum_if(F.col("is_completed"), "trip_fare").alias("revenue")
    )


def monthly_fleet_pnl(revenue: DataFrame, fuel: DataFrame, maint: DataFrame, opex: DataFrame) -> DataFrame:
    """Margin per fleet and month; every input is already one row per (fleet_id, month)."""
    keys = ["fleet_id", "month"]
    df = revenue.join(fuel, keys, "full").join(maint, keys, "full").join(opex, keys, "full")
    cols = ["revenue", "fuel_cost", "maint_cost", "opex"]
    df = df.select(*keys, *[zero(c).alias(c) for c in cols])
    return df.withColumn("net", F.col("revenue") - F.col("fuel_cost") - F.col("maint_cost") - F.col("opex"))


def customer_ltv(invoices: DataFrame) -> DataFrame:
    return customers.lifetime_value(invoices)


def vehicle_utilization(facts: DataFrame, days_basis: int = 30) -> DataFrame:
    """Days used, trips and utilisation per vehicle and month."""
    g = facts.where(F.col("is_completed")).groupBy("vehicle_key", F.trunc("trip_date", "month").alias("month")).agg(
        rows().alias("trips"), dsum("duration_days").alias("days_used"), dsum("trip_fare").alias("revenue")
    )
    return g.withColumn("utilisation_pct", fn.clip(F.col("days_used") / days_basis * 100, 0.0, 100.0))


def driver_scorecard(facts: DataFrame) -> DataFrame:
    """Trips, score, rating, accidents and complaints per driver from telematics facts."""
    return facts.groupBy("driver_id").agg(
        rows().alias("trips"), davg("safety_score").alias("avg_score"), F.avg("rating").alias("avg_rating"), F.sum("accident").alias("accidents"), F.sum("complaint").alias("complaints")
    )
