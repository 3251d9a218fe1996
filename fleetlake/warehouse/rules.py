"""Deterministic business rules: invoices, line items, legs, scores, fuel cost, rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.constants import BOOKING_MULTIPLIERS, CHARGES, DEFAULT_FUEL_PRICE, EXPENSE_SHARES
from fleetlake.functions import scalar as fn
from fleetlake.operators import joins


def _cents(c: Column) -> Column:
    return c.cast("decimal(18,4)")


def derive_invoice(trips: DataFrame, airport_fee: float, paid_share: Column, discount: Column) -> DataFrame:
    """Invoices from trips (``trip_id, customer_id, pickup, base_fare, booking_type``).

    Airport transfers pay a fee, pickups from 22:00 to 06:00 pay 10 % of the base. The
    total is base plus surcharges less discount; it is due after seven days.
    """
    base = _cents(F.col("base_fare"))
    hour = F.hour("pickup")
    airport = F.when(F.col("booking_type") == "Airport Transfer", F.lit(airport_fee)).otherwise(F.lit(0.0)).cast("decimal(18,4)")
    night = F.when((hour >= 22) | (hour < 6), F.round(base / 10, 0)).otherwise(F.lit(0)).cast("decimal(18,4)")
    df = trips.withColumns({"airport_surcharge": airport, "night_surcharge": night, "discount": _cents(discount)})
    df = df.withColumn("total", (base + F.col("airport_surcharge") + F.col("night_surcharge") - F.col("discount")).cast("decimal(18,4)"))
    paid = F.round(F.col("total") * paid_share.cast("decimal(5,4)"), 2).cast("decimal(18,4)")
    df = df.withColumn("paid", paid).withColumn("outstanding", (F.col("total") - F.col("paid")).cast("decimal(18,4)"))
    status = F.when(F.col("outstanding") == 0, "Paid").when(F.col("paid") > 0, "Partial").otherwise("Unpaid")
    issued = F.to_date("pickup")
    money = ["airport_surcharge", "night_surcharge", "discount", "total", "paid", "outstanding"]
    return df.withColumns({"payment_status": status, "invoice_date": issued, "due_date": F.date_add(issued, 7)}).withColumns(
        {c: F.col(c).cast("double") for c in money}
    )


def derive_line_items(invoices: DataFrame) -> DataFrame:
    """Base fare, surcharge and (negative) discount rows of each invoice; empty lines are left out."""

    def line(kind: str, text: str, amount: Column) -> Column:
        return F.struct(F.lit(kind).alias("charge_type"), F.lit(text).alias("description"), amount.cast("double").alias("amount"))

    lines = F.array_compact(
        F.array(
            line(*CHARGES["base"], F.col("base_fare")),
            F.when(F.col("airport_surcharge") > 0, line(*CHARGES["airport"], F.col("airport_surcharge"))),
            F.when(F.col("night_surcharge") > 0, line(*CHARGES["night"], F.col("night_surcharge"))),
            F.when(F.col("discount") > 0, line(*CHARGES["discount"], -F.col("discount"))),
        )
    )
    return invoices.select("trip_id", F.explode(lines).alias("l")).select("trip_id", "l.*")


def derive_legs(trips: DataFrame, legs: Column, min_km: float = 100.0) -> DataFrame:
    """Evenly spaced waypoints between pickup and drop-off for long trips.

    Needs ``trip_id, distance_km, lat1, lon1, lat2, lon2``; ``legs`` is the number of legs.
    """
    long = trips.where(F.col("distance_km") > min_km).withColumn("_n", legs.cast("int"))
    step = long.withColumn("leg_sequence", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    share = F.col("leg_sequence") / F.col("_n")
    return step.select(
        "trip_id", "leg_sequence", F.concat(F.lit("Waypoint-"), F.col("leg_sequence")).alias("city"),
        F.round(F.col("lat1") + (F.col("lat2") - F.col("lat1")) * share, 6).alias("lat"),
        F.round(F.col("lon1") + (F.col("lon2") - F.col("lon1")) * share, 6).alias("lon"),
        F.round((F.col("distance_km") / F.col("_n") * F.col("leg_sequence")).cast("decimal(18,6)"), 1).cast("double").alias("km_so_far"),
    )


def safety_score(brakes: Column, accels: Column, idle_minutes: Column, speeding_km: Column) -> Column:
    """100 less 1.5 per hard brake, 1 per hard acceleration, 0.05 per idle minute, 0.3 per km speeding; 0 to 100."""
    score = F.lit(100.0) - brakes * 1.5 - accels - idle_minutes * 0.05 - speeding_km * 0.3
    return fn.clip(score, 0.0, 100.0)


def fuel_price(fuel_type: Column, on: Column, timeline: Sequence[tuple[str, float, float, float]], default: float = DEFAULT_FUEL_PRICE) -> Column:
    """Price per litre in force on a date; Diesel and CNG have their own column, all else is petrol."""
    petrol, diesel, cng = ([(row[0], row[i]) for row in timeline] for i in (1, 2, 3))
    return (
        F.when(fuel_type == "Diesel", joins.price_steps(diesel, on, default))
        .when(fuel_type == "CNG", joins.price_steps(cng, on, default))
        .otherwise(joins.price_steps(petrol, on, default))
    )


def expense_spine(months: DataFrame, bases: DataFrame, key: str, shares: Mapping[str, float] = EXPENSE_SHARES) -> DataFrame:
    """Month x member x category amounts: the member's cost base times the category share.

    ``months`` has one column. Every member gets every month (see ``joins.product``).
    """
    column = months.columns[0]
    cells = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(s).cast("decimal(4,2)").alias("share")) for c, s in shares.items()])
    df = joins.product(bases, months).withColumn("_c", F.explode(cells))
    return df.select(column, key, F.col("_c.category").alias("category"), (F.col("base").cast("decimal(18,4)") * F.col("_c.share")).cast("double").alias("amount"))


def rate_matrix(fleets: DataFrame, types: DataFrame, valid_from: str, valid_to: str, multipliers: Mapping[str, float] = BOOKING_MULTIPLIERS) -> DataFrame:
    """Daily rate per fleet, vehicle type and booking type with its validity.

    Every fleet gets a rate for every type (``category, daily_rate``): the product is the result.
    """
    cells = F.array(*[F.struct(F.lit(b).alias("booking_type"), F.lit(m).cast("decimal(4,2)").alias("factor")) for b, m in multipliers.items()])
    df = joins.product(fleets, types.select("category", F.col("daily_rate").alias("_daily"))).withColumn("_m", F.explode(cells))
    rate = F.round(F.col("_daily").cast("decimal(18,4)") * F.col("_m.factor"), 0).cast("double")
    return df.select(
        *fleets.columns, "category", F.col("_m.booking_type").alias("booking_type"), rate.alias("daily_rate"),
        F.lit(valid_from).cast("date").alias("effective_from"), F.lit(valid_to).cast("date").alias("effective_to"),
    )


def trip_fare(daily: Column, days: Column, km: Column, km_rate: Column, monthly: Column) -> Column:
    """Days and kilometres at their rates; a monthly contract is 28 days at 75 %."""
    return F.when(monthly, F.round(daily * 28 * 0.75, 0)).otherwise(F.round(daily * days + km * km_rate, 0))
