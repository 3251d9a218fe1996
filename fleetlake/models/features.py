"""Feature frames of the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import scalar as fn
from fleetlake.functions.scalar import ratio, rows
from fleetlake.operators import scale


def calendar(day: Column | str) -> dict[str, Column]:
    d = F.col(day) if isinstance(day, str) else day
    return {
        "dow": F.weekday(d), "month": F.month(d), "year": F.year(d), "is_weekend": (F.weekday(d) >= 5).cast("int"), "day_of_month": F.dayofmonth(d)
    }


def safety(tel: DataFrame, drivers: DataFrame, cols: Sequence[str] = ("harsh_brakes", "harsh_accels", "idle_minutes", "speeding_km")) -> DataFrame:
    """Behaviour measures ``cols`` per trip with the driver's profile as label; rows without a profile are left out."""
    df = tel.join(drivers.where(F.col("profile").isNotNull()), "driver_id")
    return df.select("telem_id", *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in cols], "profile")


def demand(trips: DataFrame, ts: str, city: str) -> DataFrame:
    """Trips per day and city with calendar features."""
    daily = trips.groupBy(F.to_date(ts).alias("day"), F.col(city).alias("city")).agg(rows().alias("trip_count"))
    return daily.withColumns(calendar("day"))


def maintenance(maint: DataFrame, vehicles: DataFrame, this_year: int, within: int = 14) -> DataFrame:
    """Service rows with vehicle age, odometer and days since the previous service (90 for the first).

    The label tells whether the next service of the vehicle follows within ``within`` days;
    it looks ahead only, so no feature contains it.
    """
    d = "maintenance_date"
    df = scale.bounded(
        maint, ["vehicle_id"], [d, "maint_id"], {"_prev": lambda w: F.lag(d).over(w), "_next": lambda w: F.lead(d).over(w)}, before=1, after=1
    )
    df = df.join(vehicles.select("vehicle_id", "year", "odometer_km"), "vehicle_id", "left")
    return df.select(
        "maint_id", "vehicle_id", (F.lit(this_year) - F.col("year")).alias("vehicle_age"), "odometer_km",
        F.coalesce(fn.days_between("_prev", d), F.lit(90).cast("bigint")).alias("days_since_last"), "maintenance_type",
        F.coalesce((fn.days_between(d, "_next") < within).cast("int"), F.lit(0)).alias("upcoming"),
    )


def pricing(trips: DataFrame, ts: str) -> DataFrame:
    """Completed trips with calendar, place, type and distance; the label is the fare per day."""
    done = trips.where(F.col("status") == "Completed")
    fare = ratio("trip_fare", F.greatest(F.col("duration_days"), F.lit(0.1)))
    return done.select(
        "trip_id", F.month(ts).alias("month"), F.weekday(ts).alias("dow"), (F.weekday(ts) >= 5).cast("int").alias("is_weekend"), F.col("pickup_city").alias("city"), "booking_type",
        F.coalesce("distance_km", F.lit(0.0)).alias("distance_km"), fare.alias("fare_per_day"),
    )


def in_test(key: Column | str, test_share: float, seed: int = 42) -> Column:
    """Whether a key falls into the test part: by an MD5 of it, so any engine and partitioning agree."""
    digest = F.md5(F.concat(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 1000 < int(test_share * 1000)


def hash_split(df: DataFrame, key: str, test_share: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key."""
    test = in_test(key, test_share, seed)
    return df.where(~test), df.where(test)
