"""Dimensions, the destination-market bridge and segment definitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmart.contract import DEFAULT, Contract
from trailmart.functions.measures import safe_rate


def calendar(day: Column) -> list[Column]:
    """Calendar attributes of a day."""
    return [
        F.year(day).cast("smallint").alias("calendar_year"),
        F.quarter(day).cast("tinyint").alias("calendar_quarter"),
        F.month(day).cast("tinyint").alias("calendar_month"),
        F.weekofyear(day).cast("tinyint").alias("iso_week"),
        (F.weekday(day) + 1).cast("tinyint").alias("iso_day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        *(F.trunc(day, part).alias(name) for part, name in (("week", "week_start"), ("MM", "month_start"), ("quarter", "quarter_start"), ("year", "year_start"))),
    ]


def dim_date(fact: DataFrame) -> DataFrame:
    """Every day from the first to the last event, plausible check-in or plausible check-out, with its roles."""
    plausible_in, plausible_out = F.col("has_valid_lead_time"), F.col("is_plausible_trip_dates")
    roles = fact.select(
        F.explode(
            F.array(
                F.struct(F.col("event_date").alias("d"), F.lit(1).alias("role")),
                F.struct(F.when(plausible_in, F.col("checkin_date")).alias("d"), F.lit(2).alias("role")),
                F.struct(F.when(plausible_out, F.col("checkout_date")).alias("d"), F.lit(4).alias("role")),
            )
        ).alias("x")
    ).select("x.*")
    seen = roles.where("d is not null").groupBy("d").agg(*(F.bool_or(F.col("role") == r).alias(n) for r, n in ((1, "is_event_date"), (2, "is_checkin_date"), (4, "is_checkout_date"))))
    spine = seen.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("date_day"))
    joined = spine.join(seen, F.col("date_day") == F.col("d"), "left")
    no = F.lit(False)
    return joined.select("date_day", *calendar(F.col("date_day")), *(F.coalesce(n, no).alias(n) for n in ("is_event_date", "is_checkin_date", "is_checkout_date")))


def dim_origin(fact: DataFrame) -> DataFrame:
    return fact.groupBy("origin_id").agg(
        *(F.min(c).alias(c) for c in ("user_location_country", "user_location_region", "user_location_city")),
        F.count("*").alias("interaction_rows"),
        F.min("event_date").alias("first_observed_date"),
        F.max("event_date").alias("last_observed_date"),
    )


def dim_destination(destinations: DataFrame, fact: DataFrame) -> DataFrame:
    """Accepted destinations with what was observed of them and their latent features."""
    observed = (
        fact.where(F.col("srch_destination_id").isNotNull())
        .groupBy("srch_destination_id")
        .agg(
            F.min("srch_destination_type_id").alias("srch_destination_type_id"),
            F.count("*").alias("interaction_rows"),
            F.min("event_date").alias("first_observed_date"),
            F.max("event_date").alias("last_observed_date"),
        )
    )
    return destinations.join(observed, "srch_destination_id", "left")


def bridge_destination_market(fact: DataFrame) -> DataFrame:
    whole = Window.partitionBy("srch_destination_id")
    pairs = (
        fact.where(F.col("srch_destination_id").isNotNull() & F.col("hotel_market").isNotNull())
        .groupBy("srch_destination_id", "hotel_market")
        .agg(
            F.count("*").alias("interaction_rows"),
            F.count_if(F.col("is_booking") == 1).alias("booking_rows"),
            F.min("event_date").alias("first_observed_date"),
            F.max("event_date").alias("last_observed_date"),
        )
    )
    return pairs.withColumn("interaction_share_within_destination", safe_rate(F.col("interaction_rows"), F.sum("interaction_rows").over(whole)))


def segment_rows(contract: Contract = DEFAULT) -> list[tuple[str, str, int]]:
    """Family, label and order of each segment; unusable ones come last."""
    lead, stay = contract.maximum_lead_time_days, contract.maximum_stay_nights
    families = {
        "device": (["desktop", "mobile"], ["unknown"]),
        "package": (["standalone", "package"], ["unknown"]),
        "traveller": (["solo", "couple", "family", "group"], ["unknown"]),
        "lead_time": (["same_day", "01_07_days", "08_30_days", "31_90_days", "91_180_days", f"181_{lead}_days"], [f"out_of_scope_gt_{lead}", "invalid_negative", "missing"]),
        "stay": (["01_night", "02_03_nights", "04_07_nights", "08_14_nights", f"15_{stay}_nights"], [f"out_of_scope_gt_{stay}", "invalid_nonpositive", "missing"]),
    }
    return [
        (family, label, order)
        for family, (usable, rest) in families.items()
        for order, label in [*enumerate(usable, 1), *((100 - len(rest) + i, label) for i, label in enumerate(rest))]
    ]


def dim_segment_definition(spark: SparkSession, contract: Contract = DEFAULT) -> DataFrame:
    return spark.createDataFrame(segment_rows(contract), "segment_type string, segment_value string, sort_order int")
