"""Interaction, context and user-day facts.

Trip-date plausibility is part of the interaction projection, so a fact is one pass over its input
without any shuffle; contexts group by their fourteen columns and hash each group once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.contract import DEFAULT, Contract
from trailmart.functions.measures import banded, digest, month_start, safe_rate

CONTEXT_KEYS = (
    "user_id", "event_datetime", "site_name", "origin_id", "is_mobile", "is_package", "channel", "checkin_date",
    "checkout_date", "srch_adults_cnt", "srch_children_cnt", "srch_rm_cnt", "srch_destination_id", "srch_destination_type_id",
)
PLACE = ("user_location_country", "user_location_region", "user_location_city")  # of which origin_id is the digest


def labels(day: Column, contract: Contract, checkin: str, checkout: str) -> dict[str, Column]:
    """What follows from an event's day, trip dates, party and flags: calendar, lead time, stay and segments."""
    lead, stay = F.date_diff(checkin, day), F.date_diff(checkout, checkin)
    max_lead, max_stay = contract.maximum_lead_time_days, contract.maximum_stay_nights
    same_day, week, month, quarter, half = contract.lead_time_days
    one, few, long_week, fortnight = contract.stay_nights
    adults, no_children = F.col("srch_adults_cnt"), F.coalesce("srch_children_cnt", F.lit(0)) == 0
    return {
        "event_date": day,
        "event_month": month_start(day),
        "event_year": F.year(day).cast("smallint"),
        "event_month_num": F.month(day).cast("tinyint"),
        "lead_time_days": lead,
        "stay_nights": stay,
        "device_segment": F.when(F.col("is_mobile") == 1, "mobile").when(F.col("is_mobile") == 0, "desktop").otherwise("unknown"),
        "package_segment": F.when(F.col("is_package") == 1, "package").when(F.col("is_package") == 0, "standalone").otherwise("unknown"),
        "traveller_segment": F.when(F.col("srch_children_cnt") > 0, "family")
        .when((adults == 1) & no_children, "solo")
        .when((adults == 2) & no_children, "couple")
        .when((adults >= 3) & no_children, "group")
        .otherwise("unknown"),
        "lead_time_segment": F.when(F.col(checkin).isNull(), "missing")
        .when(lead < 0, "invalid_negative")
        .when(lead > max_lead, f"out_of_scope_gt_{max_lead}")
        .otherwise(banded(lead, [(same_day, "same_day"), (week, "01_07_days"), (month, "08_30_days"), (quarter, "31_90_days"), (half, "91_180_days")], f"181_{max_lead}_days")),
        "stay_segment": F.when(F.col(checkin).isNull() | F.col(checkout).isNull(), "missing")
        .when(stay <= 0, "invalid_nonpositive")
        .when(stay > max_stay, f"out_of_scope_gt_{max_stay}")
        .otherwise(banded(stay, [(one, "01_night"), (few, "02_03_nights"), (long_week, "04_07_nights"), (fortnight, "08_14_nights")], f"15_{max_stay}_nights")),
        "trip_date_quality": F.when(F.col(checkin).isNull(), "missing_checkin")
        .when(lead < 0, "checkin_before_event")
        .when(lead > max_lead, "lead_time_out_of_scope")
        .when(F.col(checkout).isNull(), "missing_checkout")
        .when(stay <= 0, "checkout_not_after_checkin")
        .when(stay > max_stay, "stay_out_of_scope")
        .otherwise("plausible"),
    }


def interactions(accepted: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """One row per accepted row, with its calendar, keys, segments and plausibility flags.

    The id follows from the raw fingerprint and its occurrence where staging made them, else from the
    scan ordinal. A distance that is no number (NaN) counts as missing here and in all that builds on it.
    """
    day = F.col("date_time").cast("date")
    label = labels(day, contract, "srch_ci", "srch_co")
    lead, stay = label["lead_time_days"], label["stay_nights"]
    plain_lead, plain_stay = lead.between(0, contract.maximum_lead_time_days), stay.between(1, contract.maximum_stay_nights)
    adults = F.col("srch_adults_cnt")
    if "raw_row_fingerprint" in accepted.columns:
        identity = F.sha2(F.concat_ws(":", "raw_row_fingerprint", F.col("duplicate_occurrence").cast("string")), 256)
    else:
        identity = digest(F.lit("row"), F.col("source_scan_ordinal"))
    no = F.lit(False)
    named = lambda *names: (label[n].alias(n) for n in names)
    return accepted.select(
        identity.alias("interaction_id"),
        F.col("date_time").alias("event_datetime"),
        *named("event_date", "event_month", "event_year", "event_month_num"),
        (F.weekday(day) + 1).cast("tinyint").alias("event_iso_day_of_week"),
        "site_name",
        "posa_continent",
        *PLACE,
        F.nanvl(F.col("orig_destination_distance").cast("double"), F.lit(None).cast("double")).alias("orig_destination_distance"),
        "user_id",
        "is_mobile",
        "is_package",
        "channel",
        digest(*(F.col(c) for c in PLACE)).alias("origin_id"),
        F.col("srch_ci").alias("checkin_date"),
        F.col("srch_co").alias("checkout_date"),
        *named("lead_time_days", "stay_nights"),
        "srch_adults_cnt",
        "srch_children_cnt",
        "srch_rm_cnt",
        (F.coalesce(adults.cast("int"), F.lit(0)) + F.coalesce(F.col("srch_children_cnt").cast("int"), F.lit(0))).alias("party_size"),
        "srch_destination_id",
        "srch_destination_type_id",
        "is_booking",
        F.col("cnt").alias("similar_event_count"),
        F.coalesce(F.col("cnt") > 0, no).alias("has_valid_similar_event_count"),
        F.when(F.col("cnt") > 0, F.col("cnt")).alias("valid_similar_event_count"),
        "hotel_continent",
        "hotel_country",
        "hotel_market",
        "hotel_cluster",
        *named("device_segment", "package_segment", "traveller_segment", "lead_time_segment", "stay_segment", "trip_date_quality"),
        F.coalesce(lead >= 0, no).alias("is_chronological_lead_time"),
        F.coalesce(stay > 0, no).alias("is_chronological_stay"),
        F.coalesce(plain_lead, no).alias("has_valid_lead_time"),
        F.coalesce(plain_stay, no).alias("has_valid_stay_dates"),
        F.coalesce(plain_lead & plain_stay, no).alias("is_plausible_trip_dates"),
    )


def contexts(fact: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """One row per search context of an identified user.

    Rows are grouped by the plain parts of the key; its digests and all that follows from it are made once per group.
    """
    distance, booked = F.col("orig_destination_distance"), F.col("is_booking") == 1
    parts = [c for k in CONTEXT_KEYS for c in (PLACE if k == "origin_id" else (k,))]
    grouped = (
        fact.where(F.col("user_id").isNotNull())
        .groupBy(*parts)
        .agg(
            F.count("*").alias("interaction_rows"),
            F.count_if(~booked).alias("click_rows"),
            F.count_if(booked).alias("booking_rows"),
            F.bool_or(booked).alias("has_booking"),
            # sets of clusters and markets are small by nature, and spare the rows a copy per distinct count
            F.size(F.collect_set("hotel_cluster")).cast("bigint").alias("distinct_hotel_clusters"),
            F.size(F.collect_set("hotel_market")).cast("bigint").alias("distinct_hotel_markets"),
            F.min(distance).alias("min_hotel_distance"),
            F.percentile(distance, 0.5).alias("median_hotel_distance"),
            F.max(distance).alias("max_hotel_distance"),
            safe_rate(F.count_if(distance.isNull()), F.count("*")).alias("distance_missing_share"),
            F.percentile(F.when(booked, distance), 0.5).alias("booked_hotel_distance"),
            F.sum("valid_similar_event_count").alias("valid_similar_event_count"),
        )
    )
    label = labels(F.col("event_datetime").cast("date"), contract, "checkin_date", "checkout_date")
    known = grouped.withColumn("origin_id", digest(*(F.col(c) for c in PLACE))).drop(*PLACE).withColumns(label)
    return known.withColumn("proxy_context_id", digest(*(F.col(c) for c in CONTEXT_KEYS)))


def user_days(context: DataFrame) -> DataFrame:
    """One row per identified user and day."""
    day = F.col("event_date")
    grouped = context.groupBy("user_id", "event_date").agg(
        F.sum("interaction_rows").alias("interaction_rows"),
        F.sum("booking_rows").alias("booking_rows"),
        F.count_distinct("srch_destination_id").alias("distinct_destinations"),
        F.count("*").alias("proxy_contexts"),
        F.bool_or("has_booking").alias("has_booking"),
    )
    return grouped.select(
        "*", month_start(day).alias("event_month"), F.year(day).cast("smallint").alias("event_year"), F.month(day).cast("tinyint").alias("event_month_num")
    )
