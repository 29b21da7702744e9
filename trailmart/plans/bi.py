"""Dashboard tables: narrow projections and joins over the marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.contract import DEFAULT, Contract
from trailmart.functions.measures import safe_rate, support


def share() -> Column:
    return safe_rate(F.col("booking_rows"), F.col("interaction_rows")).alias("booking_interaction_share")


def level(contract: Contract, rows: Column | None = None) -> Column:
    return support(F.col("interaction_rows") if rows is None else rows, contract.minimum_interactions, contract.strong_interactions).alias("support_level")


def role(definition: DataFrame, family: str, order: str) -> DataFrame:
    """The labels of one segment family with their order, to be joined by the mart's column."""
    return definition.where(F.col("segment_type") == family).select(F.col("segment_value").alias(f"{family}_segment"), F.col("sort_order").alias(order))


def overview_monthly(activity: DataFrame, outcome: DataFrame, proxy: DataFrame, partial_month: dt.date | None = None) -> DataFrame:
    joined = activity.join(outcome, "event_month").join(proxy.select("event_month", "proxy_search_contexts", "proxy_interaction_coverage"), "event_month", "left")
    return joined.select(
        "event_month",
        F.col("logged_interaction_rows").alias("interaction_rows"),
        "booking_rows",
        safe_rate(F.col("booking_rows"), F.col("logged_interaction_rows")).alias("booking_interaction_share"),
        F.col("identified_active_users").alias("active_users"),
        F.col("proxy_search_contexts").alias("proxy_contexts"),
        "proxy_interaction_coverage",
        "booking_interaction_share_ci_low",
        "booking_interaction_share_ci_high",
        F.col("event_month").eqNullSafe(F.lit(partial_month)).alias("is_partial_month"),
    )


def segments_monthly(segments: DataFrame, definition: DataFrame, outcome: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    overall = outcome.select("event_month", safe_rate(F.col("booking_rows"), F.col("interaction_rows")).alias("whole"))
    joined = segments.join(F.broadcast(definition), ["segment_type", "segment_value"], "left").join(overall, "event_month")  # the definition has 28 rows
    numeric = F.col("segment_type").isin("channel", "site")
    return joined.select(
        "event_month",
        "segment_type",
        "segment_value",
        F.coalesce("sort_order", F.when(numeric, F.col("segment_value").try_cast("int"))).alias("segment_sort_order"),
        "interaction_rows",
        "booking_rows",
        share(),
        level(contract),
        (F.col("sort_order").isNotNull() | numeric).alias("is_valid_segment"),
        ((share() - F.col("whole")) * 100.0).alias("booking_interaction_share_vs_overall_pp"),
    )


def booking_window(window: DataFrame, definition: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    for family in ("lead_time", "stay"):
        window = window.join(F.broadcast(role(definition, family, f"{family}_sort_order")), f"{family}_segment")
    return window.withColumn("support_level", level(contract))


def traveller_planning_monthly(patterns: DataFrame, definition: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """Averages of cells weighted by their rows; exact, as a cell's own key decides whether its dates are valid."""
    rows, booked = F.sum("interaction_rows"), F.sum("booking_rows")

    def weighted(name: str) -> Column:
        given = F.col(name).isNotNull()
        return F.sum(F.col(name) * F.col("interaction_rows")) / F.nullif(F.sum(F.when(given, F.col("interaction_rows"))).cast("double"), F.lit(0.0))

    joined = patterns.join(F.broadcast(role(definition, "traveller", "traveller_sort_order")), "traveller_segment")
    return joined.groupBy("event_month", "traveller_segment", "traveller_sort_order").agg(
        rows.alias("interaction_rows"),
        booked.alias("booking_rows"),
        safe_rate(booked, rows).alias("booking_interaction_share"),
        F.round(weighted("avg_valid_lead_time_days"), 9).alias("avg_valid_lead_days"),
        F.round(weighted("avg_valid_stay_nights"), 9).alias("avg_valid_stay_nights"),
        level(contract, rows),
    )


def checkin_seasonality(seasonality: DataFrame) -> DataFrame:
    month = F.col("checkin_month")
    return seasonality.select(
        "checkin_month",
        F.year(month).alias("checkin_year"),
        F.month(month).alias("checkin_month_number"),
        F.date_format(month, "MMMM").alias("checkin_month_name"),
        "traveller_segment",
        "interaction_rows",
        "booking_rows",
        "booking_interaction_share",
    )


def entity_performance(mart: DataFrame, key: str, name: str) -> DataFrame:
    """Entities against the overall share, with the third quartile of the strong ones' volume."""
    strong = F.col("support_level") == "strong"
    overall = mart.agg(
        safe_rate(F.sum("booking_rows"), F.sum("interaction_rows")).alias("overall_booking_interaction_share"),
        F.percentile(F.when(strong, F.col("interaction_rows")), 0.75).alias("interaction_volume_q3_strong"),
    )
    below = F.col("booking_interaction_share_ci_high") < F.col("overall_booking_interaction_share")
    above = F.col("booking_interaction_share_ci_low") > F.col("overall_booking_interaction_share")
    return mart.crossJoin(F.broadcast(overall)).select(  # overall is one row
        F.col(key).alias(name),
        "interaction_rows",
        "booking_rows",
        "booking_interaction_share",
        "booking_interaction_share_ci_low",
        "booking_interaction_share_ci_high",
        F.col("identified_users").alias("entity_users"),
        "support_level",
        "first_observed_date",
        "last_observed_date",
        "overall_booking_interaction_share",
        "interaction_volume_q3_strong",
        F.when(below, "below_overall_confident").when(above, "above_overall_confident").otherwise("inconclusive").alias("investigation_class"),
        F.coalesce(strong & (F.col("interaction_rows") >= F.col("interaction_volume_q3_strong")) & below, F.lit(False)).alias("investigation_candidate"),
    )


def destination_monthly(mart: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    return mart.withColumnsRenamed({"srch_destination_id": "destination_id", "identified_users": "entity_users"}).withColumn("support_level", level(contract))


def routes(mart: DataFrame) -> DataFrame:
    return mart.select(
        "origin_id",
        F.col("srch_destination_id").alias("destination_id"),
        "interaction_rows",
        "booking_rows",
        "booking_interaction_share",
        "booking_interaction_share_ci_low",
        "booking_interaction_share_ci_high",
        F.col("identified_users").alias("entity_users"),
        "support_level",
    )


def observed_recurrence(mart: DataFrame) -> DataFrame:
    names = {"first_observed_month": "cohort_month", "observed_booking_users": "booking_users", "is_right_censored": "is_censored"}
    return mart.drop("booking_user_share_among_observed_active").withColumnsRenamed(names)


def acceptance_status(checks: DataFrame, build_id: str) -> DataFrame:
    """Whether every check passed, from the checks themselves."""
    return checks.agg(
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("accepted"),
        F.count_if(~F.col("passed")).alias("failures"),
        F.count_if("passed").alias("checks_passed"),
        F.count("*").alias("checks_total"),
        F.lit(build_id).alias("build_id"),
    )


def drift_summary(mart: DataFrame) -> DataFrame:
    return mart.withColumnRenamed("compared_categories", "category_count")
