"""The earlier, context-centred marts: event weights, modal attributes, deciles, user profiles.

Modal attributes take the least of equally frequent values, deciles break ties by destination, and rows
carry a stable key, so every result is determined by its input.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmart.functions.measures import digest, month_index, month_start, safe_rate
from trailmart.operators import gates, publish
from trailmart.plans.dims import calendar
from trailmart.plans.facts import CONTEXT_KEYS, interactions
from trailmart.plans.marts import unpivot
from trailmart.schema import ObjectSpec
from trailmart.sources.landing import with_scan_ordinal


def modal(name: str, where: Column | None = None) -> Column:
    """The most frequent value, the least of several; nulls do not count."""
    column = F.col(name) if where is None else F.when(where, F.col(name))
    return F.mode(column, deterministic=True)


def weighted_interactions(accepted: DataFrame) -> DataFrame:
    """The interaction fact with week, hour, event weight, type, distance band and a context key."""
    fact = interactions(accepted)
    day, distance = F.col("event_date"), F.col("orig_destination_distance")
    band = (
        F.when(distance.isNull(), "missing")
        .when(distance < 100, "0_100")
        .when(distance < 500, "100_500")
        .when(distance < 1000, "500_1000")
        .when(distance < 5000, "1000_5000")
        .otherwise("5000_plus")
    )
    return (
        fact.withColumn("event_week", F.trunc(day, "week"))
        .withColumn("event_hour", F.hour("event_datetime").cast("tinyint"))
        .withColumn("event_weight", F.greatest(F.coalesce(F.col("similar_event_count"), F.lit(1)), F.lit(1)).cast("bigint"))
        .withColumn("interaction_type", F.when(F.col("is_booking") == 1, "booking").otherwise("click"))
        .withColumn("distance_segment", band)
        .withColumn("search_context_key", digest(*(F.col(c) for c in CONTEXT_KEYS)))
    )


SAME = (
    "event_datetime", "event_date", "event_month", "event_week", "event_iso_day_of_week", "event_hour", "site_name", "user_location_country",
    "user_location_region", "user_location_city", "user_id", "device_segment", "package_segment", "channel", "checkin_date", "checkout_date",
    "lead_time_days", "lead_time_segment", "stay_nights", "stay_segment", "srch_adults_cnt", "srch_children_cnt", "srch_rm_cnt", "party_size",
    "traveller_segment", "srch_destination_id", "srch_destination_type_id", "posa_continent", "distance_segment",
)


def search_contexts(fact: DataFrame) -> DataFrame:
    """One row per context, anonymous ones included; attributes outside the key take their least value."""
    weight, booked = F.col("event_weight"), F.col("is_booking") == 1
    return fact.groupBy("search_context_key").agg(
        *(F.min(c).alias(c) for c in SAME),
        *(modal(c).alias(f"primary_{c}") for c in ("hotel_continent", "hotel_country", "hotel_market")),
        F.bool_or("has_valid_stay_dates").alias("has_valid_stay_dates"),
        F.bool_or("has_valid_lead_time").alias("has_valid_lead_time"),
        F.count("*").alias("interaction_rows"),
        F.sum(weight).alias("weighted_interactions"),
        F.count_if(~booked).alias("click_rows"),
        F.sum(F.when(~booked, weight).otherwise(0)).alias("weighted_clicks"),
        F.count_if(booked).alias("booking_rows"),
        F.sum(F.when(booked, weight).otherwise(0)).alias("weighted_bookings"),
        F.bool_or(booked).alias("has_booking"),
        F.count_distinct("hotel_cluster").alias("distinct_hotel_clusters"),
        F.count_distinct("hotel_market").alias("distinct_hotel_markets"),
        modal("hotel_cluster", booked).alias("booked_hotel_cluster"),
    )


def dim_date(context: DataFrame) -> DataFrame:
    spine = context.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi")).where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("date_day"))
    day = F.col("date_day")
    return spine.select(day, *calendar(day), *(F.date_format(day, p).alias(n) for p, n in (("yyyy-MM", "year_month"), ("EEEE", "day_name"), ("MMMM", "month_name"))))


def first_seen(context: DataFrame) -> DataFrame:
    seen = context.where("user_id is not null").groupBy("user_id").agg(F.min("event_date").alias("first_event_date"), F.max("event_date").alias("last_event_date"))
    return seen.withColumn("first_event_month", month_start(F.col("first_event_date")))


def _counts(prefix: str = "") -> list[Column]:
    booked = F.count_if("has_booking")
    return [F.count("*").alias(f"{prefix}search_contexts"), booked.alias(f"{prefix}booking_contexts")]


def _rate() -> Column:
    return safe_rate(F.count_if("has_booking"), F.count("*")).alias("booking_context_rate")


def valid(name: str) -> Column:
    flag = "has_valid_lead_time" if name == "lead_time_days" else "has_valid_stay_dates"
    return F.when(F.col(flag), F.col(name))


def _averages() -> list[Column]:
    return [F.avg(valid("lead_time_days")).alias("avg_lead_time_days"), F.avg(valid("stay_nights")).alias("avg_stay_nights")]


def dim_destination(destinations: DataFrame, context: DataFrame) -> DataFrame:
    observed = (
        context.where("srch_destination_id is not null")
        .groupBy("srch_destination_id")
        .agg(
            modal("srch_destination_type_id").alias("destination_type_id"),
            *(modal(f"primary_hotel_{c}").alias(f"primary_hotel_{c}") for c in ("continent", "country", "market")),
            F.min("event_date").alias("first_seen_date"),
            F.max("event_date").alias("last_seen_date"),
            *_counts("observed_"),
        )
    )
    return destinations.join(observed, "srch_destination_id", "left").fillna(0, ["observed_search_contexts", "observed_booking_contexts"])


def product(context: DataFrame, period: str) -> DataFrame:
    """Daily or monthly product measures; new users are those whose first period it is."""
    start = "first_event_date" if period == "event_date" else "first_event_month"
    joined = context.join(first_seen(context), "user_id", "left")
    mobile, package = F.count_if(F.col("device_segment") == "mobile"), F.count_if(F.col("package_segment") == "package")
    lead, stay = valid("lead_time_days"), valid("stay_nights")
    return joined.groupBy(period).agg(
        *_counts(),
        F.count_if(~F.col("has_booking")).alias("non_booking_contexts"),
        _rate(),
        F.count_distinct("user_id").alias("active_users"),
        F.count_distinct(F.when(F.col(period) == F.col(start), F.col("user_id"))).alias("new_users"),
        F.count_distinct(F.when(F.col(period) > F.col(start), F.col("user_id"))).alias("returning_users"),
        *(F.sum(c).alias(c) for c in ("interaction_rows", "weighted_interactions", "click_rows", "weighted_clicks", "booking_rows", "weighted_bookings")),
        mobile.alias("mobile_contexts"),
        safe_rate(mobile, F.count("*")).alias("mobile_context_share"),
        package.alias("package_contexts"),
        safe_rate(package, F.count("*")).alias("package_context_share"),
        *_averages(),
        F.percentile(lead, 0.5).alias("median_lead_time_days"),
        F.round(F.percentile(lead, 0.9), 6).alias("p90_lead_time_days"),
        F.percentile(stay, 0.5).alias("median_stay_nights"),
        F.count_distinct("srch_destination_id").alias("unique_destinations"),
        F.count_distinct("primary_hotel_market").alias("unique_hotel_markets"),
        safe_rate(F.count("*"), F.count_distinct("user_id")).alias("contexts_per_active_user"),
    )


def segments(context: DataFrame, period: str, stable: int) -> DataFrame:
    """Ten families in long form. A context without user counts as returning."""
    start = "first_event_date" if period == "event_date" else "first_event_month"
    joined = context.join(first_seen(context).select("user_id", start), "user_id", "left")
    families = {n: F.col(f"{n}_segment") for n in ("device", "package", "traveller", "lead_time", "stay", "distance")}
    families |= {n: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for n, c in (("channel", "channel"), ("site", "site_name"), ("destination_type", "srch_destination_type_id"))}
    families["user_lifecycle"] = F.when(F.col(period) == F.col(start), "new").otherwise("returning")
    long = unpivot(joined, (period, "user_id", "has_booking", "interaction_rows", "weighted_interactions"), families, "segment_type", "segment_value")
    return long.groupBy(period, "segment_type", "segment_value").agg(
        *_counts(),
        _rate(),
        F.count_distinct("user_id").alias("active_users"),
        F.sum("interaction_rows").alias("interaction_rows"),
        F.sum("weighted_interactions").alias("weighted_interactions"),
        (F.count("*") >= stable).alias("is_stable_sample"),
    )


def destination_performance(context: DataFrame, stable: int = 100) -> DataFrame:
    """Destinations with demand and rate deciles and their quadrant about the medians."""
    mobile, package = F.count_if(F.col("device_segment") == "mobile"), F.count_if(F.col("package_segment") == "package")
    grouped = (
        context.where("srch_destination_id is not null")
        .groupBy("srch_destination_id")
        .agg(
            modal("srch_destination_type_id").alias("destination_type_id"),
            *(modal(f"primary_hotel_{c}").alias(f"primary_hotel_{c}") for c in ("continent", "country", "market")),
            *_counts(),
            _rate(),
            F.count_distinct("user_id").alias("unique_users"),
            F.sum("interaction_rows").alias("interaction_rows"),
            F.sum("weighted_interactions").alias("weighted_interactions"),
            *_averages(),
            safe_rate(mobile, F.count("*")).alias("mobile_context_share"),
            safe_rate(package, F.count("*")).alias("package_context_share"),
            F.min("event_date").alias("first_seen_date"),
            F.max("event_date").alias("last_seen_date"),
        )
    )
    high = F.col("search_contexts") >= F.col("median_destination_demand")
    good = F.col("booking_context_rate") >= F.col("median_destination_booking_rate")
    quadrant = F.concat(F.when(high, "high").otherwise("low"), F.lit("_demand_"), F.when(good, "high").otherwise("low"), F.lit("_rate"))
    demand, demand_median = deciles(grouped, "search_contexts", "demand_decile")
    rated, rate_median = deciles(demand, "booking_context_rate", "booking_rate_decile")
    medians = demand_median.withColumnRenamed("median", "median_destination_demand").crossJoin(rate_median.withColumnRenamed("median", "median_destination_booking_rate"))  # one row each
    return rated.crossJoin(F.broadcast(medians)).withColumn("performance_quadrant", quadrant).withColumn("is_stable_sample", F.col("search_contexts") >= stable)


def deciles(df: DataFrame, value: str, name: str, tie: str = "srch_destination_id", parts: int = 10) -> tuple[DataFrame, DataFrame]:
    """NTILE over all rows by ``value`` (nulls last) and ``tie``, and the median of the values, as one row.

    Rows are spread by ranges of (value, tie) and sorted within them; the counts of the ranges before turn places in a
    range into ranks, so neither all rows nor all of one value pass one task.
    """
    order = [F.col(value).asc_nulls_last(), F.col(tie).asc_nulls_last()]
    ranked = with_scan_ordinal(df.repartitionByRange(*order).sortWithinPartitions(*order), "_rank")
    whole = ranked.agg(F.count("*").alias("_n"), F.count(value).alias("_m"))
    joined = ranked.crossJoin(F.broadcast(whole))  # one row
    rank = F.col("_rank") - 1
    small, larger = F.expr(f"_n div {parts}"), F.col("_n") % parts
    edge = larger * (small + 1)
    tile = F.when(rank < edge, F.floor(rank / (small + 1))).otherwise(larger + F.floor((rank - edge) / F.greatest(small, F.lit(1)))) + 1
    middle = joined.where((F.col("_rank") >= F.expr("(_m + 1) div 2")) & (F.col("_rank") <= F.expr("_m div 2 + 1")) & (F.col("_rank") <= F.col("_m")))
    return joined.withColumn(name, tile.cast("int")).drop("_rank", "_n", "_m"), middle.agg(F.avg(value).alias("median"))


def destination_monthly(context: DataFrame, stable: int = 100) -> DataFrame:
    return (
        context.where("srch_destination_id is not null")
        .groupBy("event_month", "srch_destination_id")
        .agg(
            modal("srch_destination_type_id").alias("destination_type_id"),
            *(modal(f"primary_hotel_{c}").alias(f"primary_hotel_{c}") for c in ("country", "market")),
            *_counts(),
            _rate(),
            F.count_distinct("user_id").alias("unique_users"),
            F.sum("weighted_interactions").alias("weighted_interactions"),
            (F.count("*") >= stable).alias("is_stable_sample"),
        )
    )


PATTERN = ("event_month", "traveller_segment", "lead_time_segment", "stay_segment", "device_segment", "package_segment")


def travel_patterns(context: DataFrame, stable: int = 300) -> DataFrame:
    return context.groupBy(*PATTERN).agg(
        *_counts(),
        _rate(),
        F.count_distinct("user_id").alias("active_users"),
        F.avg("party_size").alias("avg_party_size"),
        F.avg("srch_rm_cnt").alias("avg_rooms"),
        *_averages(),
        F.sum("weighted_interactions").alias("weighted_interactions"),
        (F.count("*") >= stable).alias("is_stable_sample"),
    )


def user_profile(context: DataFrame) -> DataFrame:
    booked = F.count_if("has_booking") > 0
    habit = F.concat(F.when(F.count("*") == 1, "one_time").otherwise("repeat"), F.when(booked, "_booker").otherwise("_non_booker"))
    return (
        context.where("user_id is not null")
        .groupBy("user_id")
        .agg(
            F.min("event_date").alias("first_event_date"),
            F.max("event_date").alias("last_event_date"),
            F.date_diff(F.max("event_date"), F.min("event_date")).alias("observed_lifetime_days"),
            *_counts(),
            _rate(),
            F.count_distinct("event_date").alias("active_days"),
            F.count_distinct("event_month").alias("active_months"),
            F.sum("interaction_rows").alias("interaction_rows"),
            F.sum("weighted_interactions").alias("weighted_interactions"),
            modal("device_segment").alias("preferred_device_segment"),
            modal("package_segment").alias("preferred_package_segment"),
            modal("traveller_segment").alias("dominant_traveller_segment"),
            modal("srch_destination_id").alias("most_frequent_destination_id"),
            F.count_distinct("srch_destination_id").alias("unique_destinations"),
            F.count_distinct("primary_hotel_market").alias("unique_hotel_markets"),
            *_averages(),
            habit.alias("user_value_segment"),
        )
    )


def user_cohort_monthly(context: DataFrame) -> DataFrame:
    joined = context.join(first_seen(context).select("user_id", F.col("first_event_month").alias("cohort_month")), "user_id")
    age = month_index(F.col("event_month")) - month_index(F.col("cohort_month"))
    months = joined.groupBy("user_id", "cohort_month", F.col("event_month").alias("activity_month"), age.alias("cohort_age_month")).agg(*_counts())
    contexts, booked = F.sum("search_contexts"), F.sum("booking_contexts")
    return months.groupBy("cohort_month", "activity_month", "cohort_age_month").agg(
        F.count("*").alias("active_users"), contexts.alias("search_contexts"), booked.alias("booking_contexts"), safe_rate(booked, contexts).alias("booking_context_rate")
    )


#: Rule, severity, and the rows it affects.
RULES = (
    ("source_rows", "info", "true"),
    ("null_user_id", "warning", "user_id is null"),
    ("null_checkin_date", "warning", "checkin_date is null"),
    ("null_checkout_date", "warning", "checkout_date is null"),
    ("negative_lead_time", "warning", "lead_time_days < 0"),
    ("nonpositive_stay", "warning", "stay_nights <= 0"),
    ("missing_distance", "info", "orig_destination_distance is null"),
    ("invalid_adults", "warning", "srch_adults_cnt is null or srch_adults_cnt <= 0"),
    ("invalid_children", "critical", "srch_children_cnt < 0"),
    ("invalid_rooms", "warning", "srch_rm_cnt is null or srch_rm_cnt <= 0"),
    ("missing_destination", "warning", "srch_destination_id is null"),
    ("missing_hotel_market", "info", "hotel_market is null"),
    ("invalid_source_cnt", "warning", "similar_event_count is null or similar_event_count <= 0"),
    ("invalid_booking_flag", "critical", "is_booking not in (0, 1)"),
)
DAILY_RULES = ("null_user_id", "null_checkin_date", "null_checkout_date", "negative_lead_time", "nonpositive_stay", "missing_distance", "missing_destination", "invalid_source_cnt")
DAILY_RATES = ("null_user_id", "negative_lead_time", "nonpositive_stay", "missing_distance")


def quality_summary(fact: DataFrame) -> DataFrame:
    wide = fact.agg(F.count("*").alias("total_rows"), *(F.count_if(F.expr(e)).alias(n) for n, _, e in RULES))
    items = F.array(*(F.struct(F.lit(n).alias("rule_name"), F.lit(s).alias("severity"), F.col(n).alias("affected_rows")) for n, s, _ in RULES))
    return wide.select("total_rows", F.explode(items).alias("_")).select("total_rows", "_.*").withColumn("affected_rate", safe_rate(F.col("affected_rows"), F.col("total_rows")))


def quality_daily(fact: DataFrame) -> DataFrame:
    rules = {n: F.count_if(F.expr(e)) for n, _, e in RULES}
    return fact.groupBy("event_date").agg(
        F.count("*").alias("interaction_rows"),
        *(rules[n].alias(f"{n}_rows") for n in DAILY_RULES),
        *(safe_rate(rules[n], F.count("*")).alias(f"{n}_rate") for n in DAILY_RATES),
    )


def gates_of(source: DataFrame, made: dict[str, DataFrame]) -> DataFrame:
    """The checks of the context-centred marts: (gate, actual, expected, passed)."""
    fact, context, daily, places = (made[n] for n in ("fct_weighted_interactions", "fct_search_contexts", "dm_product_daily", "dm_destination_performance"))
    outside = lambda df, *names: reduce(Column.__or__, (~F.col(n).between(0, 1) for n in names if n in df.columns))
    one = lambda a, b: a.alias("a").crossJoin(b)  # one row each
    total = lambda c: daily.agg(F.coalesce(F.sum(c), F.lit(0)).alias("actual_"))
    pairs = {
        "fact_preserves_source_rows": one(fact.agg(F.count("*").alias("actual_")), source.agg(F.count("*").alias("wanted"))),
        "daily_context_totals_reconcile": one(total("search_contexts"), context.agg(F.count("*").alias("wanted"))),
        "daily_booking_totals_reconcile": one(total("booking_contexts"), context.agg(F.count_if("has_booking").alias("wanted"))),
    }
    found = [gates.check(df, name, F.max("actual_"), F.max("wanted")) for name, df in pairs.items()]
    found += [
        gates.none_of(fact, "fact_has_no_null_event_dates", F.col("event_date").isNull()),
        gates.none_of(fact, "fact_has_valid_booking_flag", ~F.col("is_booking").isin(0, 1)),
        gates.none_of(fact, "event_weight_is_positive", F.col("event_weight") < 1),
        gates.none_of(daily, "daily_rates_are_bounded", outside(daily, "booking_context_rate", "mobile_context_share", "package_context_share")),
        gates.none_of(places, "destination_rates_are_bounded", outside(places, "booking_context_rate")),
    ]
    return reduce(DataFrame.unionByName, found)


def marts_of(accepted: DataFrame, destinations: DataFrame, keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> dict[str, DataFrame]:
    """Every context-centred object by name, in the order in which they build on each other."""
    made: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        made[name] = keep(name, df)
        return made[name]

    fact = add("fct_weighted_interactions", weighted_interactions(accepted))
    context = add("fct_search_contexts", search_contexts(fact))
    add("dim_date", dim_date(context))
    add("dim_destination", dim_destination(destinations, context))
    add("dim_user_first_seen", first_seen(context))
    for period, column, stable in (("daily", "event_date", 100), ("monthly", "event_month", 300)):
        add(f"dm_product_{period}", product(context, column))
        add(f"dm_segment_{period}", segments(context, column, stable))
    for name, make in (
        ("dm_destination_performance", destination_performance), ("dm_destination_monthly", destination_monthly), ("dm_travel_patterns", travel_patterns),
        ("dm_user_profile", user_profile), ("dm_user_cohort_monthly", user_cohort_monthly),
    ):
        add(name, make(context))
    add("dm_data_quality_summary", quality_summary(fact))
    add("dm_data_quality_daily", quality_daily(fact))
    return made


def registry(made: dict[str, DataFrame]) -> DataFrame:
    """One row per object: rows, columns and the first and last day it speaks of, gathered row by row as objects are made."""
    entries = []
    for name, df in made.items():
        day = next((c for c in ("event_date", "event_month", "date_day", "event_day") if c in df.columns), None)
        days = [F.min(day).cast("date"), F.max(day).cast("date")] if day else [F.lit(None).cast("date")] * 2
        rows, first, last = df.agg(F.count("*"), *days).first()
        if rows == 0:
            raise gates.GateError(f"{name} is empty")
        entries.append((name, rows, len(df.columns), first, last))
    return next(iter(made.values())).sparkSession.createDataFrame(entries, "object_name string, row_count bigint, column_count int, min_date date, max_date date")


def build_legacy(spark: SparkSession, accepted: DataFrame, destinations: DataFrame, out: str, build_id: str) -> str:
    """Write every object with its registry and gates, and publish them if all gates pass."""
    with publish.Build(out, build_id) as target:
        made = marts_of(accepted, destinations, lambda name, df: target.write(df, ObjectSpec("legacy", name, ())))
        target.write(registry(made), ObjectSpec("legacy", "object_registry", ("object_name",)))
        gates.require(target.write(gates_of(accepted, made), ObjectSpec("legacy", "quality_checks", ("gate",))))
    return target.final
