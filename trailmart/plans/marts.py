"""Daily, monthly, segment, destination, route, planning, recurrence, missingness and drift marts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.contract import DEFAULT, Contract
from trailmart.functions.measures import booking_block, month_index, month_start, rate_block, safe_rate, support, wilson


@dataclass(frozen=True)
class Mart:
    """A mart that is one grouping: keys, measures, and the rows it takes."""

    keys: tuple[str, ...]
    measures: list[Column] = field(default_factory=list)
    rows: Column | None = None

    def of(self, df: DataFrame) -> DataFrame:
        kept = df if self.rows is None else df.where(self.rows)
        return kept.groupBy(*self.keys).agg(*self.measures)


def users(name: str = "identified_users") -> Column:
    return F.count_distinct("user_id").alias(name)


def activity_block() -> list[Column]:
    known = F.count("user_id")
    return [
        F.count("*").alias("logged_interaction_rows"),
        users("identified_active_users"),
        F.count_if(F.col("user_id").isNull()).alias("anonymous_interaction_rows"),
        safe_rate(known, F.count("*")).alias("identified_user_coverage"),
        F.count_distinct("srch_destination_id").alias("observed_destinations"),
        F.count_distinct("hotel_market").alias("observed_hotel_markets"),
    ]


def activity_daily(fact: DataFrame) -> DataFrame:
    extra = [F.count_if(F.col("is_mobile") == 1).alias("mobile_interaction_rows"), F.count_if(F.col("is_package") == 1).alias("package_interaction_rows")]
    return Mart(("event_date",), activity_block() + extra).of(fact)


def activity_monthly(fact: DataFrame) -> DataFrame:
    return Mart(("event_month",), activity_block()).of(fact)


def outcome(fact: DataFrame, period: str) -> DataFrame:
    return Mart((period,), rate_block()).of(fact)


def context_activity(context: DataFrame, fact: DataFrame, period: str) -> DataFrame:
    """Contexts of a period and how much of its interactions they cover."""
    booked = F.count_if("has_booking")
    mart = Mart(
        (period,),
        [
            F.count("*").alias("proxy_search_contexts"),
            booked.alias("booking_bearing_proxy_contexts"),
            safe_rate(booked, F.count("*")).alias("booking_bearing_proxy_context_share"),
            users("identified_active_users"),
            F.sum("interaction_rows").alias("covered_interaction_rows"),
        ],
    ).of(context)
    whole = fact.groupBy(period).agg(F.count("*").alias("whole"))
    return mart.join(whole, period, "left").withColumn("proxy_interaction_coverage", safe_rate(F.col("covered_interaction_rows"), F.col("whole"))).drop("whole")


def user_day_daily(days: DataFrame) -> DataFrame:
    booked = F.count_if("has_booking")
    return Mart(
        ("event_date",),
        [
            F.count("*").alias("identified_user_days"),
            booked.alias("booking_user_days"),
            safe_rate(booked, F.count("*")).alias("booking_user_day_share"),
            users("identified_active_users"),
            F.sum("interaction_rows").alias("covered_interaction_rows"),
            F.sum("proxy_contexts").alias("proxy_search_contexts"),
        ],
    ).of(days)


def user_day_monthly(days: DataFrame) -> DataFrame:
    """Distinct users of a month; each user is brought to one row first, so no Expand is needed."""
    one = days.groupBy("event_month", "user_id").agg(
        F.bool_or("has_booking").alias("b"), F.count("*").alias("d"), F.sum("interaction_rows").alias("r"), F.sum("proxy_contexts").alias("p")
    )
    return Mart(
        ("event_month",),
        [
            F.count("*").alias("identified_active_users"),
            F.count_if("b").alias("booking_users"),
            safe_rate(F.count_if("b"), F.count("*")).alias("booking_user_share"),
            F.sum("d").alias("identified_user_days"),
            F.sum("r").alias("covered_interaction_rows"),
            F.sum("p").alias("proxy_search_contexts"),
        ],
    ).of(one)


def unpivot(df: DataFrame, keep: tuple[str, ...], columns: dict[str, Column], name: str, value: str) -> DataFrame:
    """One row per input row and named column, from one scan."""
    items = F.array(*(F.struct(F.lit(n).alias(name), c.alias(value)) for n, c in columns.items()))
    return df.select(*keep, F.explode(items).alias("_")).select(*keep, f"_.{name}", f"_.{value}")


def segment_families() -> dict[str, Column]:
    families = {k: F.col(f"{k}_segment") for k in ("device", "package", "traveller", "lead_time", "stay")}
    return families | {n: F.coalesce(F.col(c).cast("string"), F.lit("missing")) for n, c in (("channel", "channel"), ("site", "site_name"))}


def segment_daily(fact: DataFrame) -> DataFrame:
    """Seven families in long form. Rows collapse to counts per combination before they multiply."""
    small = fact.groupBy("event_date", *(c.alias(n) for n, c in segment_families().items())).agg(F.count("*").alias("n"), F.count_if(F.col("is_booking") == 1).alias("b"))
    long = unpivot(small, ("event_date", "n", "b"), {n: F.col(n) for n in segment_families()}, "segment_type", "segment_value")
    sums = [F.sum("n").alias("interaction_rows"), F.sum("b").alias("booking_rows"), safe_rate(F.sum("b"), F.sum("n")).alias("booking_interaction_share")]
    return Mart(("event_date", "segment_type", "segment_value"), sums).of(long)


def segment_monthly(daily: DataFrame) -> DataFrame:
    rows, booked = F.sum("interaction_rows"), F.sum("booking_rows")
    return Mart(
        ("event_month", "segment_type", "segment_value"), [rows.alias("interaction_rows"), booked.alias("booking_rows"), safe_rate(booked, rows).alias("booking_interaction_share")]
    ).of(daily.withColumn("event_month", month_start(F.col("event_date"))))


def entity_performance(fact: DataFrame, keys: tuple[str, ...], contract: Contract = DEFAULT, dates: bool = True) -> DataFrame:
    seen = [F.min("event_date").alias("first_observed_date"), F.max("event_date").alias("last_observed_date")] if dates else []
    level = support(F.count("*"), contract.minimum_interactions, contract.strong_interactions).alias("support_level")
    return Mart(keys, [*rate_block(), users(), *seen, level], F.col(keys[-1]).isNotNull()).of(fact)


def destination_monthly(fact: DataFrame) -> DataFrame:
    return Mart(("event_month", "srch_destination_id"), [*booking_block(), users()], F.col("srch_destination_id").isNotNull()).of(fact)


def travel_patterns(fact: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    lead, stay = F.when(F.col("has_valid_lead_time"), F.col("lead_time_days")), F.when(F.col("has_valid_stay_dates"), F.col("stay_nights"))
    return Mart(
        ("event_month", "traveller_segment", "lead_time_segment", "stay_segment"),
        [
            *booking_block(),
            users(),
            F.avg(lead).alias("avg_valid_lead_time_days"),
            F.percentile(lead, 0.5).alias("median_valid_lead_time_days"),
            F.avg(stay).alias("avg_valid_stay_nights"),
            support(F.count("*"), contract.minimum_interactions, contract.strong_interactions).alias("support_level"),
        ],
    ).of(fact)


def checkin_seasonality(fact: DataFrame) -> DataFrame:
    dated = fact.where("has_valid_lead_time").withColumn("checkin_month", month_start(F.col("checkin_date")))
    return Mart(("checkin_month", "traveller_segment"), [*booking_block(), users()]).of(dated)


def booking_window(fact: DataFrame) -> DataFrame:
    low, high = wilson(F.count_if(F.col("is_booking") == 1), F.count("*"))
    return Mart(
        ("lead_time_segment", "stay_segment"),
        [*booking_block(), low.alias("booking_interaction_share_ci_low"), high.alias("booking_interaction_share_ci_high")],
        F.col("has_valid_lead_time") & F.col("has_valid_stay_dates"),
    ).of(fact)


def observed_recurrence(days: DataFrame) -> DataFrame:
    """Cohorts by first month over a full grid of ages; cells after the last observed month are null."""
    months = days.groupBy("user_id", "event_month").agg(F.bool_or("has_booking").alias("b"))
    first = Window.partitionBy("user_id")
    placed = months.withColumn("cohort", F.min("event_month").over(first))
    cells = placed.groupBy("cohort", "event_month").agg(F.count("*").alias("active"), F.count_if("b").alias("booked"))
    sizes = cells.where("cohort = event_month").select(F.col("cohort").alias("first_observed_month"), F.col("active").alias("cohort_users"))
    bounds = cells.agg(F.min("cohort").alias("lo"), F.max("event_month").alias("hi"))
    horizon = month_index(F.col("hi")) - month_index(F.col("first_observed_month"))
    grid = sizes.crossJoin(F.broadcast(bounds)).select(  # bounds is one row
        "first_observed_month",
        "cohort_users",
        horizon.alias("observable_horizon_months"),
        F.explode(F.sequence(F.lit(0), month_index(F.col("hi")) - month_index(F.col("lo")))).alias("observed_age_month"),
    )
    grid = grid.withColumn("activity_month", F.add_months("first_observed_month", F.col("observed_age_month"))).withColumn(
        "is_right_censored", F.col("observed_age_month") > F.col("observable_horizon_months")
    )
    joined = grid.join(cells.withColumnsRenamed({"cohort": "first_observed_month", "event_month": "activity_month"}), ["first_observed_month", "activity_month"], "left")

    def observed(c: Column) -> Column:
        return F.when(~F.col("is_right_censored"), c)

    active, booked = F.coalesce("active", F.lit(0)), F.coalesce("booked", F.lit(0))
    return joined.select(
        "first_observed_month",
        "activity_month",
        "observed_age_month",
        "cohort_users",
        observed(active).alias("observed_active_users"),
        observed(safe_rate(active, F.col("cohort_users"))).alias("observed_recurrence_share"),
        observed(booked).alias("observed_booking_users"),
        observed(safe_rate(booked, active)).alias("booking_user_share_among_observed_active"),
        "is_right_censored",
        "observable_horizon_months",
    )


MISSABLE = ("user_id", "orig_destination_distance", "checkin_date", "checkout_date", "srch_destination_id", "hotel_market", "similar_event_count")


def missingness_daily(fact: DataFrame) -> DataFrame:
    """Missing rows per day and field: one wide aggregate, unpivoted after it is small."""
    wide = fact.groupBy("event_date").agg(F.count("*").alias("eligible_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in MISSABLE))
    long = unpivot(wide, ("event_date", "eligible_rows"), {c: F.col(c) for c in MISSABLE}, "field_name", "missing_rows")
    return long.withColumn("missing_share", safe_rate(F.col("missing_rows"), F.col("eligible_rows")))


def context_ambiguity(context: DataFrame) -> DataFrame:
    kinds = {"multirow": "interaction_rows", "multicluster": "distinct_hotel_clusters", "multimarket": "distinct_hotel_markets", "multibooking": "booking_rows"}
    wide = context.agg(F.count("*").alias("proxy_contexts"), *(F.count_if(F.col(c) > 1).alias(k) for k, c in kinds.items()))
    long = unpivot(wide, ("proxy_contexts",), {f"{k}_context": F.col(k) for k in kinds}, "ambiguity_type", "affected_contexts")
    return long.withColumn("affected_share", safe_rate(F.col("affected_contexts"), F.col("proxy_contexts")))


DRIFT = {"device": "is_mobile", "package": "is_package", "channel": "channel", "destination_type": "srch_destination_type_id", "hotel_country": "hotel_country", "hotel_market": "hotel_market"}


def population_drift(populations: dict[str, DataFrame]) -> DataFrame:
    """Shares of each dimension's values within data set and month. Rows need ``period_month`` and the dimensions."""
    parts = [d.select(F.lit(n).alias("dataset"), "period_month", *DRIFT.values()) for n, d in populations.items()]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    long = unpivot(both, ("dataset", "period_month"), {n: F.coalesce(F.col(c).cast("string"), F.lit("missing")) for n, c in DRIFT.items()}, "dimension_name", "dimension_value")
    counted = long.groupBy("dataset", "period_month", "dimension_name", "dimension_value").agg(F.count("*").alias("booking_population_rows"))
    whole = Window.partitionBy("dataset", "period_month", "dimension_name")
    return counted.withColumn("share_within_booking_population", safe_rate(F.col("booking_population_rows"), F.sum("booking_population_rows").over(whole)))


def drift_summary(drift: DataFrame, before: str, after: str) -> DataFrame:
    """Total variation and stability index per dimension, summed as decimals so that order does not matter."""
    shares = drift.groupBy("dimension_name", "dimension_value").agg(*(F.sum(F.when(F.col("dataset") == d, F.col("booking_population_rows"))).alias(c) for d, c in ((before, "a"), (after, "b"))))
    whole = Window.partitionBy("dimension_name")
    share = {c: F.coalesce(safe_rate(F.col(c), F.sum(c).over(whole)), F.lit(0.0)) for c in "ab"}
    shares = shares.select("dimension_name", share["a"].alias("a"), share["b"].alias("b"))
    moved = F.col("b") - F.col("a")
    psi = moved * F.log((F.col("b") + 1e-12) / (F.col("a") + 1e-12))
    return shares.groupBy("dimension_name").agg(
        (F.sum(F.abs(moved).cast("decimal(38,15)")).cast("double") * 0.5).alias("total_variation_distance"),
        F.sum(psi.cast("decimal(38,15)")).cast("double").alias("population_stability_index"),
        F.count("*").alias("compared_categories"),
    )


def quality_summary(counts: DataFrame) -> DataFrame:
    """Rules over one row of raw, accepted and quarantined counts per data set."""
    gap = lambda n: F.col(f"raw_{n}") - F.col(f"accepted_{n}") - F.col(f"quarantined_{n}")
    rules = [
        ("raw_train_rows", F.col("raw_train"), F.col("raw_train"), "info"),
        ("accepted_train_rows", F.col("accepted_train"), F.col("raw_train"), "info"),
        ("quarantined_train_rows", F.col("quarantined_train"), F.col("raw_train"), "warning"),
        ("raw_train_reconciliation_gap", gap("train"), F.col("raw_train"), "critical"),
        ("raw_destination_reconciliation_gap", gap("destinations"), F.col("raw_destinations"), "critical"),
    ]
    items = F.array(*(F.struct(F.lit(r).alias("quality_rule"), a.alias("affected_rows"), d.alias("denominator_rows"), F.lit(s).alias("severity")) for r, a, d, s in rules))
    return counts.select(F.explode(items).alias("_")).select("_.*").withColumn("affected_share", safe_rate(F.col("affected_rows"), F.col("denominator_rows")))


def date_quality(fact: DataFrame) -> DataFrame:
    """Rows per trip-date class and the length of the date spine, as quality rules."""
    classes = fact.groupBy("trip_date_quality").agg(F.count("*").alias("affected_rows"))
    whole = fact.agg(F.count("*").alias("denominator_rows"))
    return classes.crossJoin(F.broadcast(whole)).select(  # whole is one row
        F.concat(F.lit("trip_date_quality:"), "trip_date_quality").alias("quality_rule"),
        "affected_rows",
        "denominator_rows",
        F.when(F.col("trip_date_quality") == "plausible", "info").otherwise("warning").alias("severity"),
        safe_rate(F.col("affected_rows"), F.col("denominator_rows")).alias("affected_share"),
    )
