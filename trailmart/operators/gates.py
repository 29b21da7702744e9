"""Quality gates over a built catalog: every check is a row of (gate, actual, expected, passed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.contract import DEFAULT, Contract
from trailmart.schema import OBJECTS, ObjectSpec

# Terms a published name must not contain, as they claim what these data cannot show.
FORBIDDEN = ("conversion", "ctr", "retention", "churn", "revenue", "gmv", "uplift")


class GateError(RuntimeError):
    """Raised before anything is published."""


def check(df: DataFrame, gate: str, actual: Column, expected: Column | int | float, passed: Column | None = None) -> DataFrame:
    """One check from one aggregate over ``df``."""
    wanted = expected if isinstance(expected, Column) else F.lit(expected)
    one = df.agg(actual.cast("double").alias("actual"), wanted.cast("double").alias("expected"))
    return one.select(F.lit(gate).alias("gate"), "actual", "expected", F.coalesce(passed if passed is not None else F.col("actual") == F.col("expected"), F.lit(False)).alias("passed"))


def at_most(df: DataFrame, gate: str, actual: Column, bound: float) -> DataFrame:
    return check(df, gate, actual, bound, F.coalesce(F.col("actual") <= F.col("expected"), F.lit(True)))


def none_of(df: DataFrame, gate: str, broken: Column) -> DataFrame:
    return check(df, gate, F.count_if(broken), 0)


def population_gates(catalog: dict[str, DataFrame]) -> list[DataFrame]:
    """Totals of every mart against the fact it was made from, one pass over each mart."""
    fact, context, days = (catalog[n] for n in ("fct_hotel_interactions", "fct_proxy_search_contexts", "fct_user_day"))
    whole = fact.agg(
        F.count("*").alias("rows"), F.count_if(F.col("is_booking") == 1).alias("bookings"), F.count("user_id").alias("identified"), F.count("srch_destination_id").alias("placed"), F.count("hotel_market").alias("marketed"),
        F.count_if(F.col("srch_destination_id").isNotNull() & F.col("hotel_market").isNotNull()).alias("paired"),
    )
    contexts = context.agg(F.count("*").alias("contexts"))
    sums = [
        ("activity_daily_rows", "dm_sample_activity_daily", "logged_interaction_rows", "rows"),
        ("activity_monthly_rows", "dm_sample_activity_monthly", "logged_interaction_rows", "rows"),
        ("outcome_daily_bookings", "dm_interaction_outcome_daily", "booking_rows", "bookings"),
        ("outcome_monthly_bookings", "dm_interaction_outcome_monthly", "booking_rows", "bookings"),
        ("context_rows", "fct_proxy_search_contexts", "interaction_rows", "identified"),
        ("user_day_rows", "fct_user_day", "interaction_rows", "identified"),
        ("destination_rows", "dm_destination_performance", "interaction_rows", "placed"),
        ("destination_monthly_rows", "dm_destination_monthly", "interaction_rows", "placed"),
        ("market_rows", "dm_hotel_market_performance", "interaction_rows", "marketed"),
        ("route_rows", "dm_origin_destination_routes", "interaction_rows", "placed"),
        ("bridge_rows", "bridge_destination_hotel_market", "interaction_rows", "paired"),
    ]
    found = []
    for gate, mart, column, target in sums:
        one = catalog[mart].agg(F.coalesce(F.sum(column), F.lit(0)).alias("s")).crossJoin(whole.select(target))
        found.append(check(one, f"population:{gate}", F.max("s"), F.max(target)))
    for period in ("daily", "monthly"):
        one = catalog[f"dm_proxy_context_{period}"].agg(F.sum("proxy_search_contexts").alias("s")).crossJoin(contexts)
        found.append(check(one, f"population:proxy_{period}", F.max("s"), F.max("contexts")))
    found.append(check(catalog["dm_user_day_daily"].agg(F.sum("identified_user_days").alias("s")).crossJoin(days.agg(F.count("*").alias("n"))), "population:user_days", F.max("s"), F.max("n")))
    return found


def range_gates(catalog: dict[str, DataFrame]) -> list[DataFrame]:
    """Rates in [0, 1], parts no more than wholes, intervals about their shares."""
    found = []
    for name, mart in catalog.items():
        if not name.startswith("dm_"):
            continue
        rates = [c for c in mart.columns if c.endswith(("_share", "_coverage", "_ci_low", "_ci_high")) or c == "affected_share"]
        if rates:
            outside = reduce(lambda a, b: a | b, (~F.col(c).between(0, 1) for c in rates))
            found.append(none_of(mart, f"range:{name}", outside))
        if {"booking_rows", "interaction_rows"} <= set(mart.columns):
            found.append(none_of(mart, f"parts:{name}", (F.col("booking_rows") < 0) | (F.col("booking_rows") > F.col("interaction_rows"))))
        if "booking_interaction_share_ci_low" in mart.columns:
            share = F.col("booking_interaction_share")
            found.append(none_of(mart, f"interval:{name}", (F.col("booking_interaction_share_ci_low") > share) | (F.col("booking_interaction_share_ci_high") < share)))
    return found


def calendar_gates(catalog: dict[str, DataFrame]) -> list[DataFrame]:
    spine = catalog["dim_date"].withColumn("step", F.date_diff("date_day", F.lag("date_day").over(Window.orderBy("date_day"))))  # days: a bounded calendar
    daily = catalog["dm_interaction_outcome_daily"].groupBy(F.trunc("event_date", "MM").alias("event_month")).agg(F.sum("interaction_rows").alias("d"))
    pair = daily.join(catalog["dm_interaction_outcome_monthly"].select("event_month", F.col("interaction_rows").alias("m")), "event_month", "full")
    found = [none_of(spine, "spine:continuous", F.col("step") != 1), none_of(pair, "rollup:daily_to_monthly", ~F.col("d").eqNullSafe(F.col("m")))]
    for period, column in (("daily", "event_date"), ("monthly", "event_month")):
        families = catalog[f"dm_segment_{period}"].groupBy(column, "segment_type").agg(F.sum("interaction_rows").alias("s"))
        whole = catalog[f"dm_interaction_outcome_{period}"].select(column, "interaction_rows")
        found.append(none_of(families.join(whole, column, "left"), f"coverage:segment_{period}", ~F.col("s").eqNullSafe(F.col("interaction_rows"))))
    recurrence = catalog["dm_observed_recurrence"]
    measures = [F.col(c).isNotNull() for c in ("observed_active_users", "observed_recurrence_share", "observed_booking_users")]
    found.append(none_of(recurrence, "recurrence:starts_whole", (F.col("observed_age_month") == 0) & (F.col("observed_recurrence_share") != 1)))
    found.append(none_of(recurrence, "recurrence:censored_is_null", F.col("is_right_censored") & reduce(lambda a, b: a | b, measures)))
    return found


def date_gates(catalog: dict[str, DataFrame]) -> list[DataFrame]:
    """Trip-date classes are known ones, and no calendar role rests on an implausible date."""
    fact, spine = catalog["fct_hotel_interactions"], catalog["dim_date"]
    classes = ("missing_checkin", "checkin_before_event", "lead_time_out_of_scope", "missing_checkout", "checkout_not_after_checkin", "stay_out_of_scope", "plausible")
    flagged = spine.where("is_checkin_date").join(fact.where("has_valid_lead_time").select(F.col("checkin_date").alias("date_day")), "date_day", "left_anti")
    flagged_out = spine.where("is_checkout_date").join(fact.where("is_plausible_trip_dates").select(F.col("checkout_date").alias("date_day")), "date_day", "left_anti")
    seasons = catalog["dm_checkin_seasonality"].agg(F.coalesce(F.sum("interaction_rows"), F.lit(0)).alias("s")).crossJoin(fact.agg(F.count_if("has_valid_lead_time").alias("n")))
    windows = catalog["dm_booking_window"].agg(F.coalesce(F.sum("interaction_rows"), F.lit(0)).alias("s")).crossJoin(fact.agg(F.count_if(F.col("has_valid_lead_time") & F.col("has_valid_stay_dates")).alias("n")))
    bounds = spine.agg(F.min("date_day").alias("first"), F.max("date_day").alias("last")).crossJoin(fact.agg(F.min("event_date").alias("from"), F.max("event_date").alias("to")))
    return [
        check(seasons, "dates:seasonality_population", F.max("s"), F.max("n")),
        check(windows, "dates:window_population", F.max("s"), F.max("n")),
        none_of(bounds, "dates:spine_covers_events", (F.col("first") > F.col("from")) | (F.col("last") < F.col("to"))),
        none_of(fact, "dates:known_classes", ~F.col("trip_date_quality").isin(*classes)),
        none_of(fact, "dates:class_agrees_with_flag", (F.col("trip_date_quality") == "plausible") != F.col("is_plausible_trip_dates")),
        check(flagged, "dates:checkin_role_justified", F.count("*"), 0),
        check(flagged_out, "dates:checkout_role_justified", F.count("*"), 0),
    ]


def catalog_gates(catalog: dict[str, DataFrame], objects: tuple[ObjectSpec, ...] = OBJECTS) -> list[DataFrame]:
    """Declared objects exist, their grain is unique, they are not empty unless quarantine, names are plain."""
    there = [F.struct(F.lit(f"exists:{s.name}").alias("gate"), F.lit(float(s.name in catalog)).alias("actual"), F.lit(1.0).alias("expected"), F.lit(s.name in catalog).alias("passed")) for s in objects]
    found = [next(iter(catalog.values())).sparkSession.range(1).select(F.inline(F.array(*there)))]
    for spec in objects:
        if spec.name not in catalog:
            continue
        df = catalog[spec.name]
        twice = df.groupBy(*spec.grain).agg(F.count("*").alias("n"))
        found.append(none_of(twice, f"grain:{spec.name}", F.col("n") > 1))
        if not spec.name.startswith("quarantine"):
            found.append(check(df, f"filled:{spec.name}", F.count("*"), 1, F.col("actual") >= 1))
    return found


def forbidden_names(catalog: dict[str, DataFrame]) -> list[str]:
    """Names of marts and their columns that claim what the data cannot show (matched as parts of words)."""
    names = [n for n in catalog if n.startswith("dm_")]
    names += [f"{n}.{c}" for n in names for c in catalog[n].columns]
    return [n for n in names if any(w in n.lower() for w in FORBIDDEN)]


def name_gates(catalog: dict[str, DataFrame]) -> list[DataFrame]:
    one = next(iter(catalog.values())).sparkSession.range(1)
    return [check(one, "names:forbidden", F.max(F.lit(len(forbidden_names(catalog)))), 0)]


def staging_gates(reconciled: dict[str, DataFrame]) -> list[DataFrame]:
    """Per source (``multiset_reconciliation``): raw rows are the accepted and quarantined ones, in number and in content."""
    found = []
    for name, df in reconciled.items():
        rows = lambda c: F.coalesce(F.sum(c), F.lit(0))
        found.append(check(df, f"staging:{name}_rows", rows("output_count"), rows("raw_count")))
        found.append(none_of(df, f"staging:{name}_multiset", ~F.col("reconciles")))
    return found


def threshold_gates(counts: DataFrame, ambiguity: DataFrame, contract: Contract = DEFAULT) -> list[DataFrame]:
    rates = [at_most(counts, f"quarantine_rate:{n}", F.max(F.col(f"quarantined_{n}") / F.greatest(F.col(f"raw_{n}"), F.lit(1))), contract.maximum_quarantine_rate) for n in ("train", "test", "destinations") if f"raw_{n}" in counts.columns]
    multi = ambiguity.where("ambiguity_type = 'multimarket_context'")
    return [*rates, at_most(multi, "multimarket_rate", F.max("affected_share"), contract.maximum_multimarket_rate)]


def all_gates(catalog: dict[str, DataFrame], reconciled: dict[str, DataFrame] | None = None, counts: DataFrame | None = None, contract: Contract = DEFAULT, objects: tuple[ObjectSpec, ...] = OBJECTS) -> DataFrame:
    """Every gate of a catalog; with the reconciliations and counts of its staging also those of the sources and the contract's limits."""
    parts = [*population_gates(catalog), *range_gates(catalog), *calendar_gates(catalog), *date_gates(catalog), *catalog_gates(catalog, objects), *name_gates(catalog)]
    if reconciled is not None:
        parts += staging_gates(reconciled)
    if counts is not None:
        parts += threshold_gates(counts, catalog["dm_proxy_context_ambiguity"], contract)
    return reduce(DataFrame.unionByName, parts)


def require(checks: DataFrame) -> None:
    """Raise if any check failed; at most one row per gate reaches the driver."""
    failed = [r["gate"] for r in checks.where("not passed").select("gate").collect()]
    if failed:
        raise GateError(f"failed gates: {', '.join(sorted(failed))}")
