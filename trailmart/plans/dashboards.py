"""The dashboard layer of a published build: made beside it, validated, audited, delivered and traced to its source."""

from __future__ import annotations

import hashlib
import json
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.contract import DEFAULT, Contract
from trailmart.functions.measures import wilson
from trailmart.operators import gates, publish
from trailmart.plans import bi
from trailmart.schema import BI_OBJECTS
from trailmart.sources.files import Files

STRONG_ONLY = ("bi_routes",)  # delivered with their strongly supported rows
RENAMED = {"bi_overview_monthly": "dm_interaction_outcome_monthly", "bi_segments_monthly": "dm_segment_monthly", "bi_booking_window": "dm_booking_window", "bi_checkin_seasonality": "dm_checkin_seasonality",
           "bi_destination_performance": "dm_destination_performance", "bi_hotel_market_performance": "dm_hotel_market_performance", "bi_destination_monthly": "dm_destination_monthly", "bi_routes": "dm_origin_destination_routes"}
EXACT = 1e-12


def tables(catalog: dict[str, DataFrame], checks: DataFrame, build_id: str, contract: Contract = DEFAULT) -> dict[str, DataFrame]:
    """The fourteen dashboard objects over the objects of a build. The first month of the data counts as partial if it does not begin on its first day."""
    c = catalog
    definition, outcome = c["dim_segment_definition"], c["dm_interaction_outcome_monthly"]
    first = c["dm_interaction_outcome_daily"].agg(F.min("event_date")).first()[0]
    return {
        "bi_overview_monthly": bi.overview_monthly(c["dm_sample_activity_monthly"], outcome, c["dm_proxy_context_monthly"], first.replace(day=1) if first and first.day > 1 else None),
        "bi_segments_monthly": bi.segments_monthly(c["dm_segment_monthly"], definition, outcome, contract),
        "bi_booking_window": bi.booking_window(c["dm_booking_window"], definition, contract),
        "bi_traveller_planning_monthly": bi.traveller_planning_monthly(c["dm_travel_patterns"], definition, contract),
        "bi_checkin_seasonality": bi.checkin_seasonality(c["dm_checkin_seasonality"]),
        "bi_destination_performance": bi.entity_performance(c["dm_destination_performance"], "srch_destination_id", "destination_id"),
        "bi_hotel_market_performance": bi.entity_performance(c["dm_hotel_market_performance"], "hotel_market", "hotel_market"),
        "bi_destination_monthly": bi.destination_monthly(c["dm_destination_monthly"], contract),
        "bi_routes": bi.routes(c["dm_origin_destination_routes"]),
        "bi_observed_recurrence": bi.observed_recurrence(c["dm_observed_recurrence"]),
        "bi_acceptance_status": bi.acceptance_status(checks, build_id),
        "bi_missingness_daily": c["dm_missingness_daily"],
        "bi_proxy_ambiguity": c["dm_proxy_context_ambiguity"],
        "bi_booking_population_drift_summary": bi.drift_summary(c["dm_booking_population_drift_summary"]),
    }


def validation(made: dict[str, DataFrame], catalog: dict[str, DataFrame], contract: Contract = DEFAULT, anchors: dict[str, float] | None = None) -> DataFrame:
    """Every object exists, has its grain once and without nulls, shares within bounds, support levels by the contract, and
    the totals of the mart it was made from. ``anchors`` are known totals of a data set, as object.column: value."""
    spark = next(iter(made.values())).sparkSession
    found = [gates.check(spark.range(1), f"bi:exists:{s.name}", F.max(F.lit(int(s.name in made))), 1) for s in BI_OBJECTS]
    for spec in BI_OBJECTS:
        if spec.name not in made:
            continue
        df, name = made[spec.name], spec.name
        keys = df.select(*spec.grain)
        # a sentinel as missing destination, origin or market is a value of its own in the marts
        found.append(gates.none_of(keys.groupBy(*spec.grain).agg(F.count("*").alias("_n")), f"bi:grain:{name}", F.col("_n") > 1))
        nulls = reduce(Column.__or__, (F.col(k).isNull() for k in spec.grain))
        found.append(gates.none_of(keys, f"bi:keys:{name}", nulls))
        found.append(gates.check(df, f"bi:filled:{name}", F.count("*"), 1, F.col("actual") >= 1))
        shares = [c for c in df.columns if c.endswith(("_share", "_ci_low", "_ci_high", "_coverage"))]
        if shares:
            found.append(gates.none_of(df, f"bi:bounds:{name}", reduce(Column.__or__, (~F.col(c).between(0, 1) for c in shares))))
        if "support_level" in df.columns:
            level = F.when(F.col("interaction_rows") >= contract.strong_interactions, "strong").when(F.col("interaction_rows") >= contract.minimum_interactions, "adequate").otherwise("low")
            found.append(gates.none_of(df, f"bi:support:{name}", F.col("support_level") != level))
        if name in RENAMED:
            both = df.agg(F.sum("interaction_rows").alias("a"), F.sum("booking_rows").alias("b")).crossJoin(catalog[RENAMED[name]].agg(F.sum("interaction_rows").alias("x"), F.sum("booking_rows").alias("y")))
            found.append(gates.none_of(both, f"bi:source:{name}", ~(F.col("a").eqNullSafe(F.col("x")) & F.col("b").eqNullSafe(F.col("y")))))
    for anchor, value in (anchors or {}).items():
        name, column = anchor.split(".")
        found.append(gates.check(made[name], f"bi:anchor:{anchor}", F.sum(column), value))
    return reduce(DataFrame.unionByName, found)


def audit(made: dict[str, DataFrame], names: tuple[str, ...] = gates.FORBIDDEN) -> DataFrame:
    """What a reader relies on: plain names, shares that are their parts, intervals about them, whole time axes, known
    segments, candidates that deserve it, recurrence that begins whole."""
    spark = next(iter(made.values())).sparkSession
    claimed = [n for t, df in made.items() for n in (t, *df.columns) if any(w in n.lower() for w in names)]
    found = [gates.check(spark.range(1), "audit:names", F.max(F.lit(len(claimed))), 0)]
    for name, df in made.items():
        if {"booking_rows", "interaction_rows", "booking_interaction_share"} <= set(df.columns):
            share = F.col("booking_rows") / F.nullif("interaction_rows", F.lit(0))
            found.append(gates.none_of(df, f"audit:share:{name}", F.abs(F.col("booking_interaction_share") - share) > EXACT))
        if "booking_interaction_share_ci_low" in df.columns:
            low, high = wilson(F.col("booking_rows"), F.col("interaction_rows"))
            off = (F.abs(F.col("booking_interaction_share_ci_low") - low) > 1e-9) | (F.abs(F.col("booking_interaction_share_ci_high") - high) > 1e-9)
            found.append(gates.none_of(df, f"audit:interval:{name}", off))
    for name, column in (("bi_overview_monthly", "event_month"), ("bi_segments_monthly", "event_month"), ("bi_checkin_seasonality", "checkin_month"), ("bi_observed_recurrence", "cohort_month")):
        found.append(gates.none_of(made[name], f"audit:months:{name}", F.col(column) != F.trunc(column, "MM")))
    segments = made["bi_segments_monthly"]
    found.append(gates.none_of(segments.where("segment_type not in ('channel', 'site')"), "audit:segments_defined", ~F.col("is_valid_segment")))
    for name in ("bi_destination_performance", "bi_hotel_market_performance"):
        weak = F.col("investigation_candidate") & ((F.col("support_level") != "strong") | (F.col("booking_interaction_share_ci_high") >= F.col("overall_booking_interaction_share")))
        found.append(gates.none_of(made[name], f"audit:candidates:{name}", weak))
    ages = made["bi_observed_recurrence"]
    age = F.months_between("activity_month", "cohort_month")
    found.append(gates.none_of(ages, "audit:recurrence_ages", (F.col("observed_age_month") != age) | (age < 0)))
    found.append(gates.none_of(ages, "audit:recurrence_starts_whole", (F.col("observed_age_month") == 0) & (F.col("observed_recurrence_share") != 1)))
    found.append(gates.none_of(made["bi_proxy_ambiguity"], "audit:ambiguity", F.col("affected_contexts") > F.col("total_contexts") if "total_contexts" in made["bi_proxy_ambiguity"].columns else F.lit(False)))
    return reduce(DataFrame.unionByName, found)


def source_truth(fact: DataFrame, made: dict[str, DataFrame]) -> DataFrame:
    """Figures counted from the interactions themselves against the same read off the dashboard tables: measure, provenance, direct, shown, agrees."""
    booked = F.col("is_booking") == 1
    direct = fact.agg(
        F.count("*").alias("interaction_rows"),
        F.count_if(booked).alias("booking_rows"),
        F.count_distinct("event_month").alias("months"),
        F.count_if(F.col("srch_destination_id").isNotNull()).alias("placed_rows"),
        F.count_if(booked & F.col("srch_destination_id").isNotNull()).alias("placed_bookings"),
        F.count_distinct("srch_destination_id").alias("destinations"),
        F.count_if(F.col("hotel_market").isNotNull()).alias("market_rows"),
        F.count_distinct("hotel_market").alias("markets"),
        F.count_if("has_valid_lead_time").alias("dated_rows"),
        F.count_if(F.col("has_valid_lead_time") & F.col("has_valid_stay_dates")).alias("planned_rows"),
        F.count_if(F.col("user_id").isNull()).alias("anonymous_rows"),
        F.count_if(F.col("device_segment") == "mobile").alias("mobile_rows"),
        F.count_if(booked & (F.col("device_segment") == "mobile")).alias("mobile_bookings"),
        F.count_if(F.col("traveller_segment") == "family").alias("family_rows"),
    )
    total = lambda name, column, where="true": made[name].where(where).agg(F.coalesce(F.sum(column), F.lit(0)).alias("v"))
    rows = lambda name: made[name].agg(F.count("*").alias("v"))
    shown = {
        "interaction_rows": ("sum", total("bi_overview_monthly", "interaction_rows")),
        "booking_rows": ("sum", total("bi_overview_monthly", "booking_rows")),
        "months": ("rows", rows("bi_overview_monthly")),
        "placed_rows": ("sum", total("bi_destination_performance", "interaction_rows")),
        "placed_bookings": ("sum", total("bi_destination_performance", "booking_rows")),
        "destinations": ("rows", rows("bi_destination_performance")),
        "market_rows": ("sum", total("bi_hotel_market_performance", "interaction_rows")),
        "markets": ("rows", rows("bi_hotel_market_performance")),
        "dated_rows": ("sum", total("bi_checkin_seasonality", "interaction_rows")),
        "planned_rows": ("sum", total("bi_booking_window", "interaction_rows")),
        "anonymous_rows": ("sum", total("bi_missingness_daily", "missing_rows", "field_name = 'user_id'")),
        "mobile_rows": ("segment", total("bi_segments_monthly", "interaction_rows", "segment_type = 'device' and segment_value = 'mobile'")),
        "mobile_bookings": ("segment", total("bi_segments_monthly", "booking_rows", "segment_type = 'device' and segment_value = 'mobile'")),
        "family_rows": ("segment", total("bi_segments_monthly", "interaction_rows", "segment_type = 'traveller' and segment_value = 'family'")),
    }
    long = direct.select(F.explode(F.create_map(*(x for n in shown for x in (F.lit(n), F.col(n))))).alias("measure", "direct"))
    seen = reduce(DataFrame.unionByName, (df.select(F.lit(n).alias("measure"), F.lit(p).alias("provenance"), F.col("v").cast("bigint").alias("shown")) for n, (p, df) in shown.items()))
    return long.join(seen, "measure").select("measure", "provenance", "direct", "shown", (F.col("direct") == F.col("shown")).alias("agrees"))


def build_bi(build: str | Path, out: str | Path, checks: DataFrame, contract: Contract = DEFAULT, anchors: dict[str, float] | None = None) -> dict:
    """Make the dashboard tables of a published build, each replaced in one step, check them and write their manifest."""
    source = publish.manifest(build)
    catalog = publish.attached(build)
    files = Files(publish.session(), out)
    files.make("")
    made = {name: publish.replace_parquet(df, files, name) for name, df in tables(catalog, checks, source["build_id"], contract).items()}
    gates.require(validation(made, catalog, contract, anchors).unionByName(audit(made)))
    info = {"build_id": source["build_id"], "objects": [{"name": n, "layer": "", "columns": df.columns, "rows": df.count()} for n, df in made.items()], "files": files.digests()}
    files.write_text("manifest.json", publish.to_json(info))
    return info


def deliver(bi_folder: str | Path, out: str | Path) -> dict[str, int]:
    """CSV of every dashboard table, in the order of its grain, counted again after writing; routes with strong support only."""
    made, files, rows = publish.attached(bi_folder), Files(publish.session(), out), {}
    for spec in BI_OBJECTS:
        df = made[spec.name].where("support_level = 'strong'") if spec.name in STRONG_ONLY else made[spec.name]
        publish.write_csv(df, files.at(spec.name), spec.grain)
        rows[spec.name] = files.spark.read.option("header", True).csv(files.at(spec.name)).count() if (n := df.count()) else 0
        if rows[spec.name] != n:
            raise ValueError(f"{spec.name}: {n} rows, {rows[spec.name]} delivered")
    digests = {n: d for n, d in files.digests("", "*.csv").items()}
    files.write_text("delivery.json", publish.to_json({"rows": rows, "files": digests, "digest": hashlib.sha256(json.dumps(digests, sort_keys=True).encode()).hexdigest()}))
    return rows
