"""The whole data product of a folder: every object by name, written once per layer and reread."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.contract import DEFAULT, Contract
from trailmart.functions.measures import month_start
from trailmart.operators import gates, publish
from trailmart.operators.profile import checksum, same_rows
from trailmart.plans import dims, facts, marts, pipeline_queries, staging
from trailmart.plans.mart_queries import populations
from trailmart.schema import DESTINATIONS, OBJECTS, TEST, TEST_OBJECTS, TRAIN, ObjectSpec
from trailmart.session import checkpointed, table
from trailmart.sources import landing


def build_catalog(
    fact: DataFrame,
    destinations: DataFrame,
    populations_: dict[str, DataFrame],
    keep: Callable[[ObjectSpec, DataFrame], DataFrame] = lambda spec, df: df,
    staged: dict[str, staging.Staged] | None = None,
) -> dict[str, DataFrame]:
    """Staging, facts, dimensions and marts by name; ``keep`` stores each and returns what later ones read.

    Without ``staged`` the staging, quarantine and quality objects are absent, and their gates fail.
    """
    specs = {s.name: s for s in (*OBJECTS, *TEST_OBJECTS)}
    made: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        made[name] = keep(specs[name], df)
        return made[name]

    if staged is not None:
        add("stg_train_accepted", staging.with_event_partitions(staged["train"].accepted))
        add("stg_destinations_accepted", staged["destinations"].accepted)
        if "test" in staged:
            add("stg_test_accepted", staging.with_event_partitions(staged["test"].accepted))
        for name in staged:
            add(f"quarantine_{name}", staged[name].quarantine)
    fact = add("fct_hotel_interactions", fact)
    context = add("fct_proxy_search_contexts", facts.contexts(fact))
    days = add("fct_user_day", facts.user_days(context))
    dates = add("dim_date", dims.dim_date(fact))
    add("dim_origin", dims.dim_origin(fact))
    add("dim_destination", dims.dim_destination(destinations, fact))
    add("bridge_destination_hotel_market", dims.bridge_destination_market(fact))
    add("dim_segment_definition", dims.dim_segment_definition(fact.sparkSession))
    for period, column in (("daily", "event_date"), ("monthly", "event_month")):
        add(f"dm_interaction_outcome_{period}", marts.outcome(fact, column))
        add(f"dm_proxy_context_{period}", marts.context_activity(context, fact, column))
    add("dm_sample_activity_daily", marts.activity_daily(fact))
    add("dm_sample_activity_monthly", marts.activity_monthly(fact))
    add("dm_user_day_daily", marts.user_day_daily(days))
    add("dm_user_day_monthly", marts.user_day_monthly(days))
    add("dm_segment_monthly", marts.segment_monthly(add("dm_segment_daily", marts.segment_daily(fact))))
    add("dm_destination_performance", marts.entity_performance(fact, ("srch_destination_id",)))
    add("dm_hotel_market_performance", marts.entity_performance(fact, ("hotel_market",)))
    add("dm_destination_monthly", marts.destination_monthly(fact))
    add("dm_origin_destination_routes", marts.entity_performance(fact, ("origin_id", "srch_destination_id"), dates=False))
    add("dm_travel_patterns", marts.travel_patterns(fact))
    add("dm_checkin_seasonality", marts.checkin_seasonality(fact))
    add("dm_booking_window", marts.booking_window(fact))
    add("dm_observed_recurrence", marts.observed_recurrence(days))
    add("dm_missingness_daily", marts.missingness_daily(fact))
    add("dm_proxy_context_ambiguity", marts.context_ambiguity(context))
    drift = add("dm_booking_population_drift", marts.population_drift(populations_))
    add("dm_booking_population_drift_summary", marts.drift_summary(drift, *populations_))
    if staged is not None:
        rules = marts.quality_summary(staging.population_counts(**staged))
        spine = dates.agg(F.count("*").alias("affected_rows")).select(
            F.lit("date_spine_calendar_days").alias("quality_rule"), "affected_rows", F.col("affected_rows").alias("denominator_rows"), F.lit("info").alias("severity"), F.lit(1.0).alias("affected_share")
        )
        add("dm_data_quality_summary", rules.unionByName(marts.date_quality(fact)).unionByName(spine))
    return made


def staged_of(spark: SparkSession, folder: str) -> dict[str, staging.Staged]:
    return {"train": pipeline_queries.train(spark, folder), "destinations": pipeline_queries.destinations(spark, folder)}


def _catalog(spark: SparkSession, folder: str, staged: dict[str, staging.Staged], keep: Callable[[ObjectSpec, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    places = table(spark, folder, "processed_destinations").dropDuplicates(["srch_destination_id"])
    return build_catalog(facts.interactions(table(spark, folder, "train")), places, populations(spark, folder), keep, staged)


def catalog_of(spark: SparkSession, folder: str, staged: dict[str, staging.Staged] | None = None) -> dict[str, DataFrame]:
    """The catalog over a data folder: staging and core facts written once, as many marts and gates read them, the rest lazy."""
    keep = lambda spec, df: checkpointed(df) if spec.layer in ("staging", "core") else df
    return _catalog(spark, folder, staged or staged_of(spark, folder), keep)


def checks(raw: dict[str, DataFrame], catalog: dict[str, DataFrame], staged: dict[str, staging.Staged], contract: Contract = DEFAULT) -> DataFrame:
    """All gates of a build: those of the catalog, of its staged objects against the raw tables, and the contract's limits."""
    reconciled = {}
    for name, df in raw.items():
        reconciled[name] = staging.multiset_reconciliation(staging.fingerprints(df, SOURCES[name]), catalog[f"stg_{name}_accepted"], catalog[f"quarantine_{name}"])
    objects = (*OBJECTS, *TEST_OBJECTS) if "test" in raw else OBJECTS
    return gates.all_gates(catalog, reconciled, staging.population_counts(**staged), contract, objects)


def raw_of(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: table(spark, folder, f"raw_{name}") for name in ("train", "destinations")}


def checks_of(spark: SparkSession, folder: str, contract: Contract = DEFAULT) -> DataFrame:
    staged = staged_of(spark, folder)
    return checks(raw_of(spark, folder), catalog_of(spark, folder, staged), staged, contract)


def _about(spark: SparkSession, contract: Contract, raw: dict[str, DataFrame]) -> dict:
    """What a build was made of: digests of the contract and of each source's rows, whatever their order."""
    sources = {name: {k: str(v) for k, v in checksum(df.select(*(c.name for c in SOURCES[name]))).first().asDict().items()} for name, df in raw.items()}
    return {"contract": hashlib.sha256(contract.to_json().encode()).hexdigest(), "sources": sources}


def build(spark: SparkSession, folder: str, out: str | Path, build_id: str, contract: Contract = DEFAULT) -> str:
    """Build from a folder of tables, check and publish under ``out/build_id``; nothing is published if a gate fails."""
    raw = raw_of(spark, folder)
    with publish.Build(out, build_id, _about(spark, contract, raw)) as target:
        staged = staged_of(spark, folder)
        catalog = _catalog(spark, folder, staged, lambda spec, df: target.write(df, spec))
        gates.require(checks(raw, catalog, staged, contract))
    return target.final


SOURCES = {"train": TRAIN, "test": TEST, "destinations": DESTINATIONS}
KEYS = {"train": None, "test": "id", "destinations": "srch_destination_id"}


def landed(spark: SparkSession, folder: str | Path) -> dict[str, DataFrame]:
    """The raw files train, test and destinations (.csv or .csv.gz) as text rows with their scan ordinals, stored once."""
    return {
        name: checkpointed(landing.with_scan_ordinal(landing.read_text_csv(spark, landing.find_raw(spark, folder, name), [c.name for c in columns]))) for name, columns in SOURCES.items()
    }


def build_from_raw(spark: SparkSession, folder: str | Path, out: str | Path, build_id: str, contract: Contract = DEFAULT) -> str:
    """The whole way from raw files: landing, staging with quarantine, facts, dimensions, marts, gates, publication.

    The fact stands on the accepted training rows; drift compares their bookings with the test set, which holds bookings only.
    """
    raw = landed(spark, folder)
    with publish.Build(out, build_id, _about(spark, contract, raw)) as target:
        staged = {name: staging.stage(df, SOURCES[name], KEYS[name]) for name, df in raw.items()}
        accepted, test = staged["train"].accepted, staged["test"].accepted
        month = month_start(F.col("date_time").cast("date"))
        compared = {"train_booking": accepted.where("is_booking = 1").withColumn("period_month", month), "test_booking": test.withColumn("period_month", month)}
        catalog = build_catalog(facts.interactions(accepted, contract), staged["destinations"].accepted, compared, lambda spec, df: target.write(df, spec), staged)
        gates.require(checks(raw, catalog, staged, contract))
    return target.final


def compare(first: str | Path, second: str | Path) -> dict[str, dict]:
    """Two published builds object by object: schema, rows, checksums and exact equality."""
    a, b = publish.attached(first), publish.attached(second)
    return {name: same_rows(a[name], b[name]) if name in a and name in b else {"exact": False} for name in sorted({*a, *b})}
