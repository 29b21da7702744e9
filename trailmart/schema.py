"""Declared columns and the catalog of published objects."""

from __future__ import annotations

from dataclasses import dataclass

from trailmart.operators.rejects import DOMAINS, REQUIRED, TRAIN_FIELDS

KINDS = {"timestamp": "timestamp_ntz", "date": "date", "float64": "double", "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint"}


@dataclass(frozen=True)
class ColumnSpec:
    """A declared column: type, whether it must be there, and the range its values keep."""

    name: str
    kind: str
    required: bool = False
    domain: tuple[int, int] | None = None


@dataclass(frozen=True)
class ObjectSpec:
    """A published object: layer, name, grain, and the columns its files are partitioned by."""

    layer: str
    name: str
    grain: tuple[str, ...]
    partitions: tuple[str, ...] = ()


TRAIN = tuple(ColumnSpec(n, KINDS[k], n in REQUIRED, DOMAINS.get(n)) for n, k in TRAIN_FIELDS)
TEST = (ColumnSpec("id", "bigint", True), *(c for c in TRAIN if c.name not in ("is_booking", "cnt", "hotel_cluster")))
LATENT = tuple(f"d{i}" for i in range(1, 150))
DESTINATIONS = (ColumnSpec("srch_destination_id", "int", True), *(ColumnSpec(c, "double") for c in LATENT))

MONTHS = ("event_year", "event_month_num")
OBJECTS = (
    ObjectSpec("staging", "stg_train_accepted", ("raw_row_fingerprint", "duplicate_occurrence"), MONTHS),
    ObjectSpec("staging", "quarantine_train", ("raw_row_fingerprint", "duplicate_occurrence")),
    ObjectSpec("staging", "stg_destinations_accepted", ("srch_destination_id",)),
    ObjectSpec("staging", "quarantine_destinations", ("raw_row_fingerprint", "duplicate_occurrence")),
    ObjectSpec("core", "fct_hotel_interactions", ("interaction_id",), MONTHS),
    ObjectSpec("core", "fct_proxy_search_contexts", ("proxy_context_id",), MONTHS),
    ObjectSpec("core", "fct_user_day", ("user_id", "event_date"), MONTHS),
    ObjectSpec("dimension", "dim_date", ("date_day",)),
    ObjectSpec("dimension", "dim_origin", ("origin_id",)),
    ObjectSpec("dimension", "dim_destination", ("srch_destination_id",)),
    ObjectSpec("bridge", "bridge_destination_hotel_market", ("srch_destination_id", "hotel_market")),
    ObjectSpec("dimension", "dim_segment_definition", ("segment_type", "segment_value")),
    *(
        ObjectSpec("mart", name, grain)
        for name, grain in (
            ("dm_sample_activity_daily", ("event_date",)),
            ("dm_sample_activity_monthly", ("event_month",)),
            ("dm_interaction_outcome_daily", ("event_date",)),
            ("dm_interaction_outcome_monthly", ("event_month",)),
            ("dm_proxy_context_daily", ("event_date",)),
            ("dm_proxy_context_monthly", ("event_month",)),
            ("dm_user_day_daily", ("event_date",)),
            ("dm_user_day_monthly", ("event_month",)),
            ("dm_segment_daily", ("event_date", "segment_type", "segment_value")),
            ("dm_segment_monthly", ("event_month", "segment_type", "segment_value")),
            ("dm_destination_performance", ("srch_destination_id",)),
            ("dm_hotel_market_performance", ("hotel_market",)),
            ("dm_destination_monthly", ("event_month", "srch_destination_id")),
            ("dm_origin_destination_routes", ("origin_id", "srch_destination_id")),
            ("dm_travel_patterns", ("event_month", "traveller_segment", "lead_time_segment", "stay_segment")),
            ("dm_checkin_seasonality", ("checkin_month", "traveller_segment")),
            ("dm_booking_window", ("lead_time_segment", "stay_segment")),
            ("dm_observed_recurrence", ("first_observed_month", "activity_month")),
            ("dm_missingness_daily", ("event_date", "field_name")),
            ("dm_proxy_context_ambiguity", ("ambiguity_type",)),
            ("dm_booking_population_drift", ("dataset", "period_month", "dimension_name", "dimension_value")),
            ("dm_booking_population_drift_summary", ("dimension_name",)),
            ("dm_data_quality_summary", ("quality_rule",)),
        )
    ),
)
#: Objects of a build whose sources have a test set.
TEST_OBJECTS = (
    ObjectSpec("staging", "stg_test_accepted", ("id",), MONTHS),
    ObjectSpec("staging", "quarantine_test", ("raw_row_fingerprint", "duplicate_occurrence")),
)
#: Dashboard objects, made of a published build.
BI_OBJECTS = tuple(
    ObjectSpec("bi", name, grain)
    for name, grain in (
        ("bi_overview_monthly", ("event_month",)),
        ("bi_segments_monthly", ("event_month", "segment_type", "segment_value")),
        ("bi_booking_window", ("lead_time_segment", "stay_segment")),
        ("bi_traveller_planning_monthly", ("event_month", "traveller_segment")),
        ("bi_checkin_seasonality", ("checkin_month", "traveller_segment")),
        ("bi_destination_performance", ("destination_id",)),
        ("bi_hotel_market_performance", ("hotel_market",)),
        ("bi_destination_monthly", ("event_month", "destination_id")),
        ("bi_routes", ("origin_id", "destination_id")),
        ("bi_observed_recurrence", ("cohort_month", "activity_month")),
        ("bi_acceptance_status", ("build_id",)),
        ("bi_missingness_daily", ("event_date", "field_name")),
        ("bi_proxy_ambiguity", ("ambiguity_type",)),
        ("bi_booking_population_drift_summary", ("dimension_name",)),
    )
)
