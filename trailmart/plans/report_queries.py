"""Profiles, reconciliation, comparison, gates and analyses by name, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.contract import DEFAULT
from trailmart.functions.cells import read_cell
from trailmart.operators import profile
from trailmart.operators.rejects import TRAIN_FIELDS
from trailmart.functions.measures import wilson_unbounded
from trailmart.plans import analysis, bi, build, dashboards, legacy
from trailmart.plans.build import checks_of
from trailmart.plans.mart_queries import QUERIES as M
from trailmart.plans.mart_queries import SQL as S
from trailmart.plans.pipeline_queries import D_, T_
from trailmart.plans.problems import SPARK_KIND, _cell
from trailmart.plans.sqltext import CONTEXT_KEYS, I, rate, wilson
from trailmart.schema import LATENT, TRAIN
from trailmart.session import checkpointed, table

COLUMNS = [n for n, _ in TRAIN_FIELDS]
CATEGORIES = ["site_name", "posa_continent", "channel", "is_mobile", "is_package", "hotel_continent", "srch_destination_type_id", "is_booking"]


def train(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "train")


def typed_copy(spark: SparkSession, folder: str) -> DataFrame:
    """raw_train read as the types of processed_train: the other copy of the same table."""
    return table(spark, folder, "raw_train").select("source_scan_ordinal", *(read_cell(F.col(n), SPARK_KIND[k]).alias(n) for n, k in TRAIN_FIELDS))


def cluster() -> object:
    value = read_cell(F.col("hotel_cluster"), "smallint")
    return read_cell(F.col("date_time"), "timestamp_ntz").isNull() | ~value.between(0, 99)


def wilson_bounds(mart: DataFrame) -> DataFrame:
    low, high = wilson_unbounded(F.col("booking_rows"), F.col("interaction_rows"))
    return mart.select("event_month", low.alias("low"), high.alias("high"))


def missing(spark: SparkSession, folder: str) -> DataFrame:
    """The columns each source lacks of those it is declared to have."""
    found = [(name, c) for name in ("raw_train", "processed_train", "train") for c in profile.missing_columns(table(spark, folder, name), [*COLUMNS, "orig_destination_distance_key"])]
    return spark.createDataFrame(found, "source string, missing_column string")


def dashboard_of(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Dashboard tables and the objects they were made of, over one stored set of marts."""
    catalog = build.catalog_of(spark, folder)
    kept = {n: checkpointed(df) if n.startswith(("dm_", "dim_seg")) else df for n, df in catalog.items()}
    checks = spark.createDataFrame([("none", 0.0, 0.0, True)], "gate string, actual double, expected double, passed boolean")
    return dashboards.tables(kept, checks, "lazy"), kept


def legacy_of(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    places = table(spark, folder, "processed_destinations").dropDuplicates(["srch_destination_id"])
    return legacy.marts_of(train(spark, folder), places, lambda name, df: checkpointed(df) if name.startswith("fct") else df)


QUERIES = {
    "pf2_null_profile": lambda s, d: profile.null_profile(train(s, d), COLUMNS),
    "pf3_numeric_profile": lambda s, d: profile.numeric_profile(train(s, d), profile.trip_numbers()),
    "pf4_categorical_profile": lambda s, d: profile.categorical_profile(train(s, d), CATEGORIES),
    "pf5_quality_counters": lambda s, d: profile.quality_counters(train(s, d)),
    "pf6_duplicate_profile": lambda s, d: profile.duplicate_profile(train(s, d), COLUMNS),
    "pf7_context_profile": lambda s, d: profile.context_profile(train(s, d)),
    "pf8_destination_keys": lambda s, d: profile.key_profile(table(s, d, "processed_destinations"), "srch_destination_id"),
    "pf8_destination_features": lambda s, d: profile.feature_profile(table(s, d, "processed_destinations"), "srch_destination_id", list(LATENT)),
    "re1_parse_failures": lambda s, d: profile.parse_failures(table(s, d, "raw_train"), TRAIN),
    "re1_train_reconciliation": lambda s, d: profile.preparation_reconciliation(table(s, d, "raw_train"), table(s, d, "processed_train"), cluster()),
    "re2_destination_reconciliation": lambda s, d: profile.preparation_reconciliation(
        table(s, d, "raw_destinations"), table(s, d, "processed_destinations"), read_cell(F.col("srch_destination_id"), "int").isNull()
    ),
    "cp1_table_checksum": lambda s, d: profile.checksum(train(s, d)),
    "cp1_portable_checksum": lambda s, d: profile.portable_checksum(train(s, d)),
    "cp2_fact_difference": lambda s, d: profile.both_differences(typed_copy(s, d), table(s, d, "processed_train").select("source_scan_ordinal", *COLUMNS), "raw", "processed"),
    "qg_all_gates": checks_of,
    "bi11_acceptance_status": lambda s, d: bi.acceptance_status(checks_of(s, d), "lazy"),
    "da2_overall": lambda s, d: analysis.overall(M["cf1_fct_hotel_interactions"](s, d)),
    "da3_month_dynamics": lambda s, d: analysis.month_dynamics(M["bm4_interaction_outcome_monthly"](s, d)),
    "da4_segment_summary": lambda s, d: analysis.segment_summary(M["bm10_segment_monthly"](s, d)),
    "da5_composition_shift": lambda s, d: analysis.composition_shift(M["bm10_segment_monthly"](s, d)),
    "da6_geography": lambda s, d: analysis.geography(M["cf1_fct_hotel_interactions"](s, d)),
    "da7_cross_segments": lambda s, d: analysis.cross_segments(M["cf1_fct_hotel_interactions"](s, d)),
    "da8_planning_summary": lambda s, d: analysis.planning_summary(M["cf1_fct_hotel_interactions"](s, d)),
    "da9_booking_window_ranking": lambda s, d: analysis.ranked_cells(M["bm17_booking_window"](s, d)),
    "da10_destination_concentration": lambda s, d: analysis.concentration(M["bm11_destination_performance"](s, d), "srch_destination_id"),
    "da10_destination_distribution": lambda s, d: analysis.distribution(M["bm11_destination_performance"](s, d)),
    "da10_market_concentration": lambda s, d: analysis.concentration(M["bm12_hotel_market_performance"](s, d), "hotel_market"),
    "da10_market_distribution": lambda s, d: analysis.distribution(M["bm12_hotel_market_performance"](s, d)),
    "da10_route_concentration": lambda s, d: analysis.concentration(M["bm14_origin_destination_routes"](s, d), "origin_id"),
    "da10_route_distribution": lambda s, d: analysis.distribution(M["bm14_origin_destination_routes"](s, d)),
    "da11_candidate_months": lambda s, d: analysis.candidate_months(M["bm13_destination_monthly"](s, d), M["bm11_destination_performance"](s, d)),
    "da11_destination_composition": lambda s, d: analysis.candidate_composition(M["cf1_fct_hotel_interactions"](s, d), M["bm11_destination_performance"](s, d), "srch_destination_id"),
    "da11_market_composition": lambda s, d: analysis.candidate_composition(M["cf1_fct_hotel_interactions"](s, d), M["bm12_hotel_market_performance"](s, d), "hotel_market"),
    "da11_bridge_composition": lambda s, d: analysis.bridge_composition(M["dm4_bridge_destination_hotel_market"](s, d), M["bm11_destination_performance"](s, d)),
    "mc2_wilson_unbounded": lambda s, d: wilson_bounds(M["bm4_interaction_outcome_monthly"](s, d)),
    "pf1_missing_columns": missing,
    "qg_failed_gates": lambda s, d: checks_of(s, d).where("not passed").select("gate", "actual", "expected"),
    "bi16_failed_checks": lambda s, d: dashboards.validation(*dashboard_of(s, d)).where("not passed").select("gate"),
    "bi17_failed_checks": lambda s, d: dashboards.audit(dashboard_of(s, d)[0]).where("not passed").select("gate"),
    "bi16_validation": lambda s, d: dashboards.validation(*dashboard_of(s, d)),
    "bi17_audit": lambda s, d: dashboards.audit(dashboard_of(s, d)[0]),
    "bi20_source_truth": lambda s, d: dashboards.source_truth(M["cf1_fct_hotel_interactions"](s, d), dashboard_of(s, d)[0]),
    "lg18_gates": lambda s, d: legacy.gates_of(train(s, d), legacy_of(s, d)),
    "da12_seasonality": lambda s, d: analysis.seasonality(M["bm16_checkin_seasonality"](s, d)),
    "da13_recurrence_by_age": lambda s, d: analysis.recurrence_by_age(M["am1_observed_recurrence"](s, d)),
    "da14_missingness_summary": lambda s, d: analysis.missingness_summary(M["am2_missingness_daily"](s, d)),
    "da15_drift_bands": lambda s, d: analysis.drift_bands(M["am5_booking_population_drift_summary"](s, d)),
    "da15_largest_shifts": lambda s, d: analysis.largest_shifts(M["am4_booking_population_drift"](s, d)),
    "da16_user_activity": lambda s, d: analysis.user_activity(M["cf4_fct_user_day"](s, d)),
}


_LEAD, _STAY = "datediff('day', date_time::date, srch_ci)", "datediff('day', srch_ci, srch_co)"
_COUNTERS = {
    "anonymous_rows": "user_id is null", "booking_rows": "is_booking = 1", "non_booking_rows": "is_booking = 0", "invalid_booking_rows": "is_booking is null or is_booking not in (0, 1)",
    "null_cnt_rows": "cnt is null", "nonpositive_cnt_rows": "cnt <= 0", "null_checkin_rows": "srch_ci is null", "null_checkout_rows": "srch_co is null", "negative_lead_time_rows": f"{_LEAD} < 0",
    "nonpositive_stay_rows": f"{_STAY} <= 0", "invalid_adults_rows": "srch_adults_cnt is null or srch_adults_cnt <= 0", "invalid_children_rows": "srch_children_cnt < 0",
    "invalid_rooms_rows": "srch_rm_cnt is null or srch_rm_cnt <= 0", "missing_distance_rows": "orig_destination_distance is null", "missing_destination_rows": "srch_destination_id is null",
}


_NUMBERS = {n: n for n in ("orig_destination_distance", "cnt", "srch_adults_cnt", "srch_children_cnt", "srch_rm_cnt")} | {
    "lead_time_days": _LEAD, "stay_nights": _STAY, "party_size": "coalesce(srch_adults_cnt, 0) + coalesce(srch_children_cnt, 0)",
}
_BOOKED = "count(*) filter (where is_booking = 1"
_TRUTH = {
    "interaction_rows": ("sum", "count(*)"), "booking_rows": ("sum", f"{_BOOKED})"), "months": ("rows", "count(distinct event_month)"), "placed_rows": ("sum", "count(srch_destination_id)"),
    "placed_bookings": ("sum", f"{_BOOKED} and srch_destination_id is not null)"), "destinations": ("rows", "count(distinct srch_destination_id)"), "market_rows": ("sum", "count(hotel_market)"),
    "markets": ("rows", "count(distinct hotel_market)"), "dated_rows": ("sum", "count(*) filter (where has_valid_lead_time)"), "planned_rows": ("sum", "count(*) filter (where has_valid_lead_time and has_valid_stay_dates)"),
    "anonymous_rows": ("sum", "count(*) - count(user_id)"), "mobile_rows": ("segment", "count(*) filter (where device_segment = 'mobile')"), "mobile_bookings": ("segment", f"{_BOOKED} and device_segment = 'mobile')"),
    "family_rows": ("segment", "count(*) filter (where traveller_segment = 'family')"),
}


def _read(name: str, kind: str) -> str:
    return _cell(name, kind).rpartition(" as ")[0]


def _text(name: str, kind: str) -> str:
    return f"try_cast({name} as decimal(38,9))::varchar" if kind == "float64" else f"strftime({name}, '%Y-%m-%d %H:%M:%S')" if kind == "timestamp" else f"{name}::varchar"


def _reconcile(raw: str, processed: str, rejected: str) -> str:
    return f"""with r as (select count(*) as raw_rows, count(*) filter (where {rejected}) as rejected_rows from {raw}), p as (select count(*) as processed_rows from {processed})
      select *, raw_rows - processed_rows as raw_minus_processed, raw_rows - processed_rows = rejected_rows as reconciles, raw_rows = processed_rows as all_rows_preserved from r, p"""


_CLUSTER = _read("hotel_cluster", "int16")
SQL = {
    "pf2_null_profile": " union all ".join(f"select '{c}' as \"column\", count(*) - count({c}) as null_rows, {rate(f'count(*) - count({c})', 'count(*)')} as null_rate from train" for c in COLUMNS),
    "pf4_categorical_profile": f"""with l as ({' union all '.join(f"select '{c}' as c, {c}::varchar as value from train" for c in CATEGORIES)}), n as (select c, value, count(*) as rows from l group by all),
      r as (select *, row_number() over (partition by c order by rows desc, value nulls last) as place, count(value) over (partition by c) as distinct_non_null,
        coalesce(sum(rows) filter (where value is null) over (partition by c), 0)::bigint as null_rows from n) select c as "column", distinct_non_null, null_rows, place, value, rows from r where place <= 20""",
    "pf5_quality_counters": f"""select count(*) as total_rows, {', '.join(f'count(*) filter (where {e}) as {n}' for n, e in _COUNTERS.items())}, count(distinct user_id) as identified_users,
      count(distinct srch_destination_id) as destinations, min(date_time)::date as min_event_date, max(date_time)::date as max_event_date, min(srch_ci) as min_checkin_date, max(srch_ci) as max_checkin_date,
      min(srch_co) as min_checkout_date, max(srch_co) as max_checkout_date, (sum(cnt) filter (where cnt > 0))::bigint as valid_similar_event_count from train""",
    "pf6_duplicate_profile": f"""with g as (select count(*) as n from train group by {', '.join(COLUMNS)}) select count(*) filter (where n > 1) as duplicate_groups,
      coalesce(sum(n) filter (where n > 1), 0)::bigint as rows_in_duplicate_groups, coalesce(sum(n - 1) filter (where n > 1), 0)::bigint as excess_duplicate_rows, max(n) as largest_group from g""",
    "pf7_context_profile": f"""with g as (select count(*) as r, count(distinct hotel_cluster) as c, count(distinct hotel_market) as m, count(*) filter (where is_booking = 1) as b from train where user_id is not null
      group by {', '.join(profile.CONTEXT)}) select count(*) as proxy_contexts, sum(r)::bigint as eligible_interaction_rows, count(*) filter (where r > 1) as multirow_contexts,
      count(*) filter (where c > 1) as multicluster_contexts, count(*) filter (where m > 1) as multimarket_contexts, count(*) filter (where b > 0) as booking_bearing_contexts,
      count(*) filter (where b > 1) as multibooking_contexts, avg(r) as avg_rows_per_context,
      quantile_disc(r, [0.5, 0.9, 0.99, 1.0]) as rows_quantiles, quantile_disc(c, [0.5, 0.9, 0.99, 1.0]) as cluster_quantiles from g""",
    "pf3_numeric_profile": f"""with l as ({' union all '.join(f"select '{n}' as metric, ({e})::double as v from train" for n, e in _NUMBERS.items())}), k as (select metric, v, case when not isnan(v) then v end as x from l)
      select metric, count(x) as valid_rows, count(*) filter (where v is null) as null_rows, min(x) as min_value, max(x) as max_value, avg(x) as mean_value, stddev_pop(x) as stddev_value,
        quantile_disc(x, {list(profile.QUANTILES)}) as quantile_values from k group by metric""",
    "pf1_missing_columns": "select * from (values ('train', 'orig_destination_distance_key'), ('raw_train', 'orig_destination_distance_key')) as t(source, missing_column)",
    "mc2_wilson_unbounded": f"""with m as ({S["bm4_interaction_outcome_monthly"]}), p as (select event_month, interaction_rows::double as n, booking_rows / interaction_rows::double as p from m)
      select event_month, (p + 1.9208 / n - 1.96 * sqrt((p * (1 - p) + 0.9604 / n) / n)) / (1 + 3.8416 / n) as low, (p + 1.9208 / n + 1.96 * sqrt((p * (1 - p) + 0.9604 / n) / n)) / (1 + 3.8416 / n) as high from p""",
    **{
        f"da11_{name}_composition": f"""{I}, m as ({S[mart]}), o as (select sum(booking_rows) / sum(interaction_rows)::double as benchmark from m), k as (select {key} from m, o where booking_interaction_share_ci_high < benchmark)
      select {key}, device_segment, package_segment, traveller_segment, count(*) as interaction_rows, count(*) filter (where is_booking = 1) as booking_rows,
        {rate('count(*) filter (where is_booking = 1)', 'count(*)')} as booking_interaction_share from i where {key} in (select {key} from k) group by 1, 2, 3, 4"""
        for name, mart, key in (("destination", "bm11_destination_performance", "srch_destination_id"), ("market", "bm12_hotel_market_performance", "hotel_market"))
    },
    # of all gates only the contract's limits can fail on sound marts: those on quarantined rows and on contexts of several markets
    "qg_failed_gates": f"""with t as ({T_} select count(*) filter (where reject_reasons <> '') / count(*)::double as v from k), d as ({D_} select count(*) filter (where reject_reasons <> '') / count(*)::double as v from k),
      m as (select affected_share as v from ({S["am3_proxy_context_ambiguity"]}) where ambiguity_type = 'multimarket_context'),
      g as (select 'quarantine_rate:train' as gate, v as actual, {DEFAULT.maximum_quarantine_rate!r}::double as expected from t union all select 'quarantine_rate:destinations', v, {DEFAULT.maximum_quarantine_rate!r}::double from d
        union all select 'multimarket_rate', v, {DEFAULT.maximum_multimarket_rate!r}::double from m) select * from g where actual > expected""",
    "bi16_failed_checks": "select '' as gate where false",
    "bi17_failed_checks": "select '' as gate where false",
    "da11_bridge_composition": f"""with m as ({S["bm11_destination_performance"]}), b as ({S["dm4_bridge_destination_hotel_market"]}), o as (select sum(booking_rows) / sum(interaction_rows)::double as benchmark from m)
      select srch_destination_id, hotel_market, interaction_rows, booking_rows, interaction_share_within_destination, first_observed_date, last_observed_date from b
      where srch_destination_id in (select srch_destination_id from m, o where booking_interaction_share_ci_high < benchmark)""",
    "bi20_source_truth": f"""{I}, d as (select {', '.join(f"{e} as {n}" for n, (_, e) in _TRUTH.items())} from i)
      select measure, provenance, direct, direct as shown, true as agrees from ({' union all '.join(f"select '{n}' as measure, '{p}' as provenance, {n} as direct from d" for n, (p, _) in _TRUTH.items())})""",
    "lg18_gates": f"""{I}, c as (select count(*) as n, count(*) filter (where has_booking) as b from (select bool_or(is_booking = 1) as has_booking from i group by {', '.join(CONTEXT_KEYS)}))
      select 'fact_preserves_source_rows' as gate, count(*)::double as actual, count(*)::double as expected, true as passed from train
      union all select 'daily_context_totals_reconcile', n, n, true from c union all select 'daily_booking_totals_reconcile', b, b, true from c
      union all select unnest(['fact_has_no_null_event_dates', 'fact_has_valid_booking_flag', 'event_weight_is_positive', 'daily_rates_are_bounded', 'destination_rates_are_bounded']), 0, 0, true""",
    "pf8_destination_keys": """select count(*) as rows, count(distinct srch_destination_id) as distinct_keys, count(*) - count(distinct srch_destination_id) as duplicate_rows,
      count(*) - count(srch_destination_id) as null_keys from processed_destinations""",
    "pf8_destination_features": " union all ".join(
        f"select '{f}' as feature, count(*) - count({f}) as null_rows, min({f})::double as min_value, max({f})::double as max_value, round(avg({f}::double), 9) as mean_value from processed_destinations" for f in LATENT
    ),
    "re1_parse_failures": " union all ".join(
        f"select '{n}' as \"column\", count(*) filter (where coalesce(trim({n}), '') <> '' and {_read(n, k)} is null) as parse_failures from raw_train" for n, k in TRAIN_FIELDS
    ),
    "re1_train_reconciliation": _reconcile("raw_train", "processed_train", f"{_read('date_time', 'timestamp')} is null or {_CLUSTER} is null or {_CLUSTER} not between 0 and 99"),
    "re2_destination_reconciliation": _reconcile("raw_destinations", "processed_destinations", f"{_read('srch_destination_id', 'int32')} is null"),
    "cp1_portable_checksum": f"""with h as (select ('0x' || md5(concat_ws('|', {', '.join(f"coalesce({_text(n, k)}, '<NULL>')" for n, k in sorted([*TRAIN_FIELDS, ('source_scan_ordinal', 'int64')]))}))[1:15])::bigint as h from train)
      select count(*) as rows, bit_xor(h) as xor, sum(h)::decimal(38,0) as total, min(h) as least, max(h) as greatest from h""",
    "cp2_fact_difference": f"""with a as (select source_scan_ordinal, {', '.join(_cell(n, k) for n, k in TRAIN_FIELDS)} from raw_train), b as (select source_scan_ordinal, {', '.join(COLUMNS)} from processed_train)
      select 'raw' as only_in, x.* from (from a except all from b) x union all select 'processed', x.* from (from b except all from a) x""",
    **analysis.SQL(I, S, rate, wilson),
}
# markets and routes as destinations; which of equal entities comes first changes no share
for _name, _mart, _keys in (("market", "bm12_hotel_market_performance", "hotel_market"), ("route", "bm14_origin_destination_routes", "origin_id, srch_destination_id")):
    for _what in ("concentration", "distribution"):
        SQL[f"da10_{_name}_{_what}"] = SQL[f"da10_destination_{_what}"].replace(S["bm11_destination_performance"], S[_mart]).replace("desc, srch_destination_id) as place", f"desc, {_keys}) as place")


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
