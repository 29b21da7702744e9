"""Facts, dimensions and marts by name, over the typed interactions of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.functions.measures import month_start
from trailmart.plans import dims, facts, marts
from trailmart.plans.sqltext import B, BOOKINGS, CI, RATES, SEGMENTS, SUPPORT, USERS, I, P, U, rate
from trailmart.session import table

#: Bookings before and from this day stand for the two populations compared for drift.
DRIFT_DAY = "2014-07-01"


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return facts.interactions(table(spark, folder, "train"))


def context(spark: SparkSession, folder: str) -> DataFrame:
    return facts.contexts(fact(spark, folder))


def days(spark: SparkSession, folder: str) -> DataFrame:
    return facts.user_days(context(spark, folder))


def populations(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    booked = table(spark, folder, "train").where("is_booking = 1").withColumn("period_month", month_start(F.col("date_time").cast("date")))
    cut = F.col("date_time") < F.lit(DRIFT_DAY).cast("timestamp_ntz")
    return {"train_booking": booked.where(cut), "test_booking": booked.where(~cut)}


def drift(spark: SparkSession, folder: str) -> DataFrame:
    return marts.population_drift(populations(spark, folder))


def segment_definition(spark: SparkSession, folder: str) -> DataFrame:
    return dims.dim_segment_definition(spark)


QUERIES = {
    "cf1_fct_hotel_interactions": fact,
    "cf3_fct_proxy_search_contexts": context,
    "cf4_fct_user_day": days,
    "dm1_dim_date": lambda s, d: dims.dim_date(fact(s, d)),
    "dm2_dim_origin": lambda s, d: dims.dim_origin(fact(s, d)),
    "dm3_dim_destination": lambda s, d: dims.dim_destination(table(s, d, "processed_destinations").dropDuplicates(["srch_destination_id"]), fact(s, d)),
    "dm4_bridge_destination_hotel_market": lambda s, d: dims.bridge_destination_market(fact(s, d)),
    "dm5_dim_segment_definition": segment_definition,
    "bm1_sample_activity_daily": lambda s, d: marts.activity_daily(fact(s, d)),
    "bm2_sample_activity_monthly": lambda s, d: marts.activity_monthly(fact(s, d)),
    "bm3_interaction_outcome_daily": lambda s, d: marts.outcome(fact(s, d), "event_date"),
    "bm4_interaction_outcome_monthly": lambda s, d: marts.outcome(fact(s, d), "event_month"),
    "bm5_proxy_context_daily": lambda s, d: marts.context_activity(context(s, d), fact(s, d), "event_date"),
    "bm6_proxy_context_monthly": lambda s, d: marts.context_activity(context(s, d), fact(s, d), "event_month"),
    "bm7_user_day_daily": lambda s, d: marts.user_day_daily(days(s, d)),
    "bm8_user_day_monthly": lambda s, d: marts.user_day_monthly(days(s, d)),
    "bm9_segment_daily": lambda s, d: marts.segment_daily(fact(s, d)),
    "bm10_segment_monthly": lambda s, d: marts.segment_monthly(marts.segment_daily(fact(s, d))),
    "bm11_destination_performance": lambda s, d: marts.entity_performance(fact(s, d), ("srch_destination_id",)),
    "bm12_hotel_market_performance": lambda s, d: marts.entity_performance(fact(s, d), ("hotel_market",)),
    "bm13_destination_monthly": lambda s, d: marts.destination_monthly(fact(s, d)),
    "bm14_origin_destination_routes": lambda s, d: marts.entity_performance(fact(s, d), ("origin_id", "srch_destination_id"), dates=False),
    "bm15_travel_patterns": lambda s, d: marts.travel_patterns(fact(s, d)),
    "bm16_checkin_seasonality": lambda s, d: marts.checkin_seasonality(fact(s, d)),
    "bm17_booking_window": lambda s, d: marts.booking_window(fact(s, d)),
    "am1_observed_recurrence": lambda s, d: marts.observed_recurrence(days(s, d)),
    "am2_missingness_daily": lambda s, d: marts.missingness_daily(fact(s, d)),
    "am3_proxy_context_ambiguity": lambda s, d: marts.context_ambiguity(context(s, d)),
    "am4_booking_population_drift": drift,
    "am5_booking_population_drift_summary": lambda s, d: marts.drift_summary(drift(s, d), "train_booking", "test_booking"),
    "am7_trip_date_quality": lambda s, d: marts.date_quality(fact(s, d)),
}

_ACTIVITY = f"""count(*) as logged_interaction_rows, count(distinct user_id) as identified_active_users, count(*) - count(user_id) as anonymous_interaction_rows,
  {rate('count(user_id)', 'count(*)')} as identified_user_coverage, count(distinct srch_destination_id) as observed_destinations, count(distinct hotel_market) as observed_hotel_markets"""


def _context_activity(period: str) -> str:
    return f"""{P}, w as (select {period}, count(*) as whole from i group by 1),
      m as (select {period}, count(*) as proxy_search_contexts, count(*) filter (where has_booking) as booking_bearing_proxy_contexts,
        {rate('count(*) filter (where has_booking)', 'count(*)')} as booking_bearing_proxy_context_share, count(distinct user_id) as identified_active_users,
        sum(interaction_rows)::bigint as covered_interaction_rows from p group by 1)
      select m.*, {rate('covered_interaction_rows', 'whole')} as proxy_interaction_coverage from m left join w using ({period})"""


def _entity(keys: str, key: str, dates: bool) -> str:
    seen = ", min(event_date) as first_observed_date, max(event_date) as last_observed_date" if dates else ""
    return f"{I} select {keys}, {RATES}, {USERS}{seen}, {SUPPORT} from i where {key} is not null group by {keys}"


_DIMENSIONS = {"device": "is_mobile", "package": "is_package", "channel": "channel", "destination_type": "srch_destination_type_id", "hotel_country": "hotel_country", "hotel_market": "hotel_market"}
_POPULATION = f"""with b as (select *, case when date_time < timestamp '{DRIFT_DAY}' then 'train_booking' else 'test_booking' end as dataset, date_trunc('month', date_time)::date as period_month
    from train where is_booking = 1),
  l as ({' union all '.join(f"select dataset, period_month, '{n}' as dimension_name, coalesce({c}::varchar, 'missing') as dimension_value from b" for n, c in _DIMENSIONS.items())})"""
_RECURRENCE = f"""{U}, f as (select user_id, min(event_month) as c from u group by 1),
  m as (select user_id, event_month as a, bool_or(has_booking) as b from u group by 1, 2),
  s as (select c, count(*) as cohort_users from f group by 1),
  o as (select c, a, count(*) as act, count(*) filter (where b) as book from m join f using (user_id) group by 1, 2),
  z as (select min(c) as lo, (select max(event_month) from u) as hi from f),
  g as (select c, cohort_users, age::int as age, (c + to_months(age::int))::date as a, (c + to_months(age::int))::date > hi as cens, datediff('month', c, hi)::int as horizon
        from s, z, unnest(generate_series(0, datediff('month', lo, hi))) as t(age))
  select g.c as first_observed_month, g.a as activity_month, age as observed_age_month, cohort_users,
    case when not cens then coalesce(act, 0) end as observed_active_users, case when not cens then {rate('coalesce(act, 0)', 'cohort_users')} end as observed_recurrence_share,
    case when not cens then coalesce(book, 0) end as observed_booking_users, case when not cens then {rate('coalesce(book, 0)', 'coalesce(act, 0)')} end as booking_user_share_among_observed_active,
    cens as is_right_censored, horizon as observable_horizon_months from g left join o on g.c = o.c and g.a = o.a"""
_MISSING = ("user_id", "orig_destination_distance", "checkin_date", "checkout_date", "srch_destination_id", "hotel_market", "similar_event_count")
_SEGMENT_VALUES = ", ".join(f"('{t}', '{v}', {o})" for t, v, o in dims.segment_rows())

SQL = {
    "cf1_fct_hotel_interactions": f"{I} select * from i",
    "cf3_fct_proxy_search_contexts": f"{P} select * from p",
    "cf4_fct_user_day": f"{U} select * from u",
    "dm1_dim_date": f"""{I}, e as (select distinct event_date as d from i), ci as (select distinct checkin_date as d from i where has_valid_lead_time),
      co as (select distinct checkout_date as d from i where is_plausible_trip_dates), al as (select d from e union select d from ci union select d from co),
      s as (select unnest(generate_series(min(d)::timestamp, max(d)::timestamp, interval 1 day))::date as x from al)
      select x as date_day, year(x)::smallint as calendar_year, quarter(x)::tinyint as calendar_quarter, month(x)::tinyint as calendar_month, week(x)::tinyint as iso_week,
        isodow(x)::tinyint as iso_day_of_week, isodow(x) > 5 as is_weekend, date_trunc('week', x)::date as week_start, date_trunc('month', x)::date as month_start,
        date_trunc('quarter', x)::date as quarter_start, date_trunc('year', x)::date as year_start,
        x in (select d from e) as is_event_date, x in (select d from ci) as is_checkin_date, x in (select d from co) as is_checkout_date from s""",
    "dm2_dim_origin": f"""{I} select origin_id, min(user_location_country) as user_location_country, min(user_location_region) as user_location_region, min(user_location_city) as user_location_city,
      count(*) as interaction_rows, min(event_date) as first_observed_date, max(event_date) as last_observed_date from i group by 1""",
    "dm3_dim_destination": f"""{I}, o as (select srch_destination_id, min(srch_destination_type_id) as srch_destination_type_id, count(*) as interaction_rows, min(event_date) as first_observed_date,
      max(event_date) as last_observed_date from i where srch_destination_id is not null group by 1), d as (select distinct * from processed_destinations)
      select * from d left join o using (srch_destination_id)""",
    "dm4_bridge_destination_hotel_market": f"""{I}, g as (select srch_destination_id, hotel_market, count(*) as interaction_rows, {B} as booking_rows, min(event_date) as first_observed_date,
      max(event_date) as last_observed_date from i where srch_destination_id is not null and hotel_market is not null group by 1, 2)
      select *, {rate('interaction_rows', 'sum(interaction_rows) over (partition by srch_destination_id)')} as interaction_share_within_destination from g""",
    "dm5_dim_segment_definition": f"select * from (values {_SEGMENT_VALUES}) as t(segment_type, segment_value, sort_order)",
    "bm1_sample_activity_daily": f"""{I} select event_date, {_ACTIVITY}, count(*) filter (where is_mobile = 1) as mobile_interaction_rows,
      count(*) filter (where is_package = 1) as package_interaction_rows from i group by 1""",
    "bm2_sample_activity_monthly": f"{I} select event_month, {_ACTIVITY} from i group by 1",
    "bm3_interaction_outcome_daily": f"{I} select event_date, {RATES} from i group by 1",
    "bm4_interaction_outcome_monthly": f"{I} select event_month, {RATES} from i group by 1",
    "bm5_proxy_context_daily": _context_activity("event_date"),
    "bm6_proxy_context_monthly": _context_activity("event_month"),
    "bm7_user_day_daily": f"""{U} select event_date, count(*) as identified_user_days, count(*) filter (where has_booking) as booking_user_days,
      {rate('count(*) filter (where has_booking)', 'count(*)')} as booking_user_day_share, count(distinct user_id) as identified_active_users,
      sum(interaction_rows)::bigint as covered_interaction_rows, sum(proxy_contexts)::bigint as proxy_search_contexts from u group by 1""",
    "bm8_user_day_monthly": f"""{U} select event_month, count(distinct user_id) as identified_active_users, count(distinct user_id) filter (where has_booking) as booking_users,
      {rate('count(distinct user_id) filter (where has_booking)', 'count(distinct user_id)')} as booking_user_share, count(*) as identified_user_days,
      sum(interaction_rows)::bigint as covered_interaction_rows, sum(proxy_contexts)::bigint as proxy_search_contexts from u group by 1""",
    "bm9_segment_daily": f"{I}{SEGMENTS} select event_date, segment_type, segment_value, {BOOKINGS} from long group by 1, 2, 3",
    "bm10_segment_monthly": f"{I}{SEGMENTS} select event_month, segment_type, segment_value, {BOOKINGS} from long group by 1, 2, 3",
    "bm11_destination_performance": _entity("srch_destination_id", "srch_destination_id", True),
    "bm12_hotel_market_performance": _entity("hotel_market", "hotel_market", True),
    "bm13_destination_monthly": f"{I} select event_month, srch_destination_id, {BOOKINGS}, {USERS} from i where srch_destination_id is not null group by 1, 2",
    "bm14_origin_destination_routes": _entity("origin_id, srch_destination_id", "srch_destination_id", False),
    "bm15_travel_patterns": f"""{I} select event_month, traveller_segment, lead_time_segment, stay_segment, {BOOKINGS}, {USERS}, avg(lead_time_days) filter (where has_valid_lead_time) as avg_valid_lead_time_days,
      median(lead_time_days) filter (where has_valid_lead_time) as median_valid_lead_time_days, avg(stay_nights) filter (where has_valid_stay_dates) as avg_valid_stay_nights, {SUPPORT} from i group by 1, 2, 3, 4""",
    "bm16_checkin_seasonality": f"""{I} select date_trunc('month', checkin_date)::date as checkin_month, traveller_segment, {BOOKINGS}, {USERS} from i where has_valid_lead_time group by 1, 2""",
    "bm17_booking_window": f"{I} select lead_time_segment, stay_segment, {BOOKINGS}, {CI} from i where has_valid_lead_time and has_valid_stay_dates group by 1, 2",
    "am1_observed_recurrence": _RECURRENCE,
    "am2_missingness_daily": f"""{I}, l as ({' union all '.join(f"select event_date, '{c}' as field_name, {c} is null as gone from i" for c in _MISSING)})
      select event_date, field_name, count(*) as eligible_rows, count(*) filter (where gone) as missing_rows, {rate('count(*) filter (where gone)', 'count(*)')} as missing_share from l group by 1, 2""",
    "am3_proxy_context_ambiguity": f"""{P}, l as (select 'multirow_context' as ambiguity_type, interaction_rows > 1 as hit from p union all select 'multicluster_context', distinct_hotel_clusters > 1 from p
      union all select 'multimarket_context', distinct_hotel_markets > 1 from p union all select 'multibooking_context', booking_rows > 1 from p)
      select ambiguity_type, count(*) filter (where hit) as affected_contexts, count(*) as proxy_contexts, {rate('count(*) filter (where hit)', 'count(*)')} as affected_share from l group by 1""",
    "am4_booking_population_drift": f"""{_POPULATION} select dataset, period_month, dimension_name, dimension_value, count(*) as booking_population_rows,
      {rate('count(*)', 'sum(count(*)) over (partition by dataset, period_month, dimension_name)')} as share_within_booking_population from l group by 1, 2, 3, 4""",
    "am5_booking_population_drift_summary": f"""{_POPULATION}, c as (select dataset, dimension_name, dimension_value, {rate('count(*)', 'sum(count(*)) over (partition by dataset, dimension_name)')} as s from l group by 1, 2, 3),
      j as (select coalesce(a.dimension_name, b.dimension_name) as dimension_name, coalesce(a.s, 0.0::double) as x, coalesce(b.s, 0.0::double) as y
            from (select * from c where dataset = 'train_booking') a full join (select * from c where dataset = 'test_booking') b on a.dimension_name = b.dimension_name and a.dimension_value = b.dimension_value)
      select dimension_name, sum(abs(y - x)::decimal(38,15))::double * 0.5::double as total_variation_distance,
        sum(((y - x) * ln((y + 1e-12::double) / (x + 1e-12::double)))::decimal(38,15))::double as population_stability_index, count(*) as compared_categories from j group by 1""",
    "am7_trip_date_quality": f"""{I}, n as (select count(*) as whole from i) select 'trip_date_quality:' || trip_date_quality as quality_rule, count(*) as affected_rows, any_value(whole) as denominator_rows,
      case when trip_date_quality = 'plausible' then 'info' else 'warning' end as severity, {rate('count(*)', 'any_value(whole)')} as affected_share from i, n group by trip_date_quality""",
}



def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
