"""The context-centred marts by name, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailmart.plans import legacy
from trailmart.plans.sqltext import CONTEXT_KEYS, I, digest, rate
from trailmart.session import table


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return legacy.weighted_interactions(table(spark, folder, "train"))


def context(spark: SparkSession, folder: str) -> DataFrame:
    return legacy.search_contexts(fact(spark, folder))


QUERIES = {
    "lg1_fct_weighted_interactions": fact,
    "lg2_fct_search_contexts": context,
    "lg3_dim_date": lambda s, d: legacy.dim_date(context(s, d)),
    "lg4_dim_destination": lambda s, d: legacy.dim_destination(table(s, d, "processed_destinations").dropDuplicates(["srch_destination_id"]), context(s, d)),
    "lg5_dim_user_first_seen": lambda s, d: legacy.first_seen(context(s, d)),
    "lg6_product_daily": lambda s, d: legacy.product(context(s, d), "event_date"),
    "lg7_product_monthly": lambda s, d: legacy.product(context(s, d), "event_month"),
    "lg8_segment_daily": lambda s, d: legacy.segments(context(s, d), "event_date", 100),
    "lg9_segment_monthly": lambda s, d: legacy.segments(context(s, d), "event_month", 300),
    "lg10_destination_performance": lambda s, d: legacy.destination_performance(context(s, d)),
    "lg11_destination_monthly": lambda s, d: legacy.destination_monthly(context(s, d)),
    "lg12_travel_patterns": lambda s, d: legacy.travel_patterns(context(s, d)),
    "lg13_user_profile": lambda s, d: legacy.user_profile(context(s, d)),
    "lg14_user_cohort_monthly": lambda s, d: legacy.user_cohort_monthly(context(s, d)),
    "lg15_data_quality_summary": lambda s, d: legacy.quality_summary(fact(s, d)),
    "lg16_data_quality_daily": lambda s, d: legacy.quality_daily(fact(s, d)),
}

F_ = f"""{I}, f as (select *, date_trunc('week', event_date)::date as event_week, hour(event_datetime)::tinyint as event_hour, greatest(coalesce(similar_event_count, 1), 1)::bigint as event_weight,
    case when is_booking = 1 then 'booking' else 'click' end as interaction_type,
    case when orig_destination_distance is null then 'missing' when orig_destination_distance < 100 then '0_100' when orig_destination_distance < 500 then '100_500'
         when orig_destination_distance < 1000 then '500_1000' when orig_destination_distance < 5000 then '1000_5000' else '5000_plus' end as distance_segment,
    {digest(*CONTEXT_KEYS)} as search_context_key from i)"""


def _mode(table_: str, keys: str, column: str, where: str = "true", out: str | None = None) -> str:
    """The most frequent value and, of several, the least, per keys."""
    out = out or column
    return f"""(select {keys}, {out} from (select {keys}, {column} as {out}, row_number() over (partition by {keys} order by count(*) desc, {column}) as r
      from {table_} where {column} is not null and {where} group by {keys}, {column}) where r = 1)"""


def _modes(table_: str, keys: str, columns: dict[str, str]) -> tuple[str, str]:
    """Join clauses and select items for several modes; ``columns`` maps outputs to inputs."""
    joins = " ".join(f"left join {_mode(table_, keys, c, out=o)} m_{o} using ({keys})" for o, c in columns.items())
    return joins, ", ".join(f"m_{o}.{o}" for o in columns)


_PRIMARY = {f"primary_hotel_{c}": f"hotel_{c}" for c in ("continent", "country", "market")}
_J, _S = _modes("f", "search_context_key", _PRIMARY)
C_ = f"""{F_}, g as (select search_context_key, {', '.join(f'min({c}) as {c}' for c in legacy.SAME)}, bool_or(has_valid_stay_dates) as has_valid_stay_dates, bool_or(has_valid_lead_time) as has_valid_lead_time,
    count(*) as interaction_rows, sum(event_weight)::bigint as weighted_interactions, count(*) filter (where is_booking = 0) as click_rows,
    coalesce(sum(event_weight) filter (where is_booking = 0), 0)::bigint as weighted_clicks, count(*) filter (where is_booking = 1) as booking_rows,
    coalesce(sum(event_weight) filter (where is_booking = 1), 0)::bigint as weighted_bookings, bool_or(is_booking = 1) as has_booking,
    count(distinct hotel_cluster) as distinct_hotel_clusters, count(distinct hotel_market) as distinct_hotel_markets from f group by 1),
  c as (select g.*, {_S}, b.booked_hotel_cluster from g {_J}
    left join {_mode('f', 'search_context_key', 'hotel_cluster', 'is_booking = 1', 'booked_hotel_cluster')} b using (search_context_key)),
  s as (select user_id, min(event_date) as first_event_date, max(event_date) as last_event_date, date_trunc('month', min(event_date))::date as first_event_month from c where user_id is not null group by 1)"""

_COUNTS = "count(*) as search_contexts, count(*) filter (where has_booking) as booking_contexts"
_RATE = f"{rate('count(*) filter (where has_booking)', 'count(*)')} as booking_context_rate"
_AVERAGES = "avg(lead_time_days) filter (where has_valid_lead_time) as avg_lead_time_days, avg(stay_nights) filter (where has_valid_stay_dates) as avg_stay_nights"
_SHARES = ", ".join(f"{rate(f'count(*) filter (where {c}_segment = {chr(39)}{v}{chr(39)})', 'count(*)')} as {n}_context_share" for c, v, n in (("device", "mobile", "mobile"), ("package", "package", "package")))
_FAMILIES = {n: f"{n}_segment" for n in ("device", "package", "traveller", "lead_time", "stay", "distance")} | {
    n: f"coalesce({c}::varchar, 'unknown')" for n, c in (("channel", "channel"), ("site", "site_name"), ("destination_type", "srch_destination_type_id"))
}


def _product(period: str, start: str) -> str:
    sums = ", ".join(f"sum({c})::bigint as {c}" for c in ("interaction_rows", "weighted_interactions", "click_rows", "weighted_clicks", "booking_rows", "weighted_bookings"))
    return f"""{C_} select {period}, {_COUNTS}, count(*) filter (where not has_booking) as non_booking_contexts, {_RATE}, count(distinct user_id) as active_users,
      count(distinct case when {period} = {start} then user_id end) as new_users, count(distinct case when {period} > {start} then user_id end) as returning_users, {sums},
      count(*) filter (where device_segment = 'mobile') as mobile_contexts, count(*) filter (where package_segment = 'package') as package_contexts, {_SHARES}, {_AVERAGES},
      median(lead_time_days) filter (where has_valid_lead_time) as median_lead_time_days, round(quantile_cont(lead_time_days, 0.9) filter (where has_valid_lead_time), 6) as p90_lead_time_days,
      median(stay_nights) filter (where has_valid_stay_dates) as median_stay_nights, count(distinct srch_destination_id) as unique_destinations,
      count(distinct primary_hotel_market) as unique_hotel_markets, {rate('count(*)', 'count(distinct user_id)')} as contexts_per_active_user
      from c left join s using (user_id) group by 1"""


def _segments(period: str, start: str, stable: int) -> str:
    families = _FAMILIES | {"user_lifecycle": f"case when {period} = {start} then 'new' else 'returning' end"}
    long = " union all ".join(f"select {period}, user_id, has_booking, interaction_rows, weighted_interactions, '{n}' as segment_type, {e} as segment_value from j" for n, e in families.items())
    return f"""{C_}, j as (select c.*, s.{start} from c left join s using (user_id)), l as ({long})
      select {period}, segment_type, segment_value, {_COUNTS}, {_RATE}, count(distinct user_id) as active_users, sum(interaction_rows)::bigint as interaction_rows,
        sum(weighted_interactions)::bigint as weighted_interactions, count(*) >= {stable} as is_stable_sample from l group by 1, 2, 3"""


_DEST = {"destination_type_id": "srch_destination_type_id"} | {f"primary_hotel_{c}": f"primary_hotel_{c}" for c in ("continent", "country", "market")}
_DJ, _DS = _modes("c", "srch_destination_id", _DEST)
_MJ, _MS = _modes("c", "event_month, srch_destination_id", {k: v for k, v in _DEST.items() if k != "primary_hotel_continent"})
_UJ, _US = _modes("c", "user_id", {"preferred_device_segment": "device_segment", "preferred_package_segment": "package_segment",
                                   "dominant_traveller_segment": "traveller_segment", "most_frequent_destination_id": "srch_destination_id"})

SQL = {
    "lg1_fct_weighted_interactions": f"{F_} select * from f",
    "lg2_fct_search_contexts": f"{C_} select * from c",
    "lg3_dim_date": f"""{C_}, z as (select unnest(generate_series(min(event_date)::timestamp, max(event_date)::timestamp, interval 1 day))::date as x from c)
      select x as date_day, year(x)::smallint as calendar_year, quarter(x)::tinyint as calendar_quarter, month(x)::tinyint as calendar_month, week(x)::tinyint as iso_week,
        isodow(x)::tinyint as iso_day_of_week, isodow(x) > 5 as is_weekend, date_trunc('week', x)::date as week_start, date_trunc('month', x)::date as month_start,
        date_trunc('quarter', x)::date as quarter_start, date_trunc('year', x)::date as year_start, strftime(x, '%Y-%m') as year_month, strftime(x, '%A') as day_name, strftime(x, '%B') as month_name from z""",
    "lg4_dim_destination": f"""{C_}, o as (select srch_destination_id, min(event_date) as first_seen_date, max(event_date) as last_seen_date, count(*) as n, count(*) filter (where has_booking) as b
        from c where srch_destination_id is not null group by 1), d as (select distinct * from processed_destinations)
      select d.*, {_DS}, first_seen_date, last_seen_date, coalesce(n, 0) as observed_search_contexts, coalesce(b, 0) as observed_booking_contexts from d left join o using (srch_destination_id) {_DJ}""",
    "lg5_dim_user_first_seen": f"{C_} select * from s",
    "lg6_product_daily": _product("event_date", "first_event_date"),
    "lg7_product_monthly": _product("event_month", "first_event_month"),
    "lg8_segment_daily": _segments("event_date", "first_event_date", 100),
    "lg9_segment_monthly": _segments("event_month", "first_event_month", 300),
    "lg10_destination_performance": f"""{C_}, a as (select srch_destination_id, {_COUNTS}, {_RATE}, count(distinct user_id) as unique_users, sum(interaction_rows)::bigint as interaction_rows,
        sum(weighted_interactions)::bigint as weighted_interactions, {_AVERAGES}, {_SHARES}, min(event_date) as first_seen_date, max(event_date) as last_seen_date
        from c where srch_destination_id is not null group by 1),
      r as (select a.*, {_DS}, ntile(10) over (order by search_contexts, srch_destination_id)::int as demand_decile, ntile(10) over (order by booking_context_rate nulls last, srch_destination_id)::int as booking_rate_decile,
        median(search_contexts) over () as median_destination_demand, median(booking_context_rate) over () as median_destination_booking_rate from a {_DJ})
      select *, case when search_contexts >= median_destination_demand then 'high' else 'low' end || '_demand_' || case when booking_context_rate >= median_destination_booking_rate then 'high' else 'low' end || '_rate'
        as performance_quadrant, search_contexts >= 100 as is_stable_sample from r""",
    "lg11_destination_monthly": f"""{C_}, a as (select event_month, srch_destination_id, {_COUNTS}, {_RATE}, count(distinct user_id) as unique_users, sum(weighted_interactions)::bigint as weighted_interactions,
        count(*) >= 100 as is_stable_sample from c where srch_destination_id is not null group by 1, 2) select a.*, {_MS} from a {_MJ}""",
    "lg12_travel_patterns": f"""{C_} select {', '.join(legacy.PATTERN)}, {_COUNTS}, {_RATE}, count(distinct user_id) as active_users, avg(party_size) as avg_party_size, avg(srch_rm_cnt) as avg_rooms, {_AVERAGES},
      sum(weighted_interactions)::bigint as weighted_interactions, count(*) >= 300 as is_stable_sample from c group by {', '.join(legacy.PATTERN)}""",
    "lg13_user_profile": f"""{C_}, a as (select user_id, min(event_date) as first_event_date, max(event_date) as last_event_date, datediff('day', min(event_date), max(event_date)) as observed_lifetime_days,
        {_COUNTS}, {_RATE}, count(distinct event_date) as active_days, count(distinct event_month) as active_months, sum(interaction_rows)::bigint as interaction_rows,
        sum(weighted_interactions)::bigint as weighted_interactions, count(distinct srch_destination_id) as unique_destinations, count(distinct primary_hotel_market) as unique_hotel_markets, {_AVERAGES},
        case when count(*) = 1 then 'one_time' else 'repeat' end || case when bool_or(has_booking) then '_booker' else '_non_booker' end as user_value_segment
        from c where user_id is not null group by 1) select a.*, {_US} from a {_UJ}""",
    "lg14_user_cohort_monthly": f"""{C_} select first_event_month as cohort_month, event_month as activity_month, datediff('month', first_event_month, event_month)::int as cohort_age_month,
      count(distinct user_id) as active_users, {_COUNTS}, {_RATE} from c join s using (user_id) group by 1, 2, 3""",
    "lg15_data_quality_summary": f"{F_} "
    + " union all ".join(f"select '{n}' as rule_name, '{s}' as severity, count(*) filter (where {e}) as affected_rows, count(*) as total_rows, {rate(f'count(*) filter (where {e})', 'count(*)')} as affected_rate from f" for n, s, e in legacy.RULES),
    "lg16_data_quality_daily": f"{F_} select event_date, count(*) as interaction_rows, "
    + ", ".join(f"count(*) filter (where {e}) as {n}_rows" for n, _, e in legacy.RULES if n in legacy.DAILY_RULES)
    + ", "
    + ", ".join(f"{rate(f'count(*) filter (where {e})', 'count(*)')} as {n}_rate" for n, _, e in legacy.RULES if n in legacy.DAILY_RATES)
    + " from f group by 1",
}


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
