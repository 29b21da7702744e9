"""Pieces of the SQL counterparts, written for an engine with its own functions."""

from __future__ import annotations


def rate(part: str, whole: str) -> str:
    return f"case when {whole} > 0 then ({part})::double / ({whole})::double end"


def wilson(part: str, whole: str, z: float = 1.96) -> tuple[str, str]:
    n, z2 = f"({whole})::double", z * z
    p = f"(({part})::double / {n})"
    spread = f"sqrt(({p} * (1 - {p}) + {z2 / 4!r}::double / {n}) / {n}) * {z!r}::double"
    centre, scale = f"({p} + {z2 / 2!r}::double / {n})", f"(1 + {z2!r}::double / {n})"
    low = f"least({p}, greatest(0.0::double, ({centre} - {spread}) / {scale}))"
    high = f"greatest({p}, least(1.0::double, ({centre} + {spread}) / {scale}))"
    return f"case when {whole} > 0 then {low} end", f"case when {whole} > 0 then {high} end"


B = "count(*) filter (where is_booking = 1)"
LOW, HIGH = wilson(B, "count(*)")
BOOKINGS = f"count(*) as interaction_rows, {B} as booking_rows, {rate(B, 'count(*)')} as booking_interaction_share"
CI = f"{LOW} as booking_interaction_share_ci_low, {HIGH} as booking_interaction_share_ci_high"
_BOOKED = "sum(valid_similar_event_count) filter (where is_booking = 1)"
RATES = f"""{BOOKINGS}, {CI}, count(*) filter (where is_booking = 0) as click_rows,
  sum(valid_similar_event_count)::bigint as valid_similar_event_count,
  (sum(valid_similar_event_count) filter (where is_booking = 0))::bigint as weighted_click_events, ({_BOOKED})::bigint as weighted_booking_events,
  {rate(_BOOKED, 'sum(valid_similar_event_count)')} as weighted_booking_event_share,
  {rate('count(valid_similar_event_count)', 'count(*)')} as similar_event_count_coverage"""
SUPPORT = "case when count(*) >= 1000 then 'strong' when count(*) >= 100 then 'adequate' else 'low' end as support_level"
USERS = "count(distinct user_id) as identified_users"


def digest(*parts: str) -> str:
    return "sha256(concat_ws('|', " + ", ".join(f"coalesce({p}::varchar, '<NULL>')" for p in parts) + "))"


CONTEXT_KEYS = (
    "user_id", "event_datetime", "site_name", "origin_id", "is_mobile", "is_package", "channel", "checkin_date",
    "checkout_date", "srch_adults_cnt", "srch_children_cnt", "srch_rm_cnt", "srch_destination_id", "srch_destination_type_id",
)


def interactions_cte(source: str = "train", identity: str | None = None) -> str:
    """``i``: the interaction fact over a typed source."""
    identity = identity or digest("'row'", "source_scan_ordinal")
    return f"""
    base as (select *, date_time::date as ed, datediff('day', date_time::date, srch_ci) as lead, datediff('day', srch_ci, srch_co) as stay from {source}),
    i as (select {identity} as interaction_id, date_time as event_datetime, ed as event_date, date_trunc('month', ed)::date as event_month,
      year(ed)::smallint as event_year, month(ed)::tinyint as event_month_num, isodow(ed)::tinyint as event_iso_day_of_week,
      site_name, posa_continent, user_location_country, user_location_region, user_location_city,
      case when not isnan(orig_destination_distance) then orig_destination_distance end as orig_destination_distance, user_id, is_mobile, is_package, channel,
      {digest("user_location_country", "user_location_region", "user_location_city")} as origin_id,
      srch_ci as checkin_date, srch_co as checkout_date, lead::int as lead_time_days, stay::int as stay_nights, srch_adults_cnt, srch_children_cnt, srch_rm_cnt,
      coalesce(srch_adults_cnt, 0)::int + coalesce(srch_children_cnt, 0)::int as party_size, srch_destination_id, srch_destination_type_id, is_booking, cnt as similar_event_count,
      coalesce(cnt > 0, false) as has_valid_similar_event_count, case when cnt > 0 then cnt end as valid_similar_event_count,
      hotel_continent, hotel_country, hotel_market, hotel_cluster,
      case is_mobile when 1 then 'mobile' when 0 then 'desktop' else 'unknown' end as device_segment,
      case is_package when 1 then 'package' when 0 then 'standalone' else 'unknown' end as package_segment,
      case when srch_children_cnt > 0 then 'family' when coalesce(srch_children_cnt, 0) <> 0 or srch_adults_cnt is null or srch_adults_cnt < 1 then 'unknown'
           when srch_adults_cnt = 1 then 'solo' when srch_adults_cnt = 2 then 'couple' else 'group' end as traveller_segment,
      case when lead is null then 'missing' when lead < 0 then 'invalid_negative' when lead > 730 then 'out_of_scope_gt_730' when lead > 180 then '181_730_days'
           when lead > 90 then '91_180_days' when lead > 30 then '31_90_days' when lead > 7 then '08_30_days' when lead > 0 then '01_07_days' else 'same_day' end as lead_time_segment,
      case when stay is null then 'missing' when stay < 1 then 'invalid_nonpositive' when stay > 365 then 'out_of_scope_gt_365' when stay > 14 then '15_365_nights'
           when stay > 7 then '08_14_nights' when stay > 3 then '04_07_nights' when stay > 1 then '02_03_nights' else '01_night' end as stay_segment,
      case when lead is null then 'missing_checkin' when lead < 0 then 'checkin_before_event' when lead > 730 then 'lead_time_out_of_scope' when stay is null then 'missing_checkout'
           when stay <= 0 then 'checkout_not_after_checkin' when stay > 365 then 'stay_out_of_scope' else 'plausible' end as trip_date_quality,
      coalesce(lead >= 0, false) as is_chronological_lead_time, coalesce(stay > 0, false) as is_chronological_stay,
      coalesce(lead between 0 and 730, false) as has_valid_lead_time, coalesce(stay between 1 and 365, false) as has_valid_stay_dates,
      coalesce(lead between 0 and 730 and stay between 1 and 365, false) as is_plausible_trip_dates from base)"""


_KEYS = ", ".join(CONTEXT_KEYS)
_SAME = ("event_date", "event_month", "event_year", "event_month_num", "device_segment", "package_segment", "traveller_segment",
         "lead_time_segment", "stay_segment", "trip_date_quality", "lead_time_days", "stay_nights")
CONTEXTS = f"""
    p as (select {_KEYS}, {', '.join(f'min({c}) as {c}' for c in _SAME)}, {digest(*CONTEXT_KEYS)} as proxy_context_id, count(*) as interaction_rows,
      count(*) filter (where is_booking = 0) as click_rows, {B} as booking_rows, bool_or(is_booking = 1) as has_booking,
      count(distinct hotel_cluster) as distinct_hotel_clusters, count(distinct hotel_market) as distinct_hotel_markets,
      min(orig_destination_distance) as min_hotel_distance, median(orig_destination_distance) as median_hotel_distance, max(orig_destination_distance) as max_hotel_distance,
      {rate('count(*) filter (where orig_destination_distance is null)', 'count(*)')} as distance_missing_share,
      median(orig_destination_distance) filter (where is_booking = 1) as booked_hotel_distance, sum(valid_similar_event_count)::bigint as valid_similar_event_count
      from i where user_id is not null group by {_KEYS})"""
USER_DAYS = """
    u as (select user_id, event_date, date_trunc('month', event_date)::date as event_month, year(event_date)::smallint as event_year, month(event_date)::tinyint as event_month_num,
      sum(interaction_rows)::bigint as interaction_rows, sum(booking_rows)::bigint as booking_rows, count(distinct srch_destination_id) as distinct_destinations,
      count(*) as proxy_contexts, bool_or(has_booking) as has_booking from p group by user_id, event_date)"""

I = f"with {interactions_cte()}"
P = f"{I}, {CONTEXTS}"
U = f"{P}, {USER_DAYS}"
FAMILIES = {"device": "device_segment", "package": "package_segment", "traveller": "traveller_segment", "lead_time": "lead_time_segment", "stay": "stay_segment",
            "channel": "coalesce(channel::varchar, 'missing')", "site": "coalesce(site_name::varchar, 'missing')"}
_LONG = " union all ".join(f"select event_date, event_month, is_booking, '{n}' as segment_type, {c} as segment_value from i" for n, c in FAMILIES.items())
SEGMENTS = f", long as ({_LONG})"
