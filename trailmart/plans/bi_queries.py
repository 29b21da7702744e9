"""Dashboard tables by name; their SQL stands on the SQL of the marts."""

from __future__ import annotations

import datetime as dt

from trailmart.plans import bi
from trailmart.plans.mart_queries import QUERIES as M
from trailmart.plans.mart_queries import SQL as S
from trailmart.plans.sqltext import rate

FIRST_MONTH = dt.date(2013, 1, 1)
DEFINITION = "dm5_dim_segment_definition"


def _on(name: str, f, *others: str):
    return lambda s, d: f(*(M[n](s, d) for n in (name, *others)))


QUERIES = {
    "bi1_overview_monthly": lambda s, d: bi.overview_monthly(
        *(M[n](s, d) for n in ("bm2_sample_activity_monthly", "bm4_interaction_outcome_monthly", "bm6_proxy_context_monthly")), FIRST_MONTH
    ),
    "bi2_segments_monthly": _on("bm10_segment_monthly", bi.segments_monthly, DEFINITION, "bm4_interaction_outcome_monthly"),
    "bi3_booking_window": _on("bm17_booking_window", bi.booking_window, DEFINITION),
    "bi4_traveller_planning_monthly": _on("bm15_travel_patterns", bi.traveller_planning_monthly, DEFINITION),
    "bi5_checkin_seasonality": _on("bm16_checkin_seasonality", bi.checkin_seasonality),
    "bi6_destination_performance": lambda s, d: bi.entity_performance(M["bm11_destination_performance"](s, d), "srch_destination_id", "destination_id"),
    "bi7_hotel_market_performance": lambda s, d: bi.entity_performance(M["bm12_hotel_market_performance"](s, d), "hotel_market", "hotel_market"),
    "bi8_destination_monthly": _on("bm13_destination_monthly", bi.destination_monthly),
    "bi9_routes": _on("bm14_origin_destination_routes", bi.routes),
    "bi10_observed_recurrence": _on("am1_observed_recurrence", bi.observed_recurrence),
    "bi12_missingness_daily": M["am2_missingness_daily"],
    "bi13_proxy_ambiguity": M["am3_proxy_context_ambiguity"],
    "bi14_booking_population_drift_summary": _on("am5_booking_population_drift_summary", bi.drift_summary),
}

_LEVEL = "case when {0} >= 1000 then 'strong' when {0} >= 100 then 'adequate' else 'low' end as support_level"
_LEVEL_ROWS = _LEVEL.format("interaction_rows")


def _weighted(name: str, out: str) -> str:
    return f"""round(sum({name} * interaction_rows) filter (where {name} is not null) / nullif((sum(interaction_rows) filter (where {name} is not null))::double, 0), 9) as {out}"""


def _entity(source: str, key: str, name: str) -> str:
    return f"""with m as ({S[source]}), o as (select {rate('sum(booking_rows)', 'sum(interaction_rows)')} as overall_booking_interaction_share from m),
      q as (select quantile_cont(interaction_rows::double, 0.75) as interaction_volume_q3_strong from m where support_level = 'strong')
      select {key} as {name}, interaction_rows, booking_rows, booking_interaction_share, booking_interaction_share_ci_low, booking_interaction_share_ci_high, identified_users as entity_users,
        support_level, first_observed_date, last_observed_date, overall_booking_interaction_share, interaction_volume_q3_strong,
        case when booking_interaction_share_ci_high < overall_booking_interaction_share then 'below_overall_confident'
             when booking_interaction_share_ci_low > overall_booking_interaction_share then 'above_overall_confident' else 'inconclusive' end as investigation_class,
        coalesce(support_level = 'strong' and interaction_rows >= interaction_volume_q3_strong and booking_interaction_share_ci_high < overall_booking_interaction_share, false) as investigation_candidate
      from m, o, q"""


SQL = {
    "bi1_overview_monthly": f"""with a as ({S['bm2_sample_activity_monthly']}), o as ({S['bm4_interaction_outcome_monthly']}), x as ({S['bm6_proxy_context_monthly']})
      select a.event_month, logged_interaction_rows as interaction_rows, booking_rows, {rate('booking_rows', 'logged_interaction_rows')} as booking_interaction_share,
        a.identified_active_users as active_users, proxy_search_contexts as proxy_contexts, proxy_interaction_coverage, booking_interaction_share_ci_low, booking_interaction_share_ci_high,
        a.event_month = date '{FIRST_MONTH}' as is_partial_month from a join o using (event_month) left join x using (event_month)""",
    "bi2_segments_monthly": f"""with g as ({S['bm10_segment_monthly']}), d as ({S[DEFINITION]}), o as ({S['bm4_interaction_outcome_monthly']})
      select g.event_month, g.segment_type, g.segment_value, coalesce(d.sort_order, case when g.segment_type in ('channel', 'site') then try_cast(g.segment_value as int) end) as segment_sort_order,
        g.interaction_rows, g.booking_rows, g.booking_interaction_share, {_LEVEL.format('g.interaction_rows')}, d.sort_order is not null or g.segment_type in ('channel', 'site') as is_valid_segment,
        (g.booking_interaction_share - o.booking_interaction_share) * 100.0::double as booking_interaction_share_vs_overall_pp
      from g left join d using (segment_type, segment_value) join o using (event_month)""",
    "bi3_booking_window": f"""with w as ({S['bm17_booking_window']}), d as ({S[DEFINITION]})
      select w.*, l.sort_order as lead_time_sort_order, s.sort_order as stay_sort_order, {_LEVEL_ROWS} from w
      join d l on l.segment_type = 'lead_time' and l.segment_value = lead_time_segment join d s on s.segment_type = 'stay' and s.segment_value = stay_segment""",
    "bi4_traveller_planning_monthly": f"""with t as ({S['bm15_travel_patterns']}), d as ({S[DEFINITION]})
      select event_month, traveller_segment, sort_order as traveller_sort_order, sum(interaction_rows)::bigint as interaction_rows, sum(booking_rows)::bigint as booking_rows,
        {rate('sum(booking_rows)', 'sum(interaction_rows)')} as booking_interaction_share, {_weighted('avg_valid_lead_time_days', 'avg_valid_lead_days')},
        {_weighted('avg_valid_stay_nights', 'avg_valid_stay_nights')}, {_LEVEL.format('sum(interaction_rows)')}
      from t join d on segment_type = 'traveller' and segment_value = traveller_segment group by 1, 2, 3""",
    "bi5_checkin_seasonality": f"""with m as ({S['bm16_checkin_seasonality']}) select checkin_month, year(checkin_month)::int as checkin_year, month(checkin_month)::int as checkin_month_number,
      strftime(checkin_month, '%B') as checkin_month_name, traveller_segment, interaction_rows, booking_rows, booking_interaction_share from m""",
    "bi6_destination_performance": _entity("bm11_destination_performance", "srch_destination_id", "destination_id"),
    "bi7_hotel_market_performance": _entity("bm12_hotel_market_performance", "hotel_market", "hotel_market"),
    "bi8_destination_monthly": f"""with m as ({S['bm13_destination_monthly']}) select event_month, srch_destination_id as destination_id, interaction_rows, booking_rows, booking_interaction_share,
      identified_users as entity_users, {_LEVEL_ROWS} from m""",
    "bi9_routes": f"""with m as ({S['bm14_origin_destination_routes']}) select origin_id, srch_destination_id as destination_id, interaction_rows, booking_rows, booking_interaction_share,
      booking_interaction_share_ci_low, booking_interaction_share_ci_high, identified_users as entity_users, support_level from m""",
    "bi10_observed_recurrence": f"""with m as ({S['am1_observed_recurrence']}) select first_observed_month as cohort_month, activity_month, observed_age_month, cohort_users, observed_active_users,
      observed_recurrence_share, observed_booking_users as booking_users, is_right_censored as is_censored, observable_horizon_months from m""",
    "bi12_missingness_daily": S["am2_missingness_daily"],
    "bi13_proxy_ambiguity": S["am3_proxy_context_ambiguity"],
    "bi14_booking_population_drift_summary": f"with m as ({S['am5_booking_population_drift_summary']}) select * rename (compared_categories as category_count) from m",
}


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
