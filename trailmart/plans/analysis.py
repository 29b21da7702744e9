"""Analyses over the marts: dynamics, rankings, concentration, shifts. Nothing is gathered at the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.functions.measures import Z_EXACT, safe_rate, wilson

def booked() -> Column:
    return F.col("booking_rows")


def rows() -> Column:
    return F.col("interaction_rows")


def _share() -> list[Column]:
    low, high = wilson(booked(), rows(), Z_EXACT)
    return [safe_rate(booked(), rows()).alias("booking_interaction_share"), low.alias("ci_low"), high.alias("ci_high")]


def _sums() -> list[Column]:
    return [F.sum(rows()).alias("interaction_rows"), F.sum(booked()).alias("booking_rows")]


def overall(fact: DataFrame) -> DataFrame:
    """Totals; the mean event count goes by its own name, apart from the coverage of the rate block."""
    one = fact.agg(
        F.count("*").alias("interaction_rows"),
        F.count_if(F.col("is_booking") == 1).alias("booking_rows"),
        F.count_distinct("user_id").alias("identified_users"),
        F.sum("valid_similar_event_count").alias("events"),
    )
    return one.select("interaction_rows", "booking_rows", "identified_users", *_share(), safe_rate(F.col("events"), rows()).alias("mean_similar_event_count"))


def month_dynamics(monthly: DataFrame) -> DataFrame:
    """Change on the month before, in per cent and points, and the slope of the share over the months."""
    order, all_ = Window.orderBy("event_month"), Window.orderBy("event_month").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # months: few rows
    base = monthly.select("event_month", "interaction_rows", "booking_interaction_share").withColumn("i", F.row_number().over(order).cast("double"))
    share = F.col("booking_interaction_share")
    rows_change = (rows() / F.lag(rows()).over(order) - 1) * 100
    points = (share - F.lag(share).over(order)) * 100
    return base.select(
        "event_month",
        "interaction_rows",
        "booking_interaction_share",
        F.round(rows_change, 9).alias("rows_change_percent"),
        F.round(points, 9).alias("share_change_points"),
        F.coalesce((F.abs(rows_change) >= 10) & (F.abs(points) >= 0.1) & (F.signum(rows_change) != F.signum(points)), F.lit(False)).alias("diverges"),
        F.round(F.regr_slope(share, F.col("i")).over(all_), 9).alias("share_slope"),
        (share == F.max(share).over(all_)).alias("is_peak"),
        (share == F.min(share).over(all_)).alias("is_trough"),
    )


def segment_summary(monthly: DataFrame) -> DataFrame:
    """Segments pooled over the months, against their family's share, with their share of its rows."""
    family = Window.partitionBy("segment_type")
    pooled = monthly.groupBy("segment_type", "segment_value").agg(
        *_sums(), F.max("booking_interaction_share").alias("top_month"), F.min("booking_interaction_share").alias("low_month"), F.count("*").alias("months")
    )
    whole = safe_rate(F.sum(booked()).over(family), F.sum(rows()).over(family))
    return pooled.select(
        "segment_type",
        "segment_value",
        "interaction_rows",
        "booking_rows",
        *_share(),
        ((safe_rate(booked(), rows()) - whole) * 100).alias("gap_points"),
        safe_rate(rows(), F.sum(rows()).over(family)).alias("population_share"),
        (F.col("top_month") - F.col("low_month")).alias("monthly_range"),
        "months",
    )


def composition_shift(monthly: DataFrame) -> DataFrame:
    """Shares of each family's rows in the first and in the last month."""
    ends = monthly.agg(F.min("event_month").alias("first"), F.max("event_month").alias("last"))
    joined = monthly.crossJoin(F.broadcast(ends)).where("event_month in (first, last)")  # ends is one row
    cells = joined.groupBy("segment_type", "segment_value").agg(
        *(F.coalesce(F.sum(F.when(F.col("event_month") == F.col(e), rows())), F.lit(0)).alias(f"{e}_rows") for e in ("first", "last"))
    )
    family = Window.partitionBy("segment_type")
    share = {e: safe_rate(F.col(f"{e}_rows"), F.sum(f"{e}_rows").over(family)) for e in ("first", "last")}
    return cells.select("segment_type", "segment_value", share["first"].alias("first_share"), share["last"].alias("last_share"), ((share["last"] - share["first"]) * 100).alias("shift_points"))


PLACES = ("posa_continent", "user_location_country", "hotel_continent", "hotel_country", "srch_destination_type_id")


def _grouping_sets(fact: DataFrame, sets: list[tuple[str, ...]]) -> DataFrame:
    """Rows and bookings per grouping set; ``family`` names the set and ``label`` its values."""
    keys = sorted({k for s in sets for k in s})
    small = fact.groupBy(*keys).agg(F.count("*").alias("interaction_rows"), F.count_if(F.col("is_booking") == 1).alias("booking_rows"))
    items = F.array(*(F.struct(F.lit("*".join(s)).alias("family"), F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("missing")) for k in s)).alias("label")) for s in sets))
    long = small.select(F.explode(items).alias("g"), "interaction_rows", "booking_rows").select("g.*", "interaction_rows", "booking_rows")
    return long.groupBy("family", "label").agg(*_sums())


def geography(fact: DataFrame) -> DataFrame:
    """Five single-place groupings from one scan, each place against the whole by its interval."""
    cells = _grouping_sets(fact, [(p,) for p in PLACES])
    family = Window.partitionBy("family")
    whole = safe_rate(F.sum(booked()).over(family), F.sum(rows()).over(family))
    judged = cells.select("family", "label", "interaction_rows", "booking_rows", *_share(), whole.alias("benchmark"))
    verdict = F.when(F.col("ci_low") > F.col("benchmark"), "above").when(F.col("ci_high") < F.col("benchmark"), "below").otherwise("inconclusive")
    return judged.withColumn("verdict", verdict)


SEG = {n: f"{n}_segment" for n in ("device", "package", "traveller", "lead_time", "stay")}
CROSSINGS = (
    ("device", "package"), ("device", "traveller"), ("device", "lead_time"), ("package", "traveller"), ("package", "lead_time"), ("traveller", "lead_time"), ("traveller", "stay"),
    ("traveller", "lead_time", "stay"), ("device", "package", "traveller", "lead_time", "stay"),
)


def cross_segments(fact: DataFrame) -> DataFrame:
    """Nine crossings of segments from one aggregate, with each cell's gap to the whole."""
    cells = _grouping_sets(fact, [tuple(SEG[n] for n in c) for c in CROSSINGS])
    family = Window.partitionBy("family")
    whole = safe_rate(F.sum(booked()).over(family), F.sum(rows()).over(family))
    return cells.select("family", "label", "interaction_rows", "booking_rows", *_share(), ((safe_rate(booked(), rows()) - whole) * 100).alias("gap_points"))


def planning_summary(fact: DataFrame) -> DataFrame:
    lead, stay = F.when(F.col("has_valid_lead_time"), F.col("lead_time_days")), F.when(F.col("has_valid_stay_dates"), F.col("stay_nights"))
    return fact.groupBy("traveller_segment").agg(
        F.count("*").alias("interaction_rows"), F.avg(lead).alias("avg_lead"), F.percentile(lead, 0.5).alias("median_lead"), F.avg(stay).alias("avg_stay"), F.percentile(stay, 0.5).alias("median_stay")
    )


def ranked_cells(window: DataFrame) -> DataFrame:
    """The cells of the booking window by share; a bounded table of labels."""
    best = Window.orderBy(F.desc("booking_interaction_share"), "lead_time_segment", "stay_segment")
    return window.withColumn("place", F.row_number().over(best)).select("place", "lead_time_segment", "stay_segment", "interaction_rows", "booking_rows", "booking_interaction_share")


def concentration(mart: DataFrame, key: str) -> DataFrame:
    """Shares of the largest 1, 5, 10, 50 and 100 entities, and the Herfindahl index.

    Only the 100 largest are sorted (a top-k); the index is one aggregate.
    """
    total = mart.agg(F.sum(rows()).alias("total"), F.count("*").alias("entities"), F.sum((rows() * rows()).cast("decimal(38,0)")).alias("squares"))
    largest = mart.orderBy(F.desc("interaction_rows"), key).limit(100).select("interaction_rows", key)
    placed = largest.withColumn("place", F.row_number().over(Window.orderBy(F.desc("interaction_rows"), key)))
    tops = placed.agg(*(F.sum(F.when(F.col("place") <= k, rows())).alias(f"t{k}") for k in (1, 5, 10, 50, 100)))
    squares, whole = F.col("squares").cast("double"), F.col("total").cast("double")
    return total.crossJoin(tops).select("entities", *(safe_rate(F.col(f"t{k}"), F.col("total")).alias(f"top_{k}_share") for k in (1, 5, 10, 50, 100)), (squares / whole / whole).alias("herfindahl"))


def distribution(mart: DataFrame) -> DataFrame:
    cuts = (("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p99", 0.99))
    return mart.groupBy("support_level").agg(F.count("*").alias("entities"), *(F.round(F.percentile(rows(), q), 6).alias(n) for n, q in cuts))


def candidate_months(monthly: DataFrame, mart: DataFrame) -> DataFrame:
    """Months of the entities whose interval lies below the whole: how persistent the gap is."""
    whole = mart.agg(safe_rate(F.sum(booked()), F.sum(rows())).alias("benchmark"))
    below = mart.crossJoin(F.broadcast(whole)).where("booking_interaction_share_ci_high < benchmark").select("srch_destination_id", "benchmark")  # one row
    joined = monthly.join(below, "srch_destination_id")
    return joined.groupBy("srch_destination_id").agg(F.count("*").alias("months"), F.count_if(F.col("booking_interaction_share") < F.col("benchmark")).alias("months_below"), *_sums())


def _candidates(mart: DataFrame, key: str) -> DataFrame:
    """The entities whose interval lies below the whole."""
    whole = mart.agg(safe_rate(F.sum(booked()), F.sum(rows())).alias("benchmark"))
    return mart.crossJoin(F.broadcast(whole)).where("booking_interaction_share_ci_high < benchmark").select(key)  # one row


def candidate_composition(fact: DataFrame, mart: DataFrame, key: str) -> DataFrame:
    """Devices, packages and travellers within each candidate, from the interactions themselves."""
    kept = fact.join(_candidates(mart, key), key, "left_semi")
    grouped = kept.groupBy(key, "device_segment", "package_segment", "traveller_segment").agg(F.count("*").alias("interaction_rows"), F.count_if(F.col("is_booking") == 1).alias("booking_rows"))
    return grouped.withColumn("booking_interaction_share", safe_rate(F.col("booking_rows"), F.col("interaction_rows")))


def bridge_composition(bridge: DataFrame, mart: DataFrame) -> DataFrame:
    """The hotel markets within each candidate destination, as the bridge has them."""
    kept = bridge.join(_candidates(mart, "srch_destination_id"), "srch_destination_id", "left_semi")
    return kept.select("srch_destination_id", "hotel_market", "interaction_rows", "booking_rows", "interaction_share_within_destination", "first_observed_date", "last_observed_date")


def seasonality(mart: DataFrame) -> DataFrame:
    """Calendar months of check-in over all years."""
    grouped = mart.groupBy(F.month("checkin_month").alias("month_number"), "traveller_segment").agg(*_sums())
    return grouped.select("month_number", "traveller_segment", "interaction_rows", "booking_rows", *_share())


def recurrence_by_age(mart: DataFrame) -> DataFrame:
    """Recurrence by age over the cohorts that can be observed at that age; censored ones are left out."""
    seen = mart.where("not is_right_censored").groupBy("observed_age_month")
    out = seen.agg(F.count("*").alias("cohorts"), F.sum("cohort_users").alias("cohort_users"), F.sum("observed_active_users").alias("active_users"))
    return out.withColumn("recurrence_share", safe_rate(F.col("active_users"), F.col("cohort_users")))


def missingness_summary(mart: DataFrame) -> DataFrame:
    """Weighted, mean and greatest missing share per field, and its slope per day."""
    day = F.unix_date("event_date").cast("double")
    return mart.groupBy("field_name").agg(
        safe_rate(F.sum("missing_rows"), F.sum("eligible_rows")).alias("weighted_share"),
        F.round(F.avg("missing_share"), 9).alias("mean_daily_share"),
        F.max("missing_share").alias("max_daily_share"),
        F.round(F.regr_slope("missing_share", day), 9).alias("slope_per_day"),
    )


def drift_bands(summary: DataFrame) -> DataFrame:
    psi = F.col("population_stability_index")
    return summary.select("dimension_name", "population_stability_index", F.when(psi < 0.1, "low").when(psi < 0.25, "moderate").otherwise("high").alias("band"))


def largest_shifts(drift: DataFrame, before: str = "train_booking", after: str = "test_booking", top: int = 10) -> DataFrame:
    """The values of each dimension whose share moved most; ``top`` is the report's length."""
    cells = drift.groupBy("dimension_name", "dimension_value").agg(*(F.coalesce(F.sum(F.when(F.col("dataset") == d, F.col("booking_population_rows"))), F.lit(0)).alias(c) for d, c in ((before, "a"), (after, "b"))))
    whole = Window.partitionBy("dimension_name")
    moved = cells.withColumn("shift", F.round((safe_rate(F.col("b"), F.sum("b").over(whole)) - safe_rate(F.col("a"), F.sum("a").over(whole))) * 100, 9))
    order = Window.partitionBy("dimension_name").orderBy(F.desc(F.abs("shift")), "dimension_value")
    return moved.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).select("dimension_name", "place", "dimension_value", F.col("shift").alias("shift_points"))


def user_activity(days: DataFrame) -> DataFrame:
    users = days.groupBy("user_id").agg(F.count("*").alias("d"), F.sum("interaction_rows").alias("r"), F.bool_or("has_booking").alias("b"))
    return users.agg(
        F.count("*").alias("identified_users"), F.count_if("b").alias("booking_users"), F.avg("d").alias("mean_days"), F.percentile("d", 0.5).alias("median_days"), F.percentile("r", 0.5).alias("median_rows"), F.max("r").alias("max_rows")
    )


def SQL(i: str, s: dict[str, str], rate, wil) -> dict[str, str]:  # noqa: N802
    """The SQL counterparts, over the SQL of the marts."""
    low, high = wil("booking_rows", "interaction_rows", Z_EXACT)
    share = f"{rate('booking_rows', 'interaction_rows')} as booking_interaction_share, {low} as ci_low, {high} as ci_high"
    sums = "sum(interaction_rows)::bigint as interaction_rows, sum(booking_rows)::bigint as booking_rows"

    whole = rate("sum(booking_rows) over (partition by {0})", "sum(interaction_rows) over (partition by {0})")

    def sets(families: list[tuple[str, ...]]) -> str:
        return " union all ".join(
            f"select '{'*'.join(f)}' as family, concat_ws('|', {', '.join(f'coalesce({k}::varchar, {chr(39)}missing{chr(39)})' for k in f)}) as label, is_booking from i" for f in families
        )

    grouped = "select family, label, count(*) as interaction_rows, count(*) filter (where is_booking = 1) as booking_rows from l group by 1, 2"
    lead, stay = "lead_time_days) filter (where has_valid_lead_time)", "stay_nights) filter (where has_valid_stay_dates)"

    return {
        "da2_overall": f"""{i}, o as (select count(*) as interaction_rows, count(*) filter (where is_booking = 1) as booking_rows, count(distinct user_id) as identified_users, sum(valid_similar_event_count) as ev from i)
          select interaction_rows, booking_rows, identified_users, {share}, {rate('ev', 'interaction_rows')} as mean_similar_event_count from o""",
        "da3_month_dynamics": f"""with m as ({s['bm4_interaction_outcome_monthly']}), x as (select event_month, interaction_rows, booking_interaction_share as sh, row_number() over w as n,
            (interaction_rows::double / lag(interaction_rows) over w - 1) * 100 as rc, (booking_interaction_share - lag(booking_interaction_share) over w) * 100 as pc from m window w as (order by event_month))
          select event_month, interaction_rows, sh as booking_interaction_share, round(rc, 9) as rows_change_percent, round(pc, 9) as share_change_points,
            coalesce(abs(rc) >= 10 and abs(pc) >= 0.1 and sign(rc) <> sign(pc), false) as diverges, round((select regr_slope(sh, n) from x), 9) as share_slope,
            sh = (select max(sh) from x) as is_peak, sh = (select min(sh) from x) as is_trough from x""",
        "da4_segment_summary": f"""with m as ({s['bm10_segment_monthly']}), g as (select segment_type, segment_value, {sums}, max(booking_interaction_share) - min(booking_interaction_share) as monthly_range, count(*) as months from m group by 1, 2)
          select segment_type, segment_value, interaction_rows, booking_rows, {share}, ({rate('booking_rows', 'interaction_rows')} - {whole.format('segment_type')}) * 100 as gap_points,
            {rate('interaction_rows', 'sum(interaction_rows) over (partition by segment_type)')} as population_share, monthly_range, months from g""",
        "da5_composition_shift": f"""with m as ({s['bm10_segment_monthly']}), e as (select min(event_month) as f, max(event_month) as l from m),
          c as (select segment_type, segment_value, coalesce(sum(interaction_rows) filter (where event_month = f), 0) as a, coalesce(sum(interaction_rows) filter (where event_month = l), 0) as b
                from m, e where event_month in (f, l) group by 1, 2),
          h as (select segment_type, segment_value, {rate('a', 'sum(a) over (partition by segment_type)')} as first_share, {rate('b', 'sum(b) over (partition by segment_type)')} as last_share from c)
          select *, (last_share - first_share) * 100 as shift_points from h""",
        "da6_geography": f"""{i}, l as ({sets([(p,) for p in PLACES])}), g as ({grouped}), j as (select *, {share}, {whole.format('family')} as benchmark from g)
          select *, case when ci_low > benchmark then 'above' when ci_high < benchmark then 'below' else 'inconclusive' end as verdict from j""",
        "da7_cross_segments": f"""{i}, l as ({sets([tuple(SEG[n] for n in c) for c in CROSSINGS])}), g as ({grouped})
          select family, label, interaction_rows, booking_rows, {share}, ({rate('booking_rows', 'interaction_rows')} - {whole.format('family')}) * 100 as gap_points from g""",
        "da8_planning_summary": f"""{i} select traveller_segment, count(*) as interaction_rows, avg({lead} as avg_lead, median({lead} as median_lead, avg({stay} as avg_stay, median({stay} as median_stay from i group by 1""",
        "da9_booking_window_ranking": f"""with m as ({s['bm17_booking_window']}) select row_number() over (order by booking_interaction_share desc, lead_time_segment, stay_segment) as place, lead_time_segment, stay_segment,
          interaction_rows, booking_rows, booking_interaction_share from m""",
        "da10_destination_concentration": f"""with m as ({s['bm11_destination_performance']}), r as (select interaction_rows, row_number() over (order by interaction_rows desc, srch_destination_id) as place from m)
          select count(*) as entities, {', '.join(f"{rate(f'sum(interaction_rows) filter (where place <= {k})', 'sum(interaction_rows)')} as top_{k}_share" for k in (1, 5, 10, 50, 100))},
            sum(interaction_rows * interaction_rows)::double / sum(interaction_rows)::double / sum(interaction_rows)::double as herfindahl from r""",
        "da10_destination_distribution": f"""with m as ({s['bm11_destination_performance']}) select support_level, count(*) as entities,
          {', '.join(f'round(quantile_cont(interaction_rows::double, {q}), 6) as {n}' for n, q in (('p10', 0.1), ('p25', 0.25), ('p50', 0.5), ('p75', 0.75), ('p90', 0.9), ('p99', 0.99)))} from m group by 1""",
        "da11_candidate_months": f"""with m as ({s['bm13_destination_monthly']}), e as ({s['bm11_destination_performance']}), w as (select {rate('sum(booking_rows)', 'sum(interaction_rows)')} as benchmark from e)
          select srch_destination_id, count(*) as months, count(*) filter (where m.booking_interaction_share < benchmark) as months_below, {sums} from m, w
          where srch_destination_id in (select srch_destination_id from e, w where booking_interaction_share_ci_high < benchmark) group by 1""",
        "da12_seasonality": f"""with m as ({s['bm16_checkin_seasonality']}), g as (select month(checkin_month)::int as month_number, traveller_segment, {sums} from m group by 1, 2)
          select month_number, traveller_segment, interaction_rows, booking_rows, {share} from g""",
        "da13_recurrence_by_age": f"""with m as ({s['am1_observed_recurrence']}) select observed_age_month, count(*) as cohorts, sum(cohort_users)::bigint as cohort_users, sum(observed_active_users)::bigint as active_users,
          {rate('sum(observed_active_users)', 'sum(cohort_users)')} as recurrence_share from m where not is_right_censored group by 1""",
        "da14_missingness_summary": f"""with m as ({s['am2_missingness_daily']}) select field_name, {rate('sum(missing_rows)', 'sum(eligible_rows)')} as weighted_share, round(avg(missing_share), 9) as mean_daily_share,
          max(missing_share) as max_daily_share, round(regr_slope(missing_share, event_date - date '1970-01-01'), 9) as slope_per_day from m group by 1""",
        "da15_drift_bands": f"""with m as ({s['am5_booking_population_drift_summary']}) select dimension_name, population_stability_index,
          case when population_stability_index < 0.1 then 'low' when population_stability_index < 0.25 then 'moderate' else 'high' end as band from m""",
        "da15_largest_shifts": f"""with m as ({s['am4_booking_population_drift']}), c as (select dimension_name, dimension_value, coalesce(sum(booking_population_rows) filter (where dataset = 'train_booking'), 0) as a,
            coalesce(sum(booking_population_rows) filter (where dataset = 'test_booking'), 0) as b from m group by 1, 2),
          h as (select dimension_name, dimension_value, round(({rate('b', 'sum(b) over (partition by dimension_name)')} - {rate('a', 'sum(a) over (partition by dimension_name)')}) * 100, 9) as sh from c),
          r as (select *, row_number() over (partition by dimension_name order by abs(sh) desc, dimension_value) as place from h) select dimension_name, place, dimension_value, sh as shift_points from r where place <= 10""",
        "da16_user_activity": f"""{s['cf4_fct_user_day'].rpartition('select * from u')[0]}, g as (select user_id, count(*) as d, sum(interaction_rows)::bigint as r, bool_or(has_booking) as b from u group by 1)
          select count(*) as identified_users, count(*) filter (where b) as booking_users, avg(d) as mean_days, median(d) as median_days, median(r) as median_rows, max(r) as max_rows from g""",
    }
