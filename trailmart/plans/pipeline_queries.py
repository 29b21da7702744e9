"""Staging and recommender by name, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.plans import marts, recommend, staging
from trailmart.plans.facts import interactions
from trailmart.plans.problems import SQL_KIND, _cell
from trailmart.schema import DESTINATIONS, TEST, TRAIN
from trailmart.session import checkpointed, table


def train(spark: SparkSession, folder: str) -> staging.Staged:
    return staging.stage(table(spark, folder, "raw_train"), TRAIN)


def destinations(spark: SparkSession, folder: str) -> staging.Staged:
    return staging.stage(table(spark, folder, "raw_destinations"), DESTINATIONS, "srch_destination_id")


def history(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.history(events(spark, folder))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """The typed copy, each row once."""
    return table(spark, folder, "processed_train").distinct()


def asked(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.validation_queries(events(spark, folder))


def proposed(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.candidates(asked(spark, folder), history(spark, folder))


def final(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.final_candidates(proposed(spark, folder))


def once(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Queries, proposals and final ranks, the events and proposals stored once for all that read them."""
    known = checkpointed(events(spark, folder))
    queries = recommend.validation_queries(known)
    offered = checkpointed(recommend.candidates(queries, recommend.history(known)))
    return queries, offered, recommend.final_candidates(offered)


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.metrics(*once(spark, folder))


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    queries, _, ranks = once(spark, folder)
    return recommend.predictions(queries, ranks)


def prepared_train(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.prepared(table(spark, folder, "raw_train"), TRAIN, distance_key=True)


def prepared_test(spark: SparkSession, folder: str) -> DataFrame:
    """There is no raw test table: the raw training rows stand in, by their ordinal as id and without their outcome."""
    raw = table(spark, folder, "raw_train")
    return recommend.prepared(raw.select(F.col("source_scan_ordinal").cast("string").alias("id"), *(c.name for c in TEST if c.name != "id")), TEST, distance_key=True)


def submission(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters for every row of the stand-in test set, from all events."""
    asked_ = checkpointed(recommend.test_queries(prepared_test(spark, folder).distinct()))
    return recommend.submission(asked_, recommend.final_candidates(recommend.candidates(asked_, recommend.history(events(spark, folder), None))))


def reconciliation(which):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        staged = which(spark, folder)
        return staging.multiset_reconciliation(staged.classified, staged.accepted, staged.quarantine)

    return run


def _lookup(n: int):
    return lambda s, d: recommend.lookup(history(s, d), recommend.LOOKUPS[n - 1])


QUERIES = {
    "st2_row_fingerprint": lambda s, d: train(s, d).classified.select("source_scan_ordinal", "raw_row_fingerprint").distinct(),
    "st3_reject_reasons": lambda s, d: train(s, d).classified.where("reject_reasons <> ''").select("source_scan_ordinal", "reject_reasons"),
    "st4_train_multiplicity": lambda s, d: train(s, d).classified.select("raw_row_fingerprint", "duplicate_group_size", "duplicate_occurrence", "reject_reasons"),
    "st5_train_accepted": lambda s, d: train(s, d).accepted,
    "st5_train_quarantine": lambda s, d: train(s, d).quarantine,
    "st6_train_reconciliation": reconciliation(train),
    "st7_destinations_accepted": lambda s, d: destinations(s, d).accepted.drop("raw_row_fingerprint", "duplicate_group_size", "duplicate_occurrence"),
    "st7_destinations_rejected": lambda s, d: destinations(s, d).quarantine.groupBy("reject_reasons").agg(F.count("*").alias("n")),
    "st8_event_partitions": lambda s, d: staging.with_event_partitions(train(s, d).accepted).groupBy("event_year", "event_month_num").agg(F.count("*").alias("n")),
    "cf1_interactions_of_staged": lambda s, d: interactions(train(s, d).accepted).select("interaction_id", "event_datetime", "trip_date_quality"),
    "am6_data_quality_summary": lambda s, d: marts.quality_summary(staging.population_counts(train(s, d), destinations(s, d))),
    "rc2_history_weight": lambda s, d: history(s, d).select("source_scan_ordinal", (F.col("tenths") / 10.0).alias("event_weight")),
    "rc3_validation_queries": lambda s, d: asked(s, d).select("row_id", "date_time", "user_id", "hotel_cluster"),
    **{f"rc5_{name}": _lookup(n) for n, name in enumerate(("exact_geo", "city_distance", "user_destination", "destination_market", "market", "global"), 1)},
    "rc6_candidates": proposed,
    "rc7_final_candidates": final,
    "rc8_metrics": metrics,
    "rc9_predictions": predictions,
    "rc1_prepared_train": prepared_train,
    "rc1_prepared_destinations": lambda s, d: recommend.prepared(table(s, d, "raw_destinations"), DESTINATIONS),
    "rc4_test_queries": lambda s, d: recommend.test_queries(prepared_test(s, d)).select("row_id", "date_time", "user_id", "srch_destination_id"),
    "rc9_submission": submission,
}

_KIND = {"timestamp_ntz": "timestamp", "date": "date", "double": "float64", "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64"}
assert set(_KIND.values()) == set(SQL_KIND)


def _reason(c) -> str:
    value = _cell(c.name, _KIND[c.kind]).rpartition(" as ")[0]
    first = f"when coalesce(trim({c.name}), '') = '' then '{c.name}:missing'" if c.required else f"when coalesce(trim({c.name}), '') = '' then null"
    last = f" when {value} not between {c.domain[0]} and {c.domain[1]} then '{c.name}:domain_error'" if c.domain else ""
    return f"case {first} when {value} is null then '{c.name}:parse_error'{last} end"


def _classified(source: str, columns, key: str | None) -> str:
    print_ = " || ".join(f"case when {c.name} is null then '-1:' else length({c.name}) || ':' || {c.name} end" for c in columns)
    reasons = ", ".join(_reason(c) for c in columns)
    typed = ", ".join(f"{_cell(c.name, _KIND[c.kind]).rpartition(' as ')[0]} as t_{c.name}" for c in columns)
    order = "source_scan_ordinal" if not key else "fp"
    first = f", row_number() over (partition by t_{key} order by case when base = '' then 0 else 1 end, {order}, duplicate_occurrence) as nth" if key else ", 1 as nth"
    lineage = "source_scan_ordinal, " if not key else ""
    return f"""with a as (select *, sha256({print_}) as fp, concat_ws(';', {reasons}) as base, {typed} from {source}),
      b as (select *, count(*) over (partition by fp) as duplicate_group_size, row_number() over (partition by fp order by {order}) as duplicate_occurrence from a),
      x as (select *{first} from b),
      k as (select {lineage}fp as raw_row_fingerprint, duplicate_group_size, duplicate_occurrence, case when base <> '' then base when nth > 1 then '{key}:duplicate_key' else '' end as reject_reasons,
        {', '.join(f't_{c.name}' for c in columns)}, {', '.join(f'{c.name} as raw__{c.name}' for c in columns)} from x)"""


T_ = _classified("raw_train", TRAIN, None)
D_ = _classified("raw_destinations", DESTINATIONS, "srch_destination_id")
_LINEAGE = "source_scan_ordinal, raw_row_fingerprint, duplicate_group_size, duplicate_occurrence"
_TYPED = ", ".join(f"t_{c.name} as {c.name}" for c in TRAIN)
H_ = f"""with e as (select distinct * from processed_train),
  h as (select *, greatest(1, datediff('month', date '2012-12-01', date_time::date))::bigint as age from e where date_time < timestamp '{recommend.CUTOFF}'),
  hist as (select *, age * age * (30 + 176 * is_booking) as tenths from h),
  q as (select *, source_scan_ordinal as row_id from e where date_time >= timestamp '{recommend.CUTOFF}' and is_booking = 1)"""


def _lookup_sql(keys: tuple[str, ...]) -> str:
    known = " and ".join(f"{k} is not null" for k in keys) or "true"
    listed = "".join(f"{k}, " for k in keys)
    part = f"partition by {', '.join(keys)} " if keys else ""
    return f"""(select * from (select *, row_number() over ({part}order by tenths desc, hotel_cluster) as source_rank
      from (select {listed}hotel_cluster, sum(tenths)::bigint as tenths from hist where {known} group by {listed}hotel_cluster)) where source_rank <= 5)"""


_PARTS = " union all ".join(
    f"select q.row_id, l.hotel_cluster, {n} as source_priority, l.source_rank, l.tenths from q {'join ' + _lookup_sql(k) + ' l on ' + ' and '.join(f'q.{c} = l.{c}' for c in k) if k else 'cross join ' + _lookup_sql(k) + ' l'}"
    for n, k in enumerate(recommend.LOOKUPS, 1)
)
C_ = f"""{H_}, p as ({_PARTS}),
  best as (select *, row_number() over (partition by row_id, hotel_cluster order by source_priority, source_rank, tenths desc) as nth from p),
  f as (select * from (select row_id, hotel_cluster, source_priority, source_rank, row_number() over (partition by row_id order by source_priority, source_rank, tenths desc, hotel_cluster) as final_rank
        from best where nth = 1) where final_rank <= 5)"""

SQL = {
    "st2_row_fingerprint": f"{T_} select distinct source_scan_ordinal, raw_row_fingerprint from k",
    "st3_reject_reasons": f"{T_} select source_scan_ordinal, reject_reasons from k where reject_reasons <> ''",
    "st4_train_multiplicity": f"{T_} select raw_row_fingerprint, duplicate_group_size, duplicate_occurrence, reject_reasons from k",
    "st5_train_accepted": f"{T_} select {_LINEAGE}, {_TYPED} from k where reject_reasons = ''",
    "st5_train_quarantine": f"{T_} select {_LINEAGE}, reject_reasons, {', '.join(f'raw__{c.name}' for c in TRAIN)} from k where reject_reasons <> ''",
    "st6_train_reconciliation": f"{T_} select raw_row_fingerprint, count(*) as raw_count, count(*) as output_count, true as reconciles from k group by 1",
    "st7_destinations_accepted": f"{D_} select {', '.join(f't_{c.name} as {c.name}' for c in DESTINATIONS)} from k where reject_reasons = ''",
    "st7_destinations_rejected": f"{D_} select reject_reasons, count(*) as n from k where reject_reasons <> '' group by 1",
    "st8_event_partitions": f"{T_} select year(t_date_time)::smallint as event_year, month(t_date_time)::tinyint as event_month_num, count(*) as n from k where reject_reasons = '' group by 1, 2",
    "rc2_history_weight": f"{H_} select source_scan_ordinal, tenths / 10.0 as event_weight from hist",
    "rc3_validation_queries": f"{H_} select row_id, date_time, user_id, hotel_cluster from q",
    **{
        f"rc5_{name}": f"{H_} select * from {_lookup_sql(k)}"
        for name, k in zip(("exact_geo", "city_distance", "user_destination", "destination_market", "market", "global"), recommend.LOOKUPS, strict=True)
    },
    "rc6_candidates": f"{C_} select * from p",
    "rc7_final_candidates": f"{C_} select row_id, hotel_cluster, source_priority, source_rank, final_rank from f",
    "rc8_metrics": f"""{C_} select count(*) as validation_rows, avg((final_rank is not null)::int) as recall_at_5, round(avg(coalesce(1.0::double / final_rank, 0.0::double)), 12) as map_at_5,
      avg((q.row_id in (select row_id from p where source_priority = 1))::int) as exact_geo_coverage, avg((q.row_id in (select row_id from p where source_priority = 2))::int) as city_distance_coverage
      from q left join f on q.row_id = f.row_id and q.hotel_cluster = f.hotel_cluster""",
    "rc9_predictions": f"""{C_} select q.row_id, q.hotel_cluster as actual_hotel_cluster, string_agg(f.hotel_cluster::varchar, ' ' order by final_rank) as predicted_hotel_clusters
      from q left join f using (row_id) group by 1, 2""",
}
_PREPARED = ", ".join(_cell(c.name, _KIND[c.kind]) for c in TRAIN)
_RAW_KEY = "nullif(trim(orig_destination_distance), '') as orig_destination_distance_key"
_TEST = f"t as (select source_scan_ordinal as id, {', '.join(_cell(c.name, _KIND[c.kind]) for c in TEST if c.name != 'id')}, {_RAW_KEY} from raw_train)"
SQL["rc1_prepared_train"] = f"select * from (select source_scan_ordinal, {_PREPARED}, {_RAW_KEY} from raw_train) where date_time is not null and hotel_cluster between 0 and 99"
SQL["rc1_prepared_destinations"] = f"select * from (select {', '.join(_cell(c.name, _KIND[c.kind]) for c in DESTINATIONS)} from raw_destinations) where srch_destination_id is not null"
SQL["rc4_test_queries"] = f"with {_TEST} select id as row_id, date_time, user_id, srch_destination_id from t where date_time is not null"
SQL["rc9_submission"] = (
    C_.replace("where date_time < timestamp '" + recommend.CUTOFF + "'", "").replace(
        "q as (select *, source_scan_ordinal as row_id from e where date_time >= timestamp '" + recommend.CUTOFF + "' and is_booking = 1)",
        f"{_TEST}, q as (select distinct *, id as row_id from t where date_time is not null)",
    )
    + """ select q.row_id as id, coalesce(string_agg(f.hotel_cluster::varchar, ' ' order by final_rank), '') as hotel_cluster from (select distinct row_id from q) q left join f using (row_id) group by 1"""
)

from trailmart.plans.sqltext import interactions_cte  # noqa: E402

_I = interactions_cte("s", "sha256(raw_row_fingerprint || ':' || duplicate_occurrence)")
SQL["cf1_interactions_of_staged"] = f"{T_}, s as (select {_LINEAGE}, {_TYPED} from k where reject_reasons = ''), {_I} select interaction_id, event_datetime, trip_date_quality from i"

SQL["am6_data_quality_summary"] = f"""with t as ({T_} select count(*) as r, count(*) filter (where reject_reasons = '') as a, count(*) filter (where reject_reasons <> '') as q from k),
  d as ({D_} select count(*) as r, count(*) filter (where reject_reasons = '') as a, count(*) filter (where reject_reasons <> '') as q from k),
  u as (select 'raw_train_rows' as quality_rule, r as affected_rows, r as denominator_rows, 'info' as severity from t union all select 'accepted_train_rows', a, r, 'info' from t
    union all select 'quarantined_train_rows', q, r, 'warning' from t union all select 'raw_train_reconciliation_gap', r - a - q, r, 'critical' from t
    union all select 'raw_destination_reconciliation_gap', r - a - q, r, 'critical' from d)
  select *, affected_rows::double / denominator_rows as affected_share from u"""


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
