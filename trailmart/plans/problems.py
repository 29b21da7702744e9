"""The pN_ queries of the general data-processing problems, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmart.functions.cells import DATE, DECIMAL, INTEGER, TIMESTAMP, read_cell
from trailmart.operators.diff import table_diff
from trailmart.operators.features import entity_features, last_day, merged_features, partial_features
from trailmart.operators.quality import RULES, column_profile, load_departures
from trailmart.operators.rejects import TRAIN_FIELDS, accepted, parse_lines, rejected
from trailmart.operators.sessions import sessionize
from trailmart.session import checkpointed, table

SQL_KIND = {"timestamp": "TIMESTAMP", "date": "DATE", "float64": "DOUBLE", "int8": "TINYINT", "int16": "SMALLINT", "int32": "INTEGER", "int64": "BIGINT"}
SPARK_KIND = {"timestamp": "timestamp_ntz", "date": "date", "float64": "double", "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint"}
EVENT_TYPES = 200


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    found = sessionize(table(spark, folder, "train"), "user_id", "date_time")
    return found.select("user_id", *(F.substring(F.col(c).cast("string"), 1, 19).alias(c) for c in ("session_start", "session_end")))


def p2_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return sessionize(table(spark, folder, "train"), "user_id", "date_time")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    train = [name for name, _ in TRAIN_FIELDS]
    raw = table(spark, folder, "raw_train")
    raw = raw.select("source_scan_ordinal", *(read_cell(F.col(n), SPARK_KIND[k]).alias(n) for n, k in TRAIN_FIELDS))
    events = table_diff(raw, table(spark, folder, "processed_train"), "source_scan_ordinal", train, "raw", "processed")
    latent = [f"d{i}" for i in range(1, 150)]
    raw = table(spark, folder, "raw_destinations")
    raw = raw.select(read_cell(F.col("srch_destination_id"), "int").alias("srch_destination_id"), *(read_cell(F.col(c), "float").alias(c) for c in latent))
    places = table_diff(raw, table(spark, folder, "processed_destinations"), "srch_destination_id", latent, "raw", "processed")
    return events.withColumn("dataset", F.lit("train")).unionByName(places.withColumn("dataset", F.lit("destinations"))).select("dataset", "row_key", "field", "kind")


EVENT_TYPE = "hotel_cluster * 2 + is_booking"


def p5_features(spark: SparkSession, folder: str) -> DataFrame:
    return entity_features(table(spark, folder, "fct_hotel_interactions"), "user_id", EVENT_TYPE, EVENT_TYPES, "event_date", "similar_event_count", "interaction_id")


def p5_features_of_stored_months(spark: SparkSession, folder: str) -> DataFrame:
    """The features of the events of 2014 alone, from stored monthly partial results of all events."""
    events = table(spark, folder, "fct_hotel_interactions")
    stored = checkpointed(partial_features(events, "user_id", EVENT_TYPE, EVENT_TYPES, "event_date", "similar_event_count", "interaction_id"))
    return merged_features(stored.where("part >= date'2014-01-01' and part < date'2015-01-01'"), "user_id", EVENT_TYPES, last_day(events, "event_date"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return load_departures(table(spark, folder, "fct_hotel_interactions"))


def p6_profile(spark: SparkSession, folder: str) -> DataFrame:
    return column_profile(table(spark, folder, "fct_hotel_interactions"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return rejected(parse_lines(table(spark, folder, "train_lines")))


def p7_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return accepted(parse_lines(table(spark, folder, "train_lines")))


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_sessions, p4_found, p5_features, p5_features_of_stored_months, p6_found, p6_profile, p7_found, p7_loaded)}


SESSIONS = """
with seen as (select user_id, date_time, date_time - lag(date_time) over (partition by user_id order by date_time) as gap
              from train where user_id is not null and date_time is not null),
     numbered as (select user_id, date_time, sum(case when gap is null or gap > interval 1800 second then 1 else 0 end)
                  over (partition by user_id order by date_time range between unbounded preceding and current row) as session_no from seen),
     sessions as (select user_id, session_no::bigint as session_no, min(date_time) as session_start, max(date_time) as session_end,
                  count(*) as event_count from numbered group by all)
"""


def _cell(name: str, kind: str) -> str:
    pattern = {"timestamp": TIMESTAMP, "date": DATE, "float64": DECIMAL, "float32": DECIMAL}.get(kind, INTEGER)
    target = {"float32": "FLOAT"}.get(kind) or SQL_KIND[kind]
    text = f"trim({name})"
    plain = f"replace({text}, 'T', ' ')" if kind == "timestamp" else f"replace({text}, '+', '')" if kind.startswith("int") else text
    return f"case when regexp_matches({text}, '{pattern}') then try_cast({plain} as {target}) end as {name}"


def _diff_sql(name: str, raw: str, processed: str, key: str, fields: list[tuple[str, str]], typed_key: bool) -> str:
    cells = ", ".join(([_cell(key, "int32")] if typed_key else [key]) + [_cell(n, k) for n, k in fields])
    names = ", ".join(n for n, _ in fields)
    value = " union all ".join(
        f"select r.{key}, '{n}', 'value' from {name}_r r join {name}_p p using ({key}) where r.{n} is distinct from p.{n}" for n, _ in fields
    )
    ctes = f"""{name}_r as (select distinct * from (select {cells} from {raw}) where {key} is not null),
      {name}_p as (select distinct {key}, {names} from {processed} where {key} is not null)"""
    body = f"""select '{name}' as dataset, x.* from (
        select {key}::bigint as row_key, '' as field, 'missing_in_processed' as kind from {name}_r where {key} not in (select {key} from {name}_p)
        union all select {key}, '', 'missing_in_raw' from {name}_p where {key} not in (select {key} from {name}_r) union all {value}) x"""
    return ctes, body


def _p4_sql() -> str:
    a, x = _diff_sql("train", "raw_train", "processed_train", "source_scan_ordinal", list(TRAIN_FIELDS), False)
    b, y = _diff_sql("destinations", "raw_destinations", "processed_destinations", "srch_destination_id", [(f"d{i}", "float32") for i in range(1, 150)], True)
    return f"with {a}, {b} {x} union all {y}"


P5 = """
with once as (select interaction_id, min(struct_pack(u := user_id, k := hotel_cluster * 2 + is_booking, d := event_date, a := coalesce(similar_event_count, 0))) as x
              from fct_hotel_interactions where interaction_id is not null group by 1),
     events as (select x.u as user_id, x.k as k, x.d as d, x.a as a from once
                union all select user_id, hotel_cluster * 2 + is_booking, event_date, coalesce(similar_event_count, 0) from fct_hotel_interactions where interaction_id is null),
     cells as (select user_id, k, count(*) as n, max(d) as last, sum(a)::bigint as total from events where user_id is not null and k between 0 and 199 group by all),
     grid as (select user_id, k from (select distinct user_id from events where user_id is not null), (select unnest(range(200)) as k)),
     today as (select max(event_date) as t from fct_hotel_interactions)
select user_id, list(coalesce(n, 0) order by k) as counts, list((t - last)::int order by k) as days_since, list(coalesce(total, 0) order by k) as totals
from grid left join cells using (user_id, k), today group by user_id
"""

P6_FOUND = """
with f as (select load_id, orig_destination_distance as dist, checkin_date as ci, datediff('day', event_date, checkin_date) as days, hotel_market as m, user_id as u from fct_hotel_interactions),
     s as (select load_id, 'orig_destination_distance' as c, dist::varchar as k, dist::double as v, dist is not null as filled, not isnan(dist) and dist between 0 and 13000 as inside from f
           union all select load_id, 'checkin_date', ci::varchar, days, ci is not null, days between 0 and 730 from f
           union all select load_id, 'hotel_market', m::varchar, m, m is not null, m between 1 and 2500 from f
           union all select load_id, 'user_id', u::varchar, u, u is not null, u between 1 and 999999999 from f),
     tops as (select load_id, c, max(n) as top from (select load_id, c, k, count(*) as n from s where filled group by all) group by all),
     figures as (select load_id, c, avg((not filled)::int) as nulls, avg((not coalesce(inside, false))::int) filter (where filled) as outside,
                 any_value(top) / count(*) filter (where filled) as top, case when c <> 'user_id' then median(v) filter (where inside) end as med
                 from s left join tops using (load_id, c) group by load_id, c),
     judged as (select *, median(nulls) over w as un, median(top) over w as ut, median(med) over w as um from figures window w as (partition by c))
select load_id::bigint as load_id, c as column_name, kind from (
  select load_id, c, 'nulls' as kind from judged where abs(nulls - un) > 0.08
  union all select load_id, c, 'out_of_range' from judged where outside > 0.05
  union all select load_id, c, 'top_value' from judged where top - ut > 0.15
  union all select load_id, c, 'shift' from judged where abs(med - um) > 0.25 * abs(um))
"""


#: Columns of the interaction table by kind, for the profile's SQL.
PROFILED = {
    "varchar": ("interaction_id", "device_segment", "traveller_segment"),
    "timestamp": ("event_datetime", "loaded_at"),
    "date": ("event_date", "event_month", "checkin_date", "checkout_date"),
    "number": (
        "event_year", "event_month_num", "site_name", "posa_continent", "user_location_country", "user_location_region", "user_location_city",
        "orig_destination_distance", "user_id", "is_mobile", "is_package", "channel", "lead_time_days", "stay_nights", "srch_adults_cnt", "srch_children_cnt",
        "srch_rm_cnt", "srch_destination_id", "srch_destination_type_id", "is_booking", "similar_event_count", "hotel_continent", "hotel_country", "hotel_market", "hotel_cluster",
    ),
}


def _p6_profile_sql() -> str:
    parts = []
    for kind, names in PROFILED.items():
        for c in names:
            number = {"timestamp": f"epoch({c})::double", "date": f"({c} - date '1970-01-01')::double", "number": f"{c}::double", "varchar": "null::double"}[kind]
            rule = RULES.get(c)
            if rule and "rlike" in rule:
                rule = f"regexp_matches({c}, {rule.split(' rlike ')[1]})"
            elif c == "checkin_date":
                rule = "datediff('day', event_date, checkin_date) between 0 and 730"
            text = c if kind == "varchar" else "null::varchar"
            value = f"case when {c} = 0 then '0' when isnan({c}::double) then 'nan' else {c}::varchar end" if kind == "number" else f"{c}::varchar"  # 0 and -0 are one value, and so are all NaN
            parts.append(f"select load_id, '{c}' as column_name, {c} is not null as filled, {value} as value, {text} as txt, {number} as num, {f'not coalesce({rule}, false)' if rule else 'false'} as broken from fct_hotel_interactions")
    return f"""
    with l as ({' union all '.join(parts)}),
         f as (select *, case when isfinite(num) then num end as v from l),
         g as (select load_id, column_name, count(*) as row_count, count(*) - count(*) filter (where filled) as gone, count(distinct value) as distinct_values,
                 min(v) as min_number, max(v) as max_number, min(txt) as min_text, max(txt) as max_text, count(*) filter (where filled and broken) as violations,
                 count(v) as m, avg(v) as mean, var_pop(v) as var from f group by all),
         h as (select a.load_id, a.column_name, sum(b.m) as rm, sum(b.m * b.mean) / nullif(sum(b.m), 0) as rest from g a join g b on a.column_name = b.column_name and a.load_id is distinct from b.load_id group by all),
         d as (select h.*, sum(b.m * b.var + b.m * (b.mean - rest) * (b.mean - rest)) / nullif(any_value(rm), 0) as rest_var
                 from h join g b on h.column_name = b.column_name and h.load_id is distinct from b.load_id group by all),
         e as (select g.*, rm, rest, sqrt((var + rest_var) / 2) as spread from g left join d on g.load_id is not distinct from d.load_id and g.column_name = d.column_name)
    select load_id::bigint as load_id, column_name, row_count, gone::double / row_count as null_share, distinct_values, min_number, max_number, min_text, max_text, violations, mean,
      case when rm > 0 and mean is not null and spread > 0 then round((mean - rest) / spread, 6) end as std_difference from e"""


def _p7_sql() -> str:
    field = '(?:"(?:[^"]|"")*"|[^",]*)'
    checks = []
    for i, (name, kind) in enumerate(TRAIN_FIELDS, 1):
        x = f"trim(v[{i}])"
        pattern = {"timestamp": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "date": r"^\d{4}-\d{2}-\d{2}$", "float64": r"^[+-]?\d+(\.\d+)?$"}.get(kind, r"^[+-]?\d+$")
        plain = f"replace({x}, '+', '')" if kind.startswith("int") else x
        bad = f"not regexp_matches({x}, '{pattern}') or try_cast({plain} as {SQL_KIND[kind]}) is null"
        if kind == "timestamp":
            bad += f" or regexp_matches({x}, ' 24:')"
        domain = {"is_mobile": (0, 1), "is_package": (0, 1), "is_booking": (0, 1), "hotel_cluster": (0, 99)}.get(name)
        last = f" when try_cast({plain} as BIGINT) not between {domain[0]} and {domain[1]} then '{name}:domain_error'" if domain else ""
        empty = f"'{name}:missing'" if name in ("date_time", "is_booking") else "null"
        checks.append(f"case when {x} = '' then {empty} when {bad} then '{name}:parse_error'{last} end")
    return f"""
    with lines as (select line_id, coalesce(raw_line, '') as l from train_lines),
         cut as (select line_id, regexp_matches(l, '^{field}(,{field})*$') as quoted, regexp_extract_all(l || ',', '({field}),', 1) as v from lines),
         plain as (select line_id, quoted, list_transform(v, lambda x: case when x like '"%' then replace(x[2:-2], '""', '"') else x end) as v from cut),
         judged as (select line_id, case when not quoted then ['quoting'] when len(v) <> 24 then ['column_count'] else [{", ".join(checks)}] end as r from plain)
    select line_id, reason from (select line_id, unnest(r) as reason from judged) where reason is not null"""


def _p7_loaded_sql() -> str:
    found = _p7_sql()
    columns = []
    for i, (name, kind) in enumerate(TRAIN_FIELDS, 1):
        x = f"nullif(trim(v[{i}]), '')"
        plain = f"replace({x}, '+', '')" if kind.startswith("int") else x
        columns.append(f"{plain}::{SQL_KIND[kind]} as {name}")
    ctes = found[: found.rindex("select line_id, reason from")]
    return f"{ctes}, bad as (select line_id from judged where len(list_filter(r, lambda x: x is not null)) > 0) select line_id, {', '.join(columns)} from plain where line_id not in (select line_id from bad)"


def oracle_sql() -> dict[str, str]:
    stamp = "strftime({0}, '%Y-%m-%d %H:%M:%S') as {0}"
    return {
        "p2_found": f"{SESSIONS} select user_id, {stamp.format('session_start')}, {stamp.format('session_end')} from sessions",
        "p2_sessions": f"{SESSIONS} select *, (epoch_us(session_end) - epoch_us(session_start)) / 1e6 as duration_seconds from sessions",
        "p4_found": _p4_sql(),
        "p5_features": P5,
        "p5_features_of_stored_months": P5.replace("     cells as", "     kept as (select * from events where d >= date '2014-01-01' and d < date '2015-01-01'),\n     cells as")
        .replace("total from events where", "total from kept where").replace("(select distinct user_id from events", "(select distinct user_id from kept"),
        "p6_found": P6_FOUND,
        "p6_profile": _p6_profile_sql(),
        "p7_found": _p7_sql(),
        "p7_loaded": _p7_loaded_sql(),
    }
