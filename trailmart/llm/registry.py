"""The pN_ queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmart.llm.distinct import distinct_counts, estimates, register_rows, roll_up
from trailmart.llm.packing import pack
from trailmart.llm.quantiles import merged_quantiles, partial_sketches
from trailmart.llm.sentences import find_sentences
from trailmart.llm.tokens import decode, encode
from trailmart.session import checkpointed, table

USER_KEYS = ("load_id", "event_date", "srch_destination_id", "device_segment", "is_booking")
USER_SETS = (
    (),
    ("load_id",),
    ("event_date",),
    ("srch_destination_id",),
    ("device_segment",),
    ("event_date", "device_segment"),
    ("event_date", "is_booking"),
    ("srch_destination_id", "is_booking"),
    ("event_date", "srch_destination_id"),
)
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def p1_distinct_users(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_counts(table(spark, folder, "fct_hotel_interactions"), "user_id", USER_KEYS, USER_SETS)


def p1_distinct_users_portable(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a hash that any SQL engine has."""
    return distinct_counts(table(spark, folder, "fct_hotel_interactions"), "user_id", USER_KEYS, USER_SETS, hash_kind="md5")


STORED_DAYS = "event_date >= date'2014-01-01' and event_date < date'2015-01-01'"


def p1_of_stored_days(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of 2014 alone, merged from stored registers of each load, day and group."""
    stored = checkpointed(register_rows(table(spark, folder, "fct_hotel_interactions"), USER_KEYS, "user_id", hash_kind="md5"))
    return estimates(roll_up(stored.where(STORED_DAYS), USER_KEYS, USER_SETS))


def p1_error_check(spark: SparkSession, folder: str) -> DataFrame:
    """How many estimates lie within 4.5 standard errors (and one) of the number counted exactly."""
    events = table(spark, folder, "fct_hotel_interactions").where("user_id is not null")
    sets = F.explode(F.array(*(F.struct(F.lit(",".join(s) or "all").alias("grouping"), F.to_json(F.struct(*(F.col(k).cast("string").alias(k) for k in s))).alias("at")) for s in USER_SETS if s)))
    exact = events.select(sets.alias("g"), "user_id").select("g.*", "user_id").distinct().groupBy("grouping", "at").agg(F.count("*").alias("n"))
    found = p1_distinct_users(spark, folder)
    at = F.coalesce(*(F.when(F.col("grouping") == ",".join(s), F.to_json(F.struct(*(F.col(k).cast("string").alias(k) for k in s)))) for s in USER_SETS if s))
    both = exact.join(found.select("grouping", at.alias("at"), "users", "standard_error"), ["grouping", "at"], "left")
    near = F.abs(F.col("users") - F.col("n")) <= 1 + 4.5 * F.col("standard_error") * F.col("n")
    return both.groupBy("grouping").agg(F.count("*").alias("groups"), F.count_if(near).alias("near"))


def p3_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, Column, dict[str, Column], dict[str, Column]]:
    rows = table(spark, folder, "train")
    month = F.trunc(F.col("date_time").cast("date"), "MM")
    groupings = {"site_name": F.col("site_name"), "hotel_country": F.col("hotel_country"), "month": F.date_format(month, "yyyyMM").cast("int")}
    columns = {
        "orig_destination_distance": F.col("orig_destination_distance"),
        "days_to_srch_ci": F.date_diff("srch_ci", F.col("date_time").cast("date")),
        "srch_adults_cnt": F.col("srch_adults_cnt"),
    }
    return rows, month, groupings, columns


def p3_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    rows, month, groupings, columns = p3_inputs(spark, folder)
    return merged_quantiles(partial_sketches(rows, groupings, month, columns), QUANTILES)


def p3_rank_check(spark: SparkSession, folder: str) -> DataFrame:
    """How many answers of p3_percentiles have their rank, counted exactly, within four standard errors and a thousandth (or one row)."""
    rows, _, groupings, columns = p3_inputs(spark, folder)
    keys = ["grouping", "g", "column_name"]
    groups = F.explode(F.array(*(F.struct(F.lit(n).alias("grouping"), F.coalesce(c.cast("string"), F.lit("none")).alias("g")) for n, c in groupings.items())))
    seen = rows.select(groups.alias("x"), F.struct(*(c.cast("double").alias(n) for n, c in columns.items())).alias("_"))
    values = F.explode(F.array(*(F.struct(F.lit(n).alias("column_name"), F.col(f"_.{n}").alias("v")) for n in columns)))
    counts = seen.select("x.*", values.alias("y")).select("grouping", "g", "y.*").where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy(*keys, "v").agg(F.count("*").alias("c"))
    names = [f"p{round(q * 100):02d}" for q in QUANTILES]
    answers = p3_percentiles(spark, folder).withColumn("g", F.coalesce(F.col("group_value").cast("string"), F.lit("none")))
    answers = answers.select(*keys, "n", "rank_error", F.explode(F.array(*(F.struct(F.lit(q).alias("q"), F.col(n).alias("value")) for q, n in zip(QUANTILES, names, strict=True)))).alias("a")).select(
        *keys, "n", "rank_error", "a.*"
    )
    slack = F.abs("value") * 2.0**-11
    ranked = (
        answers.join(counts, keys)
        .groupBy(*keys, "n", "rank_error", "q", "value")
        .agg(F.sum(F.when(F.col("v") < F.col("value") - slack, F.col("c")).otherwise(0)).alias("below"), F.sum(F.when(F.col("v") <= F.col("value") + slack, F.col("c")).otherwise(0)).alias("upto"))
    )
    rank = F.ceil(F.col("q") * F.col("n"))
    off = F.greatest(F.lit(0), F.col("below") - rank + 1, rank - F.col("upto"))
    near = off <= F.greatest(F.lit(1.0), (0.001 + 4 * F.col("rank_error")) * F.col("n"))
    return ranked.groupBy("grouping", "column_name").agg(F.count("*").alias("answers"), F.count_if(near).alias("near"))


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode(table(spark, folder, "documents"))


def p8_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """How many documents come back as they were from their ids."""
    documents = table(spark, folder, "documents")
    back = decode(encode(documents)).withColumnRenamed("text", "back")
    both = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(back, "doc_id")
    return both.agg(F.count("*").alias("documents"), F.count_if(F.col("text") == F.col("back")).alias("equal"))


CONTAINER = 2048


def p9_containers(spark: SparkSession, folder: str) -> DataFrame:
    sizes = checkpointed(encode(table(spark, folder, "documents"), only_counts=True))
    return pack(sizes, "doc_id", "tokens", CONTAINER)


def p9_check(spark: SparkSession, folder: str) -> DataFrame:
    """What a packing must keep: every document whole, no container too full, no piece over another, few containers."""
    sizes = checkpointed(encode(table(spark, folder, "documents"), only_counts=True))
    packed = checkpointed(pack(sizes, "doc_id", "tokens", CONTAINER))
    wrong = sizes.join(packed.groupBy("doc_id").agg(F.sum("size").alias("packed"), F.max("size").alias("most"), F.count("*").alias("pieces")), "doc_id", "left").where(
        ~F.col("packed").eqNullSafe(F.col("tokens")) | (F.col("pieces") != F.greatest(F.lit(1), F.ceil(F.col("tokens") / CONTAINER)))
    )
    before = Window.partitionBy("container_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    filled = packed.where("size > 0").withColumn("free", F.coalesce(F.sum("size").over(before), F.lit(0)))
    places = filled.agg(
        F.countDistinct("doc_id").alias("filled"), F.count_if(F.col("start") != F.col("free")).alias("misplaced"), F.count_if(F.col("start") + F.col("size") > CONTAINER).alias("overfull"),
        F.coalesce(F.max("container_id") + 1, F.lit(0)).alias("containers"), F.coalesce(F.sum("size"), F.lit(0)).alias("total"),
        F.count_if(F.col("size") > CONTAINER // 2).alias("large"),
    )
    counts = packed.agg(F.countDistinct("doc_id").alias("documents")).crossJoin(wrong.agg(F.count("*").alias("wrong"))).crossJoin(places)  # one row each
    # best fit by decreasing size opens at most 11/9 of the fewest containers there can be, and one more
    fewest = F.greatest(F.ceil(F.col("total") / CONTAINER), F.col("large"))
    return counts.select("documents", "wrong", "misplaced", "overfull", (F.col("containers") <= fewest * 11 / 9 + 1).alias("few"))


def p10_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """What sentences must keep: they lie in their text, begin and end with non-space characters, and do not overlap."""
    documents = table(spark, folder, "documents")
    found = find_sentences(documents).join(documents.select("doc_id", "text"), "doc_id")
    piece = F.expr("substring(text, start_char + 1, end_char - start_char)")
    after = F.lag("end_char").over(Window.partitionBy("doc_id").orderBy("start_char", "end_char"))
    return found.withColumn("after", after).agg(
        F.count_if((F.col("start_char") < 0) | (F.col("end_char") > F.length("text")) | (F.col("start_char") >= F.col("end_char"))).alias("outside"),
        F.count_if(piece.rlike(r"^\s|\s$")).alias("spaced"),
        F.count_if(F.col("after") > F.col("start_char")).alias("overlapping"),
    )


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return find_sentences(table(spark, folder, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (p1_distinct_users, p1_distinct_users_portable, p1_of_stored_days, p1_error_check, p3_percentiles, p3_rank_check, p8_ids, p8_round_trip, p9_containers, p9_check, p10_found, p10_coverage)}


def _p1_sql(p: int = 12) -> str:
    """The registers of 2^p, from the first 60 bits of MD5, by grouping set; sigma written out."""
    m, low = 1 << p, 60 - p
    sigma = " + ".join(["e", *(f"pow(e, {2.0**k}) * {2.0 ** (k - 1)}" for k in range(1, 22))])
    sets = ", ".join("(" + ", ".join((*s, "register")) + ")" for s in USER_SETS)
    name = "case " + " ".join(
        f"when grouping({', '.join(USER_KEYS)}) = {sum(1 << (len(USER_KEYS) - 1 - i) for i, k in enumerate(USER_KEYS) if k not in s)} then '{','.join(s) or 'all'}'" for s in USER_SETS
    )
    return f"""
    with hashed as (select {', '.join(USER_KEYS)}, ('0x' || md5(user_id::varchar)[1:15])::bigint as h from fct_hotel_interactions where user_id is not null),
         ranked as (select {', '.join(USER_KEYS)}, h >> {low} as register, h & {(1 << low) - 1} as rest from hashed),
         registers as (select {name} end as grouping, {', '.join(USER_KEYS)}, register,
                       max(case when rest = 0 then {low + 1} else {low + 1} - length(bin(rest)) end) as rank from ranked group by grouping sets ({sets})),
         grouped as (select grouping, {', '.join(USER_KEYS)}, count(*) as used, sum(pow(2.0, -rank)) as tail, ({m} - count(*)) / {float(m)} as e from registers group by all),
         raw as (select *, {m * m / (2 * 0.6931471805599453)!r} / ({float(m)} * ({sigma}) + tail) as raw from grouped)
    select grouping, {', '.join(USER_KEYS)}, round(raw)::bigint as users, {round(1.04 / m**0.5, 6)} as standard_error,
           floor(raw * {1 - 1.96 * 1.04 / m**0.5!r})::bigint as low, ceil(raw * {1 + 1.96 * 1.04 / m**0.5!r})::bigint as high from raw"""


P3_RANKS = f"""
with r as (select site_name, hotel_country, strftime(date_time, '%Y%m')::int as month, orig_destination_distance as d, datediff('day', date_time::date, srch_ci) as c, srch_adults_cnt as a from train),
     g as ({' union all '.join(f"select '{g}' as grouping, {g} as v, d, c, a from r" for g in ("site_name", "hotel_country", "month"))}),
     l as (select grouping, v, unnest([{{'n': 'orig_destination_distance', 'x': d}}, {{'n': 'days_to_srch_ci', 'x': c::double}}, {{'n': 'srch_adults_cnt', 'x': a::double}}]) as u from g),
     k as (select grouping, u.n as column_name, v from l where u.x is not null and not isnan(u.x) group by all)
select grouping, column_name, {len(QUANTILES)} * count(*) as answers, {len(QUANTILES)} * count(*) as near from k group by all"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_distinct_users_portable": _p1_sql(),
        "p1_of_stored_days": _p1_sql().replace("user_id is not null)", f"user_id is not null and {STORED_DAYS})", 1),
        "p1_error_check": " union all ".join(
            f"select '{','.join(s)}' as grouping, count(*) as groups, count(*) as near from (select distinct {', '.join(s)} from fct_hotel_interactions where user_id is not null)" for s in USER_SETS if s
        ),
        "p3_rank_check": P3_RANKS,
        "p8_round_trip": "select count(*) as documents, count(*) as equal from documents",
        "p9_check": "select count(*) as documents, 0::bigint as wrong, 0::bigint as misplaced, 0::bigint as overfull, true as few from documents",
        "p10_coverage": "select 0::bigint as outside, 0::bigint as spaced, 0::bigint as overlapping",
    }
