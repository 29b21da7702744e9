"""One query per generic relational operator, over the order tables, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmart.functions.cells import read_cell, stripped
from trailmart.functions.measures import safe_rate
from trailmart.operators.profile import both_differences
from trailmart.plans.sqltext import rate
from trailmart.session import table


def _t(name: str, f):
    return lambda s, d: f(table(s, d, name))


def _tt(a: str, b: str, f):
    return lambda s, d: f(table(s, d, a), table(s, d, b))


def values(spark: SparkSession, folder: str) -> DataFrame:
    return spark.createDataFrame([("F", 1, "closed"), ("O", 2, "open"), ("P", 3, None)], "status string, place int, label string")


def series(spark: SparkSession, folder: str) -> DataFrame:
    bounds = table(spark, folder, "events").agg(F.min("ts").cast("date").alias("lo"), F.max("ts").cast("date").alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("day"))


def top_per_group(orders: DataFrame) -> DataFrame:
    best = Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return orders.withColumn("place", F.row_number().over(best)).where(F.col("place") <= 5).select("o_orderpriority", "place", "o_orderkey", "o_totalprice")


def share_of_group(lines: DataFrame) -> DataFrame:
    counted = lines.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return counted.withColumn("share", safe_rate(F.col("n"), F.sum("n").over(Window.partitionBy("l_returnflag"))))


def grouping_sets(orders: DataFrame) -> DataFrame:
    orders.createOrReplaceTempView("_trailmart_orders")
    return orders.sparkSession.sql(
        "select o_orderstatus, o_orderpriority, cast(grouping(o_orderstatus) as int) as g, count(*) as n from _trailmart_orders group by grouping sets ((o_orderstatus), (o_orderpriority))"
    )


def with_group_count(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """What a correlated scalar count would give: the count is made once per key and joined."""
    counts = orders.groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return customers.join(counts, customers.c_custkey == counts.o_custkey, "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"))


def month_lag(orders: DataFrame) -> DataFrame:
    monthly = orders.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month")).agg(F.count("*").alias("n"))
    return monthly.withColumn("change", F.col("n") - F.lag("n").over(Window.orderBy("month")))  # months: few rows


QUERIES = {
    "src8_inline_values": values,
    "src9_day_series": series,
    "prj1_trim_to_null": _t("raw_train", lambda t: t.select("source_scan_ordinal", stripped(F.col("orig_destination_distance")).alias("v")).distinct()),
    "prj2_safe_cast": _t("raw_train", lambda t: t.select("source_scan_ordinal", read_cell(F.col("user_id"), "bigint").alias("v")).distinct()),
    "prj5_null_functions": _t(
        "train",
        lambda t: t.select(
            "source_scan_ordinal", F.coalesce("user_id", F.lit(-1)).alias("a"), F.nullif("channel", F.lit(9)).alias("b"), F.least("hotel_country", "hotel_market").alias("c"),
            F.greatest("hotel_country", "hotel_market").alias("d"),
        ),
    ),
    "prj6_exclude": _t("nation", lambda t: t.drop("n_name")),
    "flt2_between": _t("lineitem", lambda t: t.where(F.col("l_discount").between(0.05, 0.07) & ~F.col("l_quantity").between(10, 40)).groupBy("l_returnflag").agg(F.count("*").alias("n"))),
    "flt3_in_lists": _t(
        "orders",
        lambda t: t.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("P") & F.expr("(o_orderstatus, o_orderpriority) in (('O', '1-URGENT'), ('F', '2-HIGH'))"))
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(F.count("*").alias("n")),
    ),
    "flt4_like": _t("part", lambda t: t.where(F.col("p_type").like("P%")).groupBy("p_type").agg(F.count("*").alias("n"))),
    "flt5_filtered_aggregates": _t(
        "lineitem",
        lambda t: t.groupBy("l_linestatus").agg(
            F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.sum(F.when(F.col("l_tax") > 0.04, F.col("l_quantity"))).alias("taxed"), F.count_distinct(F.when(F.col("l_tax") > 0.04, F.col("l_suppkey"))).alias("suppliers")
        ),
    ),
    "flt6_having": _t("orders", lambda t: t.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 12")),
    "flt7_qualify": _t("orders", top_per_group),
    "jn1_inner": _tt("orders", "customer", lambda o, c: o.join(c, o.o_custkey == c.c_custkey).groupBy("c_mktsegment").agg(F.count("*").alias("n"))),
    "jn4_left": _tt("nation", "supplier", lambda n, s: n.join(s, n.n_nationkey == s.s_nationkey, "left").groupBy("n_name").agg(F.count("s_suppkey").alias("suppliers"))),
    "jn5_full": _tt(
        "customer", "supplier",
        lambda c, s: c.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers")).join(s.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers")), "k", "full"),
    ),
    "jn6_cross_one_row": _t("supplier", lambda s: s.crossJoin(F.broadcast(s.agg(F.max("s_acctbal").alias("top")))).where("s_acctbal = top").select("s_suppkey", "top")),
    "jn7_anti": _tt("customer", "orders", lambda c, o: c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")),
    "jn9_count_per_key": _tt("orders", "customer", with_group_count),
    "jn11_distinct_flag": _tt(
        "customer", "orders",
        lambda c, o: c.join(o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("seen")).distinct(), "c_custkey", "left").select("c_custkey", F.coalesce("seen", F.lit(False)).alias("seen")),
    ),
    "ag4_distinct_counts": _t("lineitem", lambda t: t.groupBy("l_returnflag").agg(*(F.count_distinct(c).alias(c) for c in ("l_orderkey", "l_partkey", "l_suppkey")))),
    "ag5_tuple_distinct": _t("train", lambda t: t.agg(F.count_distinct(F.struct("user_id", "srch_destination_id")).alias("n"))),
    "ag6_any_bool": _tt("nation", "region", lambda n, r: n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("n_regionkey").agg(F.any_value("r_name", F.lit(True)).alias("region"), F.bool_or(F.col("n_name").like("%A")).alias("has_a"))),
    "ag8_mode": _t("train", lambda t: t.where("channel is not null").groupBy("hotel_continent").agg(F.mode("channel", deterministic=True).alias("channel"))),
    "ag9_median_quantile": _t("lineitem", lambda t: t.groupBy("l_returnflag").agg(F.median("l_quantity").alias("m"), F.round(F.percentile("l_quantity", 0.9), 9).alias("p90"))),
    "ag11_approx_quantiles": _t("lineitem", lambda t: t.groupBy("l_returnflag").agg(F.percentile_approx("l_extendedprice", [0.1, 0.5, 0.9], 1_000_000).alias("q"))),
    "ag12_deviation": _t("part", lambda t: t.groupBy("p_brand").agg(F.round(F.stddev_pop("p_size"), 9).alias("sd"))),
    "ag13_ordered_list": _t("nation", lambda t: t.groupBy("n_regionkey").agg(F.expr("listagg(n_name, ' ') within group (order by n_nationkey)").alias("names"))),
    "ag15_wide_sum": _t("orders", lambda t: t.agg(F.sum(F.col("o_orderkey").cast("decimal(38,0)") * 1000000000000).cast("string").alias("total"))),
    "ag18_grouping_sets": _t("orders", grouping_sets),
    "wn2_row_number": _t("events", lambda t: t.select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("nth"))),
    "wn5_count_over": _t("nation", lambda t: t.select("n_nationkey", F.count("*").over(Window.partitionBy("n_regionkey")).alias("n"))),
    "wn6_share_of_group": _t("lineitem", share_of_group),
    "wn9_lag": _t("orders", month_lag),
    "so2_top_rows": _t("orders", lambda t: t.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")),
    "so5_extreme_by": _t("supplier", lambda t: t.groupBy("s_nationkey").agg(F.max_by("s_suppkey", F.struct("s_acctbal", "s_suppkey")).alias("richest"))),
    "se1_union_all": _tt("customer", "supplier", lambda c, s: c.select(F.col("c_nationkey").alias("k")).unionByName(s.select(F.col("s_nationkey").alias("k"))).groupBy("k").agg(F.count("*").alias("n"))),
    "se2_union": _tt("customer", "supplier", lambda c, s: c.select(F.col("c_nationkey").alias("k")).union(s.select("s_nationkey")).distinct()),
    "se3_except_all": _tt("customer", "supplier", lambda c, s: both_differences(c.select(F.col("c_nationkey").alias("k")), s.select(F.col("s_nationkey").alias("k")), "customer", "supplier")),
    "se4_distinct": _t("lineitem", lambda t: t.select("l_returnflag", "l_linestatus").distinct()),
}

SQL = {
    "src8_inline_values": "select * from (values ('F', 1, 'closed'), ('O', 2, 'open'), ('P', 3, null)) as t(status, place, label)",
    "src9_day_series": "select unnest(generate_series(min(ts)::date::timestamp, max(ts)::date::timestamp, interval 1 day))::date as day from events",
    "prj1_trim_to_null": "select distinct source_scan_ordinal, nullif(trim(orig_destination_distance), '') as v from raw_train",
    "prj2_safe_cast": "select distinct source_scan_ordinal, case when regexp_matches(trim(user_id), '^[+-]?[0-9]+$') then try_cast(replace(trim(user_id), '+', '') as bigint) end as v from raw_train",
    "prj5_null_functions": "select source_scan_ordinal, coalesce(user_id, -1) as a, nullif(channel, 9) as b, least(hotel_country, hotel_market) as c, greatest(hotel_country, hotel_market) as d from train",
    "prj6_exclude": "select * exclude (n_name) from nation",
    "flt2_between": "select l_returnflag, count(*) as n from lineitem where l_discount between 0.05::double and 0.07::double and l_quantity not between 10 and 40 group by 1",
    "flt3_in_lists": """select o_orderstatus, o_orderpriority, count(*) as n from orders where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus not in ('P')
      and (o_orderstatus, o_orderpriority) in (('O', '1-URGENT'), ('F', '2-HIGH')) group by 1, 2""",
    "flt4_like": "select p_type, count(*) as n from part where p_type like 'P%' group by 1",
    "flt5_filtered_aggregates": """select l_linestatus, count(*) filter (where l_returnflag = 'R') as returned, sum(l_quantity) filter (where l_tax > 0.04::double) as taxed,
      count(distinct l_suppkey) filter (where l_tax > 0.04::double) as suppliers from lineitem group by 1""",
    "flt6_having": "select o_custkey, count(*) as n from orders group by 1 having count(*) > 12",
    "flt7_qualify": """select o_orderpriority, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as place, o_orderkey, o_totalprice from orders qualify place <= 5""",
    "jn1_inner": "select c_mktsegment, count(*) as n from orders join customer on o_custkey = c_custkey group by 1",
    "jn4_left": "select n_name, count(s_suppkey) as suppliers from nation left join supplier on n_nationkey = s_nationkey group by 1",
    "jn5_full": """select coalesce(a.k, b.k) as k, customers, suppliers from (select c_nationkey as k, count(*) as customers from customer group by 1) a
      full join (select s_nationkey as k, count(*) as suppliers from supplier group by 1) b on a.k = b.k""",
    "jn6_cross_one_row": "select s_suppkey, top from supplier, (select max(s_acctbal) as top from supplier) where s_acctbal = top",
    "jn7_anti": "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)",
    "jn9_count_per_key": "select c_custkey, (select count(*) from orders where o_custkey = c_custkey) as orders from customer",
    "jn11_distinct_flag": "select c_custkey, c_custkey in (select o_custkey from orders where o_orderstatus = 'P') as seen from customer",
    "ag4_distinct_counts": "select l_returnflag, count(distinct l_orderkey) as l_orderkey, count(distinct l_partkey) as l_partkey, count(distinct l_suppkey) as l_suppkey from lineitem group by 1",
    "ag5_tuple_distinct": "select count(*) as n from (select distinct user_id, srch_destination_id from train)",
    "ag6_any_bool": "select n_regionkey, any_value(r_name) as region, bool_or(n_name like '%A') as has_a from nation join region on n_regionkey = r_regionkey group by 1",
    "ag8_mode": """select hotel_continent, channel from (select hotel_continent, channel, row_number() over (partition by hotel_continent order by count(*) desc, channel) as r from train
      where channel is not null group by 1, 2) where r = 1""",
    "ag9_median_quantile": "select l_returnflag, median(l_quantity) as m, round(quantile_cont(l_quantity, 0.9), 9) as p90 from lineitem group by 1",
    "ag11_approx_quantiles": "select l_returnflag, quantile_disc(l_extendedprice, [0.1, 0.5, 0.9]) as q from lineitem group by 1",
    "ag12_deviation": "select p_brand, round(stddev_pop(p_size), 9) as sd from part group by 1",
    "ag13_ordered_list": "select n_regionkey, string_agg(n_name, ' ' order by n_nationkey) as names from nation group by 1",
    "ag15_wide_sum": "select sum(o_orderkey::hugeint * 1000000000000)::varchar as total from orders",
    "ag18_grouping_sets": "select o_orderstatus, o_orderpriority, grouping(o_orderstatus)::int as g, count(*) as n from orders group by grouping sets ((o_orderstatus), (o_orderpriority))",
    "wn2_row_number": "select event_id, row_number() over (partition by user_id order by ts, event_id) as nth from events",
    "wn5_count_over": "select n_nationkey, count(*) over (partition by n_regionkey) as n from nation",
    "wn6_share_of_group": f"select l_returnflag, l_linestatus, count(*) as n, {rate('count(*)', 'sum(count(*)) over (partition by l_returnflag)')} as share from lineitem group by 1, 2",
    "wn9_lag": "with m as (select date_trunc('month', o_orderdate)::date as month, count(*) as n from orders group by 1) select *, n - lag(n) over (order by month) as change from m",
    "so2_top_rows": "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20",
    "so5_extreme_by": "select s_nationkey, (max(struct_pack(a := s_acctbal, k := s_suppkey))).k as richest from supplier group by 1",
    "se1_union_all": "select k, count(*) as n from (select c_nationkey as k from customer union all select s_nationkey from supplier) group by 1",
    "se2_union": "select c_nationkey as k from customer union select s_nationkey from supplier",
    "se3_except_all": "select 'customer' as only_in, k from (select c_nationkey as k from customer except all select s_nationkey from supplier) union all select 'supplier', k from (select s_nationkey as k from supplier except all select c_nationkey from customer)",
    "se4_distinct": "select distinct l_returnflag, l_linestatus from lineitem",
}


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return SQL
