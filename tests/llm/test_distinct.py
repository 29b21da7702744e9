import random

from pyspark.sql import functions as F

from trailmart.llm.distinct import distinct_counts, estimates, merge_registers, register_rows, standard_error

SCHEMA = "user long, day string, register string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(u, d, "x", "y") for u, d in rows], SCHEMA)


def test_error_bound_over_sizes(spark):
    p = 10
    df = spark.range(0, 200_000).select((F.col("id") * 7919).alias("user"), F.array(*(F.when(F.col("id") < n, F.lit(n)) for n in (1, 10, 100, 1_000, 3_000, 10_000, 200_000))).alias("a"))
    long = df.select("user", F.explode("a").alias("day")).where("day is not null")
    for kind in ("xxhash64", "md5"):
        for r in estimates(register_rows(long, ["day"], "user", p, kind), p).collect():
            assert abs(r["users"] - r["day"]) <= max(1, 4 * standard_error(p) * r["day"]), (kind, r)
            assert r["low"] <= r["users"] <= r["high"]


def test_merging_parts_equals_the_whole(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(500)]), rng.choice([None, "a", "b"])) for _ in range(5000)]
    whole = register_rows(frame(spark, rows), ["day"], "user")
    parts = merge_registers(register_rows(frame(spark, rows[:2000]), ["day"], "user"), register_rows(frame(spark, rows[1500:]), ["day"], "user"))
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    assert {r["day"] for r in whole.collect()} == {None, "a", "b"}


def test_grouping_sets_and_empty_tables(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (2, "b"), (None, "c")])
    found = {(r["grouping"], r["day"]): r["users"] for r in distinct_counts(df, "user", ["day"], [(), ("day",)]).collect()}
    assert found == {("all", None): 2, ("day", "a"): 1, ("day", "b"): 2}
    assert distinct_counts(df.where("false"), "user", ["day"], [()]).count() == 0
