import math
import random
import statistics
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from trailmart.operators.quality import Series, column_profile, exact_medians, load_departures, moments, power_sums, value_counts
from trailmart.session import table


def test_exact_medians(spark):
    rng = random.Random(1)
    values = {g: [rng.choice([rng.uniform(-5, 5), rng.randrange(-3, 3), rng.uniform(0, 1e9), 1e-9 * rng.random(), 7.25]) for _ in range(n)] for g, n in (("a", 301), ("b", 200), ("c", 1), ("d", 2))}
    df = spark.createDataFrame([(g, float(v), 1) for g, vs in values.items() for v in vs], "g string, v double, c long")
    assert {r["g"]: r["median"] for r in exact_medians(df, ["g"]).collect()} == {g: statistics.median(vs) for g, vs in values.items()}


def test_medians_of_huge_values(spark):
    values = [1.0, 2.0**47, 2.0**47 + 1, 2.0**50, 2.0**63, 2.0**64, 2.0**90, 1e300, -1e300]
    for k in range(1, len(values) + 1):
        df = spark.createDataFrame([(1, v, 1) for v in values[:k]], "g int, v double, c long")
        assert exact_medians(df, ["g"]).first()["median"] == statistics.median(values[:k])


def test_a_wrong_bracket_changes_no_median(spark):
    values = [float(i * i) for i in range(101)]
    df = spark.createDataFrame([(1, v, 1) for v in values], "g int, v double, c long")
    for low, high in ((2400.0, 2600.0), (-9.0, -8.0), (1e6, 1e7), (0.0, 1.0), (2500.0, 2500.0), (None, None)):
        brackets = spark.createDataFrame([(1, low, high)], "g int, low double, high double")
        assert exact_medians(df, ["g"], brackets=brackets).first()["median"] == 2500.0


LOADS = {
    1: [1.0, 2.0, 5e12], 2: [1e-9, 2e-9], 3: [1e18, -1e18, 1.0], 4: [0.1] * 7, 5: [5e-324, 1.7e308, -1.7e308, 2.0**30, 2.0**30 - 2.0**-22], 6: [0.0, -0.0, float("nan"), float("inf")],
    7: [math.pi * 10**k for k in range(-20, 20)],
}


def test_power_sums_are_exact(spark):
    """Huge, tiny and cancelling values, against rational arithmetic."""
    df = spark.createDataFrame([(g, v) for g, vs in LOADS.items() for v in vs], "load_id int, v double")
    found = {r["load"][1:]: r for r in moments(power_sums(value_counts(df, "load_id", [Series("v", F.col("v"), F.col("v"))]), "c")).collect()}
    exact = {g: [Fraction(v) for v in vs if math.isfinite(v)] for g, vs in LOADS.items()}
    for g, vs in exact.items():
        rest = [v for h, ws in exact.items() if h != g for v in ws]
        mean, other = sum(vs) / len(vs), sum(rest) / len(rest)
        variance = sum((v - mean) ** 2 for v in vs) / len(vs)
        spread = (variance + sum((v - other) ** 2 for v in rest) / len(rest)) / 2
        row = found[str(g)]
        assert row["m"] == len(vs) and row["mean"] == float(mean)
        assert row["std_difference"] == pytest.approx(float((mean - other) ** 2 / spread) ** 0.5 * (1 if mean >= other else -1), abs=2e-6)
        if variance < 10**300:
            assert row["deviation"] == pytest.approx(float(variance) ** 0.5, rel=1e-12)


def test_power_sums_combine(spark):
    df = spark.createDataFrame([(g, v) for g, vs in LOADS.items() for v in vs], "load_id int, v double")
    series = [Series("v", F.col("v"), F.col("v"))]
    whole = power_sums(value_counts(df, "load_id", series), "c")
    halves = [power_sums(value_counts(df.where(f"pmod(hash(v), 2) = {k}"), "load_id", series), "c") for k in (0, 1)]
    added = halves[0].unionByName(halves[1]).groupBy("load", "i", "band").agg(*(F.sum(c).alias(c) for c in whole.columns[3:]))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, added.collect()))


def test_large_and_small_loads_are_profiled(spark):
    df = spark.createDataFrame([(g, v) for g, vs in LOADS.items() for v in vs], "load_id int, v double")
    rows = {r["load_id"]: r for r in column_profile(df, rules={}).collect()}
    assert rows[1]["mean"] == float(Fraction(5 * 10**12 + 3) / 3) and rows[2]["mean"] == float((Fraction(1e-9) + Fraction(2e-9)) / 2)
    assert rows[3]["mean"] == float(Fraction(1, 3)) and rows[6]["distinct_values"] == 3 and rows[6]["max_number"] == 0.0


def test_hot_value_weighs_its_count(spark):
    df = spark.createDataFrame([(1, 5.0, 1000), (1, 1.0, 3), (1, 9.0, 4)], "g int, v double, c long")
    assert exact_medians(df, ["g"]).first()["median"] == 5.0


def test_profile_of_odd_tables(spark):
    df = spark.createDataFrame([(1, None, float("nan"), None), (1, 3, 2.0, "x"), (1, 3, 4.0, "y"), (None, None, None, None)], "load_id int, a int, b double, column_name string")
    rows = {(r["load_id"], r["column_name"]): r for r in column_profile(df, rules={"column_name": "column_name rlike '^x$'", "a": "a > 5"}).collect()}
    assert len(rows) == 6
    assert rows[1, "a"]["distinct_values"] == 1 and rows[1, "a"]["violations"] == 2 and abs(rows[1, "a"]["null_share"] - 1 / 3) < 1e-12
    assert rows[1, "b"]["mean"] == 3.0 and rows[1, "b"]["max_number"] == 4.0 and rows[1, "b"]["distinct_values"] == 3
    assert rows[1, "column_name"]["violations"] == 1 and rows[1, "column_name"]["max_text"] == "y"
    assert rows[None, "a"]["null_share"] == 1.0 and rows[None, "b"]["mean"] is None


def test_empty_tables(spark, data):
    empty = table(spark, data, "fct_hotel_interactions").where("false")
    assert load_departures(empty).count() == 0
    assert column_profile(empty).count() == 0


def test_loads_of_any_number_are_judged(spark):
    """-1 is a load like any other, and rows without a load are one of their own."""
    rows = [(load, float(100 * (3 if load in (-1, None) else 1) + i), "2014-01-10", "2014-01-01", 5, i + 1) for load in (None, -1, 1, 2, 3, 4, 5) for i in range(9)]
    df = spark.createDataFrame(rows, "load_id int, orig_destination_distance double, ci string, ed string, hotel_market int, user_id long")
    df = df.selectExpr("load_id", "orig_destination_distance", "date(ci) as checkin_date", "date(ed) as event_date", "hotel_market", "user_id")
    found = {(r["load_id"], r["column_name"], r["kind"]) for r in load_departures(df).collect()}
    assert found == {(None, "orig_destination_distance", "shift"), (-1, "orig_destination_distance", "shift")}
    # a narrow spread about one mean settles every column by its power sums alone
    near = df.withColumn("orig_destination_distance", F.lit(1000.0) + F.col("user_id") / 10)
    assert load_departures(near).count() == 0
