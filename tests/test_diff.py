import math

from pyspark.sql import functions as F

from trailmart.functions.cells import read_cell
from trailmart.operators.diff import UNEQUAL, checksum_matrix, table_diff

SCHEMA = "k int, a int, b double, bucket string"


def diff(spark, left, right, **kw):
    frames = [spark.createDataFrame([(*r, "z") for r in rows], SCHEMA) for rows in (left, right)]
    return sorted(tuple(r) for r in table_diff(*frames, "k", ["a", "b"], "raw", "processed", **kw).collect())


def test_differences_field_by_field(spark):
    left = [(i, i, i / 2) for i in range(200)] + [(1, 1, 0.5)] * 3 + [(None, 1, 1.0), (900, None, math.nan)]
    right = [(i, i, i / 2) for i in range(200) if i != 7] + [(300, 1, 1.0), (900, None, math.nan)]
    right = [(k, 99 if k == 5 else a, None if k == 6 else b) for k, a, b in right]
    expected = [(5, "a", "value"), (6, "b", "value"), (7, "", "missing_in_processed"), (300, "", "missing_in_raw")]
    assert diff(spark, left, right) == expected
    assert diff(spark, left, right, rows_per_bucket=1000) == expected


def test_swapped_values_do_not_cancel(spark):
    assert diff(spark, [(1, 10, 0.0), (2, 20, 0.0)], [(1, 20, 0.0), (2, 10, 0.0)], rows_per_bucket=1000) == [(1, "a", "value"), (2, "a", "value")]


def test_values_that_change_places_with_nulls(spark):
    a, b = (spark.createDataFrame([row], "k int, a int, b int") for row in ((1, None, 5), (1, 5, None)))
    assert sorted(r["field"] for r in table_diff(a, b, "k", ["a", "b"], "raw", "processed").collect()) == ["a", "b"]


def test_unlike_rows_of_one_key_are_reported(spark):
    rows = [(i, i, 1.0) for i in range(40)]
    left = [*rows, (1, 50, 1.0), (2, None, 1.0), (3, 3, 1.0)]
    right = [(k, a, 2.0 if k == 1 else b) for k, a, b in rows] + [(4, 4, 9.0), (60, 1, 1.0), (60, 2, 1.0)]
    assert diff(spark, left, right) == [
        (1, "a", "conflict_in_raw"), (1, "b", "value"), (2, "a", "conflict_in_raw"), (4, "b", "conflict_in_processed"), (60, "", "missing_in_raw"),
    ]


def test_many_columns(spark):
    names = [f"c{i}" for i in range(130)]
    schema = "k int, " + ", ".join(f"{n} float" for n in names)
    rows = [[k, *(float(k * i) for i in range(130))] for k in range(60)]
    other = [list(r) for r in rows]
    other[5][1], other[5][130], other[9][80] = 0.5, None, float("nan")
    a, b = (spark.createDataFrame(r, schema) for r in (rows, other))
    assert sorted((r["row_key"], r["field"]) for r in table_diff(a, b, "k", names, "raw", "processed").collect()) == [(5, "c0"), (5, "c129"), (9, "c79")]


def test_equal_and_empty_tables(spark):
    rows = [(i, i, 1.0) for i in range(50)]
    assert diff(spark, rows, rows) == []
    assert diff(spark, [], []) == []
    assert diff(spark, rows[:1], []) == [(0, "", "missing_in_processed")]


def test_clashing_names(spark):
    a, b = (spark.createDataFrame([(1, x, 2, 3)], "k int, bucket int, n int, x0 int") for x in (5, 6))
    assert [tuple(r) for r in table_diff(a, b, "k", ["bucket", "n", "x0"], "raw", "processed").collect()] == [(1, "bucket", "value")]


def test_matrix_is_additive(spark):
    df = spark.createDataFrame([(i, i, 1.0, "") for i in range(90)], SCHEMA).withColumn("_bucket", F.col("k") % 8)
    cells = lambda d: {(r["_bucket"], r["i"]): (r["n"], r["lo"], r["hi"]) for r in checksum_matrix(d, "k", ["a", "b"]).collect()}
    whole, parts = cells(df), [cells(df.where("k < 40")), cells(df.where("k >= 40"))]
    assert len(whole) == 16
    for at, sums in whole.items():
        assert sums == tuple(map(sum, zip(*(p[at] for p in parts if at in p), strict=True)))
    twice = df.withColumn("w", F.lit(1)).unionByName(df.withColumn("w", F.lit(-1)))
    assert checksum_matrix(twice, "k", ["a", "b"], F.col("w")).where(UNEQUAL).count() == 0


def test_cells_are_read_strictly(spark):
    cases = [
        ("int", " +5 ", 5), ("int", "007", 7), ("int", "5.0", None), ("int", "1e2", None), ("int", "5-", None), ("int", "+-5", None), ("int", "-", None), ("int", "\t5", None), ("int", "+5", 5), ("double", ".", None), ("double", "e5", None), ("double", "1.", 1.0), ("double", "1e", None), ("double", "\t1", None), ("double", "NaN", None), ("double", "0x1p3", None), ("int", "2147483648", None), ("tinyint", "128", None), ("int", "", None), ("int", None, None),
        ("double", "1.50E+03", 1500.0), ("double", "1d", None), ("double", "-.5", -0.5), ("date", "2013-02-30", None), ("date", "2013", None), ("date", " 2013-02-28", "2013-02-28"),
        ("timestamp_ntz", "2013-01-01T10:00:00", "2013-01-01 10:00:00"), ("timestamp_ntz", "2013-01-01 10:00:00.000", "2013-01-01 10:00:00"), ("timestamp_ntz", "2013-01-01 24:00:00", None),
        ("timestamp_ntz", "2013-01-01 10:00:00.5", None),
    ]
    for kind, text, expected in cases:
        df = spark.createDataFrame([(text,)], "c string").select(read_cell(F.col("c"), kind).alias("v"))
        value = df.first()["v"]
        assert (value if value is None or not isinstance(expected, str) else str(value)) == expected, (kind, text)
