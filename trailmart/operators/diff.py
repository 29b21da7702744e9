"""Differences between two copies of a table by a column-by-bucket checksum matrix.

Every row adds, for each column, a hash of (column, key, value) to the cell of its key's bucket. The sums
are additive and mergeable. They are taken in two steps: the margin of the matrix first, one hash of the
whole row per bucket, then its columns for the buckets whose margins differ. Equal cells mean equal
contents; only the rows of unequal buckets, and of them only the columns unequal in their bucket, are made
unique by key and joined.

A sum is kept as two sums of 32-bit halves of a 64-bit hash: none overflows below 2^31 rows a
bucket, and together they are as wide as 126 bits. Repeated rows change the sums of their bucket,
which only makes the bucket a candidate; the join then decides exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.session import checkpointed

LOW = 0xFFFFFFFF


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), F.col(key)), F.lit(buckets))


def _sums(weight: Column, value: Column) -> list[Column]:
    """What a set of hashes adds up to: their number and the sums of their halves."""
    return [F.sum(weight).alias("n"), F.sum(weight * value.bitwiseAND(F.lit(LOW))).alias("lo"), F.sum(weight * F.shiftrightunsigned(value, 32)).alias("hi")]


def _row_hash(key: str, columns: list[str]) -> Column:
    """A hash of the whole row. Hashing skips nulls, so the place of each column is hashed before its value."""
    return F.xxhash64(F.col(key), *(x for i, c in enumerate(columns) for x in (F.lit(i), F.col(c))))


def checksum_margin(df: DataFrame, key: str, columns: list[str], buckets: int, weight: int = 1) -> DataFrame:
    """The row hashes to be added up: _bucket, h, and the weight of each."""
    return df.select(_bucket(key, buckets).alias("_bucket"), _row_hash(key, columns).alias("h"), F.lit(weight).cast("bigint").alias("w"))


def checksum_matrix(df: DataFrame, key: str, columns: list[str], weight: Column | None = None) -> DataFrame:
    """One row per cell: _bucket, i (the column), and the sums n, lo and hi of a table that has ``_bucket``.

    Matrices of disjoint parts of a table combine by adding their cells; with weights of 1 and -1 for two
    sides, cells of equal contents add up to nothing.
    """
    hashes = F.array(*(F.xxhash64(F.lit(c), F.col(key), F.col(c)) for c in columns))
    cells = df.select("_bucket", (F.lit(1).cast("bigint") if weight is None else weight).alias("w"), F.posexplode(hashes).alias("i", "h"))
    return cells.groupBy("_bucket", "i").agg(*_sums(F.col("w"), F.col("h")))


UNEQUAL = "n <> 0 or lo <> 0 or hi <> 0"


def table_diff(left: DataFrame, right: DataFrame, key: str, columns: list[str], left_name: str, right_name: str, rows_per_bucket: int = 4) -> DataFrame:
    """One row per difference: row_key, field, kind.

    ``kind`` is ``missing_in_<name>`` with an empty field, or ``value`` with the column's name.
    Both sides must have the same types. Nulls equal nulls, NaN equals NaN. Rows without a key are
    left out. Identical rows of one key within a side count once; where rows of one key differ within a
    side, each field they differ in is reported as ``conflict_in_<name>`` and not compared. Columns not
    listed are ignored. Two empty tables give no rows.
    """
    left, right = (d.select(key, *columns).where(F.col(key).isNotNull()) for d in (left, right))
    buckets = max(64, max(left.count(), right.count()) // rows_per_bucket)
    margin = checksum_margin(left, key, columns, buckets).unionByName(checksum_margin(right, key, columns, buckets, -1))
    suspects = checkpointed(margin.groupBy("_bucket").agg(*_sums(F.col("w"), F.col("h"))).where(UNEQUAL).select("_bucket"))
    # the rows of unequal buckets, of both sides: a part of the data, read several times from here on
    sides = (d.select(F.lit(w).cast("bigint").alias("_side"), _bucket(key, buckets).alias("_bucket"), key, *columns).join(suspects, "_bucket", "left_semi") for d, w in ((left, 1), (right, -1)))
    both = checkpointed(reduce(DataFrame.unionByName, sides).withColumn("_hash", _row_hash(key, columns)))
    left, right = both.where("_side = 1").drop("_side"), both.where("_side = -1").drop("_side")
    located = checkpointed(checksum_matrix(both, key, columns, F.col("_side")).where(UNEQUAL).groupBy("_bucket").agg(F.collect_list("i").alias("cells")))

    def candidates(d: DataFrame, tag: str) -> DataFrame:
        kept = d.join(located.withColumnRenamed("_bucket", "_b"), F.col("_bucket") == F.col("_b"), "left")
        wanted = [F.when(F.array_contains("cells", i), F.col(c)).alias(f"{tag}{i}") for i, c in enumerate(columns)]
        return kept.select(F.col(key).alias("row_key"), *wanted, "_hash").groupBy("row_key").agg(
            *(F.first(f"{tag}{i}").alias(f"{tag}{i}") for i in range(len(columns))), (F.min("_hash") == F.max("_hash")).alias(tag)
        )

    joined = candidates(left, "x").join(candidates(right, "y"), "row_key", "full")
    fields = [F.when(~F.col(f"x{i}").eqNullSafe(F.col(f"y{i}")), F.struct(F.lit(c).alias("field"), F.lit("value").alias("kind"))) for i, c in enumerate(columns)]
    found = (
        F.when(F.col("y").isNull(), F.array(F.struct(F.lit("").alias("field"), F.lit(f"missing_in_{right_name}").alias("kind"))))
        .when(F.col("x").isNull(), F.array(F.struct(F.lit("").alias("field"), F.lit(f"missing_in_{left_name}").alias("kind"))))
        .when(F.col("x") & F.col("y"), F.array_compact(F.array(*fields)))
    )
    out = joined.select(F.col("row_key").cast("bigint").alias("row_key"), F.explode(found).alias("d")).select("row_key", "d.field", "d.kind")

    repeats = checkpointed(both.groupBy("_side", F.col(key).alias("row_key")).agg(F.min("_hash").alias("a"), F.max("_hash").alias("b")).where("a <> b").select("_side", "row_key"))
    if repeats.isEmpty():
        return out
    split = [(repeats.where(F.col("_side") == side).select("row_key"), d, name) for side, d, name in ((1, left, left_name), (-1, right, right_name))]
    return reduce(DataFrame.unionByName, (out, *_conflicts(split, key, columns)))


def _conflicts(split: list[tuple[DataFrame, DataFrame, str]], key: str, columns: list[str]) -> list[DataFrame]:
    """What keys with unlike rows within a side differ in: between those rows, and in the other fields between the sides."""
    keys = reduce(DataFrame.unionByName, (repeats for repeats, _, _ in split)).distinct()
    ends = []
    for (_, d, _), tag in zip(split, "xy", strict=True):
        aggs = [a for i, c in enumerate(columns) for a in (F.min(c).alias(f"{tag}lo{i}"), F.max(c).alias(f"{tag}hi{i}"), F.count(c).alias(f"{tag}n{i}"))]
        ends.append(d.withColumnRenamed(key, "row_key").join(keys, "row_key", "left_semi").groupBy("row_key").agg(F.count("*").alias(f"{tag}n"), *aggs))
    both = ends[0].join(ends[1], "row_key")  # a key that one side lacks is reported as missing there
    mixed = lambda t, i: (F.col(f"{t}lo{i}") != F.col(f"{t}hi{i}")) | ((F.col(f"{t}n{i}") > 0) & (F.col(f"{t}n{i}") < F.col(f"{t}n")))
    sure = lambda t, i: F.coalesce(mixed(t, i), F.lit(False))
    out = []
    for t, (_, _, name) in zip("xy", split, strict=True):
        cells = [F.when(sure(t, i), F.struct(F.lit(c).alias("field"), F.lit(f"conflict_in_{name}").alias("kind"))) for i, c in enumerate(columns)]
        out.append(both.select("row_key", F.explode(F.array_compact(F.array(*cells))).alias("d")))
    cells = [F.when(~sure("x", i) & ~sure("y", i) & ~F.col(f"xlo{i}").eqNullSafe(F.col(f"ylo{i}")), F.struct(F.lit(c).alias("field"), F.lit("value").alias("kind"))) for i, c in enumerate(columns)]
    out.append(both.select("row_key", F.explode(F.array_compact(F.array(*cells))).alias("d")))
    return [o.select(F.col("row_key").cast("bigint").alias("row_key"), "d.field", "d.kind") for o in out]
