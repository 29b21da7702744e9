"""Ranks that no hot key can bring down to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def block_rank(df: DataFrame, keys: list[str], order: str, name: str, total: str | None = None, width: int = 1 << 20) -> DataFrame:
    """ROW_NUMBER() over ``keys`` by the whole number ``order``, and optionally the key's row count.

    The order is cut in blocks of ``width``; rows are ranked within (key, block), to which the totals of
    the key's earlier blocks are added. Null keys are a key. Rows of equal order rank arbitrarily.
    """
    cut = df.withColumn("_b", F.floor(F.col(order) / width))
    sizes = cut.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy(F.col("_b").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_total", F.sum("_n").over(whole)).drop("_n")
    names = [*keys, "_b"]
    right = sizes.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(names)})
    match = None
    for i, k in enumerate(names):
        equal = F.col(k).eqNullSafe(F.col(f"_k{i}"))
        match = equal if match is None else match & equal
    ranked = cut.withColumn("_r", F.row_number().over(Window.partitionBy(*names).orderBy(F.col(order).asc_nulls_last())))
    joined = ranked.join(right, match).withColumn(name, F.col("_r") + F.col("_before"))
    if total:
        joined = joined.withColumn(total, F.col("_total"))
    return joined.drop("_b", "_r", "_before", "_total", *(f"_k{i}" for i in range(len(names))))
