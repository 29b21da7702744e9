"""Distinct counts over huge identifier sets by log-log registers.

A register holds the greatest rank (leading zeros + 1) of the hashes that fall to it. Registers are
rows (keys..., register, rank), so a partial result is a table, partial results of days or loads are
merged by the maximum, and Spark combines them map-side before any shuffle: a key of any weight sends
at most 2^p rows per task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRECISION = 12


def standard_error(p: int = PRECISION) -> float:
    """The relative standard error of an estimate from 2^p registers."""
    return 1.04 / math.sqrt(1 << p)


def register_rows(df: DataFrame, keys: Sequence[str], identifier: str, p: int = PRECISION, hash_kind: str = "xxhash64") -> DataFrame:
    """The registers of each combination of ``keys``: keys, register, rank.

    A null identifier is not counted; a null key is a group of its own. An empty table gives no rows.
    ``hash_kind`` is xxhash64, or md5 (its first 60 bits), which any SQL engine can repeat.
    """
    known = df.where(F.col(identifier).isNotNull())
    if hash_kind == "xxhash64":
        h = F.xxhash64(F.col(identifier))
        bits = 64
        register = F.shiftrightunsigned(h, bits - p)
        low = h.bitwiseAND(F.lit((1 << (bits - p)) - 1))
    else:
        h = F.conv(F.substring(F.md5(F.col(identifier).cast("string")), 1, 15), 16, 10).cast("bigint")
        bits = 60
        register = F.shiftright(h, bits - p)
        low = h.bitwiseAND(F.lit((1 << (bits - p)) - 1))
    # bin() writes no leading zeros, so its length tells how many there were
    rank = F.when(low == 0, F.lit(bits - p + 1)).otherwise(F.lit(bits - p + 1) - F.length(F.bin(low)))
    rows = known.select(*keys, register.cast("int").alias("register"), rank.cast("int").alias("rank"))
    return rows.groupBy(*keys, "register").agg(F.max("rank").alias("rank"))


def merge_registers(*parts: DataFrame) -> DataFrame:
    """The registers of the union of disjoint or overlapping parts with the same keys."""
    whole = reduce(DataFrame.unionByName, parts)
    keys = [c for c in whole.columns if c != "rank"]
    return whole.groupBy(*keys).agg(F.max("rank").alias("rank"))


def roll_up(registers: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]]) -> DataFrame:
    """Registers of several combinations of the keys at once; ``grouping`` names each one's keys.

    A key that is not of the combination is null. Only the registers are read, never the events.
    """
    names = [c for c in registers.columns if c not in ("register", "rank")]
    rows = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(",".join(s) or "all").alias("grouping"),
                    *((F.col(k) if k in s else F.lit(None).cast(registers.schema[k].dataType)).alias(k) for k in keys),
                )
                for s in sets
            )
        )
    )
    assert set(keys) <= set(names)
    long = registers.select(rows.alias("g"), "register", "rank").select("g.*", "register", "rank")
    return long.groupBy("grouping", *keys, "register").agg(F.max("rank").alias("rank"))


def estimates(registers: DataFrame, p: int = PRECISION) -> DataFrame:
    """The estimated number of identifiers per key, its standard error and its two-sided 95 % bounds.

    Ertl's estimator: m = 2^p registers, of which those absent are zero. It has no bias steps between
    small and large sets, and equals linear counting in effect for small ones.
    """
    m = float(1 << p)
    keys = [c for c in registers.columns if c not in ("register", "rank")]
    grouped = registers.groupBy(*keys).agg(F.count("*").alias("used"), F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("tail"))
    empty = (m - F.col("used")) / m
    sigma = empty
    for k in range(1, 22):
        sigma = sigma + F.pow(empty, float(2**k)) * float(2 ** (k - 1))
    raw = m * m / (2 * math.log(2)) / (m * sigma + F.col("tail"))
    error = standard_error(p)
    return grouped.select(
        *keys,
        F.round(raw).cast("bigint").alias("users"),
        F.lit(round(error, 6)).alias("standard_error"),
        F.floor(raw * (1 - 1.96 * error)).cast("bigint").alias("low"),
        F.ceil(raw * (1 + 1.96 * error)).cast("bigint").alias("high"),
    )


def distinct_counts(df: DataFrame, identifier: str, keys: Sequence[str], sets: Sequence[Sequence[str]], p: int = PRECISION, hash_kind: str = "xxhash64") -> DataFrame:
    """Distinct identifiers for each combination of keys in ``sets``; see register_rows and estimates."""
    return estimates(roll_up(register_rows(df, keys, identifier, p, hash_kind), keys, sets), p)
