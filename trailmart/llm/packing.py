"""Packing items into containers of fixed capacity by bulk-synchronous best fit.

Items are kept in order of size and gaps (what is left in open containers) in order of width, each with
its rank among its equals. A superstep takes the next range of sizes, from the largest down. Its sweep
goes over sizes and widths, which are whole numbers up to the capacity, and finds for each item its
successor, the least gap that holds it: because equals are told apart by rank alone, it decides whole
runs of ranks at once, and where items compete for a gap the lower rank wins. Items and gaps then find
each other by rank in a distributed join, the gaps shrink by what they took, items without a successor
open containers, and the next superstep begins with the gaps as they are now.

The sweep carries the runs from one width to the next; it sees counts only, at most one for each whole
number up to the capacity, however many items there are. Ranks, joins and updates are spread over the
cluster; an item size or a gap width that a large share of all rows has is salted.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.session import checkpointed

#: Ends of the ranges of sizes: capacity / 2, capacity / 3, ...; the last range goes down to 1.
STEPS = (2, 3, 4, 8, 32)
SHARE = 1 << 18  # rows of one value ranked in one task, or a thousandth of all rows if that is more


@dataclass
class Run:
    """Gaps that had width ``source`` when the superstep began (0: opened in it), of ranks first..first+count-1, now ``gap`` wide."""

    source: int
    first: int
    count: int
    gap: int


@dataclass
class Plan:
    """Which ranks of each size go to which ranks of gaps."""

    opened: int = 0
    #: size, first rank, ranks, source width (0: new), first rank of the gaps, items per gap
    ranges: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)


def sweep(sizes: dict[int, int], gaps: dict[int, int], capacity: int) -> Plan:
    """Best fit of a range of sizes into gaps: ``sizes`` and ``gaps`` count the items and gaps of each size and width."""
    plan = Plan()
    least = min(sizes, default=0)
    order = sorted((width, width, 0, Run(width, 0, count, width)) for width, count in gaps.items() if width >= least)  # by gap, then source and rank

    def put(run: Run) -> None:
        if run.gap >= least and run.count > 0:
            bisect.insort(order, (run.gap, run.source, run.first, run))

    def take(run: Run, size: int, rank: int, left: int) -> int:
        """Fill the gaps of ``run`` one after the other with up to ``left`` items."""
        each = run.gap // size
        full = min(run.count, left // each)
        rest = left - full * each if full < run.count else 0
        for count, items in ((full, each), (1, rest)):
            if count and items:
                plan.ranges.append((size, rank, count * items, run.source, run.first, items))
                put(Run(run.source, run.first, count, run.gap - items * size))
                run.first, run.count = run.first + count, run.count - count
                rank, left = rank + count * items, left - count * items
        put(run)
        return left

    for size in sorted(sizes, reverse=True):
        left = sizes[size]
        while left and (at := bisect.bisect_left(order, (size,))) < len(order):
            left = take(order.pop(at)[3], size, sizes[size] - left, left)
        if left:
            count = -(-left // (capacity // size))
            plan.opened += count
            take(Run(0, plan.opened - count, count, capacity), size, sizes[size] - left, left)
    return plan


def pieces(items: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """One row per piece: _key, piece, size. Only items above the capacity are cut, into full pieces and a rest."""
    known = items.select(F.col(key).alias("_key"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("bigint").alias("whole"))
    cut = known.select("_key", "whole", F.explode(F.expr(f"sequence(0L, greatest((whole - 1) div {capacity}, 0L))")).alias("piece"))
    return cut.select("_key", "piece", F.least(F.col("whole") - F.col("piece") * capacity, F.lit(capacity)).alias("size"))


def ranked(df: DataFrame, value: str, order: list[str], salt: Column) -> tuple[DataFrame, dict[int, int]]:
    """``df`` with ``rank``, from 0 among the rows of equal ``value``, and the number of rows of each value.

    There are at most capacity values, and at most 1,000 of them hold more than a thousandth of all rows: those are salted.
    """
    spark = df.sparkSession
    counts = {r[0]: r[1] for r in df.groupBy(value).agg(F.count("*")).collect()}
    limit = max(SHARE, sum(counts.values()) // 1000)
    hot = [(v, -(-n // limit)) for v, n in counts.items() if n > limit]
    salted = df.withColumn("_salt", F.lit(0))
    if hot:
        table = spark.createDataFrame(hot, "_value bigint, _salts int")
        salted = df.join(F.broadcast(table), F.col(value) == F.col("_value"), "left").withColumn("_salt", F.pmod(salt, F.coalesce("_salts", F.lit(1))).cast("int")).drop("_value", "_salts")
    out = salted.withColumn("rank", F.row_number().over(Window.partitionBy(value, "_salt").orderBy(*order)) - F.lit(1).cast("bigint"))
    if hot:
        sizes = salted.where(F.col("_salt") > -1).join(F.broadcast(table), F.col(value) == F.col("_value")).groupBy("_value", "_salt").agg(F.count("*").alias("n"))
        before = Window.partitionBy("_value").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.select("_value", F.col("_salt").alias("_s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))  # at most 2,000 rows
        out = out.join(F.broadcast(sizes), (F.col(value) == F.col("_value")) & (F.col("_salt") == F.col("_s")), "left")
        out = out.withColumn("rank", F.col("rank") + F.coalesce("_before", F.lit(0))).drop("_value", "_s", "_before")
    return out, counts


def _targets(items: DataFrame, plan: Plan) -> DataFrame:
    """Items with the gap the plan gives them: its width when the superstep began, and its rank."""
    schema = "_size bigint, first bigint, ranks bigint, source bigint, target bigint, each bigint"
    ranges = items.sparkSession.createDataFrame(plan.ranges, schema)
    # the ranges of a size and salt as one array, so that an item finds its own by a search in its row
    lists = ranges.groupBy("_size").agg(F.collect_list(F.struct("first", "ranks", "source", "target", "each")).alias("ranges"))
    salts = items.select(F.col("size").alias("_size"), F.col("_salt").alias("_s")).distinct()
    lists = lists.join(salts, "_size")
    found = items.join(lists, (F.col("size") == F.col("_size")) & (F.col("_salt") == F.col("_s"))).withColumn(
        "r", F.expr("element_at(filter(ranges, x -> x.first <= rank and rank < x.first + x.ranks), 1)")
    )
    return found.select("_key", "piece", "size", F.col("r.source").alias("source"), (F.col("r.target") + F.expr("(rank - r.first) div r.each")).alias("target"))


def pack(items: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """One row per piece: key, piece, container_id, place, start, size.

    ``place`` numbers the pieces of a container from 0, the largest first, ``start`` is where in the
    container a piece begins. Items of size 0 (or null) take no room: they lie in container 0 at place -1.
    An empty table gives no rows. Which of several items of one size goes where follows from their keys;
    repeated rows are items of their own. The items are read several times, so they should be cheap to
    read again; other columns are ignored. The result is that of best fit by decreasing size.
    """
    cut = pieces(items, key, size, capacity)
    rows, sizes = ranked(cut.where("size > 0"), "size", ["_key", "piece"], F.xxhash64("_key", "piece"))
    rows = checkpointed(rows)
    gaps: DataFrame | None = None  # container_id, gap
    containers, placed = 0, []
    ends = [capacity, *(capacity // k for k in STEPS), 0]
    for high, low in zip(ends, ends[1:], strict=False):
        own = {s: n for s, n in sizes.items() if low < s <= high}
        if not own:
            continue
        widths: dict[int, int] = {}
        if gaps is not None:
            numbered, widths = ranked(gaps.where(F.col("gap") >= min(own)), "gap", ["container_id"], F.xxhash64("container_id"))
        plan = sweep(own, widths, capacity)
        found = _targets(rows.where(F.col("size").between(min(own), max(own))), plan)
        step = found.where("source = 0").select("_key", "piece", "size", (F.col("target") + containers).alias("container_id"))
        if any(r[3] for r in plan.ranges):
            at = numbered.select("container_id", F.col("gap").alias("source"), F.col("rank").alias("target"))
            step = step.unionByName(found.where("source > 0").join(at, ["source", "target"]).select("_key", "piece", "size", "container_id"))
        step = checkpointed(step)
        placed.append(step)
        containers += plan.opened
        if low:
            used = step.groupBy("container_id").agg(F.sum("size").alias("used"))
            both = used if gaps is None else gaps.join(used, "container_id", "full")
            left = F.lit(capacity) if gaps is None else F.coalesce("gap", F.lit(capacity))
            gaps = checkpointed(both.select("container_id", (left - F.coalesce("used", F.lit(0))).cast("bigint").alias("gap")).where("gap > 0"))
    within = Window.partitionBy("container_id").orderBy(F.desc("size"), "_key", "piece")
    nothing = cut.where("size = 0").select(
        "_key", "piece", F.lit(0).cast("bigint").alias("container_id"), F.lit(-1).cast("bigint").alias("place"), F.lit(0).cast("bigint").alias("start"), "size"
    )
    for step in placed[1:]:
        placed[0] = placed[0].unionByName(step)
    for whole in placed[:1]:
        whole = whole.withColumn("place", F.row_number().over(within).cast("bigint") - 1).withColumn("start", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        nothing = whole.select("_key", "piece", "container_id", "place", "start", "size").unionByName(nothing)
    return nothing.withColumnRenamed("_key", key)
