"""Sessions by start-end pairing.

An instant starts a session when no event of its user lies within the gap before it, and ends
one when none lies within the gap after it; two RANGE frames find both. Starts and ends are
numbered separately, equal numbers are joined, and the number of events is the difference of
the events' own ranks.

A user may hold a third of all rows, so no frame spans a whole user: time is cut in blocks,
instants near a block's edge are copied into the neighbouring block as silent witnesses, and
ranks within blocks become ranks within users by adding the totals of the earlier blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmart.session import checkpointed

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def sessionize(df: DataFrame, user: str, time: str, gap_seconds: int = 1800, block_seconds: int = 21600) -> DataFrame:
    """One row per session: user, session_no, session_start, session_end, duration_seconds, event_count.

    Rows without user or time belong to no session. Two successive instants at most
    ``gap_seconds`` apart share a session. Rows at the same instant, repeated or not, count as
    events of one session. ``block_seconds`` must not be less than the gap. Other columns are
    ignored, so their names cannot clash. An empty table gives no rows.
    """
    if block_seconds < gap_seconds:
        raise ValueError("block_seconds must be at least gap_seconds")
    gap, block = gap_seconds * 1_000_000, block_seconds * 1_000_000
    instants = (
        df.select(F.col(user).alias("u"), F.col(time).cast("timestamp_ntz").alias("at"))
        .where(F.col("u").isNotNull() & F.col("at").isNotNull())
        .select("u", F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, at)").alias("t"))
        .groupBy("u", "t")
        .agg(F.count("*").alias("n"))
        .withColumn("b", F.expr(f"(t - pmod(t, {block}L)) div {block}L"))
    )
    witnessed = instants.select(
        "u",
        "t",
        F.explode(
            F.expr(
                f"""filter(array(
                    struct(b as b, true as own, n as n),
                    if(pmod(t, {block}L) < {gap}L, struct(b - 1 as b, false as own, 0L as n), null),
                    if({block}L - pmod(t, {block}L) <= {gap}L, struct(b + 1 as b, false as own, 0L as n), null)
                ), x -> x is not null)"""
            )
        ).alias("x"),
    ).select("u", "t", "x.*")
    frame = Window.partitionBy("u", "b").orderBy("t")
    flagged = (
        witnessed.withColumn("before", F.count("*").over(frame.rangeBetween(-gap, -1)))
        .withColumn("after", F.count("*").over(frame.rangeBetween(1, gap)))
        .withColumn("s", (F.col("own") & (F.col("before") == 0)).cast("long"))
        .withColumn("e", (F.col("own") & (F.col("after") == 0)).cast("long"))
    )
    running = frame.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("u", "b").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = checkpointed(
        flagged.withColumn("s_rank", F.sum("s").over(running))
        .withColumn("e_rank", F.sum("e").over(running))
        .withColumn("n_rank", F.sum("n").over(running))
        .withColumn("last", F.max(F.when(F.col("own"), F.col("t"))).over(whole) == F.col("t"))
        .where(F.col("own") & ((F.col("s") == 1) | (F.col("e") == 1) | F.col("last")))
        .select("u", "b", "t", "n", "s", "e", "last", "s_rank", "e_rank", "n_rank")
    )
    earlier = Window.partitionBy("u").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = edges.where("last").select(
        "u", "b", *(F.coalesce(F.sum(f"{k}_rank").over(earlier), F.lit(0)).alias(f"{k}_off") for k in "sen")
    )
    placed = edges.where("s = 1 or e = 1").join(offsets, ["u", "b"])
    starts = placed.where("s = 1").select(
        "u", (F.col("s_rank") + F.col("s_off")).alias("k"), F.col("t").alias("t0"), (F.col("n_rank") - F.col("n") + F.col("n_off")).alias("n0")
    )
    ends = placed.where("e = 1").select(
        "u", (F.col("e_rank") + F.col("e_off")).alias("k"), F.col("t").alias("t1"), (F.col("n_rank") + F.col("n_off")).alias("n1")
    )
    return starts.join(ends, ["u", "k"]).select(
        F.col("u").alias(user),
        F.col("k").alias("session_no"),
        F.expr(f"timestampadd(MICROSECOND, t0, {EPOCH})").alias("session_start"),
        F.expr(f"timestampadd(MICROSECOND, t1, {EPOCH})").alias("session_end"),
        ((F.col("t1") - F.col("t0")) / 1e6).alias("duration_seconds"),
        (F.col("n1") - F.col("n0")).alias("event_count"),
    )
