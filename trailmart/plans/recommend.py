"""Top-five recommender by popularity within ever wider neighbourhoods, and its evaluation.

Scores are whole numbers of tenths, so sums do not depend on their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.functions.cells import read_cell, stripped
from trailmart.functions.measures import month_index
from trailmart.schema import ColumnSpec

CUTOFF = "2014-07-01"
K = 5
#: Neighbourhoods from narrow to wide; the last is everything.
LOOKUPS: tuple[tuple[str, ...], ...] = (
    ("user_location_country", "user_location_region", "user_location_city", "hotel_market", "orig_destination_distance_key"),
    ("user_location_city", "orig_destination_distance_key"),
    ("user_id", "srch_destination_id", "hotel_country", "hotel_market"),
    ("srch_destination_id", "hotel_country", "hotel_market"),
    ("hotel_country", "hotel_market"),
    (),
)


def before(day: str) -> Column:
    return F.col("date_time") < F.lit(day).cast("timestamp_ntz")


def history(events: DataFrame, cutoff: str | None = CUTOFF) -> DataFrame:
    """Events before the cutoff with their weight: recent ones and bookings count more."""
    age = F.greatest(F.lit(1), month_index(F.col("date_time").cast("date")) - (2012 * 12 + 12)).cast("bigint")
    kept = events if cutoff is None else events.where(before(cutoff))
    return kept.withColumn("tenths", age * age * (F.lit(30) + F.lit(176) * F.col("is_booking")))


def validation_queries(events: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """Bookings from the cutoff on; the scan ordinal is the row id."""
    return events.where(~before(cutoff) & (F.col("is_booking") == 1)).withColumn("row_id", F.col("source_scan_ordinal"))


def lookup(past: DataFrame, keys: tuple[str, ...], k: int = K) -> DataFrame:
    """The k best clusters of each neighbourhood, by score and then cluster."""
    known = reduce(lambda d, c: d.where(F.col(c).isNotNull()), keys, past)
    scores = known.groupBy(*keys, "hotel_cluster").agg(F.sum("tenths").alias("tenths"))
    best = Window.partitionBy(*keys).orderBy(F.desc("tenths"), "hotel_cluster")
    return scores.withColumn("source_rank", F.row_number().over(best)).where(F.col("source_rank") <= k)


def candidates(queries: DataFrame, past: DataFrame) -> DataFrame:
    """Clusters proposed for each row by each neighbourhood: row_id, hotel_cluster, source_priority, source_rank, tenths."""
    parts = []
    for priority, keys in enumerate(LOOKUPS, 1):
        table = lookup(past, keys)
        asked = queries.select("row_id", *keys)
        met = asked.join(table, list(keys)) if keys else asked.crossJoin(F.broadcast(table))  # everything: k rows
        parts.append(met.select("row_id", "hotel_cluster", F.lit(priority).alias("source_priority"), "source_rank", "tenths"))
    return reduce(DataFrame.unionByName, parts)


def final_candidates(proposed: DataFrame, k: int = K) -> DataFrame:
    """The k first distinct clusters of each row, by priority, rank, score and cluster."""
    best = proposed.groupBy("row_id", "hotel_cluster").agg(F.min(F.struct("source_priority", "source_rank", (-F.col("tenths")).alias("minus"))).alias("b"))
    order = Window.partitionBy("row_id").orderBy("b", "hotel_cluster")
    return best.withColumn("final_rank", F.row_number().over(order)).where(F.col("final_rank") <= k).select("row_id", "hotel_cluster", "b.source_priority", "b.source_rank", "final_rank")


def metrics(queries: DataFrame, proposed: DataFrame, final: DataFrame) -> DataFrame:
    """Rows, recall and mean reciprocal rank at k, and the reach of the two narrowest neighbourhoods."""
    asked = queries.select("row_id", "hotel_cluster")
    reach = proposed.where("source_priority <= 2").groupBy("row_id").agg(*(F.bool_or(F.col("source_priority") == p).alias(f"s{p}") for p in (1, 2)))
    joined = asked.join(final.select("row_id", "hotel_cluster", "final_rank"), ["row_id", "hotel_cluster"], "left").join(reach, "row_id", "left")
    yes = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("int"))
    return joined.agg(
        F.count("*").alias("validation_rows"),
        yes(F.col("final_rank").isNotNull()).alias("recall_at_5"),
        F.round(F.avg(F.coalesce(1.0 / F.col("final_rank"), F.lit(0.0))), 12).alias("map_at_5"),
        yes(F.col("s1")).alias("exact_geo_coverage"),
        yes(F.col("s2")).alias("city_distance_coverage"),
    )


def predictions(queries: DataFrame, final: DataFrame) -> DataFrame:
    """The ranked clusters of each row as text, best first; null where none was found."""
    lists = final.groupBy("row_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("final_rank", "hotel_cluster"))), lambda x: x["hotel_cluster"].cast("string")), " ").alias("predicted_hotel_clusters"))
    return queries.select("row_id", F.col("hotel_cluster").alias("actual_hotel_cluster")).join(lists, "row_id", "left")


def prepared(raw: DataFrame, columns: tuple[ColumnSpec, ...], distance_key: bool = False) -> DataFrame:
    """A raw table as typed rows: unreadable cells are null, rows without a required value or outside the range of a cluster are dropped.

    With ``distance_key`` the distance's own text is kept beside its number, as a key that no rounding touches.
    """
    lineage = [c for c in ("source_scan_ordinal",) if c in raw.columns]
    typed = raw.select(
        *lineage,
        *(read_cell(F.col(c.name), c.kind).alias(c.name) for c in columns),
        *([stripped(F.col("orig_destination_distance")).alias("orig_destination_distance_key")] if distance_key else []),
    )
    # a booking flag is not asked for here; a training row needs its time and its cluster, a test row its id and time
    needed = [c.name for c in columns if c.name in ("date_time", "id", "srch_destination_id" if len(columns) == 150 else "date_time")]
    kept = reduce(Column.__and__, (F.col(n).isNotNull() for n in needed))
    if "hotel_cluster" in typed.columns:
        kept = kept & F.coalesce(F.col("hotel_cluster").between(0, 99), F.lit(False))
    return typed.where(kept)


def test_queries(test: DataFrame) -> DataFrame:
    """The rows to predict for: the id of each is its row id."""
    return test.withColumn("row_id", F.col("id"))


def submission(queries: DataFrame, final: DataFrame) -> DataFrame:
    """One row per id with its ranked clusters as text, empty where none was found: the columns of a submission file."""
    lists = final.groupBy("row_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("final_rank", "hotel_cluster"))), lambda x: x["hotel_cluster"].cast("string")), " ").alias("hotel_cluster"))
    return queries.select("row_id").distinct().join(lists, "row_id", "left").select(F.col("row_id").alias("id"), F.coalesce("hotel_cluster", F.lit("")).alias("hotel_cluster"))


def reciprocal_rank(actual: object, predicted: list) -> float:
    """1 / the place of ``actual``, or 0."""
    return 1.0 / (predicted.index(actual) + 1) if actual in predicted else 0.0


def mean_average_precision(actual: list, predicted: list[list], k: int = K) -> float:
    """Mean reciprocal rank within the first ``k``; each row has one right answer."""
    if k <= 0 or not actual or len(actual) != len(predicted):
        raise ValueError("k must be positive, and each of one or more rows needs a prediction")
    return sum(reciprocal_rank(a, p[:k]) for a, p in zip(actual, predicted, strict=True)) / len(actual)
