"""Source profile, raw-to-prepared reconciliation and order-free comparison of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmart.functions.cells import read_cell, stripped
from trailmart.functions.measures import safe_rate
from trailmart.plans.marts import unpivot
from trailmart.schema import ColumnSpec

QUANTILES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns that a table lacks, in order."""
    return sorted(set(required) - set(df.columns))


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null rows and rate per column, in one pass."""
    wide = df.agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    long = unpivot(wide, ("n",), {c: F.col(c) for c in columns}, "column", "null_rows")
    return long.select("column", "null_rows", safe_rate(F.col("null_rows"), F.col("n")).alias("null_rate"))


def trip_numbers() -> dict[str, Column]:
    """The numbers a profile describes."""
    lead = F.date_diff("srch_ci", F.col("date_time").cast("date"))
    plain = {c: F.col(c) for c in ("orig_destination_distance", "cnt", "srch_adults_cnt", "srch_children_cnt", "srch_rm_cnt")}
    return plain | {"lead_time_days": lead, "stay_nights": F.date_diff("srch_co", "srch_ci"), "party_size": F.coalesce("srch_adults_cnt", F.lit(0)) + F.coalesce("srch_children_cnt", F.lit(0))}


def numeric_profile(df: DataFrame, numbers: dict[str, Column], accuracy: int = 1_000_000) -> DataFrame:
    """Counts, range, mean, deviation and approximate quantiles (rank error 1/accuracy) per number; NaN is left out."""
    long = unpivot(df, (), {n: c.cast("double") for n, c in numbers.items()}, "metric", "v")
    value = F.when(~F.isnan("v"), F.col("v"))
    return long.groupBy("metric").agg(
        F.count(value).alias("valid_rows"),
        F.count_if(F.col("v").isNull()).alias("null_rows"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean_value"),
        F.stddev_pop(value).alias("stddev_value"),
        F.percentile_approx(value, list(QUANTILES), accuracy).alias("quantile_values"),
    )


def categorical_profile(df: DataFrame, columns: list[str], top: int = 20) -> DataFrame:
    """Distinct values, nulls and the most frequent values (as text) per column; ``top`` is the report's length."""
    from pyspark.sql import Window

    long = unpivot(df, (), {c: F.col(c).cast("string") for c in columns}, "column", "value")
    counted = long.groupBy("column", "value").agg(F.count("*").alias("rows"))
    ranked = counted.withColumn("place", F.row_number().over(Window.partitionBy("column").orderBy(F.desc("rows"), F.col("value").asc_nulls_last())))
    whole = counted.groupBy("column").agg(F.count("value").alias("distinct_non_null"), F.sum(F.when(F.col("value").isNull(), F.col("rows")).otherwise(0)).alias("null_rows"))
    return ranked.where(F.col("place") <= top).join(whole, "column").select("column", "distinct_non_null", "null_rows", "place", "value", "rows")


def quality_counters(df: DataFrame) -> DataFrame:
    """One row of counters and ranges of the source."""
    lead, stay = F.date_diff("srch_ci", F.col("date_time").cast("date")), F.date_diff("srch_co", "srch_ci")
    day = F.col("date_time").cast("date")
    counters = {
        "anonymous_rows": F.col("user_id").isNull(),
        "booking_rows": F.col("is_booking") == 1,
        "non_booking_rows": F.col("is_booking") == 0,
        "invalid_booking_rows": F.col("is_booking").isNull() | ~F.col("is_booking").isin(0, 1),
        "null_cnt_rows": F.col("cnt").isNull(),
        "nonpositive_cnt_rows": F.col("cnt") <= 0,
        "null_checkin_rows": F.col("srch_ci").isNull(),
        "null_checkout_rows": F.col("srch_co").isNull(),
        "negative_lead_time_rows": lead < 0,
        "nonpositive_stay_rows": stay <= 0,
        "invalid_adults_rows": F.coalesce(F.col("srch_adults_cnt") <= 0, F.lit(True)),
        "invalid_children_rows": F.col("srch_children_cnt") < 0,
        "invalid_rooms_rows": F.coalesce(F.col("srch_rm_cnt") <= 0, F.lit(True)),
        "missing_distance_rows": F.col("orig_destination_distance").isNull(),
        "missing_destination_rows": F.col("srch_destination_id").isNull(),
    }
    return df.agg(
        F.count("*").alias("total_rows"),
        *(F.count_if(c).alias(n) for n, c in counters.items()),
        F.count_distinct("user_id").alias("identified_users"),
        F.count_distinct("srch_destination_id").alias("destinations"),
        *(f(c).alias(f"{n}_{what}_date") for what, c in (("event", day), ("checkin", F.col("srch_ci")), ("checkout", F.col("srch_co"))) for n, f in (("min", F.min), ("max", F.max))),
        F.sum(F.when(F.col("cnt") > 0, F.col("cnt"))).alias("valid_similar_event_count"),
    )


def duplicate_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Groups of equal rows, found by the rows themselves."""
    sizes = df.groupBy(*columns).agg(F.count("*").alias("n"))
    several = F.col("n") > 1
    return sizes.agg(
        F.count_if(several).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(several, F.col("n"))), F.lit(0)).alias("rows_in_duplicate_groups"),
        F.coalesce(F.sum(F.when(several, F.col("n") - 1)), F.lit(0)).alias("excess_duplicate_rows"),
        F.max("n").alias("largest_group"),
    )


CONTEXT = (
    "user_id", "date_time", "site_name", "posa_continent", "user_location_country", "user_location_region", "user_location_city", "is_mobile", "is_package",
    "channel", "srch_ci", "srch_co", "srch_adults_cnt", "srch_children_cnt", "srch_rm_cnt", "srch_destination_id", "srch_destination_type_id",
)


def context_profile(df: DataFrame, accuracy: int = 1_000_000) -> DataFrame:
    """How rows gather into contexts of identified users; quantiles have a rank error of 1/accuracy."""
    contexts = (
        df.where("user_id is not null")
        .groupBy(*CONTEXT)
        .agg(F.count("*").alias("r"), F.count_distinct("hotel_cluster").alias("c"), F.count_distinct("hotel_market").alias("m"), F.count_if(F.col("is_booking") == 1).alias("b"))
    )
    return contexts.agg(
        F.count("*").alias("proxy_contexts"),
        F.sum("r").alias("eligible_interaction_rows"),
        *(F.count_if(F.col(c) > k).alias(f"{n}_contexts") for c, k, n in (("r", 1, "multirow"), ("c", 1, "multicluster"), ("m", 1, "multimarket"), ("b", 0, "booking_bearing"), ("b", 1, "multibooking"))),
        F.avg("r").alias("avg_rows_per_context"),
        *(F.percentile_approx(c, [0.5, 0.9, 0.99, 1.0], accuracy).alias(f"{n}_quantiles") for c, n in (("r", "rows"), ("c", "cluster"))),
    )


def feature_profile(df: DataFrame, key: str, features: list[str]) -> DataFrame:
    """Nulls, range and mean of each latent feature, by one wide aggregate."""
    aggs = [a for f in features for a in (F.count(f).alias(f"n_{f}"), F.min(f).alias(f"lo_{f}"), F.max(f).alias(f"hi_{f}"), F.avg(F.col(f).cast("double")).alias(f"mean_{f}"))]
    wide = df.agg(F.count("*").alias("rows"), *aggs)
    items = F.array(
        *(
            F.struct(
                F.lit(f).alias("feature"), (F.col("rows") - F.col(f"n_{f}")).alias("null_rows"), F.col(f"lo_{f}").cast("double").alias("min_value"),
                F.col(f"hi_{f}").cast("double").alias("max_value"), F.round(f"mean_{f}", 9).alias("mean_value"),
            )
            for f in features
        )
    )
    return wide.select(F.explode(items).alias("_")).select("_.*")


def key_profile(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        (F.count("*") - F.count_distinct(key)).alias("duplicate_rows"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
    )


def parse_failures(raw: DataFrame, columns: tuple[ColumnSpec, ...]) -> DataFrame:
    """Per column the non-empty cells that are not readable as its type."""
    wide = raw.agg(*(F.count_if(stripped(F.col(c.name)).isNotNull() & read_cell(F.col(c.name), c.kind).isNull()).alias(c.name) for c in columns))
    return unpivot(wide, (), {c.name: F.col(c.name) for c in columns}, "column", "parse_failures")


def preparation_reconciliation(raw: DataFrame, processed: DataFrame, rejected: Column) -> DataFrame:
    """Whether the rows a preparation should reject explain the difference in row counts."""
    counts = raw.agg(F.count("*").alias("raw_rows"), F.count_if(F.coalesce(rejected, F.lit(True))).alias("rejected_rows")).crossJoin(processed.agg(F.count("*").alias("processed_rows")))
    gap = F.col("raw_rows") - F.col("processed_rows")
    return counts.select("*", gap.alias("raw_minus_processed"), (gap == F.col("rejected_rows")).alias("reconciles"), (gap == 0).alias("all_rows_preserved"))


def checksum(df: DataFrame) -> DataFrame:
    """An order-free checksum of a table: rows, and xor, sum, least and greatest of its row hashes."""
    h = F.xxhash64(*(F.struct(F.lit(c), F.col(f"`{c}`")) for c in sorted(df.columns)))
    hashed = df.select(h.alias("h"))
    return hashed.agg(
        F.count("*").alias("rows"), F.bit_xor("h").alias("xor"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.min("h").alias("least"), F.max("h").alias("greatest")
    )


def portable_checksum(df: DataFrame) -> DataFrame:
    """The same from 60 bits of MD5 over the cells as text, so that another engine can repeat it.

    Fractions count with nine decimals; a value that is no finite number counts as null.
    """
    cells = (F.col(f"`{c}`").try_cast("decimal(38,9)") if k in ("float", "double") else F.col(f"`{c}`") for c, k in sorted(df.dtypes))
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *(F.coalesce(x.cast("string"), F.lit("<NULL>")) for x in cells)).cast("binary")), 1, 15), 16, 10).cast("bigint")
    return df.select(h.alias("h")).agg(
        F.count("*").alias("rows"), F.bit_xor("h").alias("xor"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.min("h").alias("least"), F.max("h").alias("greatest")
    )


def both_differences(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """The rows each table has more often than the other, with the table's name in ``only_in``."""
    return left.exceptAll(right).select(F.lit(left_name).alias("only_in"), "*").unionAll(right.exceptAll(left).select(F.lit(right_name).alias("only_in"), "*"))


def same_rows(left: DataFrame, right: DataFrame) -> dict[str, object]:
    """Whether two tables hold the same rows, however ordered: checksums first, and exactly.

    With equal schemas and row counts an empty one-way difference of multisets proves equality.
    """
    schema = [(f.name, f.dataType) for f in left.schema] == [(f.name, f.dataType) for f in right.schema]
    a, b = checksum(left).first(), checksum(right).first()
    equal = schema and a["rows"] == b["rows"] and left.exceptAll(right).isEmpty()
    return {"same_schema": schema, "left_rows": a["rows"], "right_rows": b["rows"], "checksums_agree": a == b, "exact": equal}


def report(df: DataFrame, columns: list[str], categories: list[str]) -> dict[str, list[dict]]:
    """Every profile of a source as rows by section; a table that lacks a required column is refused."""
    if missing := missing_columns(df, columns):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    sections = {
        "counters": quality_counters(df),
        "nulls": null_profile(df, columns).orderBy("column"),
        "numbers": numeric_profile(df, trip_numbers()).orderBy("metric"),
        "categories": categorical_profile(df, categories).orderBy("column", "place"),
        "duplicates": duplicate_profile(df, columns),
        "contexts": context_profile(df),
    }
    return {name: [r.asDict() for r in part.collect()] for name, part in sections.items()}  # a few rows per column each
