"""Reading raw files: strict all-text CSV, discovery, scan ordinals, JSON documents."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmart.session import checkpointed
from trailmart.sources.files import Files

PARTITION_BITS = 33


def find_raw(spark: SparkSession, folder: str | Path, stem: str) -> str:
    """The first of <stem>.csv and <stem>.csv.gz in a folder of any file system."""
    files = Files(spark, folder)
    for suffix in (".csv", ".csv.gz"):
        if files.exists(f"{stem}{suffix}"):
            return files.at(f"{stem}{suffix}")
    raise FileNotFoundError(f"no {stem}.csv or {stem}.csv.gz in {folder}")


def read_text_csv(spark: SparkSession, path: str | Path, columns: list[str], strict: bool = True) -> DataFrame:
    """A CSV with header, every column text, empty cells null, with the file it came from.

    ``strict`` fails at the first malformed record; otherwise its cells are null.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return reader.option("nullValue", "").option("emptyValue", "").csv(str(path)).select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("source_block"))


def read_inferred_csv(spark: SparkSession, path: str | Path) -> DataFrame:
    """A CSV with header and inferred types, for checking exports."""
    return spark.read.option("header", True).option("inferSchema", True).csv(str(path))


def with_scan_ordinal(df: DataFrame, name: str = "source_scan_ordinal") -> DataFrame:
    """Rows numbered from 1 in scan order, without bringing them to one task.

    Spark's increasing ids hold partition and position; counts of the earlier partitions make them dense. Where the
    rows say their ``source_file`` and start of block (``source_block``), files count in order of name and blocks in
    order of place, however they were packed into tasks. The ids are stored once, as both counts and rows need the same.
    """
    lineage = [c for c in ("source_file", "source_block") if c in df.columns]
    marked = checkpointed(df.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", PARTITION_BITS)
    sizes = marked.groupBy(*lineage, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_id").alias("_least"))
    before = Window.orderBy(*lineage, "_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per block of a file
    offsets = sizes.select("_part", "_least", *lineage, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    joined = marked.withColumn("_part", part).join(offsets, ["_part", *lineage])
    return joined.withColumn(name, F.col("_off") + F.col("_id") - F.col("_least") + 1).drop("_part", "_id", "_off", "_least", "source_block")


def read_document(path: str | Path) -> dict:
    """A JSON document in UTF-8, with or without byte order mark."""
    return json.loads(Path(path).read_text(encoding="utf-8-sig"))
