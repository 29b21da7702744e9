"""Raw text to typed accepted rows and quarantined rows, each with its lineage, and their reconciliation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.functions.cells import read_cell
from trailmart.functions.measures import row_fingerprint
from trailmart.operators.ranking import block_rank
from trailmart.schema import ColumnSpec
from trailmart.session import checkpointed


@dataclass(frozen=True)
class Staged:
    accepted: DataFrame
    quarantine: DataFrame
    classified: DataFrame


def reject_reason(spec: ColumnSpec) -> Column:
    """The first failing rule of a read column (its text in raw__<name>): missing, parse_error, domain_error."""
    empty, value = F.coalesce(F.trim(F.col(f"raw__{spec.name}")), F.lit("")) == "", F.col(spec.name)
    reason = F.when(empty, f"{spec.name}:missing" if spec.required else None).when(value.isNull(), f"{spec.name}:parse_error")
    if spec.domain:
        reason = reason.when((value < spec.domain[0]) | (value > spec.domain[1]), f"{spec.name}:domain_error")
    return reason


def classify(raw: DataFrame, columns: tuple[ColumnSpec, ...], key: str | None = None, ordinal: str = "source_scan_ordinal") -> DataFrame:
    """Raw rows with fingerprint, multiplicity, typed cells and the reasons to reject them ('' if none).

    Without an ordinal of its own the input's rows are ordered by fingerprint. With a ``key`` only the
    first valid row of each key is accepted; later ones are rejected as duplicates of it.
    """
    names = [c.name for c in columns]
    lineage = [c for c in (ordinal, "source_file") if c in raw.columns]
    # Written once, as both outputs read it; the rules then stand on plain columns. In one projection with
    # the reading of the cells the optimiser would multiply the two.
    cells = checkpointed(raw.select(*lineage, *(read_cell(F.col(n), c.kind).alias(n) for n, c in zip(names, columns, strict=True)), *(F.col(n).alias(f"raw__{n}") for n in names)))
    rows = cells.select(
        "*",
        row_fingerprint([f"raw__{n}" for n in names]).alias("raw_row_fingerprint"),
        F.concat_ws(";", *(reject_reason(c) for c in columns)).alias("base"),
    )
    order = ordinal if ordinal in lineage else "_order"
    if order == "_order":
        rows = rows.withColumn("_order", F.xxhash64("raw_row_fingerprint"))
    rows = block_rank(rows, ["raw_row_fingerprint"], order, "duplicate_occurrence", "duplicate_group_size")
    reasons = F.col("base")
    if key:
        first = Window.partitionBy(key).orderBy(F.when(F.col("base") == "", 0).otherwise(1), order, "duplicate_occurrence")
        rows = rows.withColumn("_nth", F.row_number().over(first))
        reasons = F.when((F.col("base") == "") & (F.col("_nth") > 1), f"{key}:duplicate_key").otherwise(reasons)
    return rows.withColumn("reject_reasons", reasons).drop("base", "_nth", "_order")


def stage(raw: DataFrame, columns: tuple[ColumnSpec, ...], key: str | None = None) -> Staged:
    classified = classify(raw, columns, key)
    typed = [c.name for c in columns]
    accepted = classified.where(F.col("reject_reasons") == "").drop("reject_reasons", *(f"raw__{c}" for c in typed))
    return Staged(accepted, classified.where(F.col("reject_reasons") != "").drop(*typed), classified)


def with_event_partitions(accepted: DataFrame) -> DataFrame:
    return accepted.withColumn("event_year", F.year("date_time").cast("smallint")).withColumn("event_month_num", F.month("date_time").cast("tinyint"))


def fingerprints(raw: DataFrame, columns: tuple[ColumnSpec, ...]) -> DataFrame:
    """The fingerprints of the raw rows themselves, to reconcile outputs with."""
    return raw.select(row_fingerprint([c.name for c in columns]).alias("raw_row_fingerprint"))


def multiset_reconciliation(raw: DataFrame, *outputs: DataFrame, key: str = "raw_row_fingerprint") -> DataFrame:
    """Per fingerprint the raw and output counts and whether they agree."""
    together = outputs[0].select(key)
    for output in outputs[1:]:
        together = together.unionByName(output.select(key))
    counts = raw.groupBy(key).agg(F.count("*").alias("raw_count")).join(together.groupBy(key).agg(F.count("*").alias("output_count")), key, "full")
    return counts.select(
        key, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("raw_count", "output_count")), (F.coalesce("raw_count", F.lit(0)) == F.coalesce("output_count", F.lit(0))).alias("reconciles")
    )


def population_counts(train: Staged, destinations: Staged, test: Staged | None = None) -> DataFrame:
    """One row of raw, accepted and quarantined counts per data set."""

    def counts(staged: Staged, name: str) -> DataFrame:
        bad = F.col("reject_reasons") != ""
        return staged.classified.agg(F.count("*").alias(f"raw_{name}"), F.count_if(~bad).alias(f"accepted_{name}"), F.count_if(bad).alias(f"quarantined_{name}"))

    both = counts(train, "train").crossJoin(counts(destinations, "destinations"))  # one row each
    return both if test is None else both.crossJoin(counts(test, "test"))
