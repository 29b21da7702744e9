"""Column expressions shared by the marts: guarded rates, intervals, labels, calendar arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Z = 1.96
#: For analyses that quote a full-precision 95 % quantile.
Z_EXACT = 1.959963984540054


def safe_rate(part: Column, whole: Column) -> Column:
    """part / whole as a double; null where the whole is null or not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def wilson(part: Column, whole: Column, z: float = Z) -> tuple[Column, Column]:
    """Wilson score bounds of a share, kept in [0, 1] and on their sides of the share itself."""
    n, z2 = whole.cast("double"), z * z
    p = part.cast("double") / n
    centre = p + z2 / 2 / n
    spread = F.sqrt((p * (1 - p) + z2 / 4 / n) / n) * z
    scale = 1 + z2 / n
    low = F.least(p, F.greatest(F.lit(0.0), (centre - spread) / scale))
    high = F.greatest(p, F.least(F.lit(1.0), (centre + spread) / scale))
    return F.when(whole > 0, low), F.when(whole > 0, high)


def wilson_unbounded(part: Column, whole: Column, z: float = Z) -> tuple[Column, Column]:
    """The bare Wilson formula, which rounding may carry beyond [0, 1] or the share itself."""
    n, z2 = whole.cast("double"), z * z
    p = part.cast("double") / n
    spread = F.sqrt((p * (1 - p) + z2 / 4 / n) / n) * z
    return F.when(whole > 0, (p + z2 / 2 / n - spread) / (1 + z2 / n)), F.when(whole > 0, (p + z2 / 2 / n + spread) / (1 + z2 / n))


def bookings(flag: Column | None = None) -> Column:
    return F.count_if((F.col("is_booking") if flag is None else flag) == 1)


def booking_block() -> list[Column]:
    """Rows, bookings and their share."""
    return [
        F.count("*").alias("interaction_rows"),
        bookings().alias("booking_rows"),
        safe_rate(bookings(), F.count("*")).alias("booking_interaction_share"),
    ]


def rate_block() -> list[Column]:
    """The eleven outcome measures of an interaction mart."""
    n, k, events = F.count("*"), bookings(), F.col("valid_similar_event_count")
    low, high = wilson(k, n)
    booked = F.sum(F.when(F.col("is_booking") == 1, events))
    return [
        n.alias("interaction_rows"),
        F.count_if(F.col("is_booking") == 0).alias("click_rows"),
        k.alias("booking_rows"),
        safe_rate(k, n).alias("booking_interaction_share"),
        low.alias("booking_interaction_share_ci_low"),
        high.alias("booking_interaction_share_ci_high"),
        F.sum(events).alias("valid_similar_event_count"),
        F.sum(F.when(F.col("is_booking") == 0, events)).alias("weighted_click_events"),
        booked.alias("weighted_booking_events"),
        safe_rate(booked, F.sum(events)).alias("weighted_booking_event_share"),
        safe_rate(F.count(events), n).alias("similar_event_count_coverage"),
    ]


def support(rows: Column, adequate: int, strong: int) -> Column:
    return F.when(rows >= strong, "strong").when(rows >= adequate, "adequate").otherwise("low")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_index(day: Column) -> Column:
    """Months since year 0, so that differences count calendar boundaries."""
    return F.year(day) * 12 + F.month(day)


def banded(value: Column, bands: list[tuple[int, str]], beyond: str) -> Column:
    """The label of the first band whose upper bound the value does not exceed."""
    first, *rest = bands
    return reduce(lambda c, b: c.when(value <= b[0], b[1]), rest, F.when(value <= first[0], first[1])).otherwise(beyond)


def digest(*parts: Column, null: str = "<NULL>") -> Column:
    """SHA-256 of the parts as text, joined by a bar; nulls have a spelling of their own."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit(null)) for p in parts)), 256)


def row_fingerprint(columns: list[str]) -> Column:
    """SHA-256 over length-prefixed raw texts: unlike rows never have the same input."""
    return F.sha2(F.concat(*(F.when(F.col(c).isNull(), "-1:").otherwise(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c))) for c in columns)), 256)
