"""Column-level quality profile of a table that arrives in loads.

Everything comes from one table of mergeable parts, the counts of each value per load and column, and
the exact power sums made of it. Nulls, distinct values, ranges, violations and top values are read off
the counts; numeric shifts are described by the power sums: means, spreads and the standardised
difference of each load from all others. ``load_departures`` judges by the same parts. Where a decision
stands on a median, the power sums say where it lies (never farther from the mean than the standard
deviation), which settles many columns and starts the exact selection for the others.

A power sum is exact for any double: values are split by exponent into bands of 30 binary digits, and
within a band into three whole-number limbs, whose sums and products are added up as decimals. The sums
of "all other loads" are the total less the load's own. Only the final division rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.session import checkpointed

BINS = 4096
BAND = 30  # binary digits of a band; squares of its limbs fit 64 bits
LIMBS = ("s0", "s1", "s2", "q0", "q1", "q2", "q3", "q4")


def exact_medians(base: DataFrame, keys: list[str], value: str = "v", count: str = "c", brackets: DataFrame | None = None) -> DataFrame:
    """The exact median of ``value`` (finite double, not null) per ``keys`` (not null), each value weighing ``count``.

    ``base`` is one row per keys and value and should be cheap to read again. Each round cuts the range of
    a middle rank into 4,096 bins and goes on with the bin that holds it, until that holds one value; so no
    task sorts more than the bins of a group. ``brackets`` (keys, low, high) say where medians are expected;
    the first round starts there, and a wrong bracket only costs rounds. An even total gives the mean of
    the middle two.
    """
    base = base.select(*keys, F.col(value).alias("v"), F.col(count).alias("c"))
    targets = base.groupBy(*keys).agg(F.sum("c").alias("total"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    if brackets is not None:
        low, high = F.greatest("lo", "low"), F.least("hi", "high")  # both skip nulls
        targets = targets.join(brackets.select(*keys, "low", "high"), keys, "left")
        targets = targets.withColumns({"lo": F.when(low < high, low).otherwise(F.col("lo")), "hi": F.when(low < high, high).otherwise(F.col("hi"))})
    targets = checkpointed(targets.select(*keys, F.explode(F.expr("array_distinct(array((total + 1) div 2, total div 2 + 1))")).alias("todo"), "lo", "hi"))
    found = targets.where("lo = hi")
    active, first = targets.where("lo < hi"), True
    while not active.isEmpty():
        ranges = active.select(*keys, "lo", "hi").distinct()
        share = F.coalesce((F.col("v") / 2 - F.col("lo") / 2) / F.nullif(F.col("hi") / 2 - F.col("lo") / 2, F.lit(0.0)), F.when(F.col("v") > F.col("lo"), 1.0).otherwise(0.0))
        number = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), BINS).otherwise(F.least(F.lit(BINS - 1), F.floor(share * BINS).cast("int")))
        inside = base.join(ranges, keys)
        if not first:
            inside = inside.where(F.col("v").between(F.col("lo"), F.col("hi")))
        bins = inside.groupBy(*keys, "lo", "hi", number.alias("bin")).agg(F.sum("c").alias("here"), F.min("v").alias("least"), F.max("v").alias("most"))
        upto = Window.partitionBy(*keys, "lo", "hi").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        bins = bins.withColumn("upto", F.sum("here").over(upto))
        chosen = active.join(bins, [*keys, "lo", "hi"]).where((F.col("todo") > F.col("upto") - F.col("here")) & (F.col("todo") <= F.col("upto")))
        chosen = checkpointed(chosen.select(*keys, (F.col("todo") - F.col("upto") + F.col("here")).alias("todo"), F.col("least").alias("lo"), F.col("most").alias("hi")))
        found = found.unionByName(chosen.where("lo = hi"))
        active, first = chosen.where("lo < hi"), False
    return found.groupBy(*keys).agg(F.avg("lo").alias("median"))


@dataclass(frozen=True)
class Series:
    """A column to profile: its value, the number that stands for it (a function of the value) and its rule."""

    name: str
    value: Column
    number: Column | None = None
    inside: Column | None = None


def load_key(load: Column) -> Column:
    """A load as text that is never null, so that loads join by equality."""
    return F.when(load.isNull(), "null").otherwise(F.concat(F.lit("="), load.cast("string")))


def load_of(key: str = "load") -> Column:
    return F.when(F.col(key) != "null", F.substring(key, 2, 1 << 30))


def value_counts(df: DataFrame, load: str, series: list[Series]) -> DataFrame:
    """The parts: load, i (the series), h (64-bit hash of the value, null for none), v, c (rows), w (rows within the rule).

    Parts of disjoint rows combine by adding c and w.
    """

    def entry(i: int, s: Series) -> Column:
        number = F.lit(None).cast("double") if s.number is None else s.number.cast("double")
        return F.struct(
            F.lit(i).alias("i"),
            F.when(s.value.isNotNull(), F.xxhash64(s.value)).alias("h"),
            number.alias("v"),
            (s.value.isNotNull() & (F.lit(True) if s.inside is None else F.coalesce(s.inside, F.lit(False)))).alias("inside"),
        )

    rows = df.select(load_key(F.col(load)).alias("load"), F.explode(F.array(*(entry(i, s) for i, s in enumerate(series)))).alias("x")).select("load", "x.*")
    return rows.groupBy("load", "i", "h", "v").agg(F.count("*").alias("c"), F.count_if("inside").alias("w"))


def shares(counts: DataFrame) -> DataFrame:
    """Per load and series: rows, filled, inside, distinct values, rows of the top value, least and greatest finite number."""
    filled, finite = F.col("h").isNotNull(), F.when(F.abs("v") < float("inf"), F.col("v"))  # NaN is greater than all
    return counts.groupBy("load", "i").agg(
        F.sum("c").alias("n"),
        F.sum(F.when(filled, F.col("c")).otherwise(0)).alias("filled"),
        F.sum("w").alias("inside"),
        F.count("h").alias("distinct"),
        F.max(F.when(filled, F.col("c"))).alias("top"),
        F.min(finite).alias("lo"),
        F.max(finite).alias("hi"),
    )


def power_sums(counts: DataFrame, weight: str) -> DataFrame:
    """Exact sums of v and v^2 per load, series and band: load, i, band, m (rows) and the sums of the limbs.

    With v = sign * (a + b 2^-26 + c 2^-52) 2^(30 band), s0..s2 are the sums of a, b and c, and q0..q4 those
    of the products that v^2 has at 2^0, 2^-26, ..., 2^-104. Sums of disjoint rows combine by adding.
    """
    size, half = F.abs("v"), F.pow(F.lit(2.0), F.col("band") * -(BAND // 2))
    scaled = F.col("size") * half * half  # in two steps, as 2^(30 band) itself may not be a double
    rows = (
        counts.where((F.col(weight) > 0) & (size < float("inf")))
        .select("load", "i", F.col(weight).alias("w"), F.when(F.col("v") < 0, -1).otherwise(1).cast("bigint").alias("sign"), size.alias("size"))
        .withColumn("band", F.when(F.col("size") == 0, 0).otherwise(F.floor(F.log2("size") / BAND)).cast("int"))
        .withColumn("x", scaled)  # the logarithm may have rounded over a band's end
        .withColumn("band", F.col("band") + F.when(F.col("x") >= float(1 << BAND), 1).when((F.col("x") < 1) & (F.col("x") > 0), -1).otherwise(0))
        .withColumn("x", scaled)
        .withColumn("a", F.floor("x").cast("bigint"))
        .withColumn("x", (F.col("x") - F.col("a")) * float(1 << 26))
        .withColumn("b", F.floor("x").cast("bigint"))
        .withColumn("c", ((F.col("x") - F.col("b")) * float(1 << 26)).cast("bigint"))
    )
    a, b, c, sign = (F.col(x) for x in ("a", "b", "c", "sign"))
    terms = (a * sign, b * sign, c * sign, a * a, 2 * a * b, 2 * a * c + b * b, 2 * b * c, c * c)
    weighed = [F.sum(t.cast("decimal(19,0)") * F.col("w").cast("decimal(19,0)")).cast("decimal(38,0)").alias(n) for t, n in zip(terms, LIMBS, strict=True)]
    return rows.groupBy("load", "i", "band").agg(F.sum("w").alias("m"), *weighed)


def _exact(bands: list) -> tuple[int, Fraction, Fraction]:
    """Number, sum and sum of squares of the bands of a load or of all."""
    m, s, q = 0, Fraction(0), Fraction(0)
    for x in bands:
        s0, s1, s2, q0, q1, q2, q3, q4 = (int(x[n]) for n in LIMBS)
        m += int(x["m"])
        s += ((s0 << 52) + (s1 << 26) + s2) * Fraction(2) ** (BAND * x["band"] - 52)
        q += ((q0 << 104) + (q1 << 78) + (q2 << 52) + (q3 << 26) + q4) * Fraction(2) ** (2 * BAND * x["band"] - 104)
    return m, s, q


def _root(x: Fraction) -> float:
    """The square root of a rational, also where the rational itself is no double."""
    shift = (x.numerator.bit_length() - x.denominator.bit_length()) // 2
    try:
        return math.sqrt(float(x / Fraction(4) ** shift)) * 2.0**shift
    except OverflowError:
        return math.inf


def moments(sums: DataFrame) -> DataFrame:
    """Per load and series from the power sums: m, mean, deviation, and std_difference.

    std_difference is (mean of the load - mean of all other loads) / sqrt(mean of the two variances), null
    where the others have no value or neither has any spread.
    """
    columns = ("band", "m", *LIMBS)
    own = sums.groupBy("load", "i").agg(F.collect_list(F.struct(*columns)).alias("own"))  # at most 70 bands
    added = sums.groupBy("i", "band").agg(F.sum("m").alias("m"), *(F.sum(n).alias(n) for n in LIMBS))
    total = added.groupBy("i").agg(F.collect_list(F.struct(*columns)).alias("total"))

    def combine(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for load, i, mine, everything in zip(part["load"], part["i"], part["own"], part["total"], strict=True):
                m, s, q = _exact(mine)
                n, t, u = _exact(everything)
                mean = s / m
                variance = q / m - mean * mean
                difference = None
                if n > m:
                    rest = (t - s) / (n - m)
                    spread = (variance + (u - q) / (n - m) - rest * rest) / 2
                    if spread > 0:
                        difference = round(math.copysign(_root((mean - rest) ** 2 / spread), mean - rest), 6)
                rows.append((load, i, m, float(mean), _root(variance), difference))
            yield pd.DataFrame(rows, columns=["load", "i", "m", "mean", "deviation", "std_difference"])

    return own.join(total, "i").mapInPandas(combine, "load string, i int, m bigint, mean double, deviation double, std_difference double")


def load_departures(df: DataFrame) -> DataFrame:
    """Loads whose four watched columns depart from the usual load: load_id, column_name, kind.

    "Usual" is the exact median over the loads. A load with no value to judge has no such figure and
    departs in nothing but its nulls. A check-in without an event date cannot be placed and is out of
    range. Rows without load_id form a load of their own (null). An empty table gives no rows.

    A shift is one of medians. Each median lies within a standard deviation of its mean, so the power
    sums bound it, and the usual one; medians are selected exactly only for columns in which the bounds
    leave open whether some load has shifted.
    """
    days = F.date_diff("checkin_date", "event_date")
    distance, market, user = F.col("orig_destination_distance"), F.col("hotel_market"), F.col("user_id")
    watched = [
        Series("orig_destination_distance", distance, distance, ~F.isnan(distance) & distance.between(0, 13000)),
        Series("checkin_date", F.col("checkin_date")),
        Series("hotel_market", market, market, market.between(1, 2500)),
        Series("user_id", user, None, user.between(1, 999999999)),
        Series("checkin_date", days, days, days.between(0, 730)),  # places of check-ins; its shares stand for the third's range
    ]
    places = len(watched) - 1
    counts = checkpointed(value_counts(df, "load_id", watched))
    figures = checkpointed(shares(counts))
    moment = checkpointed(moments(power_sums(counts.where(F.col("i").isin(0, 2, places)), "w")))

    low, high = F.col("mean") - F.col("deviation"), F.col("mean") + F.col("deviation")
    usual = moment.groupBy("i").agg(F.percentile(low, 0.5).alias("u_low"), F.percentile(high, 0.5).alias("u_high"))
    least = F.when(F.col("u_low") * F.col("u_high") > 0, F.least(F.abs("u_low"), F.abs("u_high"))).otherwise(0.0)
    settled = F.greatest(high - F.col("u_low"), F.col("u_high") - low) < 0.2499 * least
    undecided = moment.join(usual, "i").where(~settled).select("i").distinct()
    slack = F.abs("mean") * 1e-12 + F.col("deviation") * 1e-9
    brackets = moment.select("load", "i", (low - slack).alias("low"), (high + slack).alias("high"))
    medians = exact_medians(counts.where("w > 0 and v is not null").join(undecided, "i", "left_semi"), ["load", "i"], "v", "w", brackets)

    n, filled = F.col("n"), F.nullif("filled", F.lit(0))
    inside = F.when(F.col("i") == 1, F.col("placed")).otherwise(F.col("inside"))
    figures = (
        figures.where(F.col("i") != places)
        .join(figures.where(F.col("i") == places).select("load", F.col("inside").alias("placed")), "load")
        .select("load", "i", ((n - F.col("filled")) / n).alias("nulls"), ((filled - inside) / filled).alias("out"), (F.col("top") / filled).alias("top"))
        .join(medians.select("load", F.when(F.col("i") == places, 1).otherwise(F.col("i")).alias("i"), "median"), ["load", "i"], "left")
    )
    usual = figures.groupBy("i").agg(*(F.percentile(c, 0.5).alias(f"u_{c}") for c in ("nulls", "top", "median")))
    kinds = F.array_compact(
        F.array(
            F.when(F.abs(F.col("nulls") - F.col("u_nulls")) > 0.08, "nulls"),
            F.when(F.col("out") > 0.05, "out_of_range"),
            F.when(F.col("top") - F.col("u_top") > 0.15, "top_value"),
            F.when(F.abs(F.col("median") - F.col("u_median")) > 0.25 * F.abs(F.col("u_median")), "shift"),
        )
    )
    names = F.array(*(F.lit(s.name) for s in watched))
    return figures.join(usual, "i").select(load_of().cast("bigint").alias("load_id"), F.element_at(names, F.col("i") + 1).alias("column_name"), F.explode(kinds).alias("kind"))


#: Patterns and ranges a valid value keeps; a value that breaks its rule is a violation.
RULES = {
    "interaction_id": "interaction_id rlike '^[0-9a-f]{64}$'",
    "device_segment": "device_segment rlike '^[a-z_]+$'",
    "traveller_segment": "traveller_segment rlike '^[a-z_]+$'",
    "orig_destination_distance": "not isnan(orig_destination_distance) and orig_destination_distance between 0 and 13000",
    "checkin_date": "datediff(checkin_date, event_date) between 0 and 730",
    "hotel_market": "hotel_market between 1 and 2500",
    "user_id": "user_id between 1 and 999999999",
    "is_mobile": "is_mobile in (0, 1)",
    "is_package": "is_package in (0, 1)",
    "is_booking": "is_booking in (0, 1)",
    "hotel_cluster": "hotel_cluster between 0 and 99",
}


def _number(name: str, kind: str) -> Column | None:
    column = F.col(name)
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind.startswith("timestamp"):
        return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(`{name}` as timestamp_ntz))").cast("double")
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return column.cast("double")
    return None


def column_profile(df: DataFrame, load: str = "load_id", rules: dict[str, str] | None = None) -> DataFrame:
    """One row per load and column: rows, null_share, distinct_values, ranges, violations, shift.

    ``std_difference`` is (mean of the load - mean of the rest) / sqrt of their mean variance, from exact
    power sums; dates count as days and timestamps as seconds since 1970, other numbers as doubles. NaN and
    infinities are values, but in neither sums nor ranges. Text columns have text ranges instead. A
    rule whose answer is null on a non-null value is broken. An empty table gives no rows. Distinct
    values are counted by 64-bit hash.
    """
    rules = RULES if rules is None else rules
    kinds = {c: k for c, k in df.dtypes if c != load}
    series = [Series(c, F.col(f"`{c}`"), _number(c, k), F.expr(rules[c]) if c in rules else None) for c, k in kinds.items()]
    texts = [i for i, s in enumerate(series) if s.number is None]
    counts = checkpointed(value_counts(df, load, series))
    moment = moments(power_sums(counts.where(~F.col("i").isin(texts)).withColumn("seen", F.when(F.col("h").isNotNull(), F.col("c")).otherwise(0)), "seen"))
    ranges = df.groupBy(load_key(F.col(load)).alias("load")).agg(
        F.lit(1).alias("one"), *(a for i in texts for a in (F.min(series[i].value.cast("string")).alias(f"lo{i}"), F.max(series[i].value.cast("string")).alias(f"hi{i}")))
    )
    no_text = F.lit(None).cast("string")
    least, most = (F.coalesce(no_text, *(F.when(F.col("i") == i, F.col(f"{end}{i}")) for i in texts)) for end in ("lo", "hi"))
    names = F.array(*(F.lit(c) for c in kinds))
    return (
        shares(counts)
        .join(ranges, "load")
        .join(moment, ["load", "i"], "left")
        .select(
            load_of().cast("bigint").alias("load_id"),
            F.element_at(names, F.col("i") + 1).alias("column_name"),
            F.col("n").alias("row_count"),
            ((F.col("n") - F.col("filled")) / F.col("n")).alias("null_share"),
            F.col("distinct").alias("distinct_values"),
            F.col("lo").alias("min_number"),
            F.col("hi").alias("max_number"),
            least.alias("min_text"),
            most.alias("max_text"),
            (F.col("filled") - F.col("inside")).alias("violations"),
            "mean",
            "std_difference",
        )
    )
