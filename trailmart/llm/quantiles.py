"""Percentiles of very large numeric columns by dyadic Count-sketches.

A value is encoded as an integer of ``BITS`` bits in the order of the values: the sign, the exponent
and the first 11 fraction bits, so a decoded value is within 2^-11 of the true one, relatively.
For each binary resolution a signed sketch counts the values by their leading bits: the coarse
resolutions fit exactly, the finer ones are Count-sketches of DEPTH rows and WIDTH counters. A sketch
is linear: partial sketches add up, and adding with weight -1 deletes. To find the value of a rank,
the levels are descended from the top, each time into the half that holds the rank.

The rank error of an answer is the sum of the errors of the sketched levels met on the way down, each
with standard deviation at most sqrt(F2 / WIDTH) of its level's second moment F2. How far the rows of the
sketch disagree shows how large it is in fact, so every answer comes with the standard error of its rank.

A sketch is made where the rows are: each task collapses a run of rows to partial results, and only these are
shuffled. A partial result of up to PLAIN codes is kept as these codes and their weights, which is the
same sketch before it is spread over its counters: it turns into counters, without any loss or gain, once
addition has made it larger. Groups of a third of all rows are added up in two steps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRACTION = 11
BITS = 1 + 11 + FRACTION  # all signs and exponents of doubles
WIDTH = 512
DEPTH = 5
EXACT = WIDTH.bit_length() - 1  # levels whose nodes fit the width are counted exactly
SIZE = (2 << EXACT) - 2 + (BITS - EXACT) * DEPTH * WIDTH
PLAIN = 2048  # codes that take less room than the counters
MIX = np.uint64(0x9E3779B97F4A7C15)
LEAST = 2.0**-1022
RUN = 1 << 18  # rows collapsed at once
SALTS = 32


def encode(values: np.ndarray) -> np.ndarray:
    """Codes of doubles, in their order; infinities have their own. Values nearer to zero than the
    least normal double fall on zero."""
    size = np.abs(values)
    finite = np.isfinite(size)
    mantissa, exponent = np.frexp(np.where(finite, size, 1.0))
    magnitude = (exponent.astype(np.int64) + 1022 << FRACTION) + np.floor((mantissa * 2 - 1) * (1 << FRACTION)).astype(np.int64)
    magnitude = np.where(finite, np.where(size < LEAST, 0, magnitude), 2047 << FRACTION)
    half = 1 << (BITS - 1)
    return np.where((values < 0) & (magnitude > 0), half - 1 - magnitude, half + magnitude)


def decode(codes: np.ndarray) -> np.ndarray:
    """The middle of each code's interval; integers below 2^12 come back exactly."""
    half = 1 << (BITS - 1)
    negative = codes < half
    magnitude = np.where(negative, half - 1 - codes, codes - half)
    exponent = (magnitude >> FRACTION) - 1023
    with np.errstate(over="ignore"):
        low = np.where(magnitude > 0, np.ldexp(1 + (magnitude & ((1 << FRACTION) - 1)) / (1 << FRACTION), exponent), 0.0)
        width = np.ldexp(1.0, exponent - FRACTION)
    value = np.where((low == np.round(low)) & (width <= 1) | ~np.isfinite(low) | (magnitude == 0), low, low + np.where(np.isfinite(low), width, 0.0) / 2)
    return np.where(negative, -value, value)


def _cells(nodes: np.ndarray, level: int, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and sign of nodes in one row of one level: a fixed 64-bit mix of node, level and row."""
    with np.errstate(over="ignore"):
        h = nodes.astype(np.uint64) * MIX + np.uint64((level * DEPTH + row + 1) * 0xD1B54A32D192ED03 & (2**64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return (h & np.uint64(WIDTH - 1)).astype(np.int64), np.where(h >> np.uint64(63), -1, 1)


def _offset(level: int, row: int = 0) -> int:
    return (1 << level) - 2 if level <= EXACT else (2 << EXACT) - 2 + ((level - EXACT - 1) * DEPTH + row) * WIDTH


def counters(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The counters of a sketch; weights may be negative."""
    out = np.zeros(SIZE, np.int64)
    for level in range(1, BITS + 1):
        nodes = codes >> (BITS - level)
        if level <= EXACT:
            np.add.at(out, _offset(level) + nodes, weights)
            continue
        for row in range(DEPTH):
            bucket, sign = _cells(nodes, level, row)
            np.add.at(out, _offset(level, row) + bucket, sign * weights)
    return out


def _narrow(values: np.ndarray) -> tuple[bytes, bytes]:
    top = int(np.abs(values).max(initial=0))
    kind = next(k for k in ("i1", "i2", "i4", "i8") if top < 1 << (8 * int(k[1]) - 1))
    return kind.encode(), values.astype("<" + kind).tobytes()


class Sketch:
    """Codes with weights while they are few, counters once they are not."""

    def __init__(self, codes: np.ndarray | None = None, weights: np.ndarray | None = None) -> None:
        """``codes`` ascending and without repeats."""
        self.codes = np.empty(0, np.int64) if codes is None else codes
        self.weights = np.empty(0, np.int64) if weights is None else weights
        self.counters: np.ndarray | None = None
        self._spread()

    def _spread(self) -> None:
        if len(self.codes) > PLAIN:
            self.counters = counters(self.codes, self.weights)

    def add(self, other: Sketch) -> None:
        """Add another partial result up."""
        if self.counters is None and other.counters is None:
            codes = np.concatenate([self.codes, other.codes])
            self.codes, at = np.unique(codes, return_inverse=True)
            weights = np.zeros(len(self.codes), np.int64)
            np.add.at(weights, at, np.concatenate([self.weights, other.weights]))
            self.codes, self.weights = self.codes[weights != 0], weights[weights != 0]
            self._spread()
            return
        mine = counters(self.codes, self.weights) if self.counters is None else self.counters
        self.counters = mine + (counters(other.codes, other.weights) if other.counters is None else other.counters)

    def pack(self) -> bytes:
        """The sketch as bytes, in the narrowest integers that hold it."""
        if self.counters is not None:
            kind, data = _narrow(self.counters)
            return b"c" + kind + zlib.compress(data, 1)
        kind, data = _narrow(self.weights)
        body = self.codes.astype("<u4").tobytes() + data
        return b"p" + kind + body if len(body) < 512 else b"z" + kind + zlib.compress(body, 1)

    @classmethod
    def unpack(cls, data: bytes) -> Sketch:
        form, kind, body = data[:1], "<" + data[1:3].decode(), data[3:] if data[:1] == b"p" else zlib.decompress(data[3:])
        made = cls()
        if form == b"c":
            made.counters = np.frombuffer(body, kind).astype(np.int64)
        else:
            size = len(body) // (4 + int(kind[2]))
            made.codes, made.weights = np.frombuffer(body, "<u4", size).astype(np.int64), np.frombuffer(body, kind, size, 4 * size).astype(np.int64)
        return made

    def node_counts(self, nodes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The estimated numbers of values below nodes of one level, and their standard errors."""
        if level <= EXACT:
            return self.counters[_offset(level) + nodes], np.zeros(len(nodes))
        rows = []
        for row in range(DEPTH):
            bucket, sign = _cells(nodes, level, row)
            rows.append(sign * self.counters[_offset(level, row) + bucket])
        ordered = np.sort(np.array(rows), axis=0)
        middle = DEPTH // 2
        # of five normal deviates the median has standard deviation 0.54, and the fourth is 0.99 above the second
        return ordered[middle], 0.54 * (ordered[middle + 1] - ordered[middle - 1])

    def invert(self, quantiles: Sequence[float]) -> tuple[int, np.ndarray, float]:
        """The number of values, the values at the quantiles (nearest rank, from below), and the largest standard error of their ranks, as a share."""
        n = int(self.weights.sum() if self.counters is None else self.counters[0] + self.counters[1])
        if n <= 0:
            return 0, np.full(len(quantiles), np.nan), 0.0
        left = np.maximum(1.0, np.ceil(np.array(quantiles) * n))
        if self.counters is None:
            return n, decode(self.codes[np.searchsorted(np.cumsum(self.weights), left)]), 0.0
        nodes = np.zeros(len(quantiles), np.int64)
        held = np.full(len(quantiles), float(n))
        variance = np.zeros(len(quantiles))
        for level in range(1, BITS + 1):
            (low, low_error), (high, high_error) = self.node_counts(nodes * 2, level), self.node_counts(nodes * 2 + 1, level)
            # the two halves are known to add up to their parent: share the difference between them
            slack = 0.0 if level <= EXACT else (held - low - high) / 2
            low = np.clip(low + slack, 0, held)
            right = left > low
            left = np.where(right, left - low, left)
            nodes = nodes * 2 + right
            held = np.where(right, held - low, low)
            variance += (low_error**2 + high_error**2) / 4  # each bears half of either's error
        return n, decode(nodes), float(variance.max(initial=0.0)) ** 0.5 / n


PARTIAL = "grouping string, group_value bigint, part date, column_name string, sketch binary"


def _collapsed(codes: np.ndarray, groups: np.ndarray, weights: np.ndarray) -> Iterator[tuple[int, Sketch]]:
    """The sketch of each group, of rows in any order."""
    both = (groups << BITS) | codes
    order = np.argsort(both, kind="stable")
    both, weights = both[order], weights[order]
    starts = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
    both, weights = both[starts], np.add.reduceat(weights, starts)
    both, weights = both[weights != 0], weights[weights != 0]
    if len(both):
        owner = both >> BITS
        cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for a, b in zip(cuts, np.r_[cuts[1:], len(both)], strict=True):
            yield int(owner[a]), Sketch(both[a:b] & ((1 << BITS) - 1), weights[a:b])


def partial_sketches(df: DataFrame, groupings: dict[str, Column], part: Column, columns: dict[str, Column], weight: Column | None = None) -> DataFrame:
    """Packed sketches per grouping, group value, part (a date, such as the month) and column: one for each run of rows.

    ``groupings`` and ``columns`` give expressions by name. Null and NaN values are left out; a null
    group value or part is a group of its own. ``weight`` (default 1) may be -1 to take rows back.
    Sketches of any parts are combined by merged_quantiles. An empty table gives no rows.
    """
    wide = df.select(
        *(c.cast("bigint").alias(f"g{i}") for i, c in enumerate(groupings.values())),
        *(c.cast("double").alias(f"v{i}") for i, c in enumerate(columns.values())),
        part.alias("part"),
        (weight if weight is not None else F.lit(1)).cast("bigint").alias("w"),
    )

    groups, names = list(groupings), list(columns)

    def numbered(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
        coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        weights = whole["w"].to_numpy()
        parts, part_values = numbered(whole["part"])
        rows: list[tuple] = []
        for j, column in enumerate(names):
            values = whole[f"v{j}"].to_numpy()
            here = ~np.isnan(values)
            codes, w = encode(values[here]), weights[here]
            for i, grouping in enumerate(groups):
                numbers, group_values = numbered(whole[f"g{i}"])
                for owner, sketch in _collapsed(codes, (numbers * len(part_values) + parts)[here], w):
                    rows.append((grouping, group_values[owner // len(part_values)].as_py(), part_values[owner % len(part_values)].as_py(), column, sketch.pack()))
        if rows:
            kinds = (pa.string(), pa.int64(), pa.date32(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["grouping", "group_value", "part", "column_name", "sketch"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= RUN:
                yield from flush(held)
                held = []
        if held:
            yield from flush(held)

    return wide.mapInArrow(build, PARTIAL)


def _sums(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Sketch]]:
    """The sum of the sketches of each key, of rows sorted by key."""
    at: tuple | None = None
    total = Sketch()
    for batch in batches:
        for *key, data in zip(*(batch[k].to_pylist() for k in (*keys, "sketch")), strict=True):
            if tuple(key) != at:
                if at is not None:
                    yield at, total
                at, total = tuple(key), Sketch()
            total.add(Sketch.unpack(data))
    if at is not None:
        yield at, total


def merged_quantiles(partials: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """Quantiles of the union of the parts per grouping, group value and column: n, rank_error, p05, p50, ...

    ``rank_error`` is the largest standard error of the ranks of the answers, as a share of n: 0 where the codes are few
    enough to be known exactly. Beside it, a value is within 2^-11 of the true one, relatively.
    """
    keys = ["grouping", "group_value", "column_name"]
    names = [f"p{round(q * 100):02d}" for q in quantiles]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), *[pa.float64()] * (1 + len(names))]
    schema = "grouping string, group_value bigint, column_name string, n bigint, rank_error double, " + ", ".join(f"{n} double" for n in names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, total in _sums(batches, keys):
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((*key, total.pack()), (*kinds[:3], pa.binary()), strict=True)], [*keys, "sketch"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for key, total in _sums(batches, keys):
            n, values, error = total.invert(quantiles)
            if n > 0:
                rows.append((*key, n, error, *values))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [*keys, "n", "rank_error", *names])

    salted = partials.select(*keys, "sketch", F.pmod(F.xxhash64("part", "sketch"), F.lit(SALTS)).alias("salt"))
    some = salted.repartition(*keys, "salt").select(*keys, "sketch").sortWithinPartitions(*keys).mapInArrow(add, "grouping string, group_value bigint, column_name string, sketch binary")
    return some.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(answer, schema)
