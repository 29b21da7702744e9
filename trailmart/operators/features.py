"""One feature row per entity from bit-sliced counters.

Entities are hashed into blocks. A partial result covers one block and one part (a month) and numbers the
entities it has seen by ordinals; for all event types together it holds one counter and one total per
(type, ordinal), bit-sliced: slice j is a compressed bitmap of the positions whose count has bit j set. The
latest day of each counted position lies in an array aligned with those positions. Partial results are rows
of a table: they can be stored, and those of any days, loads or months combine by renumbering their
ordinals and adding slices with carries, the latest days by maximum. Only the last step decodes slices.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEVER = -(2**31)
CHUNK = 1 << 16  # events of one partial result at most
ENTITIES = 4096  # of a block, about


class Bitmap:
    """A bitmap of which only the words that are not empty are kept: their numbers, ascending, and their bits."""

    __slots__ = ("keys", "words")

    def __init__(self, keys: np.ndarray, words: np.ndarray) -> None:
        self.keys, self.words = keys, words

    @classmethod
    def of(cls, positions: np.ndarray) -> Bitmap:
        """The bitmap of ascending ``positions`` without repeats."""
        if not len(positions):
            return cls(np.empty(0, np.int64), np.empty(0, np.uint64))
        keys = positions >> 6
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return cls(keys[starts], np.bitwise_or.reduceat(np.uint64(1) << (positions & 63).astype(np.uint64), starts))

    def positions(self) -> np.ndarray:
        bits = np.unpackbits(self.words.view(np.uint8), bitorder="little").reshape(-1, 64)
        at, bit = np.nonzero(bits)
        return self.keys[at] * 64 + bit

    def __and__(self, other: Bitmap) -> Bitmap:
        keys, a, b = np.intersect1d(self.keys, other.keys, assume_unique=True, return_indices=True)
        words = self.words[a] & other.words[b]
        return Bitmap(keys[words != 0], words[words != 0])

    def _joined(self, other: Bitmap) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.union1d(self.keys, other.keys)
        a, b = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
        a[np.searchsorted(keys, self.keys)] = self.words
        b[np.searchsorted(keys, other.keys)] = other.words
        return keys, a, b

    def __xor__(self, other: Bitmap) -> Bitmap:
        keys, a, b = self._joined(other)
        words = a ^ b
        return Bitmap(keys[words != 0], words[words != 0])

    def __or__(self, other: Bitmap) -> Bitmap:
        keys, a, b = self._joined(other)
        return Bitmap(keys, a | b)

    def __bool__(self) -> bool:
        return bool(len(self.keys))

    def pack(self) -> bytes:
        gaps = np.diff(self.keys, prepend=0).astype("<u4")
        return zlib.compress(np.uint32(len(gaps)).tobytes() + gaps.tobytes() + self.words.astype("<u8").tobytes(), 1)

    @classmethod
    def unpack(cls, data: bytes) -> Bitmap:
        raw = zlib.decompress(data)
        size = int(np.frombuffer(raw, "<u4", 1)[0])
        return cls(np.cumsum(np.frombuffer(raw, "<u4", size, 4).astype(np.int64)), np.frombuffer(raw, "<u8", size, 4 + 4 * size).astype(np.uint64))


class BitSliced:
    """Counters over positions, held as one bitmap per binary digit."""

    def __init__(self, slices: list[Bitmap] | None = None) -> None:
        self.slices = slices or []

    @classmethod
    def of(cls, positions: np.ndarray, amounts: np.ndarray) -> BitSliced:
        """The counters with non-negative ``amounts`` at ascending, unlike ``positions``."""
        return cls([Bitmap.of(positions[(amounts >> digit) & 1 == 1]) for digit in range(int(amounts.max(initial=0)).bit_length())])

    def add_slice(self, carry: Bitmap, digit: int) -> None:
        """Add 2^digit at the positions of ``carry``, rippling the carries upwards."""
        while carry:
            while len(self.slices) <= digit:
                self.slices.append(Bitmap.of(np.empty(0, np.int64)))
            held = self.slices[digit]
            self.slices[digit], carry = held ^ carry, held & carry
            digit += 1

    def merge(self, other: BitSliced) -> None:
        """Add another partial result over the same ordinals."""
        for digit, carry in enumerate(other.slices):
            self.add_slice(carry, digit)

    def moved(self, place: np.ndarray) -> BitSliced:
        """The same counters at the positions ``place`` gives them (ascending)."""
        return BitSliced([Bitmap.of(place[s.positions()]) for s in self.slices])

    def used(self) -> np.ndarray:
        """The positions that are not zero."""
        return reduce(Bitmap.__or__, self.slices, Bitmap.of(np.empty(0, np.int64))).positions()

    def decode(self, size: int) -> np.ndarray:
        values = np.zeros(size, np.int64)
        for digit, held in enumerate(self.slices):
            values[held.positions()] += 1 << digit
        return values

    def pack(self) -> list[bytes]:
        return [s.pack() for s in self.slices]

    @classmethod
    def unpack(cls, data: list[bytes]) -> BitSliced:
        return cls([Bitmap.unpack(x) for x in data])


PARTIAL = "block int, part date, entities binary, counts array<binary>, plus array<binary>, minus array<binary>, latest binary"


def _sliced(users: np.ndarray, kinds: np.ndarray, amounts: np.ndarray, days: np.ndarray) -> tuple:
    """The partial result of some events of one block and part."""
    entities, ordinal = np.unique(users, return_inverse=True)
    known = kinds >= 0
    position = kinds[known].astype(np.int64) * len(entities) + ordinal[known]
    order = np.argsort(position, kind="stable")
    position, amounts, days = position[order], amounts[known][order], days[known][order].astype(np.int64)
    starts = np.flatnonzero(np.r_[True, position[1:] != position[:-1]]) if len(position) else np.empty(0, np.int64)
    if len(starts):
        n = np.diff(np.r_[starts, len(position)])
        plus, minus = (np.add.reduceat(np.maximum(sign * amounts, 0), starts) for sign in (1, -1))
        latest = np.maximum.reduceat(days, starts)
    else:
        n = plus = minus = latest = np.empty(0, np.int64)
    position = position[starts]
    slices = [BitSliced.of(position, x).pack() for x in (n, plus, minus)]
    return zlib.compress(np.diff(entities, prepend=0).astype("<i8").tobytes(), 1), *slices, latest.astype("<i4").tobytes()


def partial_features(events: DataFrame, entity: str, kind: str, types: int, day: str, amount: str, event_id: str | None = None, blocks: int | None = None) -> DataFrame:
    """Partial results by block and month: bit-sliced counts and totals, and the latest days. See ``entity_features``.

    Results to be combined must be made with the same ``blocks`` (if not given, from the number of
    entities) and of disjoint events. Events are spread by block and month; a block with more than a
    thousandth of all events is spread further by a hash of the event.
    """
    fields = ("user", "kind", "day", "amount")
    base = events.select(
        *([F.col(event_id).alias("id")] if event_id else [F.lit(None).cast("string").alias("id")]),
        F.col(entity).cast("bigint").alias("user"),
        F.expr(kind).cast("int").alias("kind"),
        F.unix_date(day).alias("day"),
        F.coalesce(F.col(amount).cast("bigint"), F.lit(0)).alias("amount"),
    )
    if blocks is None:
        blocks = max(1, (base.agg(F.approx_count_distinct("user")).first()[0] or 0) // ENTITIES)
    block = F.pmod(F.xxhash64("user"), F.lit(blocks)).cast("int")
    sizes = base.where("user is not null").groupBy(block.alias("block")).agg(F.count("*").alias("n"))
    limit = max(CHUNK * 16, (sizes.agg(F.sum("n")).first()[0] or 0) // 1000)
    hot = sizes.where(F.col("n") > limit).select("block", F.ceil(F.col("n") / limit).cast("int").alias("salts"))  # at most 1,000 rows
    if event_id:
        once = base.where("id is not null").groupBy("id").agg(F.min(F.struct(*fields)).alias("x")).select("id", "x.*")
        base = once.unionByName(base.where("id is null"))
    spread = (
        base.where("user is not null")
        .select(
            block.alias("block"),
            F.trunc(F.date_from_unix_date("day"), "MM").alias("part"),
            "user",
            F.when(F.col("kind").between(0, types - 1), F.col("kind")).otherwise(-1).alias("kind"),
            "amount",
            F.coalesce("day", F.lit(NEVER)).alias("day"),
            F.xxhash64("id", *fields[1:]).alias("salt"),
        )
        .join(F.broadcast(hot), "block", "left")
        .withColumn("salt", F.pmod("salt", F.coalesce("salts", F.lit(1))))
        .repartition("block", "part", "salt")
        .select("block", "part", "user", "kind", "amount", "day")
        .sortWithinPartitions("block", "part")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            blocks_, parts = whole["block"].to_numpy(), whole["part"].cast(pa.int32()).fill_null(NEVER).to_numpy()
            starts = np.flatnonzero(np.r_[True, (blocks_[1:] != blocks_[:-1]) | (parts[1:] != parts[:-1])])
            columns = [whole[c].to_numpy() for c in ("user", "kind", "amount", "day")]
            rows = [_sliced(*(c[a:b] for c in columns)) for a, b in zip(starts, np.r_[starts[1:], len(whole)], strict=True)]
            binary, many = pa.binary(), pa.list_(pa.binary())
            packed = [pa.array([r[i] for r in rows], t) for i, t in enumerate((binary, many, many, many, binary))]
            heads = whole.select(["block", "part"]).take(pa.array(starts)).combine_chunks()
            yield pa.RecordBatch.from_arrays([heads["block"].combine_chunks(), heads["part"].combine_chunks(), *packed], ["block", "part", "entities", "counts", "plus", "minus", "latest"])
            held.clear()

        for batch in batches:
            for start in range(0, len(batch), CHUNK):
                held.append(batch.slice(start, CHUNK))
                if sum(map(len, held)) >= CHUNK:
                    yield from flush()
        if held:
            yield from flush()

    return spread.mapInArrow(build, PARTIAL)


def _merged(rows: list[dict], as_of: int, types: int) -> pa.RecordBatch:
    """Add the partial results of a block up and decode them."""
    own = [np.cumsum(np.frombuffer(zlib.decompress(r["entities"]), "<i8")) for r in rows]
    entities = np.unique(np.concatenate(own))
    count = len(entities)
    size = types * count
    sums = [BitSliced() for _ in range(3)]
    latest = np.full(size, NEVER, np.int64)
    for row, seen in zip(rows, own, strict=True):
        place = (np.arange(types)[:, None] * count + np.searchsorted(entities, seen)).reshape(-1)
        parts = [BitSliced.unpack(row[c]) for c in ("counts", "plus", "minus")]
        used = place[parts[0].used()]
        latest[used] = np.maximum(latest[used], np.frombuffer(row["latest"], "<i4"))
        for total, part in zip(sums, parts, strict=True):
            total.merge(part.moved(place))
    counts, plus, minus = (s.decode(size) for s in sums)

    def lists(values: np.ndarray, kind: pa.DataType, mask: np.ndarray | None = None) -> pa.Array:
        turn = lambda x: np.ascontiguousarray(x.reshape(types, -1).T).reshape(-1)
        flat = pa.array(turn(values).astype(kind.to_pandas_dtype()), mask=None if mask is None else turn(mask))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, size + 1, types, dtype=np.int32)), flat)

    never = latest == NEVER
    return pa.RecordBatch.from_arrays(
        [pa.array(entities), lists(counts, pa.int64()), lists(np.where(never, 0, as_of - latest), pa.int32(), never), lists(plus - minus, pa.int64())],
        ["entity", "counts", "days_since", "totals"],
    )


def merged_features(partials: DataFrame, entity: str, types: int, as_of: int) -> DataFrame:
    """The feature rows of the union of partial results: one row per entity that any of them has seen."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: int | None = None
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != at and held:
                    yield _merged(held, as_of, types)
                    held = []
                at = row["block"]
                held.append(row)
        if held:
            yield _merged(held, as_of, types)

    schema = "entity bigint, counts array<bigint>, days_since array<int>, totals array<bigint>"
    columns = ("block", "entities", "counts", "plus", "minus", "latest")
    return partials.select(*columns).repartition("block").sortWithinPartitions("block").mapInArrow(merge, schema).withColumnRenamed("entity", entity)


def last_day(events: DataFrame, day: str | Column) -> int:
    """The latest day of all rows, since 1970-01-01; 0 if there is none."""
    return events.agg(F.max(F.unix_date(day))).first()[0] or 0


def entity_features(
    events: DataFrame,
    entity: str,
    kind: str,
    types: int,
    day: str,
    amount: str,
    event_id: str | None = None,
    as_of: int | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """One row per non-null entity: the entity, and counts, days_since and totals by type ordinal.

    ``kind`` is an expression for the type's ordinal 0..types-1; an event whose type is null or
    outside gives its entity a row but no count. Each non-null ``event_id`` counts once (the copy
    with the least values by order of entity, type, day, amount, if copies should differ); rows without
    id count each. A null amount adds 0, a null day leaves recency alone. ``as_of`` is the day
    (since 1970-01-01) recency is measured from: the latest day of all rows if not given. Recency of
    a type the entity never had is null. An empty table gives no rows.
    """
    if as_of is None:
        as_of = last_day(events, day)
    return merged_features(partial_features(events, entity, kind, types, day, amount, event_id, blocks), entity, types, as_of)
