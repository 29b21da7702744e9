"""Loading delimited text while setting aside the lines that cannot be loaded, with every reason.

Blocks of lines take a fast columnar path: a test of their bytes, one pass of a native CSV reader, and
the conversion of whole columns. None of the three says which line is at fault; a block that fails one of
them is bisected, recursively, until the failing lines stand alone, and only those are diagnosed strictly,
field by field. The fast path accepts a block only if each of its lines would pass the strict one, so both
give the same answer.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns of an interaction line, their types and rules, in file order.
TRAIN_FIELDS: tuple[tuple[str, str], ...] = (
    ("date_time", "timestamp"), ("site_name", "int16"), ("posa_continent", "int16"), ("user_location_country", "int32"),
    ("user_location_region", "int32"), ("user_location_city", "int32"), ("orig_destination_distance", "float64"),
    ("user_id", "int64"), ("is_mobile", "int8"), ("is_package", "int8"), ("channel", "int16"), ("srch_ci", "date"),
    ("srch_co", "date"), ("srch_adults_cnt", "int16"), ("srch_children_cnt", "int16"), ("srch_rm_cnt", "int16"),
    ("srch_destination_id", "int32"), ("srch_destination_type_id", "int16"), ("is_booking", "int8"), ("cnt", "int32"),
    ("hotel_continent", "int16"), ("hotel_country", "int32"), ("hotel_market", "int32"), ("hotel_cluster", "int16"),
)
REQUIRED = frozenset({"date_time", "is_booking"})
DOMAINS = {"is_mobile": (0, 1), "is_package": (0, 1), "is_booking": (0, 1), "hotel_cluster": (0, 99)}

INT = re.compile(r"[+-]?[0-9]+")
NUMBER = re.compile(r"[+-]?[0-9]+(\.[0-9]+)?")
DAY = re.compile(r"([0-9]{4})-([0-9]{2})-([0-9]{2})")
MOMENT = re.compile(r"([0-9]{4})-([0-9]{2})-([0-9]{2}) ([0-9]{2}):([0-9]{2}):([0-9]{2})")
ARROW = {"timestamp": pa.timestamp("us"), "date": pa.date32(), "float64": pa.float64(), "int8": pa.int8(), "int16": pa.int16(), "int32": pa.int32(), "int64": pa.int64()}
SPARK = {"timestamp": T.TimestampNTZType(), "date": T.DateType(), "float64": T.DoubleType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType()}


def split_line(line: str) -> list[str] | None:
    """The fields of one line, or None if its quoting is broken."""
    fields, at, size = [], 0, len(line)
    while True:
        if at < size and line[at] == '"':
            parts, at = [], at + 1
            while True:
                end = line.find('"', at)
                if end < 0:
                    return None
                parts.append(line[at:end])
                if line[end + 1 : end + 2] != '"':
                    break
                parts.append('"')
                at = end + 2
            at = end + 1
            fields.append("".join(parts))
            if at < size and line[at] != ",":
                return None
        else:
            end = line.find(",", at)
            end = size if end < 0 else end
            if '"' in line[at:end]:
                return None
            fields.append(line[at:end])
            at = end
        if at >= size:
            return fields
        at += 1


def read_field(text: str, kind: str) -> object:
    """The typed value of a stripped, non-empty field; raises ValueError if it is none."""
    if kind == "timestamp":
        if not (m := MOMENT.fullmatch(text)):
            raise ValueError(text)
        return dt.datetime(*map(int, m.groups()))
    if kind == "date":
        if not (m := DAY.fullmatch(text)):
            raise ValueError(text)
        return dt.date(*map(int, m.groups()))
    if kind == "float64":
        if not NUMBER.fullmatch(text):
            raise ValueError(text)
        return float(text)
    if not INT.fullmatch(text):
        raise ValueError(text)
    value, top = int(text), 1 << (int(kind[3:]) - 1)
    if not -top <= value < top:
        raise ValueError(text)
    return value


def diagnose(line: str | None) -> tuple[list[object] | None, list[str]]:
    """The typed values of a line, or None and all its reasons, in column order."""
    fields = split_line(line or "")
    if fields is None:
        return None, ["quoting"]
    if len(fields) != len(TRAIN_FIELDS):
        return None, ["column_count"]
    values: list[object] = []
    reasons = []
    for raw, (name, kind) in zip(fields, TRAIN_FIELDS, strict=True):
        text, value = raw.strip(), None
        if not text:
            if name in REQUIRED:
                reasons.append(f"{name}:missing")
        else:
            try:
                value = read_field(text, kind)
            except ValueError:
                reasons.append(f"{name}:parse_error")
            else:
                if name in DOMAINS and not DOMAINS[name][0] <= value <= DOMAINS[name][1]:
                    reasons.append(f"{name}:domain_error")
        values.append(value)
    return (None, reasons) if reasons else (values, [])


WIDTH = len(TRAIN_FIELDS)
NAMES = [name for name, _ in TRAIN_FIELDS]
PLAIN = b'0123456789+-:,. "\n'  # the bytes a valid line may have
AS_TEXT = pacsv.ConvertOptions(column_types=dict.fromkeys(NAMES, pa.string()), null_values=[], strings_can_be_null=False, quoted_strings_can_be_null=False)
LAST = b",".join([b"0"] * WIDTH) + b"\n"  # read after each block: a quote left open by its last line would swallow it
FIELDS = [pa.field(name, ARROW[kind]) for name, kind in TRAIN_FIELDS]
OUT = pa.schema([pa.field("line_id", pa.int64()), *FIELDS, pa.field("reasons", pa.list_(pa.string()))])


def failing(size: int, passes: Callable[[int, int], bool]) -> list[int]:
    """The records 0..size-1 that fail alone, found by bisecting: a block that passes is done, one that fails is halved."""
    found, stack = [], [(0, size)]
    while stack:
        start, end = stack.pop()
        if start == end or passes(start, end):
            continue
        if end - start == 1:
            found.append(start)
        else:
            half = (start + end) // 2
            stack += [(half, end), (start, half)]
    return found


class Block:
    """Lines as one buffer, in which a range of lines can be tested and cut into fields at once."""

    def __init__(self, lines: pa.Array) -> None:
        lines = pc.fill_null(lines, "")
        self.data = b"\n" + (pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")[0].as_buffer().to_pybytes() if len(lines) else b"") + b"\n"
        self.starts = np.r_[0, np.cumsum(np.asarray(pc.binary_length(lines), np.int64) + 1)].tolist()  # of the line ends before each line

    def plain(self, start: int, end: int) -> bool:
        """Whether the lines, taken together, have the bytes, the commas and the quotes of valid ones."""
        low, high = self.starts[start], self.starts[end] + 1
        cut, lines = self.data[low:high], end - start
        if cut.count(b",") != (WIDTH - 1) * lines or cut.count(b"\n") != lines + 1 or cut.translate(None, PLAIN):
            return False
        quotes = cut.count(b'"')
        return not quotes or quotes == cut.count(b',"') + cut.count(b'\n"') + cut.count(b'",') + cut.count(b'"\n')

    def fields(self, start: int, end: int) -> list[pa.Array] | None:
        """The fields by column, stripped and null where empty, or None if a line has not all of them."""
        cut = self.data[self.starts[start] + 1 : self.starts[end] + 1] + LAST
        try:
            read = pacsv.read_csv(pa.BufferReader(cut), pacsv.ReadOptions(column_names=NAMES, use_threads=False, block_size=len(cut)), pacsv.ParseOptions(newlines_in_values=False, ignore_empty_lines=False), AS_TEXT)
        except pa.ArrowInvalid:
            return None
        if len(read) != end - start + 1:
            return None
        stripped = [pc.ascii_trim(c.slice(0, end - start).combine_chunks(), " ") for c in read.columns]
        return [pc.if_else(pc.equal(c, ""), pa.scalar(None, pa.string()), c) for c in stripped]


def convert(texts: pa.Array, name: str, kind: str) -> pa.Array | None:
    """The typed column, or None if any of its texts is no valid value."""
    if name in REQUIRED and texts.null_count:
        return None
    if kind == "timestamp" and not pc.all(pc.equal(pc.binary_length(texts), 19), min_count=0).as_py():
        return None
    if kind == "float64" and not pc.all(pc.match_substring_regex(texts, r"^-?[0-9]+(\.[0-9]+)?$"), min_count=0).as_py():
        return None
    try:
        values = pc.cast(texts, ARROW[kind])
    except pa.ArrowInvalid:
        return None
    if name in DOMAINS:
        ends = pc.min_max(values).as_py()
        if ends["min"] is not None and not DOMAINS[name][0] <= ends["min"] <= ends["max"] <= DOMAINS[name][1]:
            return None
    return values


def bulk_parse(lines: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """Which lines failed, and the typed columns of the others.

    The three steps of the fast path each take the whole block: the bytes of the lines, their fields, and one column after
    the other. Where a step fails it is bisected; what it isolated is left out of the next.
    """
    good = np.arange(len(lines))

    def without(bad: list[int]) -> None:
        nonlocal good
        good = np.delete(good, bad)

    block = Block(lines)
    without(failing(len(good), block.plain))
    if len(good) < len(lines):
        block = Block(lines.take(pa.array(good)))
    if (columns := block.fields(0, len(good))) is None:
        without(failing(len(good), lambda a, b: block.fields(a, b) is not None))
        columns = Block(lines.take(pa.array(good))).fields(0, len(good))
        assert columns is not None
    bad: set[int] = set()
    for texts, (name, kind) in zip(columns, TRAIN_FIELDS, strict=True):
        bad.update(failing(len(texts), lambda a, b: convert(texts.slice(a, b - a), name, kind) is not None))  # noqa: B023
    if bad:
        kept = pa.array(np.delete(np.arange(len(good)), sorted(bad)))
        columns = [c.take(kept) for c in columns]
        without(sorted(bad))
    failed = np.ones(len(lines), bool)
    failed[good] = False
    return failed, [pc.cast(c, ARROW[kind]) for c, (_, kind) in zip(columns, TRAIN_FIELDS, strict=True)]


def _resolve(ids: pa.Array, lines: pa.Array) -> Iterator[pa.RecordBatch]:
    """Batches of the result: the lines that parsed in bulk, and those that did not, diagnosed strictly."""
    failed, columns = bulk_parse(lines)
    loaded = len(lines) - int(failed.sum())
    if loaded:
        none = pa.ListArray.from_arrays(pa.array(np.zeros(loaded + 1, np.int32)), pa.array([], pa.string()))
        yield pa.RecordBatch.from_arrays([ids.filter(pa.array(~failed)), *columns, none], schema=OUT)
    if loaded < len(lines):
        rows = [diagnose(x) for x in lines.filter(pa.array(failed)).to_pylist()]
        typed = [pa.array([v[i] if v else None for v, _ in rows], f.type) for i, f in enumerate(FIELDS)]
        yield pa.RecordBatch.from_arrays([ids.filter(pa.array(failed)), *typed, pa.array([r for _, r in rows], pa.list_(pa.string()))], schema=OUT)


def parse_lines(df: DataFrame, line_id: str = "line_id", line: str = "raw_line", block: int = 4096) -> DataFrame:
    """One row per line: line_id, the typed columns (all null if rejected) and ``reasons`` (empty if loaded).

    A null or empty line has too few columns. Spaces around an unquoted or quoted value are dropped.
    Line ids are passed through, so repeated lines stay. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), block):
                cut = batch.slice(start, block)
                yield from _resolve(cut.column(0).cast(pa.int64()), cut.column(1))

    schema = T.StructType(
        [T.StructField("line_id", T.LongType()), *(T.StructField(n, SPARK[k]) for n, k in TRAIN_FIELDS), T.StructField("reasons", T.ArrayType(T.StringType()))]
    )
    return df.select(F.col(line_id).cast("bigint"), F.col(line).cast("string")).mapInArrow(run, schema)


def accepted(parsed: DataFrame) -> DataFrame:
    """The typed table of the lines that loaded."""
    return parsed.where(F.size("reasons") == 0).drop("reasons")


def rejected(parsed: DataFrame) -> DataFrame:
    """One row per rejected line and reason."""
    return parsed.select("line_id", F.explode("reasons").alias("reason"))
