import random

import pyarrow as pa
import pytest

from trailmart.operators.rejects import NAMES, TRAIN_FIELDS, Block, bulk_parse, diagnose, failing, parse_lines, split_line

GOOD = "2013-01-01 01:45:55,8,3,195,380,38024,1.5,649,0,0,10,2013-01-02,2013-01-12,3,0,1,142,5,0,1,1,50,161,13"


def change(column, value):
    cells = GOOD.split(",")
    cells[NAMES.index(column)] = value
    return ",".join(cells)


@pytest.mark.parametrize(
    ("line", "reasons"),
    [
        (GOOD, []),
        (",".join(f'"{c}"' for c in GOOD.split(",")), []),
        (change("cnt", "  +3 "), []),
        (change("srch_ci", '""'), []),
        (change("cnt", '" 3 "'), []),
        (change("date_time", ""), ["date_time:missing"]),
        (change("is_booking", " "), ["is_booking:missing"]),
        (change("srch_ci", "2013-02-30"), ["srch_ci:parse_error"]),
        (change("srch_ci", "2013-2-3"), ["srch_ci:parse_error"]),
        (change("date_time", "2013-01-01T01:45:55"), ["date_time:parse_error"]),
        (change("user_id", "9223372036854775808"), ["user_id:parse_error"]),
        (change("user_id", "٣"), ["user_id:parse_error"]),
        (change("is_mobile", "128"), ["is_mobile:parse_error"]),
        (change("is_mobile", "2"), ["is_mobile:domain_error"]),
        (change("hotel_cluster", "100"), ["hotel_cluster:domain_error"]),
        (change("orig_destination_distance", "1e3"), ["orig_destination_distance:parse_error"]),
        (change("orig_destination_distance", "-.5"), ["orig_destination_distance:parse_error"]),
        (change("cnt", '4"'), ["quoting"]),
        (change("cnt", '"4'), ["quoting"]),
        (change("cnt", ' "4"'), ["quoting"]),
        (change("cnt", '"4"x'), ["quoting"]),
        (GOOD + ",", ["column_count"]),
        ("", ["column_count"]),
        (None, ["column_count"]),
    ],
)
def test_reasons(line, reasons):
    assert diagnose(line)[1] == reasons


def test_quotes():
    assert split_line('"a""b",,"c,d"') == ['a"b', "", "c,d"]
    assert split_line('a,"') is None
    assert split_line('"a",') == ["a", ""]


def agrees(lines):
    """The fast path takes no line that the strict one rejects, and reads the same values."""
    failed, columns = bulk_parse(pa.array(lines, pa.string()))
    good = [x for x, f in zip(lines, failed, strict=True) if not f]
    for i, x in enumerate(good):
        values, reasons = diagnose(x)
        assert not reasons, x
        assert [c[i].as_py() for c in columns] == values, x
    return failed.tolist()


def test_fast_path_never_accepts_what_the_strict_one_rejects():
    rng = random.Random(4)
    for alphabet, base in (("0123456789-: ,\".+eTx\n\r", GOOD), ('",1 \n', ",".join(f'"{c}"' for c in GOOD.split(",")))):
        lines = []
        for _ in range(1500):
            line = list(base)
            for _ in range(rng.randrange(1, 4)):
                i = rng.randrange(len(line))
                line[i : i + rng.randrange(2)] = rng.choice(alphabet)
            lines.append("".join(line))
        together = agrees(lines)
        assert together == [x for line in lines for x in agrees([line])]  # a neighbour changes nothing
        assert sum(together) < 1500
        for i in range(0, 1500, 2):
            agrees([GOOD, lines[i], lines[i + 1]])


def test_fast_path_knows_the_calendar():
    """strptime-like readers roll 30 February over to March."""
    lines = []
    for column, hour in (("date_time", " 10:00:00"), ("srch_ci", ""), ("srch_co", "")):
        for year in (2012, 2013, 1900, 2000):
            for month in range(0, 14):
                for day in (0, 1, 28, 29, 30, 31, 32):
                    lines.append(change(column, f"{year}-{month:02d}-{day:02d}{hour}"))
    lines += [change("date_time", f"2013-01-01 {clock}") for clock in ("24:00:00", "23:60:00", "23:59:60", "00:00:00", "23:59:59")]
    assert agrees(lines) == [bool(diagnose(x)[1]) for x in lines]
    lines = []
    for column, kind in TRAIN_FIELDS:
        if kind.startswith("int"):
            top = 1 << (int(kind[3:]) - 1)
            lines += [change(column, str(value)) for value in (top - 1, top, -top, -top - 1, 10**30, "0" * 30 + "1", "-0", "  5", "5  ", "", " ")]
    lines += [change("orig_destination_distance", value) for value in ("1." + "0" * 400, "9" * 400, "0.1", "-0.0", "123456789.123456789", "5.", ".5", "-", ".")]
    agrees(lines)


def test_bisection_tests_blocks_only():
    """A block that passes is never cut; each failing line costs two tests a level at most."""
    rng = random.Random(6)
    for size, count in ((4096, 0), (4096, 1), (4096, 40), (1000, 7), (8, 8), (1, 1), (0, 0)):
        bad = sorted(rng.sample(range(size), count))
        calls = []

        def passes(start, end):
            calls.append((start, end))
            return not any(start <= b < end for b in bad)  # noqa: B023

        assert sorted(failing(size, passes)) == bad
        assert len(calls) <= 1 + 2 * count * size.bit_length()
        clean = [c for c in calls if not any(c[0] <= b < c[1] for b in bad)]
        assert not any(a != b and a[0] <= b[0] and b[1] <= a[1] for a in clean for b in clean)


def test_a_block_says_yes_or_no():
    block = Block(pa.array([GOOD, GOOD + ",1", GOOD]))
    assert block.plain(0, 1) and not block.plain(0, 3) and not block.plain(1, 2) and block.plain(2, 3)
    assert block.fields(0, 3) is None and len(block.fields(2, 3)) == 24


def test_blocks_and_lines_agree(spark):
    rng = random.Random(5)
    lines = [GOOD if rng.random() < 0.8 else rng.choice([None, "", GOOD + ",x", change("cnt", "x"), change("cnt", '"'), change("hotel_cluster", "-1")]) for _ in range(700)]
    df = spark.createDataFrame([(i, x, "r") for i, x in enumerate(lines)], "line_id long, raw_line string, reasons string")
    found = {r["line_id"]: r["reasons"] for r in parse_lines(df, block=128).collect()}
    assert found == {i: diagnose(x)[1] for i, x in enumerate(lines)}
    assert parse_lines(df.where("false")).count() == 0
