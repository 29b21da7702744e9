import datetime as dt
import random

import pytest

from trailmart.operators.sessions import sessionize

SCHEMA = "user_id bigint, date_time timestamp_ntz, u string, k string"


def brute(rows, gap):
    found = []
    for user in {r[0] for r in rows if r[0] is not None}:
        times = sorted(t for u, t, *_ in rows if u == user and t is not None)
        start = prev = None
        count = 0
        for t in times:
            if prev is None or (t - prev).total_seconds() > gap:
                if prev is not None:
                    found.append((user, start, prev, count))
                start, count = t, 0
            prev, count = t, count + 1
        if prev is not None:
            found.append((user, start, prev, count))
    return sorted(found)


def run(spark, rows, gap=1800, block=3600):
    df = spark.createDataFrame([(u, t, "x", "y") for u, t, *_ in rows], SCHEMA)
    return sorted((r["user_id"], r["session_start"], r["session_end"], r["event_count"]) for r in sessionize(df, "user_id", "date_time", gap, block).collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    base = dt.datetime(2013, 1, 1)
    rows = []
    for _ in range(400):
        user = rng.choice([None, 1, 1, 1, 2, 3])
        moment = None if rng.random() < 0.05 else base + dt.timedelta(seconds=rng.choice([0, 1, 1799, 1800, 1801, 3600]) + 900 * rng.randrange(300))
        rows.append((user, moment))
    rows += rows[:40]  # repeated rows
    assert run(spark, rows) == brute(rows, 1800)


def test_edges(spark):
    base = dt.datetime(1969, 12, 31, 23, 50)
    exact = [(1, base), (1, base + dt.timedelta(seconds=1800)), (1, base + dt.timedelta(seconds=3601)), (1, base + dt.timedelta(seconds=5402))]
    assert [n for *_, n in run(spark, exact)] == [1, 1, 2] or [n for *_, n in run(spark, exact)] == [2, 1, 1]
    assert run(spark, exact) == brute(exact, 1800)
    assert run(spark, []) == []
    assert run(spark, [(None, base), (2, None)]) == []
    assert run(spark, [(5, base)] * 7) == [(5, base, base, 7)]
    with pytest.raises(ValueError):
        run(spark, exact, 1800, 60)
