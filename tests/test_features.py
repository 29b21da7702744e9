import collections
import datetime as dt
import random

import numpy as np

from trailmart.operators.features import Bitmap, BitSliced, entity_features, merged_features, partial_features

SCHEMA = "id string, user bigint, t int, d date, a int, counts string, kind string"


def test_bit_sliced_addition():
    rng = np.random.default_rng(3)
    truth = np.zeros(5000, np.int64)
    halves = [BitSliced(), BitSliced()]
    for i in range(12):
        at = np.sort(rng.choice(5000, rng.integers(0, 900), replace=False))
        amounts = rng.integers(0, 100, len(at))
        truth[at] += amounts
        halves[i % 2].merge(BitSliced.unpack(BitSliced.of(at, amounts).pack()))
    halves[0].merge(halves[1])
    assert (halves[0].decode(5000) == truth).all()
    assert (halves[0].used() == np.flatnonzero(truth)).all()
    assert not Bitmap.of(np.empty(0, np.int64))


def brute(rows, types, as_of):
    seen, kept = set(), []
    for i, *rest in rows:
        if i is None or i not in seen:
            kept.append(rest)
        seen.add(i)
    out = {}
    for user, t, d, a in kept:
        if user is None:
            continue
        c, last, total = out.setdefault(user, ([0] * types, [None] * types, [0] * types))
        if t is not None and 0 <= t < types:
            c[t] += 1
            total[t] += a or 0
            if d is not None:
                gone = (as_of - d).days
                last[t] = gone if last[t] is None else min(last[t], gone)
    return out


def test_equals_brute_force(spark):
    rng = random.Random(2)
    day = dt.date(2014, 1, 1)
    rows = []
    for i in range(3000):
        user = rng.choice([None, 1, 1, 1, *range(2, 60)])
        rows.append((f"e{i}" if rng.random() < 0.9 else None, user, rng.choice([None, -1, 7, *range(6)]), None if rng.random() < 0.03 else day + dt.timedelta(days=rng.randrange(400)), rng.choice([None, -3, 0, 1, 40])))
    rows += [r for r in rows[:300] if r[0]]
    as_of = max(r[3] for r in rows if r[3])
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = entity_features(df, "user", "t", 6, "d", "a", "id", blocks=5).collect()
    assert {r["user"]: (r["counts"], r["days_since"], r["totals"]) for r in found} == brute(rows, 6, as_of)
    assert len(found) == len(collections.Counter(r["user"] for r in found))


def test_stored_partials_of_separate_loads_combine(spark):
    rng = random.Random(9)
    day = dt.date(2014, 1, 1)
    rows = [(f"e{i}", rng.choice([7, 7, *range(90)]), rng.choice([None, *range(6)]), rng.choice([None, day + dt.timedelta(days=rng.randrange(99))]), rng.randrange(-9, 2**31 - 1), "x", "y") for i in range(900)]
    whole = entity_features(spark.createDataFrame(rows, SCHEMA), "user", "t", 6, "d", "a", "id", as_of=20000)
    parts = [partial_features(spark.createDataFrame(rows[k::3], SCHEMA), "user", "t", 6, "d", "a", "id", blocks=4) for k in range(3)]
    assert len({r["part"] for r in parts[0].collect()}) == 5  # four months and events without a day
    added = merged_features(parts[0].unionByName(parts[1]).unionByName(parts[2]), "user", 6, 20000)
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, whole.collect()))


def test_empty(spark):
    assert entity_features(spark.createDataFrame([], SCHEMA), "user", "t", 6, "d", "a", "id").count() == 0
