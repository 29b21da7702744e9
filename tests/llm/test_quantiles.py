import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailmart.llm import quantiles as q


def sketch(values, weight=1):
    codes, counts = np.unique(q.encode(np.asarray(values, float)), return_counts=True)
    return q.Sketch(codes, counts * weight)


def added(*sketches):
    total = q.Sketch()
    for s in sketches:
        total.add(s)
    return total


def test_codes_keep_order_and_value():
    rng = np.random.default_rng(1)
    values = np.r_[rng.normal(0, 1000, 20_000), np.arange(-4095.0, 4096), [0.0, -0.0, 1e-320, -1e-320, 1e40, -1e40, 1.7e308, -1.7e308, np.inf, -np.inf, 2.0**-1022, 1e-300]]
    codes = q.encode(values)
    assert 0 <= codes.min() and codes.max() < 1 << q.BITS
    assert (np.diff(codes[np.argsort(values)]) >= 0).all()
    whole = np.arange(-4095.0, 4096)
    assert (q.decode(q.encode(whole)) == whole).all()
    plain = values[(np.abs(values) < np.inf) & (np.abs(values) >= 2.0**-1022)]
    assert (np.abs(q.decode(q.encode(plain)) - plain) <= np.abs(plain) * 2.0**-11).all()
    assert q.decode(q.encode(np.array([np.inf, -np.inf, 1e-320]))).tolist() == [np.inf, -np.inf, 0.0]


@pytest.mark.parametrize("kind", ["uniform", "ties", "heavy"])
def test_rank_error(kind):
    rng = np.random.default_rng(7)
    n = 50_000
    values = {"uniform": rng.uniform(0, 13_000, n), "ties": rng.integers(0, 9, n).astype(float), "heavy": np.r_[np.full(n // 3, 1000.0), rng.lognormal(5, 2, n - n // 3)]}[kind]
    points = np.array([0.01, 0.25, 0.5, 0.75, 0.99])
    made = sketch(values)
    assert (made.counters is None) == (kind == "ties")
    count, found, error = made.invert(points)
    assert count == n and error < 0.02 and (error == 0) == (kind == "ties")
    for point, value in zip(points, found, strict=True):
        slack = abs(value) * 2.0**-11
        low, high = (values < value - slack).sum(), (values <= value + slack).sum()
        rank = np.ceil(point * n)
        assert max(0, low - rank + 1, rank - high) <= (0.001 + 4 * error) * n


def test_plain_codes_turn_into_the_same_counters():
    """Parts added up as codes, as counters or both give one sketch."""
    rng = np.random.default_rng(3)
    a, b, c = rng.normal(0, 10, 1500), rng.normal(5, 1, 1700), rng.lognormal(3, 2, 9000)
    assert sketch(a).counters is None and sketch(c).counters is not None
    whole = sketch(np.r_[a, b, c]).counters
    for order in ((a, b, c), (c, b, a), (a, c, b)):
        assert (added(*map(sketch, order)).counters == whole).all()
    assert (added(sketch(a), sketch(b)).counters == sketch(np.r_[a, b]).counters).all()


def test_deletion_and_packing():
    rng = np.random.default_rng(3)
    a, c = rng.normal(0, 10, 900), rng.lognormal(3, 2, 9000)
    assert (added(sketch(a), sketch(c), sketch(c, -1)).counters == q.counters(sketch(a).codes, sketch(a).weights)).all()
    gone = added(sketch(a), sketch(a, -1))
    assert len(gone.codes) == 0 and gone.invert([0.5])[0] == 0
    for weight in (1, -1, 1000, 10**12):
        for values in (a, a[:3], c, []):
            s = sketch(values, weight)
            t = q.Sketch.unpack(s.pack())
            assert (t.codes == s.codes).all() and (t.weights == s.weights).all() if s.counters is None else (t.counters == s.counters).all()


def test_merged_parts(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 3)) or None, dt.date(2013, int(rng.integers(1, 4)), 1), float(v), "x") for v in rng.normal(100, 20, 3000)]
    rows += [(1, dt.date(2013, 1, 1), float("nan"), "x"), (1, None, None, "x")]
    df = spark.createDataFrame(rows, "g int, m date, v double, grouping string")
    parts = q.partial_sketches(df, {"g": F.col("g")}, F.col("m"), {"v": F.col("v")})
    assert {(r["group_value"], r["part"]) for r in parts.collect()} >= {(g, dt.date(2013, m, 1)) for g in (None, 1, 2) for m in (1, 2, 3)}
    found = {r["group_value"]: r for r in q.merged_quantiles(parts, [0.5, 0.9]).collect()}
    for g in (None, 1, 2):
        own = np.array([v for k, _, v, _ in rows if k == g and v is not None and v == v])
        assert found[g]["n"] == len(own)
        for name, point in (("p50", 0.5), ("p90", 0.9)):
            assert abs((own < found[g][name]).mean() - point) < 0.02
    gone = q.partial_sketches(df.where("g = 1"), {"g": F.col("g")}, F.col("m"), {"v": F.col("v")}, F.lit(-1))
    assert set(r["group_value"] for r in q.merged_quantiles(parts.unionByName(gone), [0.5]).collect()) == {None, 2}
    assert q.merged_quantiles(q.partial_sketches(df.where("false"), {"g": F.col("g")}, F.col("m"), {"v": F.col("v")}), [0.5]).count() == 0
