import collections
import random

import pytest
from pyspark.sql import functions as F

from trailmart.llm import packing
from trailmart.llm.packing import STEPS, pack, sweep


def check(rows, items, capacity):
    """Every piece placed once, whole items uncut, containers dense and within capacity."""
    sizes = collections.defaultdict(list)
    for r in rows:
        sizes[r["k"]].append((r["piece"], r["size"]))
    wanted = collections.Counter(k for k, _ in items)
    for k, size in items:
        own = sorted(sizes[k])
        size = max(size or 0, 0)
        expected = sorted([(i, capacity if (i + 1) * capacity <= size else size - i * capacity) for i in range(max(1, -(-size // capacity)))] * wanted[k])
        assert own == expected, k
    held = collections.defaultdict(list)
    for r in rows:
        if r["size"]:
            held[r["container_id"]].append((r["place"], r["start"], r["size"]))
    for placed in held.values():
        at = 0
        for i, (place, start, size) in enumerate(sorted(placed)):
            assert (place, start) == (i, at)
            at += size
        assert at <= capacity
    assert sorted(held) == list(range(len(held)))
    return len(held)


def best_fit(sizes, capacity):
    gaps = []
    for size in sorted(sizes, reverse=True):
        fits = [g for g in gaps if g >= size]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - size)
        else:
            gaps.append(capacity - size)
    return len(gaps)


def steps(sizes, capacity):
    """Containers and the most ranges of one superstep, with gaps updated from the ranges alone."""
    gaps, containers, most = [], 0, 0
    ends = [capacity, *(capacity // k for k in STEPS), 0]
    for high, low in zip(ends, ends[1:], strict=False):
        own = {s: n for s, n in sizes.items() if low < s <= high}
        if not own:
            continue
        gaps.sort()
        by_width = {w: [g for g in gaps if g[0] == w] for w in {g[0] for g in gaps}}
        plan = sweep(own, {w: len(g) for w, g in by_width.items()}, capacity)
        fresh = [[capacity] for _ in range(plan.opened)]
        for s, first, ranks, source, target, each in plan.ranges:
            assert first >= 0 and ranks <= own[s]
            for r in range(ranks):
                gap = (by_width[source] if source else fresh)[target + r // each]
                gap[0] -= s
                assert gap[0] >= 0
        assert sum(r[2] for r in plan.ranges) == sum(own.values())
        gaps += fresh
        containers, most = containers + plan.opened, max(most, len(plan.ranges))
    return containers, most


@pytest.mark.parametrize("seed", range(12))
def test_supersteps_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    sizes = [min(100, int(rng.lognormvariate(3, 1)) + 1) for _ in range(rng.randrange(1, 900))]
    assert steps(collections.Counter(sizes), 100)[0] == best_fit(sizes, 100)


def test_plan_does_not_grow_with_the_items():
    rng = random.Random(9)
    shape = collections.Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    for factor in (1, 100_000):
        assert len(sweep({s: n * factor for s, n in shape.items()}, {}, 2048).ranges) <= 8 * 2048


def test_hot_sizes_are_salted(spark, monkeypatch):
    """Ranks are dense within each size, whatever the salts."""
    monkeypatch.setattr(packing, "SHARE", 10)
    df = spark.range(700).selectExpr("id as k", "case when id % 3 = 0 then 5L else id % 40 end as size")
    rows, counts = packing.ranked(df, "size", ["k"], F.xxhash64("k"))
    seen = collections.defaultdict(list)
    for r in rows.collect():
        seen[r["size"]].append(r["rank"])
    assert {s: sorted(r) for s, r in seen.items()} == {s: list(range(n)) for s, n in counts.items()}
    assert rows.select("size", "_salt").distinct().groupBy("size").count().where("size = 5").first()["count"] > 10
    items = [(i, 7 if i % 3 else 20) for i in range(300)]
    packed = pack(spark.createDataFrame(items, "k long, tokens long"), "k", "tokens", 64).collect()
    assert check(packed, items, 64) == best_fit([s for _, s in items], 64)


@pytest.mark.parametrize("seed", range(2))
def test_pack(spark, seed):
    rng = random.Random(seed)
    items = [(i, rng.choice([None, 0, -1, 7, 7, 7, rng.randrange(1, 90), 64, 65, 200])) for i in range(500)]
    items += items[:5]  # repeated rows are items of their own
    df = spark.createDataFrame([(k, s, "x", "y") for k, s in items], "k long, tokens long, size string, piece string")
    rows = pack(df.select("k", "tokens"), "k", "tokens", 64).collect()
    count = check(rows, items, 64)
    cut = [s % 64 or 64 for _, s in items if s and s > 0] + [64] * sum((s - 1) // 64 for _, s in items if s and s > 0)
    assert count == best_fit(cut, 64)


def test_a_large_capacity(spark):
    rng = random.Random(4)
    items = [(i, min(131_072, int(rng.lognormvariate(9, 1.5)) + 1)) for i in range(600)]
    rows = pack(spark.createDataFrame(items, "k long, tokens long"), "k", "tokens", 131_072).collect()
    assert check(rows, items, 131_072) == best_fit([s for _, s in items], 131_072)


def test_empty(spark):
    df = spark.createDataFrame([], "k long, tokens long")
    assert pack(df, "k", "tokens", 64).count() == 0
