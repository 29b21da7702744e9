"""Contracts, the catalog, gates, builds, the recommender's metrics, determinism."""

import json

import pytest
from pyspark.sql import functions as F

from trailmart.contract import Contract
from trailmart.operators import gates, profile, publish
from trailmart.operators.ranking import block_rank
from trailmart.plans import build, legacy, recommend
from trailmart.schema import DESTINATIONS, OBJECTS, TEST, TRAIN, ObjectSpec
from trailmart.session import table
from trailmart.sources import landing


def test_contract(tmp_path):
    path = tmp_path / "c.json"
    path.write_bytes(b"\xef\xbb\xbf" + Contract(minimum_interactions=5).to_json().encode())
    assert Contract.load(path).minimum_interactions == 5
    path.write_text('{"surprise": 1}')
    with pytest.raises(ValueError):
        Contract.load(path)
    path.write_text('{"stay_nights": [3, 1]}')
    with pytest.raises(ValueError):
        Contract.load(path)


def test_declared_schemas():
    assert len(TRAIN) == 24 and len(TEST) == 22 and len(DESTINATIONS) == 150
    assert len({o.name for o in OBJECTS}) == len(OBJECTS)
    assert all(len(set(o.grain)) == len(o.grain) for o in OBJECTS)


def test_catalog_passes_its_gates(spark, data):
    catalog = build.catalog_of(spark, data)
    catalog = {n: df.persist() if n.startswith("fct") else df for n, df in catalog.items()}
    failed = [r["gate"] for r in gates.all_gates(catalog).where("not passed").collect()]
    assert failed == []
    assert gates.forbidden_names(catalog) == []
    broken = catalog | {"dm_booking_window": catalog["dm_booking_window"].withColumn("booking_interaction_share", F.lit(2.0))}
    with pytest.raises(gates.GateError, match="range:dm_booking_window"):
        import functools

        gates.require(functools.reduce(lambda a, b: a.unionByName(b), gates.range_gates(broken)))
    spark.catalog.clearCache()


def test_publish_and_compare(spark, tmp_path):
    df = spark.range(20).withColumn("event_year", (F.col("id") % 2).cast("smallint"))
    spec = ObjectSpec("core", "things", ("id",), ("event_year",))
    for name in ("one", "two"):
        with publish.Build(tmp_path, name) as target:
            target.write(df, spec)
    manifest = publish.latest(tmp_path)
    assert manifest["build_id"] == "two" and manifest["objects"][0]["rows"] == 20
    with pytest.raises(FileExistsError), publish.Build(tmp_path, "one"):
        pass
    with pytest.raises(RuntimeError), publish.Build(tmp_path, "three") as target:
        raise RuntimeError("no")
    assert not (tmp_path / "three").exists() and publish.latest(tmp_path)["build_id"] == "two"
    a, b = (spark.read.parquet(str(tmp_path / n / "core" / "things")) for n in ("one", "two"))
    result = profile.same_rows(a, b)
    assert result["exact"] and result["checksums_agree"]
    assert not profile.same_rows(a, b.where("id > 0").union(b.where("id = 1")))["exact"]
    checks = publish.acceptance(tmp_path / "one", tmp_path / "two", {"things": result}, {"things": 20}, {"seen": True})
    assert all(c["passed"] for c in checks)
    assert publish.package(tmp_path / "one", tmp_path / "one.zip").is_file()
    next((tmp_path / "one").rglob("*.parquet")).write_bytes(b"x")
    assert publish.changed_files(tmp_path / "one")
    with pytest.raises(ValueError):
        publish.package(tmp_path / "one", tmp_path / "again.zip")
    assert publish.plain({"x": float("nan"), "y": 2**70, "z": [float("inf")]}) == {"x": None, "y": str(2**70), "z": [None]}


def test_landing(spark, tmp_path):
    (tmp_path / "train.csv").write_text('a,b\n1,"x, ""y"""\n,""\n3,z\n', encoding="utf-8")
    assert landing.find_raw(spark, tmp_path, "train").endswith("/train.csv")
    with pytest.raises(FileNotFoundError):
        landing.find_raw(spark, tmp_path, "test")
    rows = landing.with_scan_ordinal(landing.read_text_csv(spark, tmp_path / "train.csv", ["a", "b"])).orderBy("source_scan_ordinal").collect()
    assert [(r["a"], r["b"], r["source_scan_ordinal"]) for r in rows] == [("1", 'x, "y"', 1), (None, None, 2), ("3", "z", 3)]
    (tmp_path / "bad.csv").write_text("a,b\n1,2,3\n")
    with pytest.raises(Exception):  # noqa: B017
        landing.read_text_csv(spark, tmp_path / "bad.csv", ["a", "b"]).collect()
    many = landing.with_scan_ordinal(spark.range(0, 1000, 1, 7)).collect()
    assert sorted(r["source_scan_ordinal"] for r in many) == list(range(1, 1001))
    publish.write_csv(spark.range(3), tmp_path / "out")
    assert landing.read_inferred_csv(spark, tmp_path / "out").count() == 3
    (tmp_path / "many").mkdir()
    for i in range(5):
        (tmp_path / "many" / f"{i}.csv").write_text("a\n" + "".join(f"{i * 1000 + j}\n" for j in range(100 * (5 - i))))
    whole = landing.with_scan_ordinal(landing.read_text_csv(spark, tmp_path / "many", ["a"])).orderBy("source_scan_ordinal").collect()
    assert [r["source_scan_ordinal"] for r in whole] == list(range(1, 1501)) and [int(r["a"]) for r in whole] == sorted(int(r["a"]) for r in whole)
    loose = landing.read_text_csv(spark, tmp_path / "bad.csv", ["a", "b"], strict=False).collect()
    assert len(loose) == 1
    (tmp_path / "d.json").write_bytes(b"\xef\xbb\xbf" + json.dumps({"k": 1}).encode())
    assert landing.read_document(tmp_path / "d.json") == {"k": 1}


def test_metrics():
    assert [recommend.reciprocal_rank(3, p) for p in ([3], [1, 3], [1, 2, 4, 5, 3], [1])] == [1, 0.5, 0.2, 0]
    assert recommend.mean_average_precision([1, 2], [[1], [3, 2]]) == 0.75
    for actual, predicted, k in (([], [], 5), ([1], [[1]], 0), ([1], [], 5)):
        with pytest.raises(ValueError):
            recommend.mean_average_precision(actual, predicted, k)


def test_ranks_and_deciles(spark):
    rows = [("hot", i) for i in range(200)] + [(None, 5), (None, 3), ("b", 9)]
    df = spark.createDataFrame(rows, "k string, o long")
    found = block_rank(df, ["k"], "o", "r", "n", width=16).collect()
    assert sorted((r["o"], r["r"]) for r in found if r["k"] == "hot") == [(i, i + 1) for i in range(200)]
    assert sorted((r["o"], r["r"], r["n"]) for r in found if r["k"] is None) == [(3, 1, 2), (5, 2, 2)]
    for size in (0, 1, 9, 10, 23, 57):
        df = spark.createDataFrame([(i, float(i % 4)) for i in range(size)], "srch_destination_id int, v double")
        deciled, median = legacy.deciles(df, "v", "t")
        ours = deciled.select("srch_destination_id", "t").collect()
        assert median.first()["median"] == df.selectExpr("percentile(v, 0.5) as m").first()["m"]
        theirs = df.selectExpr("srch_destination_id", "ntile(10) over (order by v nulls last, srch_destination_id) as t").collect()
        assert sorted(map(tuple, ours)) == sorted(map(tuple, theirs))


def test_results_do_not_depend_on_partitions(spark, data):
    from trailmart.plans.mart_queries import QUERIES

    names = ("bm4_interaction_outcome_monthly", "am5_booking_population_drift_summary", "bm15_travel_patterns")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    first = {n: sorted(map(str, QUERIES[n](spark, data).collect())) for n in names}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert first == {n: sorted(map(str, QUERIES[n](spark, data).collect())) for n in names}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_facts_of_an_empty_table(spark, data):
    from trailmart.plans import facts

    fact = facts.interactions(table(spark, data, "train").where("false"))
    assert build.build_catalog(fact, table(spark, data, "processed_destinations").where("false"), {"a": table(spark, data, "train").where("false").withColumn("period_month", F.current_date()), "b": table(spark, data, "train").where("false").withColumn("period_month", F.current_date())})[
        "dm_segment_monthly"
    ].count() == 0
