"""Gates of staging, names and the contract's limits."""

import functools

import pytest
from pyspark.sql import functions as F

from trailmart.contract import Contract
from trailmart.operators import gates
from trailmart.plans import bi, build


def rows(parts):
    return {r["gate"]: r for r in functools.reduce(lambda a, b: a.unionByName(b), parts).collect()}


@pytest.fixture(scope="module")
def parts(spark, data):
    """The catalog and the staging of a folder, made once."""
    staged = build.staged_of(spark, data)
    return build.catalog_of(spark, data, staged), staged


def test_contract_limits_are_enforced(spark, data, parts):
    catalog, staged = parts
    found = {r["gate"]: r for r in build.checks(build.raw_of(spark, data), catalog, staged).collect()}
    assert {n for n in found if n.startswith(("staging:", "quarantine_rate:", "multimarket_rate", "names:"))} == {
        "staging:train_rows", "staging:train_multiset", "staging:destinations_rows", "staging:destinations_multiset",
        "quarantine_rate:train", "quarantine_rate:destinations", "multimarket_rate", "names:forbidden",
    }
    # 15 of 199 raw rows and 2 of 61 destinations are set apart, over the default limit of 0.001
    assert {n for n, r in found.items() if not r["passed"]} == {"quarantine_rate:train", "quarantine_rate:destinations"}
    assert abs(found["quarantine_rate:train"]["actual"] - 15 / 199) < 1e-12
    status = bi.acceptance_status(spark.createDataFrame(list(found.values())), "x").first()
    assert not status["accepted"] and status["failures"] == 2
    relaxed = rows(gates.threshold_gates(build.staging.population_counts(staged["train"], staged["destinations"]), catalog["dm_proxy_context_ambiguity"], Contract(maximum_quarantine_rate=0.1)))
    assert all(r["passed"] for r in relaxed.values())


def test_lost_rows_and_forbidden_names_fail(spark, data, parts):
    staged = parts[1]["train"]
    raw = build.staging.fingerprints(build.table(spark, data, "raw_train"), build.TRAIN)
    lost = rows(gates.staging_gates({"train": build.staging.multiset_reconciliation(raw, staged.accepted)}))
    assert not lost["staging:train_rows"]["passed"] and not lost["staging:train_multiset"]["passed"]
    named = rows(gates.name_gates({"dm_x": spark.range(1).select(F.col("id").alias("Revenue_rows"))}))
    assert not named["names:forbidden"]["passed"]


def test_build_refuses_what_the_contract_forbids(spark, data, tmp_path):
    with pytest.raises(gates.GateError, match="quarantine_rate:train"):
        build.build(spark, data, tmp_path, "strict")
    assert not (tmp_path / "strict").exists()
    assert build.build(spark, data, tmp_path, "relaxed", Contract(maximum_quarantine_rate=0.1)) == str(tmp_path / "relaxed")
    assert (tmp_path / "relaxed").is_dir()


def test_declared_objects_exist(parts):
    catalog = parts[0]
    assert set(catalog) == {o.name for o in build.OBJECTS}
    rules = {r["quality_rule"] for r in catalog["dm_data_quality_summary"].collect()}
    assert {"quarantined_train_rows", "trip_date_quality:plausible", "date_spine_calendar_days"} <= rules
    without = gates.catalog_gates({n: df for n, df in catalog.items() if n != "quarantine_train"})[0]
    assert [r["gate"] for r in without.where("not passed").collect()] == ["exists:quarantine_train"]
