"""From raw files to accepted builds, dashboards, delivery and submission, by the command line."""

import csv
import json

import pytest

from trailmart import cli
from trailmart.operators import publish
from trailmart.plans import dashboards
from trailmart.schema import BI_OBJECTS, DESTINATIONS, OBJECTS, TEST, TEST_OBJECTS, TRAIN

BASE = {
    "date_time": "2014-01-02 10:00:00", "site_name": "2", "posa_continent": "3", "user_location_country": "66", "user_location_region": "174", "user_location_city": "24103",
    "orig_destination_distance": "100.5", "user_id": "10", "is_mobile": "0", "is_package": "0", "channel": "9", "srch_ci": "2014-01-10", "srch_co": "2014-01-12", "srch_adults_cnt": "2",
    "srch_children_cnt": "0", "srch_rm_cnt": "1", "srch_destination_id": "1000", "srch_destination_type_id": "1", "is_booking": "0", "cnt": "1", "hotel_continent": "2", "hotel_country": "50",
    "hotel_market": "500", "hotel_cluster": "12",
}


def write(path, columns, rows):
    with path.open("w", newline="", encoding="utf-8") as file:
        out = csv.writer(file)
        out.writerow([c.name for c in columns])
        out.writerows([[r[c.name] for c in columns] for r in rows])


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    train = [
        BASE,
        BASE | {"hotel_cluster": "13", "hotel_market": "501"},
        BASE | {"date_time": "2014-01-02 11:00:00", "is_booking": "1"},
        BASE | {"date_time": "2014-02-03 09:00:00", "user_id": "11", "srch_children_cnt": "1", "is_mobile": "1", "is_package": "1", "is_booking": "1", "srch_ci": "2014-02-10", "srch_co": "2014-02-12"},
        BASE | {"date_time": "2014-02-04 09:00:00", "srch_ci": "2558-03-15", "srch_co": ""},
        BASE | {"date_time": "2014-08-04 09:00:00", "is_booking": "1"},
        BASE | {"date_time": "not-a-date"},
    ]
    write(folder / "train.csv", TRAIN, train)
    write(folder / "test.csv", TEST, [BASE | {"id": str(i), "date_time": f"2015-0{i + 1}-02 10:00:00"} for i in (0, 1, 1)])
    write(folder / "destinations.csv", DESTINATIONS, [{"srch_destination_id": str(k), **{c.name: "-2.5" for c in DESTINATIONS[1:]}} for k in (1000, 2000)])
    (folder / "contract.json").write_text(json.dumps({"maximum_quarantine_rate": 0.5, "maximum_multimarket_rate": 1.0, "minimum_rows": {"fct_hotel_interactions": 6}}))
    return folder


@pytest.fixture(scope="module")
def builds(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    for name in ("one", "two"):
        assert cli.main(["build", str(raw), str(out), name, "--contract", str(raw / "contract.json")], spark) == 0
    return out


def said(capsys):
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_a_build_has_every_object(spark, builds):
    found = {o["name"]: o["rows"] for o in publish.latest(builds)["objects"]}
    assert set(found) == {o.name for o in (*OBJECTS, *TEST_OBJECTS)}
    assert found["fct_hotel_interactions"] == 6 and found["quarantine_train"] == 1
    assert found["stg_test_accepted"] == 2 and found["quarantine_test"] == 1  # a repeated id is set apart
    made = publish.attached(builds / "two")
    assert made["quarantine_train"].first()["reject_reasons"] == "date_time:parse_error"
    assert {r["dataset"] for r in made["dm_booking_population_drift"].select("dataset").distinct().collect()} == {"train_booking", "test_booking"}


def test_two_builds_are_equal_and_accepted(spark, raw, builds, tmp_path, capsys):
    one, two = str(builds / "one"), str(builds / "two")
    assert cli.main(["compare", one, two], spark) == 0 and said(capsys)["exact"]
    review = tmp_path / "manual.json"
    review.write_bytes(b"\xef\xbb\xbf" + json.dumps({"read": True}).encode())
    cli.main(["accept", one, two, "--contract", str(raw / "contract.json"), "--manual", str(review)], spark)
    assert set(said(capsys)["failed"]) <= {"clean_tree"}
    assert cli.main(["accept", one, one], spark) == 1
    assert {"distinct_builds", "manual:file"} <= set(said(capsys)["failed"])
    assert cli.main(["validate", str(builds)], spark) == 0 and said(capsys)["build_id"] == "two"
    verdict = json.loads((builds / "one" / "acceptance.json").read_text())["checks"]
    assert "missing: none_such" in publish.proven(builds / "one", verdict, ["dim_date", "none_such"])


def test_dashboards_delivery_and_package(spark, raw, builds, tmp_path, capsys):
    assert cli.main(["bi", str(builds / "two"), str(tmp_path / "bi"), "--contract", str(raw / "contract.json")], spark) == 0
    assert set(said(capsys)["objects"]) == {o.name for o in BI_OBJECTS}
    made = publish.attached(tmp_path / "bi")
    catalog = publish.attached(builds / "two")
    assert dashboards.source_truth(catalog["fct_hotel_interactions"], made).where("not agrees").count() == 0
    broken = made | {"bi_overview_monthly": made["bi_overview_monthly"].selectExpr("*", "1 as revenue").withColumn("booking_interaction_share", made["bi_overview_monthly"]["booking_interaction_share"] + 2)}
    failed = {r["gate"] for r in dashboards.audit(broken).unionByName(dashboards.validation(broken, catalog, anchors={"bi_routes.booking_rows": 99})).where("not passed").collect()}
    assert {"audit:names", "audit:share:bi_overview_monthly", "bi:bounds:bi_overview_monthly", "bi:anchor:bi_routes.booking_rows"} <= failed
    without = {n: df for n, df in made.items() if n != "bi_proxy_ambiguity"}
    assert [r["gate"] for r in dashboards.validation(without, catalog).where("not passed").collect() if r["gate"].startswith("bi:exists")] == ["bi:exists:bi_proxy_ambiguity"]
    assert cli.main(["deliver", str(tmp_path / "bi"), str(tmp_path / "csv")], spark) == 0
    assert said(capsys)["rows"]["bi_routes"] == 0  # none has strong support
    assert cli.main(["package", str(tmp_path / "bi"), str(tmp_path / "bi.zip")], spark) == 0 and said(capsys)["faults"] == []
    assert cli.main(["package", str(tmp_path / "bi"), str(tmp_path / "bi.zip")], spark) == 1


def test_recommender_profile_and_context_marts(spark, raw, tmp_path, capsys):
    out = str(tmp_path / "prepared")
    assert cli.main(["prepare", str(raw), out], spark) == 0
    assert said(capsys)["rows"] == {"train": 6, "test": 3, "destinations": 2}
    assert cli.main(["evaluate", out], spark) == 0 and said(capsys)["validation_rows"] == 1
    assert cli.main(["submit", out, str(tmp_path / "sub")], spark) == 0
    rows = spark.read.option("header", True).csv(str(tmp_path / "sub")).collect()
    assert [(r["id"], r["hotel_cluster"]) for r in rows] == [("0", "12 13"), ("1", "12 13")]
    assert cli.main(["profile", f"{out}/train.parquet", str(tmp_path / "report")], spark) == 0
    assert "## nulls" in (tmp_path / "report" / "profile.md").read_text() and json.loads((tmp_path / "report" / "profile.json").read_text())["counters"][0]["total_rows"] == 6
    assert cli.main(["legacy", out, str(tmp_path / "legacy"), "a"], spark) == 0
    registry = {r["object_name"]: r["row_count"] for r in spark.read.parquet(str(tmp_path / "legacy" / "a" / "legacy" / "object_registry")).collect()}
    assert registry["fct_weighted_interactions"] == 6 and len(registry) == 16
