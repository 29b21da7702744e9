"""The command line: each command prints one JSON document and exits with 0, or with 1 if its answer is no."""

from __future__ import annotations

import argparse
import json
import subprocess
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

from trailmart.contract import DEFAULT, Contract
from trailmart.operators import gates, profile, publish
from trailmart.plans import build, dashboards, legacy, recommend
from trailmart.schema import BI_OBJECTS, DESTINATIONS, TEST, TRAIN
from trailmart.session import checkpointed, get_spark
from trailmart.sources import landing
from trailmart.sources.files import Files

Answer = tuple[dict, bool]


def _contract(args: argparse.Namespace) -> Contract:
    return Contract.load(args.contract) if args.contract else DEFAULT


def _build(spark: SparkSession, args: argparse.Namespace) -> Answer:
    make = build.build if args.tables else build.build_from_raw
    return {"build": make(spark, args.source, args.out, args.id, _contract(args))}, True


def _validate(spark: SparkSession, args: argparse.Namespace) -> Answer:
    answer = publish.inspect(args.out)
    return answer, answer["valid"]


def _inspect(spark: SparkSession, args: argparse.Namespace) -> Answer:
    return publish.inspect(args.out), True


def _compare(spark: SparkSession, args: argparse.Namespace) -> Answer:
    found = build.compare(args.first, args.second)
    exact = all(r["exact"] for r in found.values())
    return {"exact": exact, "objects": found}, exact


def clean_tree(folder: Path) -> bool:
    """Whether the code in ``folder`` is committed; no repository counts as not clean."""
    said = subprocess.run(["git", "-C", str(folder), "status", "--porcelain"], capture_output=True, text=True)
    return said.returncode == 0 and not said.stdout.strip()


def _accept(spark: SparkSession, args: argparse.Namespace) -> Answer:
    manual = landing.read_document(args.manual) if args.manual else None
    checks = publish.acceptance(args.first, args.second, build.compare(args.first, args.second), _contract(args).minimum_rows, manual, clean_tree(Path(__file__).parent))
    accepted = all(c["passed"] for c in checks)
    Files(spark, args.first).write_text("acceptance.json", publish.to_json({"accepted": accepted, "checks": checks}))
    return {"accepted": accepted, "failed": [c["gate"] for c in checks if not c["passed"]]}, accepted


def _bi(spark: SparkSession, args: argparse.Namespace) -> Answer:
    verdict = json.loads(Files(spark, args.build).read_text("acceptance.json"))["checks"] if Files(spark, args.build).exists("acceptance.json") else []
    checks = spark.createDataFrame([(c["gate"], float(c["passed"]), 1.0, c["passed"]) for c in verdict], "gate string, actual double, expected double, passed boolean")
    info = dashboards.build_bi(args.build, args.out, checks, _contract(args))
    return {"objects": {o["name"]: o["rows"] for o in info["objects"]}}, len(info["objects"]) == len(BI_OBJECTS)


def _deliver(spark: SparkSession, args: argparse.Namespace) -> Answer:
    return {"rows": dashboards.deliver(args.build, args.out)}, True


def _package(spark: SparkSession, args: argparse.Namespace) -> Answer:
    faults = publish.package_faults(publish.package(args.build, args.out))
    return {"package": str(args.out), "faults": faults}, not faults


def _prepare(spark: SparkSession, args: argparse.Namespace) -> Answer:
    """Raw files to typed tables for the recommender."""
    rows = {}
    for name, columns in (("train", TRAIN), ("test", TEST), ("destinations", DESTINATIONS)):
        raw = landing.with_scan_ordinal(landing.read_text_csv(spark, landing.find_raw(spark, args.source, name), [c.name for c in columns]))
        publish.write_parquet(recommend.prepared(raw, columns, distance_key=name != "destinations"), f"{args.out}/{name}.parquet")
        rows[name] = spark.read.parquet(f"{args.out}/{name}.parquet").count()
    return {"rows": rows}, True


def _evaluate(spark: SparkSession, args: argparse.Namespace) -> Answer:
    events = spark.read.parquet(f"{args.source}/train.parquet")
    asked = recommend.validation_queries(events)
    offered = checkpointed(recommend.candidates(asked, recommend.history(events)))
    return recommend.metrics(asked, offered, recommend.final_candidates(offered)).first().asDict(), True


def _submit(spark: SparkSession, args: argparse.Namespace) -> Answer:
    events, test = (spark.read.parquet(f"{args.source}/{n}.parquet") for n in ("train", "test"))
    asked = recommend.test_queries(test)
    final = recommend.final_candidates(recommend.candidates(asked, recommend.history(events, None)))
    publish.write_csv(recommend.submission(asked, final), args.out, ("id",))
    return {"rows": spark.read.option("header", True).csv(args.out).count()}, True


def _profile(spark: SparkSession, args: argparse.Namespace) -> Answer:
    from trailmart.plans.report_queries import CATEGORIES, COLUMNS

    sections = profile.report(spark.read.parquet(args.source), COLUMNS, CATEGORIES)
    files = Files(spark, args.out)
    files.make("")
    files.write_text("profile.json", publish.to_json(sections))
    files.write_text("profile.md", publish.to_markdown("Source profile", sections))
    return {"sections": {k: len(v) for k, v in sections.items()}}, True


def _legacy(spark: SparkSession, args: argparse.Namespace) -> Answer:
    events, places = (spark.read.parquet(f"{args.source}/{n}.parquet") for n in ("train", "destinations"))
    return {"build": legacy.build_legacy(spark, events, places, args.out, args.id)}, True


COMMANDS: dict[str, tuple[Callable[[SparkSession, argparse.Namespace], Answer], tuple[str, ...], str]] = {
    "build": (_build, ("source", "out", "id"), "build and publish from raw files (or, with --tables, from a folder of tables)"),
    "validate": (_validate, ("out",), "whether the latest build still has the files it was published with"),
    "inspect": (_inspect, ("out",), "what the latest build holds"),
    "compare": (_compare, ("first", "second"), "compare two builds object by object"),
    "accept": (_accept, ("first", "second"), "judge two builds of one input"),
    "bi": (_bi, ("build", "out"), "make the dashboard tables of a build"),
    "deliver": (_deliver, ("build", "out"), "write dashboard tables as CSV"),
    "package": (_package, ("build", "out"), "pack a build and check the package"),
    "profile": (_profile, ("source", "out"), "profile a source table as JSON and Markdown"),
    "prepare": (_prepare, ("source", "out"), "raw files to typed tables for the recommender"),
    "evaluate": (_evaluate, ("source",), "metrics of the recommender on the bookings from the cutoff on"),
    "submit": (_submit, ("source", "out"), "clusters for every row of the test set, as CSV"),
    "legacy": (_legacy, ("source", "out", "id"), "build the context-centred marts"),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="trailmart", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    for name, (_, positions, text) in COMMANDS.items():
        sub = commands.add_parser(name, help=text)
        for position in positions:
            sub.add_argument(position)
        sub.add_argument("--contract", help="a contract as JSON")
        sub.add_argument("--manual", help="answers of a manual review as JSON")
        sub.add_argument("--tables", action="store_true", help="the source is a folder of Parquet tables")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        answer, good = COMMANDS[args.command][0](spark or get_spark(), args)
    except (gates.GateError, FileExistsError, FileNotFoundError, ValueError) as refused:
        answer, good = {"error": str(refused)}, False
    print(json.dumps(publish.plain(answer), ensure_ascii=False, allow_nan=False))
    return 0 if good else 1
