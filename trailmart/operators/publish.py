"""Immutable builds: written beside, checked, renamed into place, and pointed to atomically.

Data is written and digested by Spark, and folders and pointers are moved through Hadoop's file system, so
that a build may lie on any file system the cluster shares.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import json
import math
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from trailmart.schema import ObjectSpec
from trailmart.sources.files import Files


def plain(value: object) -> object:
    """A value JSON can hold: dates as ISO, paths and decimals as text, NaN and infinities as null, huge integers as text."""
    if isinstance(value, dict):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set)):
        return [plain(v) for v in value]
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, (Path, decimal.Decimal)):
        return str(value)
    if isinstance(value, float) and not math.isfinite(value):
        return None
    if isinstance(value, int) and not isinstance(value, bool) and abs(value) > 2**63 - 1:
        return str(value)
    return value


def to_json(data: object) -> str:
    return json.dumps(plain(data), indent=2, ensure_ascii=False, allow_nan=False)


def to_markdown(title: str, sections: dict[str, list[dict]]) -> str:
    """A report: a heading and a table per section."""
    out = [f"# {title}"]
    for name, rows in sections.items():
        out.append(f"\n## {name}\n")
        if not rows:
            out.append("none")
            continue
        heads = list(rows[0])
        cell = lambda v: str(plain(v)).replace("|", "\\|")
        out += [f"| {' | '.join(heads)} |", f"|{'---|' * len(heads)}", *(f"| {' | '.join(cell(r[h]) for h in heads)} |" for r in rows)]
    return "\n".join(out) + "\n"


def write_parquet(df: DataFrame, path: str | Path, partitions: tuple[str, ...] = (), block_mb: int = 128) -> None:
    """Zstandard Parquet. A partitioned table is rebalanced by its partition columns first: a task writes few
    partitions and a partition few files, and adaptive execution splits one that is too large for a task."""
    writer = (df.hint("rebalance", *partitions) if partitions else df).write.option("compression", "zstd").option("parquet.block.size", block_mb << 20)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(str(path))


def replace_parquet(df: DataFrame, files: Files, name: str) -> DataFrame:
    """Write a table beside and move it into place; the one before stays until then. Returns it as read again."""
    part = f".{name}.part"
    files.delete(part)
    write_parquet(df, files.at(part))
    files.delete(name)
    files.rename(part, name)
    return files.spark.read.schema(df.schema).parquet(files.at(name))


def write_csv(df: DataFrame, path: str | Path, order: tuple[str, ...] = ()) -> None:
    """CSV with header, for delivery: one sorted run over all part files, in the order of their names, if ``order`` is given."""
    (df.orderBy(*order) if order else df).write.option("header", True).csv(str(path))


def session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active session")
    return spark


class Build:
    """A build directory: ``with Build(root, id) as b: b.write(df, spec)``; published on a clean exit.

    An existing build id is refused, a failed build leaves no trace, and ``latest.json`` moves last. ``about`` goes
    into the manifest (contract and source digests).
    """

    def __init__(self, root: str | Path, build_id: str, about: dict | None = None) -> None:
        self.files, self.build_id, self.about = Files(session(), root), build_id, about or {}
        self.work, self.final = f".{build_id}.part", self.files.at(build_id)
        self.objects: list[dict] = []

    def __enter__(self) -> Build:
        if self.files.exists(self.build_id):
            raise FileExistsError(f"build {self.build_id} exists")
        self.files.delete(self.work)
        self.files.make(self.work)
        return self

    def write(self, df: DataFrame, spec: ObjectSpec) -> DataFrame:
        """Write one object and return it as read again, with its lineage cut."""
        path = self.files.at(f"{self.work}/{spec.layer}/{spec.name}")
        write_parquet(df, path, spec.partitions)
        back = df.sparkSession.read.schema(df.schema).parquet(path)
        self.objects.append({"name": spec.name, "layer": spec.layer, "grain": spec.grain, "rows": back.count(), "columns": df.columns})
        return back

    def __exit__(self, kind: object, *_: object) -> None:
        if kind is not None:
            self.files.delete(self.work)
            return
        inside = Files(self.files.spark, self.files.at(self.work))
        inside.write_text("manifest.json", to_json({"build_id": self.build_id, **self.about, "objects": self.objects, "files": inside.digests()}))
        self.files.rename(self.work, self.build_id)
        self.files.write_text("latest.json", to_json({"build_id": self.build_id, "path": self.build_id}))


def manifest(build: str | Path) -> dict:
    return json.loads(Files(session(), build).read_text("manifest.json"))


def latest(root: str | Path) -> dict:
    """The manifest of the build that ``latest.json`` points to."""
    pointer = json.loads(Files(session(), root).read_text("latest.json"))
    return manifest(f"{root}/{pointer['path']}")


def attached(build: str | Path) -> dict[str, DataFrame]:
    """The objects of a published build by name, to be read only."""
    files = Files(session(), build)
    return {o["name"]: files.spark.read.parquet(files.at(f"{o['layer']}/{o['name']}")) for o in manifest(build)["objects"]}


def changed_files(build: str | Path) -> list[str]:
    """Files of a build that are missing or no longer have the digest of its manifest."""
    files, listed = Files(session(), build), manifest(build)["files"]
    try:
        found = files.digests()
    except Exception:  # the file system itself refuses a damaged file: look which
        found = {name: digest for name in listed if (digest := _digest(files, name))}
    return [name for name, digest in listed.items() if found.get(name) != digest]


def _digest(files: Files, name: str) -> str | None:
    try:
        return hashlib.sha256(files.read_bytes(name)).hexdigest()
    except Exception:
        return None


def inspect(root: str | Path) -> dict:
    """What the latest build holds, and whether its files are those it was published with."""
    info = latest(root)
    damaged = changed_files(f"{root}/{info['build_id']}")
    return {"build_id": info["build_id"], "objects": {o["name"]: o["rows"] for o in info["objects"]}, "files": len(info["files"]), "damaged": damaged, "valid": not damaged}


def package(build: str | Path, target: str | Path) -> Path:
    """A ZIP of a build with its checksums; refuses damaged builds and existing targets. A ZIP is one file, made by one process."""
    target = Path(target)
    if target.exists():
        raise FileExistsError(target)
    if damaged := changed_files(build):
        raise ValueError(f"damaged files: {damaged[:5]}")
    files, sums = Files(session(), build), []
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for name in files.names():
            data = files.read_bytes(name)
            archive.writestr(name, data)
            sums.append(f"{hashlib.sha256(data).hexdigest()}  {name}\n")
        archive.writestr("SHA256SUMS", "".join(sums))
    return target


def package_faults(target: str | Path) -> list[str]:
    """Entries of a package that are missing, unlisted or not what its checksums say."""
    with zipfile.ZipFile(target) as archive:
        names = set(archive.namelist()) - {"SHA256SUMS"}
        listed = {n: d for d, n in (line.split("  ", 1) for line in archive.read("SHA256SUMS").decode().splitlines())}
        return sorted(n for n in names | set(listed) if n not in names or n not in listed or hashlib.sha256(archive.read(n)).hexdigest() != listed[n])


def acceptance(first: str | Path, second: str | Path, comparison: dict[str, dict], minimum_rows: dict[str, int], manual: dict[str, bool] | None = None, clean_tree: bool | None = None) -> list[dict]:
    """The checks by which two builds of one input are accepted: whole, of one contract and source, equal, large enough, reviewed.

    ``clean_tree`` says whether the code was committed; None leaves that check out. Without ``manual`` its one check fails.
    """
    manifests = [manifest(b) for b in (first, second)]
    rows = {o["name"]: o["rows"] for o in manifests[0]["objects"]}
    checks = [("files_intact", not changed_files(first) and not changed_files(second)), ("distinct_builds", manifests[0]["build_id"] != manifests[1]["build_id"])]
    checks += [(f"same_{k}", manifests[0].get(k) == manifests[1].get(k)) for k in ("contract", "sources")]
    checks += [("clean_tree", clean_tree)] if clean_tree is not None else []
    checks += [(f"exact:{name}", bool(result["exact"])) for name, result in comparison.items()]
    checks += [(f"rows:{name}", rows.get(name, 0) >= least) for name, least in minimum_rows.items()]
    checks += [(f"manual:{k}", bool(v)) for k, v in manual.items()] if manual is not None else [("manual:file", False)]
    return [{"gate": g, "passed": p} for g, p in checks]


def proven(build: str | Path, verdict: list[dict], required: list[str]) -> list[str]:
    """What stands against analysing a build: unmet checks of its acceptance, objects it lacks, damaged files."""
    there = {o["name"] for o in manifest(build)["objects"]}
    faults = [f"not accepted: {c['gate']}" for c in verdict if not c["passed"]] + ["no verdict"] * (not verdict)
    return faults + [f"missing: {n}" for n in required if n not in there] + [f"damaged: {n}" for n in changed_files(build)]
