"""Session factory and the two helpers every plan needs: reading a table, cutting lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "trailmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI on, UTC and AQE. ``master`` and ``conf`` override the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder; columns and filters are pruned by the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of this application's checkpoints, which all executors share.

    It is the one the cluster names in ``spark.checkpoint.dir``; only where that is unset (tests on one
    machine) a temporary folder is used instead, and removed at exit.
    """
    context = spark.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="trailmart-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in that folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
