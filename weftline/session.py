"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import os
import shutil

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package and give local runs a checkpoint folder.

    On a cluster the folder is the one named by spark.checkpoint.dir; without it only
    a local master gets a folder of its own.
    """
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *parts])
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set from spark.checkpoint.dir, or a default in local mode that
    is removed at the end. On a cluster spark.cleaner.referenceTracking.cleanCheckpoints lets
    Spark remove checkpoints that are no longer used."""
    sc = spark.sparkContext
    now = sc._jsc.sc().getCheckpointDir()
    if now.isDefined():
        return now.get()
    folder = sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file:///tmp/weftline-checkpoints"
        sc.setCheckpointDir(folder)
        atexit.register(shutil.rmtree, sc._jsc.sc().getCheckpointDir().get().removeprefix("file:"), True)
        return sc._jsc.sc().getCheckpointDir().get()
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of df with a reliable checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
