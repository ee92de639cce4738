"""Cutting lineage so that a lost executor costs a re-read, never the job."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the one that the cluster names in ``spark.checkpoint.dir``, which all executors share.

    That setting always wins, over a folder set on the context before too.  Where neither is there, a temporary folder
    is made, and removed at the end, but only on a local master: on a cluster a folder of one machine would be lost
    with it, so that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getConf().get(SETTING, None)
    current = context.getCheckpointDir()
    if named:
        # Spark makes a folder of its own inside the named one.
        path = named.split(":", 1)[-1].replace("//", "/").rstrip("/")
        if current is None or path not in current:
            context.setCheckpointDir(named)
    elif current is None:
        if not context.master.split("[", 1)[0] == "local":
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="tidelane-checkpoint-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        context.setCheckpointDir(own)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there (runs a job).

    What is written goes with the table that it belongs to where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
