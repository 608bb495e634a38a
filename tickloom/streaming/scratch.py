"""Where runs that leave files put them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a local session may fall back to a temporary folder of this machine, since its
    executors run here.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.gettempdir() + "/tickloom"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run. The caller's reads outlive the run, so it is kept."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
