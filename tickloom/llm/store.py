"""Tables that an operator writes on its way, and what its Python tasks need to find this package."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shared_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a session whose executors are this very process may do without one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "tickloom-llm")


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package also where it is not installed, and bound their batches.

    Rows here are whole texts: a batch of ten thousand, the default, can be larger than a worker's memory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([ROOT, *paths])


def own_ids(rows: DataFrame, column: str = "doc_id") -> bool:
    """Whether every row has an id of its own, by one pass over that column."""
    shared = rows.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return shared.where((F.col("rows") > 1) | F.col(column).isNull()).isEmpty()


def free_name(rows: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Workspace:
    """A fresh shared folder of one run. ``save`` writes a table there and reads it again.

    A saved table cuts the lineage: a lost executor repeats at most the step after it. The shuffle files behind it are
    of no more use then, and go at once.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str):
        ready(spark)
        self.spark = spark
        self.path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        before = self.spark.conf.get(self.CLEANUP, "false")
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(self.CLEANUP, before)
        return self.spark.read.schema(frame.schema).parquet(path)

    def numbered(self, rows: DataFrame, column: str) -> DataFrame:
        """The rows with a number each, stored, so that it stays the same."""
        return self.save(rows.withColumn(column, F.monotonically_increasing_id()), f"numbered_{column}")

    def drop(self, name: str) -> None:
        """Delete a table of this run that a later one has replaced."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
