"""What a checkpoint holds: the operators with state, and the windows that are still open."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Operators of a query with state: their place in the plan, name, partitions and range of batches."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "numPartitions", "minBatchId", "maxBatchId")


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator: int = 0) -> DataFrame:
    """Group keys of an aggregate that a restart would go on with, as of the last committed batch or an earlier one.

    Keys that are windows come as window_start and window_end. The state is read where it is, partition by partition.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    keys = reader.load(checkpoint).select("key.*")
    columns = []
    for field in keys.schema:
        if field.dataType.typeName() == "struct" and {"start", "end"} == set(field.dataType.names):
            columns += [F.col(f"`{field.name}`.start").alias("window_start"), F.col(f"`{field.name}`.end").alias("window_end")]
        else:
            columns.append(F.col(f"`{field.name}`"))
    return keys.select(*columns)
