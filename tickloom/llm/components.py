"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.llm.store import Workspace


def components(links: DataFrame, space: Workspace, name: str) -> DataFrame:
    """(doc_id, component) for every document of ``links`` (x, y); component is the smallest doc_id reachable.

    Each round every document takes the smallest label among its own, its neighbours' and its label's label, so
    labels travel along links and jump along labels at once. Rounds end when no label changes; each is saved, so its
    plan does not grow. The driver sees one number per round.
    """
    edges = space.save(
        links.select(F.col("x").alias("doc_id"), F.col("y").alias("other"))
        .unionByName(links.select(F.col("y").alias("doc_id"), F.col("x").alias("other"))).distinct(), f"{name}_edges")
    labels = space.save(
        edges.groupBy("doc_id").agg(F.min("other").alias("other"))
        .select("doc_id", F.least("doc_id", "other").alias("component")), f"{name}_0")
    step = 0
    while True:
        step += 1
        passed = edges.join(labels.withColumnRenamed("doc_id", "other"), "other").select("doc_id", "component")
        jumped = (
            labels.alias("a").join(labels.alias("b"), F.col("a.component") == F.col("b.doc_id"))
            .select(F.col("a.doc_id").alias("doc_id"), F.col("b.component").alias("component"))
        )
        least = passed.unionByName(jumped).groupBy("doc_id").agg(F.min("component").alias("least"))
        new = space.save(
            labels.join(least, "doc_id", "left")
            .select("doc_id", F.least("component", "least").alias("component"),
                    (F.coalesce("least", "component") < F.col("component")).alias("changed")), f"{name}_{step}")
        if new.where("changed").isEmpty():
            return new.select("doc_id", "component")
        labels = new.select("doc_id", "component")
