"""Tables in the folder that all executors share, and connected components over links."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it isn't installed but lies at the same path."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{paths}:{root}".strip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; where it is unset and the master is local, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm/{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str = "part", compression: str | None = None) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends here and lost executors lose nothing."""
    path = f"{folder(frame.sparkSession)}-{name}"
    frame.write.parquet(path, compression=compression)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of all nodes of the links (a, b): the smallest node reachable is the component.

    Each round every node takes the least label around it, then its label's label; the rounds needed grow with
    the logarithm of the longest path. Links of one hub are summed up on both sides of the shuffle.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a <> b").distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component")), "labels")
    for _ in range(rounds):
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("component").alias("near"))
        taken = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("taken"))
        jump = labels.select(F.col("node").alias("taken"), F.col("component").alias("beyond"))
        step = taken.join(jump, "taken", "left").select(
            "node", F.least("taken", F.coalesce("beyond", "taken")).alias("component"), F.col("component").alias("was")
        )
        step = written(step, "labels")
        labels = step.select("node", "component")
        if step.where("component <> was").isEmpty():
            return labels
    raise RuntimeError("the components did not settle")
