"""Intermediate tables that outlive executors.

Mining reads some results several times and must cut its lineage between levels. Such a result is
written once as Parquet below the cluster's shared checkpoint folder and read back, so a lost
executor costs a re-read, and Catalyst sees the real size when it chooses between broadcast and
shuffle joins.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode a fresh one where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster has several machines' folders
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="basketry-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


class Workspace:
    """A folder of written tables, one per run. As a context manager it is dropped at the end."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.path = f"{checkpoint_root(spark)}/basketry-{uuid.uuid4().hex}"
        self._tables = 0

    def folder(self, name: str) -> str:
        """A path below the workspace that no other table uses."""
        self._tables += 1
        return f"{self.path}/{self._tables:03d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` now and return it as read back from the written table."""
        path = self.folder(name)
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_measured(
        self, df: DataFrame, name: str, **measures: Column
    ) -> tuple[DataFrame, dict[str, object]]:
        """``save``, and aggregates of the rows taken while they are written, without a second job."""
        seen = Observation()
        saved = self.save(df.observe(seen, *[m.alias(key) for key, m in measures.items()]), name)
        return saved, seen.get

    def drop(self) -> None:
        """Delete the workspace. Frames returned by ``save`` are unusable afterwards."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()
