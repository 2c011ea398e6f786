"""Lineage cutting for iterative jobs.

Iterative estimators rebuild small tables many times; without a cut the
logical plan grows with every step. Each step's table is written as
parquet into a fresh folder under the shared folder named by
``spark.checkpoint.dir`` and read back: the read-back plan is a plain file
scan with no memory of how it was computed. (A ``checkpoint()``ed
Dataset keeps a link to its origin plan; over dozens of dependent steps
planning time doubled per step in Spark 4.1 -- measured, step 30 took 40 s.)
Files on shared storage survive executor loss. Never a local checkpoint
(dies with its executor) and never a machine-local folder on a cluster.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from shelfwise.session import ensure_checkpoint_dir, hadoop_path


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of a write in this block go when it is done: a written
    table is read, not its plan, so nothing asks for them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Scratch:
    """Folder of intermediate tables for one job; ``close()`` deletes the
    tables it wrote except those marked ``keep``."""

    def __init__(self, spark: SparkSession, tag: str = "job"):
        self.spark = spark
        base = ensure_checkpoint_dir(spark).rstrip("/")
        self.root = f"{base}/shelfwise-{tag}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._keep: set[str] = set()

    def cut(self, df: DataFrame, keep: bool = False) -> DataFrame:
        """Materialise df and return a lineage-free DataFrame over it."""
        self._n += 1
        name = f"t{self._n:04d}"
        path = f"{self.root}/{name}"
        with shuffles_freed(self.spark):
            df.write.mode("overwrite").parquet(path)
        if keep:
            self._keep.add(name)
        # Explicit schema: no footer read on the way back.
        return self.spark.read.schema(df.schema).parquet(path)

    def cut_cached(self, df: DataFrame) -> DataFrame:
        """For a large input scanned many times: compute once into the cache,
        checkpoint from that copy, and cache the lineage-free result."""
        out = self.cut(df).persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        return out

    def folder(self, name: str) -> str:
        """A folder of this job for what Spark itself writes there (streams)."""
        place, fs = hadoop_path(self.spark, f"{self.root}/{name}")
        fs.mkdirs(place)
        return f"{self.root}/{name}"

    def close(self) -> None:
        root, fs = hadoop_path(self.spark, self.root)
        if not self._keep:
            fs.delete(root, True)
            return
        for st in fs.listStatus(root) if fs.exists(root) else []:
            p = st.getPath()
            if p.getName() not in self._keep:
                fs.delete(p, True)

