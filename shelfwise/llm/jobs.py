"""Shared plumbing of the operators: session settings, results, components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.graph import components  # noqa: F401
from shelfwise.operators.lineage import Scratch
from shelfwise.session import ensure_checkpoint_dir

#: Rows and bytes of an Arrow batch: the bytes bound a Python worker's memory.
BATCH_ROWS, BATCH_BYTES = 20_000, "4m"
#: Rows of ids up to which a side may be broadcast (some 20 MB).
BROADCAST_ROWS = 500_000


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder named by the session, and small Arrow batches."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def finish(df: DataFrame, scratch: Scratch) -> DataFrame:
    """Checkpoint a result (ids and numbers, no texts) and delete the scratch
    tables it came from. The copy is in the session's checkpoint folder and
    Spark's cleaner removes it once unreferenced."""
    out = df.checkpoint()
    scratch.close()
    return out


def sized(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a table whose counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
