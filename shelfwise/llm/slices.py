"""A stated query set meets all rows of a table, slice by slice.

Rows are dealt into slices of a bounded number of rows and bytes; a query is
sent to each slice it has to see. One shuffle brings a slice's rows and then
its queries to a task, which holds one slice at a time and streams the queries
past it. So neither the rows of a hot key nor the queries are ever held whole,
nothing of them passes the driver, and a lost task is run again by itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and bytes of vectors of a slice, and queries scored against it at a time.
SLICE_ROWS, SLICE_BYTES, QUERIES = 16_384, 4 << 20, 128
#: Whole components beyond this are cut to it.
MOST = 1 << 62


def quantised(table: DataFrame, key: str, vector: str, factor: int, **others) -> DataFrame:
    """(vec_id, v, others) of the rows that take part: v is floor(factor * x)
    of each component, x as double. A null id or vector, an empty vector and
    any null or non-finite component leave a row out."""
    v = F.col("v")
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"),
                        *[c.alias(name) for name, c in others.items()])
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))))
    whole = F.transform("v", lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(x * F.lit(float(factor))))))
    return rows.withColumn("v", whole)


def main_shape(rows: DataFrame) -> tuple[int, int, int] | None:
    """(dimension, rows, largest magnitude) of the dimension that most rows
    have (ties: the smaller), or None without rows."""
    peak = F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))
    top = (rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), peak.alias("peak"))
           .orderBy(F.desc("n"), "d").limit(1).collect())
    return (top[0].d, top[0].n, top[0].peak) if top else None


def narrow(rows: DataFrame, dim: int, peak: int) -> DataFrame:
    """Rows of this dimension, as 32-bit integers where they all fit."""
    rows = rows.where(F.size("v") == dim)
    return rows.withColumn("v", F.col("v").cast("array<int>")) if peak < 1 << 31 else rows


def rows_of_slice(dim: int) -> int:
    return max(256, min(SLICE_ROWS, SLICE_BYTES // (8 * dim)))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


class Rows:
    """The rows of a slice: ids, whole vectors, and other columns by name."""

    def __init__(self, table: pa.Table, dim: int):
        self.ids = table.column("vec_id").to_numpy()
        self.whole = matrix(table.column("v"), dim)
        self.peak = int(np.abs(self.whole).max(initial=0))
        self.turned = np.ascontiguousarray(self.whole.T.astype(np.float64))
        self.table = table

    def scores(self, asked: np.ndarray) -> np.ndarray:
        """Exact inner products, queries by rows; beyond 64 bits the nearest
        long. Doubles are exact while all partial sums are below 2 ** 53."""
        if self.peak * int(np.abs(asked).max(initial=0)) * asked.shape[1] < 1 << 53:
            return (asked.astype(np.float64) @ self.turned).astype(np.int64)
        exact = asked.astype(object) @ self.whole.T.astype(object)
        return np.clip(exact, -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, in this order."""
    place = np.arange(len(scores))
    if len(scores) > k:
        place = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    return place[np.lexsort((ids[place], -scores[place]))[:k]]


def meet(rows: DataFrame, asked: DataFrame, dim: int, parts: int, schema: str,
         work: Callable[[Rows, pa.RecordBatch], Iterator[pa.RecordBatch]], hold: type = Rows) -> DataFrame:
    """work(rows of a slice, some queries of that slice) for each slice; the
    rows as ``hold`` keeps them.

    rows (slice, vec_id, v, ...) and asked (slice, vec_id, v, ...): columns of
    one that the other lacks are null there."""
    both = (rows.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
            .repartition(parts, "slice").sortWithinPartitions("slice", "kind"))

    def run(batches):
        at, gathered, held = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            slices, kinds = batch.column("slice").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.r_[True, (slices[1:] != slices[:-1]) | (kinds[1:] != kinds[:-1])])
            for low, high in zip(edges, np.r_[edges[1:], len(slices)], strict=True):
                if slices[low] != at:
                    at, gathered, held = slices[low], [], None
                part = batch.slice(low, high - low)
                if kinds[low] == 0:
                    gathered.append(part)
                elif gathered or held is not None:
                    if held is None:
                        held, gathered = hold(pa.Table.from_batches(gathered), dim), []
                    for k in range(0, part.num_rows, QUERIES):
                        yield from work(held, part.slice(k, QUERIES))
    return both.mapInArrow(run, schema)
