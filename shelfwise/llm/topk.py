"""Exact top-k search by inner product over a pivot-distance index.

Indexing. Pivots are the centres of a few rounds of k-means over a bounded
sample (SAMPLE_ROWS rows, SAMPLE_BYTES of vectors). Every row is keyed by its
nearest pivot and its distance to it. A pivot's rows, in order of distance,
are cut into rings at quantiles of the distances; the directory holds of each
ring the least and largest distance, the largest squared norm and the row
count. There are at most MOST_PIVOTS * MOST_RINGS rings whatever the size of
the table, so the directory is small; a ring with many rows is dealt over
slices of bounded size.

Searching. For a query q at distance d from a pivot, the triangle inequality
bounds the distance of q to every row of a ring with distances low..high from
below by g = max(0, d - high, low - d). So no row there has an inner product
above (|q|^2 + N - g^2) / 2, N the ring's largest squared norm. A query's
annuli are taken in falling order of this bound, a few at first and eight
times as many in each round; it stops when the next bound is below its k-th
score. The bounds are widened by more than the rounding of doubles, and scores
are whole numbers, so the result is exact.

Defined results: rows with a null id, a null or empty vector, or null or
non-finite components take no part; zero vectors do. The dimension is the one
most rows have (ties: the smaller); other rows take no part. Equal scores rank
by id. A query never finds rows of its own id; repeated ids are rows of their
own as candidates, and of a repeated query id the first vector by value is
asked. Whole components beyond 2^62 are cut to it, scores beyond 64 bits to
the nearest long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm import jobs, slices
from shelfwise.operators.lineage import Scratch

#: Bounds of the pivots' sample.
SAMPLE_ROWS, SAMPLE_BYTES = 8192, 16 << 20
#: Rows that a ring should have while the bounds on pivots and rings allow it.
RING_ROWS = 1024
LEAST_PIVOTS, MOST_PIVOTS, LEAST_RINGS, MOST_RINGS = 8, 256, 4, 128
#: Annuli of a query's first round, and how many times more in each next one.
FIRST, GROWTH = 1, 8


def find_pivots(rows: DataFrame, dim: int, count: int, rounds: int = 8, seed: int = 31) -> np.ndarray:
    """Centres of at most ``count`` clusters of a sample of the rows."""
    most = max(count, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    sample = slices.matrix(rows.orderBy(F.rand(seed)).limit(most).select("v").toArrow().column("v"), dim).astype(float)
    sample = np.unique(sample, axis=0)
    centres = sample[np.random.default_rng(seed).permutation(len(sample))[:count]]
    for _ in range(rounds):
        near = _squares(sample, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def _squares(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return (m * m).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (m @ pivots.T)


def keyed(rows: DataFrame, dim: int, pivots: np.ndarray) -> DataFrame:
    """rows with their pivot, their distance to it (``away``) and their
    squared norm."""
    def run(batches):
        for batch in batches:
            m = slices.matrix(batch.column("v"), dim).astype(float)
            near = _squares(m, pivots).argmin(1)
            gap = m - pivots[near]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(near.astype(np.int32)),
                 pa.array(np.sqrt((gap * gap).sum(1))), pa.array((m * m).sum(1))],
                ["vec_id", "v", "pivot", "away", "square"])
    kind = rows.schema["v"].dataType.simpleString()
    return rows.select("vec_id", "v").mapInArrow(run, f"vec_id long, v {kind}, pivot int, away double, square double")


class Directory:
    """What a search knows of the rings, as arrays by ring."""

    def __init__(self, pivots: np.ndarray, found: list, slice_rows: int):
        self.pivots = pivots
        self.ring = np.array([r.ring for r in found], np.int64)
        self.pivot = np.array([r.pivot for r in found], np.int64)
        self.low, self.high = (np.array([r[c] for r in found], float) for c in ("low", "high"))
        self.square = np.array([r.square for r in found], float)
        self.slices = np.array([-(-r.n // slice_rows) for r in found], np.int64)
        self.first = np.cumsum(self.slices) - self.slices

    def order(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query its rings in falling order of the bound, and these
        bounds of the inner product."""
        own = (asked * asked).sum(1)[:, None]
        away = np.sqrt(np.maximum(0, _squares(asked, self.pivots)))[:, self.pivot]
        gap = np.maximum(0, np.maximum(away - self.high, self.low - away))
        reach = own + self.square[None, :]
        bound = (reach - gap * gap) / 2 + 1e-7 * (1 + reach + away * away)
        order = np.argsort(-bound, axis=1, kind="stable")
        return order, np.take_along_axis(bound, order, 1)


def build_index(rows: DataFrame, dim: int, n: int, scratch: Scratch) -> tuple[DataFrame, Directory]:
    """(the rows with their slice, the directory)."""
    spark = rows.sparkSession
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(2 * math.sqrt(n / RING_ROWS))))
    pivots = find_pivots(rows, dim, wanted)
    rings = min(MOST_RINGS, max(LEAST_RINGS, math.ceil(n / (RING_ROWS * len(pivots)))))
    key = scratch.cut(keyed(rows, dim, pivots))
    # at most MOST_PIVOTS rows of MOST_RINGS numbers
    cuts = key.groupBy("pivot").agg(F.percentile_approx("away", [i / rings for i in range(1, rings)], 1000).alias("cuts"))
    ringed = key.join(F.broadcast(cuts), "pivot").withColumn(
        "ring", F.col("pivot") * rings + F.size(F.filter("cuts", lambda c: c < F.col("away"))))
    found = ringed.groupBy("ring", "pivot").agg(
        F.count("*").alias("n"), F.min("away").alias("low"), F.max("away").alias("high"), F.max("square").alias("square"))
    directory = Directory(pivots, found.orderBy("ring").collect(), slices.rows_of_slice(dim))
    dealt = spark.createDataFrame(list(zip(*(x.tolist() for x in (directory.ring, directory.first, directory.slices)),
                                           strict=True)), "ring int, first long, slices long")
    index = ringed.join(F.broadcast(dealt), "ring").select(
        (F.col("first") + F.floor(F.rand(37) * F.col("slices"))).alias("slice"), "vec_id", "v")
    return scratch.cut(index), directory


def _chooser(directory: Directory, dim: int, k: int, start: int, stop: int):
    """Rows (slice, vec_id, v, least) for the annuli start..stop of each
    query whose bound still reaches its k-th score."""
    def run(batches):
        for batch in batches:
            whole = slices.matrix(batch.column("v"), dim)
            order, bound = directory.order(whole.astype(float))
            known = batch.column("scores").to_pylist()
            least = np.array([s[k - 1] if s is not None and len(s) == k else -slices.MOST * 2 for s in known], np.int64)
            go = bound[:, start:stop] >= least.astype(float)[:, None]
            owner, place = np.nonzero(go)
            ring = order[:, start:stop][owner, place]
            times = directory.slices[ring]
            owner = np.repeat(owner, times)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(directory.first[ring], times) + within), batch.column("vec_id").take(take),
                 batch.column("v").take(take), pa.array(least[owner])], ["slice", "vec_id", "v", "least"])
    return run


def _best(k: int, dim: int):
    def work(rows: slices.Rows, asked: pa.RecordBatch):
        scores = rows.scores(slices.matrix(asked.column("v"), dim))
        ids, least = asked.column("vec_id").to_numpy(), asked.column("least").to_numpy()
        found = []
        for q, own in enumerate(scores):
            place = np.flatnonzero((own >= least[q]) & (rows.ids != ids[q]))
            found.append(place[slices.best_of(own[place], rows.ids[place], k)])
        owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
        place = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids[owner]), pa.array(rows.ids[place]), pa.array(scores[owner, place])],
                                         ["query_id", "vec_id", "score"])
    return work


def top_k(rows: DataFrame, queries: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of the highest inner
    product with each query. Both have (vec_id, v) with whole components."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shape = slices.main_shape(rows)
    if shape is None:
        return empty
    dim, n, peak = shape
    rows, queries = (slices.narrow(df.select("vec_id", "v"), dim, peak) for df in (rows, queries))
    index, directory = build_index(rows, dim, n, scratch)
    asked = scratch.cut(queries.groupBy("vec_id").agg(F.min("v").alias("v")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = asked.schema["v"].dataType.simpleString()
    falling = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = scratch.cut(empty.select("query_id", "vec_id", "score"))
    start, width = 0, FIRST
    while start < len(directory.ring):
        known = best.groupBy("query_id").agg(F.reverse(F.array_sort(F.collect_list("score"))).alias("scores"))
        now = scratch.cut(asked.join(known.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").mapInArrow(
            _chooser(directory, dim, k, start, start + width), f"slice long, vec_id long, v {kind}, least long"))
        wanted = now.select("slice").distinct()
        some = wanted.count()
        if not some:
            break
        new = slices.meet(index.join(jobs.sized(wanted, some), "slice", "left_semi"), now, dim, parts,
                          "query_id long, vec_id long, score long", _best(k, dim))
        best = scratch.cut(new.unionByName(best).withColumn("place", F.row_number().over(falling)).where(
            F.col("place") <= k).drop("place"))
        start, width = start + width, width * GROWTH
    return best.select("query_id", F.row_number().over(falling).alias("rank"), "vec_id", "score")


def op13_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 rows of the highest inner product with every embedding whose id
    is divisible by 100, over floor(1024 * x)."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "pivots")
    try:
        table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
        rows = scratch.cut(slices.quantised(table, "vec_id", "embedding", 1024))
        return jobs.finish(top_k(rows, rows.where("vec_id % 100 = 0"), 10, scratch), scratch)
    finally:
        scratch.close()


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
