"""Approximate nearest neighbours by randomly rotated one-bit codes.

Indexing. Rows belong to the nearest of some centres (k-means over a bounded
sample: SAMPLE_ROWS rows, SAMPLE_BYTES of vectors). What is left of a vector
without its list's centre is scaled to length one and turned by a random
rotation (seeded). Its code is the sign of each turned component, packed in
64-bit words; its correction scalars are that length and the inner product of
the unit vector with its code. Lists are dealt over slices of bounded size, so
a list with a third of all rows is many tasks' work. Every row is indexed.

Searching. A query meets its lists nearest first, a few at first and eight
times as many in each round; a list is read unless the triangle inequality
puts all its rows beyond the k-th distance known by then. In a slice the
turned query is cut to LEVELS bits a component, and its inner product with
each code is a weighted sum of popcounts of packed words. Divided by the
scalar it estimates the inner product of query and vector without bias; its
error is bounded with overwhelming probability by epsilon * sqrt((1 - s^2) /
s^2) / sqrt(d - 1) times the lengths, s the scalar, and the cut of the query
adds its own exact bound. A vector is reranked by its exact distance in double
precision only if the lower bound of its distance is no more than the k-th
smallest upper bound, or than the k-th distance known. Queries are joined to
slices by a shuffle; neither they nor the rows pass the driver, which holds
the centres and one directory row for each list (MOST_LISTS of them).

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components take no part, nor do rows with a null id; the dimension
is the one most rows have (ties: the smaller) and other rows take no part.
Equal distances rank by id; a query never finds its own id. Repeated ids are
rows of their own for candidates, and of a repeated query id the first vector
by value is asked.
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

#: Standard errors in the bound; 5 lets about one in a million estimates out.
EPSILON = 5.0
#: Bits of a query's component.
LEVELS = 6
#: Bounds of the centres' sample, and of the lists.
SAMPLE_ROWS, SAMPLE_BYTES = 32_768, 32 << 20
LEAST_LISTS, MOST_LISTS = 4, 1024
#: Lists of a query's first round, and how many times more in each next one.
FIRST, GROWTH = 1, 8


def rotation(dim: int, seed: int = 23) -> np.ndarray:
    """A random orthogonal matrix (QR of a Gaussian one, signs fixed)."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector as array<double>) of the rows that take part."""
    v = F.col("v")
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
        & F.exists("v", lambda x: x != 0))
    return rows


def main_dimension(rows: DataFrame) -> tuple[int, int] | None:
    """(dimension, rows) of the dimension that most rows have."""
    top = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return (top[0].d, top[0].n) if top else None


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _length(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(1))


def _closest(m: np.ndarray, centres: np.ndarray, at_once: int = 2048) -> np.ndarray:
    own = (centres * centres).sum(1)
    return np.concatenate([(own - 2 * (m[k:k + at_once] @ centres.T)).argmin(1) for k in range(0, len(m), at_once)]
                          or [np.zeros(0, np.int64)])


def find_centres(rows: DataFrame, dim: int, count: int, rounds: int = 8, seed: int = 23) -> np.ndarray:
    """Centres of at most ``count`` clusters of the sample, the first rows by hash."""
    most = max(count, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    sample = rows.orderBy(F.xxhash64("vec_id", "v")).limit(most).select("v").toArrow()
    sample = np.unique(_matrix(sample.column("v"), dim), axis=0)
    centres = sample[np.random.default_rng(seed).permutation(len(sample))[:count]]
    for _ in range(rounds):
        near = _closest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


# --- codes ------------------------------------------------------------------

def pack_words(bits: np.ndarray) -> np.ndarray:
    """Booleans by row as 64-bit words; what the last word lacks is zero."""
    lacking = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, lacking))), axis=1).view(np.uint64)


def encode(rows: DataFrame, dim: int, centres: np.ndarray, turn: np.ndarray) -> DataFrame:
    """(vec_id, v, list, code, length, scalar) of every row."""
    def run(batches):
        for batch in batches:
            m = _matrix(batch.column("v"), dim)
            near = _closest(m, centres)
            m -= centres[near]
            length = _length(m)
            turned = (m @ turn) / np.maximum(length, 1e-300)[:, None]
            scalar = np.abs(turned).sum(1) / math.sqrt(dim)
            code = [c.tobytes() for c in pack_words(turned >= 0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(near.astype(np.int32)), pa.array(code, pa.binary()),
                 pa.array(length), pa.array(scalar)], ["vec_id", "v", "list", "code", "length", "scalar"])
    return rows.select("vec_id", "v").mapInArrow(
        run, "vec_id long, v array<double>, list int, code binary, length double, scalar double")


def inner_products(turned: np.ndarray, code: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(queries by codes) inner products of turned queries with codes of
    components +-1 / sqrt(d), from popcounts, and a bound of each query's
    error, since a query's components are cut to LEVELS bits."""
    dim = turned.shape[1]
    low = turned.min(1)
    step = (turned.max(1) - low) / ((1 << LEVELS) - 1)
    step[step == 0] = 1.0
    level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64)
    cut = low[:, None] + step[:, None] * level
    counts = np.zeros((len(turned), len(code)), np.int32)
    for bit in range(LEVELS):
        plane = pack_words((level >> bit) & 1 == 1)
        for word in range(code.shape[1]):
            counts += np.bitwise_count(plane[:, word, None] & code[None, :, word]).astype(np.int32) << bit
    product = 2 * (low[:, None] * ones + step[:, None] * counts) - cut.sum(1)[:, None]
    return product / math.sqrt(dim), np.abs(turned - cut).sum(1) / math.sqrt(dim)


# --- the index --------------------------------------------------------------

class Slice:
    """The indexed rows of a slice; all are of one list."""

    def __init__(self, table: pa.Table, dim: int):
        self.ids = table.column("vec_id").to_numpy()
        self.v = _matrix(table.column("v"), dim)
        self.list = table.column("list")[0].as_py()
        self.code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint64).reshape(len(self.ids), -1)
        self.ones = np.bitwise_count(self.code).sum(1).astype(np.float64)
        self.length = table.column("length").to_numpy()
        self.scalar = np.maximum(table.column("scalar").to_numpy(), 1e-12)


class Directory:
    """Centres, and of each list the least and largest length and its slices."""

    def __init__(self, centres: np.ndarray, found: list, slice_rows: int):
        self.list = np.array([r.list for r in found], np.int64)
        self.centres = centres[self.list]
        self.low, self.high = (np.array([r[c] for r in found], float) for c in ("low", "high"))
        self.slices = np.array([-(-r.n // slice_rows) for r in found], np.int64)
        self.first = np.cumsum(self.slices) - self.slices

    def order(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query its lists, nearest first, and a lower bound of the
        distance to each one's rows, less than rounding could make it."""
        own, far = (asked * asked).sum(1)[:, None], (self.centres * self.centres).sum(1)[None, :]
        away = np.sqrt(np.maximum(0, own + far - 2 * (asked @ self.centres.T)))
        bound = np.maximum(away - self.high, self.low - away) - 1e-6 * (np.sqrt(own) + np.sqrt(far))
        order = np.argsort(away, axis=1, kind="stable")
        return order, np.take_along_axis(np.maximum(0, bound), order, 1)


def build_index(rows: DataFrame, dim: int, n: int, scratch: Scratch) -> tuple[DataFrame, Directory, np.ndarray]:
    """(the encoded rows with their slice, the directory, the rotation)."""
    spark = rows.sparkSession
    turn = rotation(dim)
    centres = find_centres(rows, dim, min(MOST_LISTS, max(LEAST_LISTS, math.ceil(math.sqrt(n) / 2))))
    coded = scratch.cut(encode(rows, dim, centres, turn))
    found = coded.groupBy("list").agg(F.count("*").alias("n"), F.min("length").alias("low"), F.max("length").alias("high"))
    directory = Directory(centres, found.orderBy("list").collect(), slices.rows_of_slice(dim))
    dealt = spark.createDataFrame(list(zip(*(x.tolist() for x in (directory.list, directory.first, directory.slices)),
                                           strict=True)), "list int, first long, slices long")
    # at most MOST_LISTS rows of three numbers
    index = coded.join(F.broadcast(dealt), "list").withColumn("slice", F.col("first") + F.floor(F.rand(41) * F.col("slices")))
    return scratch.cut(index.drop("first", "slices")), directory, turn


# --- the search -------------------------------------------------------------

def _chooser(directory: Directory, dim: int, start: int, stop: int):
    """Rows (slice, vec_id, v, worst) for the lists start..stop of each query
    that may hold a row within its k-th distance."""
    def run(batches):
        for batch in batches:
            order, bound = directory.order(_matrix(batch.column("v"), dim))
            worst = batch.column("worst").to_numpy(zero_copy_only=False)
            owner, place = np.nonzero(~(bound[:, start:stop] > worst[:, None]))
            chosen = order[:, start:stop][owner, place]
            times = directory.slices[chosen]
            owner = np.repeat(owner, times)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(directory.first[chosen], times) + within), batch.column("vec_id").take(take),
                 batch.column("v").take(take), pa.array(worst[owner])], ["slice", "vec_id", "v", "worst"])
    return run


def _reranker(centres: dict[int, np.ndarray], turn: np.ndarray, dim: int, k: int, epsilon: float):
    """(query_id, vec_id, score): a slice's k nearest of what the estimates
    leave, by exact distance."""
    def work(rows: Slice, batch: pa.RecordBatch):
        ids, asked = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), dim)
        worst = batch.column("worst").to_numpy(zero_copy_only=False) ** 2
        moved = asked - centres[rows.list]
        far = _length(moved)[:, None]
        product, error = inner_products(moved @ turn, rows.code, rows.ones)
        wide = epsilon * np.sqrt(np.maximum(0, 1 - rows.scalar ** 2)) / (rows.scalar * math.sqrt(max(1, dim - 1)))
        near = rows.length ** 2 + far ** 2 - 2 * rows.length * product / rows.scalar
        slack = 2 * rows.length * (wide * far + error[:, None] / rows.scalar) + 1e-12 * (rows.length ** 2 + far ** 2)
        low = np.maximum(near - slack, (far - rows.length) ** 2 * (1 - 1e-9) - 1e-12 * (rows.length ** 2 + far ** 2))
        high = np.where(rows.ids[None, :] == ids[:, None], np.inf, near + slack)
        if len(rows.ids) > k:
            worst = np.fmin(worst, np.partition(high, k - 1, axis=1)[:, k - 1])
        for q in range(len(ids)):
            pick = np.flatnonzero(~(low[q] > worst[q] * (1 + 1e-9)) & (rows.ids != ids[q]))
            gap = rows.v[pick] - asked[q]
            exact = np.sqrt((gap * gap).sum(1))
            best = slices.best_of(-exact, rows.ids[pick], k)
            if len(best):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), ids[q])), pa.array(rows.ids[pick][best]), pa.array(exact[best])],
                    ["query_id", "vec_id", "score"])
    return work


def nearest(rows: DataFrame, queries: DataFrame, k: int, scratch: Scratch, epsilon: float = EPSILON) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each query."""
    spark = rows.sparkSession
    found = "query_id long, vec_id long, score double"
    shape = main_dimension(rows)
    if shape is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = shape
    index, directory, turn = build_index(rows.where(F.size("v") == dim), dim, n, scratch)
    centres = dict(zip(directory.list.tolist(), directory.centres, strict=True))
    asked = scratch.cut(queries.where(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = scratch.cut(spark.createDataFrame([], found))
    start, width = 0, FIRST
    while start < len(directory.list):
        known = (best.groupBy(F.col("query_id").alias("vec_id"))
                 .agg(F.when(F.count("*") >= k, F.max("score")).alias("worst")))
        now = scratch.cut(asked.join(known, "vec_id", "left").withColumn("worst", F.coalesce("worst", F.lit(math.inf)))
                          .mapInArrow(_chooser(directory, dim, start, start + width),
                                      "slice long, vec_id long, v array<double>, worst double"))
        wanted = now.select("slice").distinct()
        some = wanted.count()
        if some:
            new = slices.meet(index.join(jobs.sized(wanted, some), "slice", "left_semi"), now, dim, parts, found,
                              _reranker(centres, turn, dim, k, epsilon), Slice)
            best = scratch.cut(new.unionByName(best).withColumn("place", F.row_number().over(order))
                               .where(F.col("place") <= k).drop("place"))
        start, width = start + width, width * GROWTH
    return best.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")


def op9_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest rows of every embedding whose id is divisible by 100."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "codes")
    try:
        rows = scratch.cut(usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding"))
        return jobs.finish(nearest(rows, rows.where("vec_id % 100 = 0"), 10, scratch), scratch)
    finally:
        scratch.close()


SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""
