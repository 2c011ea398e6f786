"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised at the quantiles of all rows into 2^bits cells.
Strings are ranked whole: their values are counted, put in order over range
partitions, and a value's cell follows from the share of rows below it. The
cells' index on the Hilbert curve orders the rows; runs of that order, cut so
that row counts differ by at most one, are the shards. Neighbours on the curve
are near in every dimension, so a shard's ranges of each are narrow and files
can be pruned by any of them.

Rows are sorted by range partitions of (index, tie-breakers), so a cell that
holds a third of all rows spreads over many tasks; ranks are a partition's
offset plus the place in it. Only boundaries (2^bits - 1 numbers for each
dimension) and one count for each partition reach the driver.

Defined results: a null in a dimension is a value of its own, below all
others. Null texts have no bytes. Rows equal in all columns read are
interchangeable and get neighbouring slots. An empty table has no shards.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm import jobs
from shelfwise.operators.lineage import Scratch

BITS = 5
SHARDS = 40


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points (rows, dimensions): from the top
    bit down, each level's orthant is rotated and reflected into place, then
    the Gray-coded bits are interleaved."""
    x = [c.astype(np.int64) for c in cells.T]
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            inverts = (x[i] & q) != 0
            swap = np.where(inverts, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inverts, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    fold = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        fold ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << 1 | ((x[i] ^ fold) >> level & 1)
    return out


def string_cells(df: DataFrame, name: str, bits: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """((value, cell) of the strings of a column, how many): the cell is the
    share of rows below the middle of the value's own, nulls below all."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
    ordered = scratch.cut(counts.repartitionByRange(parts, F.col("value").asc_nulls_first())
                          .sortWithinPartitions(F.col("value").asc_nulls_first())
                          .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    sums = {r.part: (r.n, r.values) for r in ordered.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("values")).collect()}
    total = sum(n for n, _ in sums.values())
    starts = list(zip(sorted(sums), accumulate([0, *[sums[p][0] for p in sorted(sums)]]), strict=False))
    offsets = F.broadcast(spark.createDataFrame(starts, "part long, begins long"))
    before = F.col("begins") + F.sum("n").over(Window.partitionBy("part").orderBy("at")) - F.col("n") / 2
    cell = F.least(F.lit((1 << bits) - 1), F.floor(before / max(1, total) * (1 << bits)))
    cells = ordered.join(offsets, "part").select("value", F.when(F.col("value").isNull(), 0).otherwise(cell).cast("int").alias("cell"))
    return scratch.cut(cells), sum(values for _, values in sums.values())


def quantised(df: DataFrame, dims: list[str], bits: int, scratch: Scratch) -> DataFrame:
    """df plus cell_<k> for each dimension: for numbers how many of the
    2^bits - 1 quantile boundaries of all rows lie at or below the value
    (null: 0), for strings as in string_cells."""
    parts = 1 << bits
    shares = [k / parts for k in range(1, parts)]
    kinds = dict(df.dtypes)
    numbers = {k: F.col(c).cast("double") for k, c in enumerate(dims) if kinds[c] not in ("string", "binary")}
    cut = df.agg(F.count("*"), *[F.percentile_approx(c, shares, 10_000).alias(f"q{k}") for k, c in numbers.items()]).first()
    out = df
    for k, name in enumerate(dims):
        if k in numbers:
            # repeated boundaries count, so a frequent value takes its share of the cells
            bounds = sorted(cut[f"q{k}"] or [])
            edge = F.array(*[F.lit(float(b)) for b in bounds]) if bounds else F.array().cast("array<double>")
            # a null counts below every boundary
            out = out.withColumn(f"cell_{k}", F.when(numbers[k].isNull(), 0).otherwise(_below(edge, numbers[k])))
        else:
            cells, n = string_cells(df, name, bits, scratch)
            cells = jobs.sized(cells.withColumnsRenamed({"value": f"value_{k}", "cell": f"cell_{k}"}), n)
            out = out.join(cells, F.col(name).eqNullSafe(F.col(f"value_{k}"))).drop(f"value_{k}")
    return out


def _below(edges: Column, value: Column) -> Column:
    return F.size(F.filter(edges, lambda b: b <= value))


def curve(bits: int, dims: int):
    @F.arrow_udf("long")
    def index(*cells: pa.Array) -> pa.Array:
        return pa.array(hilbert_index(np.stack([c.to_numpy(zero_copy_only=False) for c in cells], 1), bits))

    return index(*[F.col(f"cell_{k}") for k in range(dims)])


def hilbert_shards(df: DataFrame, dims: list[str], ties: list[str], shards: int, scratch: Scratch,
                   bits: int = BITS) -> DataFrame:
    """df plus hilbert, shard (0 to shards - 1) and slot (place in the shard,
    from 0). ``ties`` order the rows of one cell."""
    spark = df.sparkSession
    base = quantised(df, dims, bits, scratch).withColumn("hilbert", curve(bits, len(dims))).drop(
        *[f"cell_{k}" for k in range(len(dims))])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["hilbert", *ties]
    ordered = scratch.cut(base.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                          .withColumn("at", F.monotonically_increasing_id()))
    # the id is the partition times 2^33 plus the place in it
    counts = {r.part: r.n for r in ordered.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    starts = dict(zip(sorted(counts), accumulate([0, *[counts[p] for p in sorted(counts)]]), strict=False))
    if not total:
        return df.select("*", F.lit(0).cast("long").alias("hilbert"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    offsets = F.broadcast(spark.createDataFrame(sorted(starts.items()), "part long, begins long"))
    size, extra = divmod(total, shards)      # the first `extra` shards hold one more
    rank = F.col("begins") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = ordered.withColumn("part", F.shiftright("at", 33)).join(offsets, "part").withColumn("rank", rank)
    edge = extra * (size + 1)
    shard = F.when(F.col("rank") < edge, F.floor(F.col("rank") / (size + 1))).otherwise(
        extra + F.floor((F.col("rank") - edge) / max(size, 1))).cast("int")
    first = F.col("shard") * size + F.least(F.col("shard"), F.lit(extra))
    return (ranked.withColumn("shard", shard).withColumn("slot", (F.col("rank") - first).cast("long"))
            .drop("part", "begins", "at", "rank"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Files under path/shard=<k>, rows in slot order: tasks hold ranges of
    (shard, slot), so a shard larger than a task becomes several files."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards by the Hilbert order of language,
    source, size and id; law `rows`."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "hilbert")
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        body = F.coalesce(F.col("text").cast("string"), F.lit(""))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source",
                           (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
        found = hilbert_shards(rows, ["lang", "source", "size", "doc_id"], ["doc_id", "text_crc32", "size"], SHARDS, scratch)
        return jobs.finish(found.select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), "hilbert"), scratch)
    finally:
        scratch.close()
