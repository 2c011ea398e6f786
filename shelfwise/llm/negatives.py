"""Hard-negative mining by slot-decomposed selection.

1. Positives: the first few other rows of an anchor's label, by inner product.
   Rows are dealt into slices by label (a label with many rows over many
   slices), so an anchor meets the slices of its own label only.
2. A positive of score s opens the window ceil(low * s) .. floor(high * s) of
   negative scores. The upper limits of an anchor's windows, in falling order,
   cut the scores into disjoint slots: slot j holds scores up to limit j and
   above limit j + 1. Every anchor meets all slices; a task keeps the first
   ``take`` rows of each slot, and a grouped top ``take`` joins the tasks.
3. The windows overlap, the slots do not: a window's candidates are the rows
   of its own slot and of all lower ones. Slots merged from the lowest up, the
   first ``take`` kept, answer all windows of an anchor; what lies under a
   window's lower limit goes last, since it is the end of that list.

So no pair of rows leaves a task but for the few kept in each slot.

Defined results: rows with a null id, label or vector, an empty vector, or
null or non-finite components take no part; the dimension is the one most rows
have (ties: the smaller) and other rows take no part. Zero vectors take part.
Scores are whole and fall, ties by id. Rows of the anchor's own id are neither
positives nor negatives; repeated ids are rows of their own otherwise, and of a
repeated anchor id the first (label, vector) by value is asked. Windows of
negative positives are empty. Whole components beyond 2^62 are cut to it,
scores beyond 64 bits to the nearest long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm import jobs, slices
from shelfwise.operators.lineage import Scratch


def dealt(rows: DataFrame, n: int, dim: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """(rows with their slice, (label, first, spread) of every label, slices).

    A label's rows go evenly to ``spread`` slices in a row from ``first`` on."""
    size = slices.rows_of_slice(dim)
    total = -(-n // size)
    labels = scratch.cut(rows.groupBy("label").agg(F.count("*").alias("n")).select(
        "label", F.pmod(F.xxhash64("label"), F.lit(total)).alias("first"), F.ceil(F.col("n") / size).alias("spread")))
    placed = rows.join(jobs.sized(labels, labels.count()), "label").select(
        F.pmod(F.col("first") + F.floor(F.rand(41) * F.col("spread")), F.lit(total)).alias("slice"), "vec_id", "label", "v")
    return scratch.cut(placed), labels, total


def _labels(rows: slices.Rows, asked: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Labels of a slice's rows and of queries as numbers of this slice."""
    if not hasattr(rows, "label"):
        names = rows.table.column("label").combine_chunks().dictionary_encode()
        rows.names = {name: i for i, name in enumerate(names.dictionary.to_pylist())}
        rows.label = names.indices.to_numpy()
    return rows.label, np.array([rows.names.get(x, -1) for x in asked.column("label").to_pylist()], np.int64)


def _positives(most: int, dim: int):
    def work(rows: slices.Rows, asked: pa.RecordBatch):
        scores = rows.scores(slices.matrix(asked.column("v"), dim))
        ids = asked.column("vec_id").to_numpy()
        label, own = _labels(rows, asked)
        found = []
        for q in range(len(ids)):
            place = np.flatnonzero((label == own[q]) & (rows.ids != ids[q]))
            found.append(place[slices.best_of(scores[q][place], rows.ids[place], most)])
        owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
        place = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids[owner]), pa.array(rows.ids[place]), pa.array(scores[owner, place])],
                                         ["anchor_id", "vec_id", "score"])
    return work


def _slotted(take: int, dim: int):
    def work(rows: slices.Rows, asked: pa.RecordBatch):
        scores = rows.scores(slices.matrix(asked.column("v"), dim))
        ids = asked.column("vec_id").to_numpy()
        label, own = _labels(rows, asked)
        limits, lowest = asked.column("limits").to_pylist(), asked.column("lowest").to_numpy()
        out = [[], [], [], []]
        for q in range(len(ids)):
            rising = np.array(limits[q][::-1], np.int64)
            place = np.flatnonzero((scores[q] <= rising[-1]) & (scores[q] >= lowest[q]) & (label != own[q]))
            mine = scores[q][place]
            # limits at or above a score: the slot is the last of them in falling order
            slot = len(rising) - 1 - np.searchsorted(rising, mine, "left")
            for j in range(len(rising)):
                inside = np.flatnonzero(slot == j)
                best = inside[slices.best_of(mine[inside], rows.ids[place[inside]], take)]
                out[0].append(np.full(len(best), ids[q]))
                out[1].append(np.full(len(best), j, np.int32))
                out[2].append(rows.ids[place[best]])
                out[3].append(mine[best])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["anchor_id", "slot", "vec_id", "score"])
    return work


def hard_negatives(rows: DataFrame, anchors: DataFrame, scratch: Scratch, positives: int = 5, take: int = 3,
                   low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score). rows and anchors have (vec_id, label, v) with whole
    components; low and high are percentages of the positive's score."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                      "positive_score long, negative_score long")
    shape = slices.main_shape(rows)
    if shape is None:
        return empty
    dim, n, peak = shape
    rows, anchors = (slices.narrow(df.select("vec_id", F.col("label").cast("string").alias("label"), "v"), dim, peak)
                     for df in (rows, anchors))
    placed, labels, total = dealt(rows, n, dim, scratch)
    asked = scratch.cut(anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("of")).select(
        "vec_id", "of.label", "of.v"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    # the slices of an anchor's own label
    near = asked.join(labels, "label").select("vec_id", "label", "v", F.explode(F.expr(
        "sequence(0L, spread - 1)")).alias("step"), "first").select(
        F.pmod(F.col("first") + F.col("step"), F.lit(total)).alias("slice"), "vec_id", "label", "v")
    met = slices.meet(placed, near, dim, parts, "anchor_id long, vec_id long, score long",
                      _positives(positives, dim))
    falling = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    first = met.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= positives)
    exact = F.col("score").cast("decimal(20,0)")
    windows = scratch.cut(first.select(
        "anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.ceil(exact * low / 100).cast("long").alias("low"), F.floor(exact * high / 100).cast("long").alias("limit"))
        .where("low <= limit"))

    limits = windows.groupBy("anchor_id").agg(
        F.reverse(F.array_sort(F.collect_set("limit"))).alias("limits"), F.min("low").alias("lowest"))
    far = (asked.join(limits.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
           .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(total - 1).cast("long")))))
    slotted = slices.meet(placed, far, dim, parts, "anchor_id long, slot int, vec_id long, score long",
                          _slotted(take, dim))
    inside = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    order = F.struct((-F.col("score")).alias("back"), "vec_id")
    tops = (slotted.withColumn("place", F.row_number().over(inside)).where(F.col("place") <= take)
            .groupBy("anchor_id", "slot").agg(F.array_sort(F.collect_list(order)).alias("top")))

    # slots from the lowest up, so that each has what lies in it and under it
    upward = Window.partitionBy("anchor_id").orderBy(F.desc("slot"))
    every = limits.select("anchor_id", F.posexplode("limits").alias("slot", "limit"))
    merged = every.join(tops, ["anchor_id", "slot"], "left").select(
        "anchor_id", "limit", F.slice(F.array_sort(F.flatten(F.collect_list(
            F.coalesce("top", F.array().cast("array<struct<back:bigint,vec_id:bigint>>"))).over(upward))), 1, take).alias("top"))
    return (windows.join(merged, ["anchor_id", "limit"])
            .select("anchor_id", "positive_id", "positive_score", "low", F.posexplode("top").alias("place", "of"))
            .where(-F.col("of.back") >= F.col("low"))
            .select("anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("of.vec_id").alias("negative_id"),
                    "positive_score", (-F.col("of.back")).alias("negative_score")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every embedding whose id is divisible by 50, over
    floor(256 * x); labels of ids divisible by 7 are moved on by one first."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "negatives")
    try:
        table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
        label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        rows = scratch.cut(slices.quantised(table, "vec_id", "embedding", 256, label=label).where("label is not null"))
        return jobs.finish(hard_negatives(rows, rows.where("vec_id % 50 = 0"), scratch), scratch)
    finally:
        scratch.close()


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS place
  FROM s WHERE same),
m AS (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  WHERE place <= 5 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 3"""
