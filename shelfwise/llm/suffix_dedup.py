"""Suffix-array deduplication over sparse suffixes.

1. Of every window of 25 starts of 8-word grams the smallest hash is retained
   (minimisers): positions chosen by content alone, so a run of 50 words found
   in two texts retains the same positions in both, the first of them with at
   least 26 words of the run to its right.
2. Suffixes whose first 26 words no other document has at a retained position
   can have no neighbour of that length and are left out (a count by hash).
3. The others are sorted over all documents by the hash of those words and the
   words that follow, and compared with their neighbours: the longest extension
   to the right is always that to a neighbour. An extension of 24 words proves
   a run of 50.
4. Where such runs leave some of the 24 words before a suffix open, or its own
   are too few, all suffixes of its hash are sorted once more by the words that
   precede, read backwards, and extended to the left.
5. Runs of 50 words that extensions to both sides allow are compared by their
   hash, each at the suffix of its least gram among the first 25, since the
   neighbour on the left and that on the right may be different documents. The confirmed ones, merged, are a document's repeated passages:
   every word of them stands in a run of 50 words that another document has.

The sort keys end in (doc_id, at), so a passage that a third of all documents
share is cut over many tasks; a task meets those before and after it by their
nearest row of another document. Nothing is quadratic in the copies of a passage.

Defined results: words are runs of letters and digits, case folded. Null,
empty and shorter texts, and rows with a null doc_id, have no passages.
Repeats inside one document (or rows of one doc_id) alone are none; two texts
of one doc_id have passages of their own, equal rows only one. Passages whose
runs overlap or touch are one. first_doc_id is the smallest doc_id that holds
any of the passage's confirmed runs; removed tells that it is not this
document's own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm import jobs, text
from shelfwise.operators.lineage import Scratch

LEAST_WORDS = 50
GRAM = 8
WINDOW = 25
#: Words of a passage right of its first retained position, at least.
REACH = LEAST_WORDS - WINDOW + 1
#: Words compared beyond them on either side: they make a run of LEAST_WORDS.
FOLLOW = LEAST_WORDS - REACH


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over values[i:i + width] for every full window, by doubling."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def retained(w: text.Words) -> tuple[np.ndarray, ...]:
    """(document, word index in the batch, hash of the next REACH words, more,
    fewest, most) of the retained positions. In the runs of LEAST_WORDS that
    start fewest to most words before it, a position's gram is the first least
    one of the first WINDOW: so each run has one such position. Of positions within REACH words that agree in
    all words compared (a text that repeats a few words for long) the first is
    enough: what it shares holds for the last too, more words on."""
    n = len(w.hash)
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    if n < LEAST_WORDS:
        return nothing
    up, down = text._powers(n + 1)
    keyed = text.mix(w.hash)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(keyed * up[:n])])
    runs = lambda k: text.mix((sums[k:] - sums[:-k]) * down[:n - k + 1])
    grams = runs(GRAM)
    doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    stop = w.first[1:][doc]
    low = _sliding(grams, WINDOW, np.minimum)
    # a window counts if all its grams are in one document
    low = np.where(np.arange(len(low)) + WINDOW + GRAM - 1 <= stop[:len(low)], low, np.uint64(0))
    pad = np.zeros(WINDOW - 1, np.uint64)
    best = _sliding(np.concatenate([pad, low, pad]), WINDOW, np.maximum)
    at = np.flatnonzero(best[:len(grams)] == grams)
    at = at[at + REACH <= stop[at]]
    if not len(at):
        return nothing
    h = runs(REACH)[at]
    low, high = np.maximum(w.first[doc[at]], at - FOLLOW), np.minimum(stop[at], at + REACH + FOLLOW)
    seen = text.mix((sums[high] - sums[low]) * down[low] + ((at - low) << 8 | (high - at)).astype(np.uint64))
    order = np.lexsort((at, seen, doc[at]))
    d, s, a = doc[at][order], seen[order], at[order]
    fresh = np.r_[True, (d[1:] != d[:-1]) | (s[1:] != s[:-1])]
    step = (a - a[np.maximum.accumulate(np.where(fresh, np.arange(len(a)), 0))]) // REACH
    opens = np.flatnonzero(fresh | np.r_[True, step[1:] != step[:-1]])
    more = a[np.r_[opens[1:], len(a)] - 1] - a[opens]
    back = np.argsort(order[opens])
    keep = order[opens][back]
    doc, at, h = doc[at[keep]], at[keep], h[keep]
    own, reach = grams[at], {}
    for way in (-1, 1):
        alive, count = np.ones(len(at), bool), np.zeros(len(at), np.int64)
        for k in range(way, way * WINDOW, way):
            there = np.clip(at + k, 0, len(grams) - 1)
            inside = (at + k >= w.first[doc]) & (at + k + GRAM <= w.first[doc + 1])
            alive &= inside & ((grams[there] > own) if way < 0 else (grams[there] >= own))
            count += alive
        reach[way] = count
    return doc, at, h, more[back], WINDOW - 1 - reach[1], reach[-1]


def _suffixes(batches):
    for batch in text.portions(batches):
        w = text.words_of(batch.column("text"))
        doc, at, h, *counts = retained(w)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id").take(pa.array(doc)), batch.column("same").take(pa.array(doc)),
            pa.array((at - w.first[doc]).astype(np.int32)), pa.array(h.view(np.int64)),
            *[pa.array(c.astype(np.int32)) for c in counts]], ["doc_id", "same", "at", "h", "more", "fewest", "most"])


def _contexts(batches):
    """Words after the first REACH and words before, as 4 bytes each."""
    names = ["doc_id", "same", "at", "h", "more", "fewest", "most", "right", "left"]
    for batch in text.portions(batches):
        w = text.words_of(batch.column("text"))
        short = (w.hash >> np.uint64(32)).astype(">u4")
        rows = []
        for d, (doc_id, same, found) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "same", "found")), strict=True)):
            a, b = w.first[d], w.first[d + 1]
            for r in found:
                at = a + r["at"]
                rows.append((doc_id, same, r["at"], r["h"], r["more"], r["fewest"], r["most"],
                             short[at + REACH:min(b, at + REACH + FOLLOW)].tobytes(),
                             short[max(a, at - FOLLOW):at][::-1].tobytes()))
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 3, pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _common(a: bytes, b: bytes) -> int:
    """Equal leading words of two contexts."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // 4
    low, high = 0, n // 4
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:4 * mid] == b[:4 * mid] else (low, mid - 1)
    return low


def neighbours(rows: DataFrame, side: str, scratch: Scratch) -> DataFrame:
    """rows with their extent: sorted by (h, side), each with its longest
    common extension with a neighbour of another document."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["h", side, "doc_id", "at"]
    names = rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", extent int"
    ordered = scratch.cut(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                          .withColumn("place", F.monotonically_increasing_id()))
    # first and last row of each sorted partition, and the first and last of
    # another document than theirs
    mine, part = F.struct("h", side, "doc_id"), F.shiftright("place", 33).alias("part")
    ends = sorted(ordered.groupBy(part).agg(F.min_by(mine, "place").alias("head"), F.max_by(mine, "place").alias("tail")).collect())
    ids = F.broadcast(spark.createDataFrame([(r.part, r.head.doc_id, r.tail.doc_id) for r in ends], "part long, low long, high long"))
    others = {r.part: r for r in ordered.select("*", part).join(ids, "part").groupBy("part").agg(
        F.min_by(mine, F.when(F.col("doc_id") != F.col("low"), F.col("place"))).alias("head"),
        F.max_by(mine, F.when(F.col("doc_id") != F.col("high"), F.col("place"))).alias("tail")).collect()}

    def nearest(rows: list, end: str) -> list[tuple]:
        """For each partition in turn, the last row (``end``) met before it of
        another document than the one at its near end."""
        out, last, other = [], None, None
        far = {"tail": "head", "head": "tail"}[end]
        for r in rows:
            doc = r[far].doc_id
            out.append(tuple(last if last and last.doc_id != doc else other or (None, None, None)))
            here = others[r.part][end]
            if here is not None:
                other = here
            elif last and last.doc_id != r[end].doc_id:
                other = last
            last = r[end]
        return out

    edges = [(r.part, *b, *a) for r, b, a in zip(ends, nearest(ends, "tail"), nearest(ends[::-1], "head")[::-1], strict=True)]
    near = F.broadcast(spark.createDataFrame(
        edges, "part long, bh long, bkey binary, bdoc long, ah long, akey binary, adoc long"))
    order = Window.partitionBy("part").orderBy("place")
    rows = ordered.withColumn("part", F.shiftright("place", 33)).join(near, "part")
    shift = {}
    for name, lag in (("before", F.lag), ("after", F.lead)):
        b = name[0]
        edge = F.struct(F.col(f"{b}h").alias("h"), F.col(f"{b}key").alias(side), F.col(f"{b}doc").alias("doc_id"))
        shift[name] = F.coalesce(lag(F.struct("h", side, "doc_id")).over(order), edge)
    rows = rows.select("part", "place", *names,
                       shift["before"].alias("before"), shift["after"].alias("after"))
    # rows of one document that stand together share the neighbours outside
    same = F.col("before.doc_id").eqNullSafe(F.col("doc_id"))
    rows = rows.withColumn("run", F.sum(F.when(same, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("part", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(*names, F.first("before").over(run).alias("before"),
                       F.last("after").over(run).alias("after"))

    def extents(batches):
        for batch in batches:
            mine = batch.select(["h", side, "doc_id"]).to_pylist()
            best = []
            for row, b, a in zip(mine, batch.column("before").to_pylist(), batch.column("after").to_pylist(), strict=True):
                best.append(max((_common(row[side], o[side]) for o in (b, a)
                                 if o["h"] == row["h"] and o["doc_id"] != row["doc_id"]), default=-1))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(best, pa.int32())], [*names, "extent"])

    return rows.mapInArrow(extents, schema)


def _merged(runs: DataFrame, start: str, stop: str) -> DataFrame:
    """runs with opened: the start of the passage they overlap or touch to."""
    order = Window.partitionBy("doc_id", "same").orderBy(start, stop)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.when(F.max(stop).over(before) >= F.col(start), F.lit(None)).otherwise(F.col(start))
    return runs.withColumn("opens", opens).withColumn(
        "opened", F.max("opens").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("opens")


def open_hashes(right: DataFrame) -> DataFrame:
    """Distinct h of suffixes that have too few words on the right, or words
    before them that no run proven on the right covers."""
    proven = _merged(right.where(F.col("extent") >= FOLLOW).withColumn("stop", F.col("at") + F.col("more") + LEAST_WORDS), "at", "stop")
    bare = proven.where(F.col("opened") > F.greatest(F.col("at") - FOLLOW, F.lit(0)))
    return right.where(F.col("extent") < FOLLOW).select("h").unionByName(bare.select("h")).distinct()


def repeated_passages(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, start_word, stop_word, n_words, first_doc_id, removed) of all
    repeated passages; words count from 0, the end exclusive."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id is not null").withColumn("same", F.xxhash64("text"))
    found = scratch.cut(texts.mapInArrow(_suffixes, "doc_id long, same long, at int, h long, more int, fewest int, most int"))
    # written first: the join then deals out plain rows, and a hash that many
    # documents have can be split
    shared = scratch.cut(found.groupBy("h").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last"))
    kept = found.join(shared.select("h"), "h")
    by_doc = kept.groupBy("doc_id", "same").agg(F.collect_set(F.struct("at", "h", "more", "fewest", "most")).alias("found"))
    rows = scratch.cut(texts.join(by_doc, ["doc_id", "same"]).mapInArrow(
        _contexts, "doc_id long, same long, at int, h long, more int, fewest int, most int, right binary, left binary"))

    def key(words):
        """A run of LEAST_WORDS by its suffix and the words before it."""
        return F.xxhash64("h", words, F.substring("left", F.lit(1), 4 * words),
                          F.substring("right", F.lit(1), 4 * (FOLLOW - words))).alias("key")

    place = ["doc_id", "same", "more"]
    right = scratch.cut(neighbours(rows.drop("left", "fewest", "most"), "right", scratch).withColumn("left", F.lit(b"")).select(
        *place, "at", "h", "extent", key(F.lit(0))))
    unsure = scratch.cut(open_hashes(right))
    left = neighbours(rows.join(jobs.sized(unsure, unsure.count()), "h", "left_semi"), "left", scratch)
    least, most = F.greatest("fewest", F.lit(1)), F.least("extent", "most")
    runs = scratch.cut(
        left.where(least <= most).withColumn("words", F.explode(F.sequence(least, most)))
        .where(F.octet_length("right") >= 4 * (FOLLOW - F.col("words")))
        .select(*place, (F.col("at") - F.col("words")).alias("start"), key(F.col("words")))
        .unionByName(right.where(F.col("extent") >= FOLLOW).select(*place, F.col("at").alias("start"), "key")))
    held = scratch.cut(runs.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last"))
    sure = runs.join(held.select("key", "first"), "key").withColumn("stop", F.col("start") + F.col("more") + LEAST_WORDS)
    return (_merged(sure, "start", "stop").groupBy("doc_id", "same", "opened").agg(
                F.min("start").alias("start_word"), F.max("stop").alias("stop_word"), F.min("first").alias("first_doc_id"))
            .withColumn("n_words", F.col("stop_word") - F.col("start_word"))
            .select("doc_id", "start_word", "stop_word", "n_words", "first_doc_id",
                    (F.col("first_doc_id") != F.col("doc_id")).alias("removed")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of 50 words or more that another document holds too."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "suffixes")
    try:
        return jobs.finish(repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch), scratch)
    finally:
        scratch.close()
