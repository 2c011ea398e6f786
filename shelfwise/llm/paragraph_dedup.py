"""Substring deduplication by paragraph MinHash banding.

The words of every line are parted into paragraphs: a sentence of eight words
or more, or a run of shorter ones up to about as many. So all words of a text
are in one paragraph. (``every`` takes all sentences and all whole lines as
they are instead, of any length.) Equal word sequences are one class by a
128-bit hash.

1. Paragraphs of eight words or more are banded for a recall of 0.9995 at
   Jaccard 0.8. Band hashes are sorted where they meet and those of one class
   alone dropped; buckets of the same members are one.
2. One pass writes the place and class of every paragraph, with the 5-word
   shingles of those that share a bucket (a bitmap of fixed size tells which).
3. Inside each bucket all classes are compared exactly (block against block in
   large ones), so what a loose band brings together is checked there and never
   grows into one large candidate set. Shorter paragraphs have too few shingles
   for a near copy: they are one class if their word sequences are equal.
4. The components of verified links are the clusters. Of each cluster the first
   occurrence (by doc_id and place) stays and all others are removals.

Paragraphs that stand together join to passages. One of a common word or two
is no evidence of copying, so ``least_passage`` reports the paragraphs of
passages of that many words at least; what is read and compared stays whole.

Defined results: one row for each paragraph of a cluster of two or more
occurrences. Null and empty texts and rows with a null doc_id have none;
repeated rows are occurrences of their own (of equal doc_id and place both
count, and neither is a removal of the other). Places are code points, the end
exclusive. With ``every`` a line of one sentence is one paragraph; a line of
several is one beside its sentences, so rows may lie within each other. A
passage is a longest run of words of one text all of which are in such
paragraphs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm import jobs, near, text
from shelfwise.llm.ngram_join import same_text
from shelfwise.operators.lineage import Scratch

RECALL = 0.9995
#: Words from which a paragraph is banded.
LEAST_WORDS = 8
MOST_HASHES = 36
#: Words of a passage that op2_paragraph_dedup reports, at least.
LEAST_PASSAGE = 12
#: Bits of the filters that spare rows a shuffle (they let some too many through).
FILTER_BITS = 1 << 27


PLACES = "doc_id long, same long, start int, stop int, word int, words int, node binary, set binary"


class Paragraphs:
    """The paragraphs of a batch: first word, end and document of each."""

    def __init__(self, texts: pa.Array, every: bool):
        w = self.words = text.words_of(texts)
        first, doc = text.sentences(w)
        whole, owner = text.sentences(w, lines=True)
        if every:
            several = np.flatnonzero(np.diff(np.searchsorted(first, whole)) > 1)
            self.begin = np.r_[first[:-1], whole[:-1][several]]
            self.end = np.r_[first[1:], whole[1:][several]]
            self.doc = np.r_[doc, owner[several]]
            return
        # of short sentences in a row, those that begin within the same eight words join
        n = np.diff(first)
        short = n < LEAST_WORDS
        opens = np.ones(len(n), bool)
        opens[1:] = ~short[1:] | ~short[:-1] | np.isin(first[1:-1], whole)
        before = np.cumsum(n) - n
        block = (before - before[np.maximum.accumulate(np.where(opens, np.arange(len(n)), 0))]) // LEAST_WORDS
        opens[1:] |= block[1:] != block[:-1]
        at = np.flatnonzero(opens)
        self.begin, self.end, self.doc = first[:-1][at], np.r_[first[:-1][at[1:]], first[-1:]][:len(at)], doc[at]

    def keep(self, which: np.ndarray) -> None:
        self.begin, self.end, self.doc = self.begin[which], self.end[which], self.doc[which]

    def sequences(self) -> tuple[np.ndarray, np.ndarray]:
        """(words of the paragraphs, one after another; limits)."""
        owner, place = text.spread(self.end - self.begin)
        return self.words.hash[self.begin[owner] + place], np.concatenate([[0], np.cumsum(self.end - self.begin)])

    def keys(self) -> np.ndarray:
        return text.pair_keys(*self.sequences()) if len(self.begin) else np.zeros((0, 2), np.uint64)


def _places(shared, every: bool):
    """(doc_id, same, start, stop, word, words, node) of every paragraph; and
    its set if the filter holds its key (once in a batch)."""
    def run(batches):
        for batch in text.portions(batches):
            p = Paragraphs(batch.column("text"), every)
            w = p.words
            at = text.code_points(w.data)
            base = at[w.offsets[:-1]][p.doc]
            take = pa.array(p.doc, pa.int64())
            keys = p.keys()
            places = [batch.column("doc_id").take(take), batch.column("same").take(take),
                      pa.array((at[w.start[p.begin]] - base).astype(np.int32)), pa.array((at[w.end[p.end - 1]] - base).astype(np.int32)),
                      pa.array((p.begin - w.first[p.doc]).astype(np.int32)), pa.array((p.end - p.begin).astype(np.int32)),
                      text.fixed_binary(keys)]
            _, fresh = np.unique(keys[:, 0], return_index=True)
            fresh = np.sort(fresh[held(shared.value, keys[fresh, 0]) & (p.end - p.begin >= LEAST_WORDS)[fresh]])
            which = np.full(len(keys), -1)
            which[fresh] = np.arange(len(fresh))
            p.keep(fresh)
            sets = text.binary_runs(*text.distinct_runs(*text.shingles(*p.sequences())))
            yield pa.RecordBatch.from_arrays([*places, sets.take(pa.array(which, pa.int64(), mask=which < 0))],
                                             [c.split()[0] for c in PLACES.split(", ")])
    return run


def _banded(bands: int, rows: int, seed: int, every: bool):
    """(value, key) of each band of the long paragraphs, once for a batch."""
    def run(batches):
        for batch in text.portions(batches):
            p = Paragraphs(batch.column("text"), every)
            p.keep(np.flatnonzero(p.end - p.begin >= LEAST_WORDS))
            if not len(p.begin):
                continue
            keys = p.keys()[:, 0].view(np.int64)
            _, fresh = np.unique(keys, return_index=True)
            p.keep(fresh)
            values, limits = text.shingles(*p.sequences())
            found = text.band_hashes(text.minima(values, limits, bands * rows, seed), bands, rows)
            yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), pa.array(np.repeat(keys[fresh], bands))], ["value", "key"])
    return run


def _shared(batches):
    """Rows sorted by (value, key): each key of the values that have several,
    once. Only the last row is held between batches."""
    last, single = None, False               # the last row, and whether it waits for a second key
    for batch in batches:
        values = batch.column("value").to_numpy(zero_copy_only=False)
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        if not len(values):
            continue
        if last is not None:
            values, keys = np.r_[last[0], values], np.r_[last[1], keys]
        fresh = np.r_[True, (values[1:] != values[:-1]) | (keys[1:] != keys[:-1])]
        values, keys = values[fresh], keys[fresh]
        same = values[1:] == values[:-1]
        several = np.r_[False, same] | np.r_[same, False]
        # the first row has gone out already if it had company before
        if last is not None and not single:
            several[0] = False
        last, single = (values[-1], keys[-1]), not (several[-1] or (len(values) == 1 and last is not None and not single))
        yield pa.RecordBatch.from_arrays([pa.array(values[several]), pa.array(keys[several])], ["value", "key"])


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap with the place of each key (a long) set, of the same size for
    any number of keys: a row whose place is not set has none of them."""
    place = F.pmod("key", F.lit(bits)) + 1
    parts = keys.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("at")).groupBy(
        "part").agg(F.bitmap_construct_agg("at").alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.toLocalIterator():
        low = (r.part - 1) * 4096
        out[low:low + 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def held(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the 64-bit keys have their place set."""
    at = np.mod(keys.view(np.int64), np.int64(8 * len(bitmap)))
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _node_keys(nodes: pa.Array) -> np.ndarray:
    """The first of a class's two hashes, by which bands and filters go."""
    return np.frombuffer(b"".join(n[:8] for n in nodes.to_pylist()), np.int64)


def _keyed(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_node_keys(batch.column("node")))], ["key"])


def _with_key(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(_node_keys(batch.column("node"))), batch.column("set")],
                                         ["node", "key", "set"])


def _filtered(shared):
    """Rows whose node the filter holds."""
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(held(shared.value, _node_keys(batch.column("node")))))
    return run


def shared_buckets(texts: DataFrame, scratch: Scratch, recall: float, seed: int, every: bool) -> DataFrame:
    """(value, key): the classes of each bucket that has several."""
    bands, rows = text.banding(text.SIMILARITY, recall, MOST_HASHES)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = scratch.cut(texts.select("text").mapInArrow(_banded(bands, rows, seed, every), "value long, key long")
                         .repartition(parts, "value").sortWithinPartitions("value", "key")
                         .mapInArrow(_shared, "value long, key long"))
    # of buckets with the same members one is enough
    alike = shared.groupBy("value").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"),
                                        F.min("key").alias("low"), F.max("key").alias("high"))
    chosen = alike.groupBy("n", "x", "low", "high").agg(F.min("value").alias("value")).select("value")
    return scratch.cut(shared.join(chosen, "value"))


def verified_links(shared: DataFrame, sketch: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): verified links between classes that share a bucket."""
    spark = sketch.sparkSession
    sets = scratch.cut(sketch.where("set is not null").groupBy("node").agg(F.first("set").alias("set"))
                       .mapInArrow(_with_key, "node binary, key long, set binary"))
    members = scratch.cut(near.deal(
        shared.join(sets.select("key", "node", F.octet_length("set").cast("long").alias("bytes")), "key")
        .select("node", F.col("value").alias("root"), "bytes", F.lit(1).cast("long").alias("n"))))
    dealt, some = near.block_pairs(members, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not some:
        return spark.createDataFrame([], "node binary, root binary")
    return scratch.cut(near.verify(dealt.join(sets.select("node", "set"), "node")).select("node", "root").distinct())


def paragraph_clusters(docs: DataFrame, scratch: Scratch, recall: float = RECALL, seed: int = 17,
                       least_passage: int = 1, every: bool = False) -> DataFrame:
    """(doc_id, start, stop, first_doc_id, first_start, copies, removed,
    passage_words) for every paragraph of a cluster; see the module."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id is not null")
    shared = shared_buckets(texts, scratch, recall, seed, every)
    wanted = spark.sparkContext.broadcast(key_filter(shared.select("key")))
    sketch = scratch.cut(texts.select("doc_id", "text", same_text().alias("same")).mapInArrow(_places(wanted, every), PLACES))
    wanted.unpersist()
    links = verified_links(shared, sketch, scratch)
    roots = jobs.components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    # classes of several rows, or linked to another
    nodes = sketch.groupBy("node").agg(F.count("*").alias("n"))
    named = scratch.cut(nodes.join(roots, "node", "left").where("n > 1 or root is not null").select(
        "node", F.coalesce("root", "node").alias("cluster")))
    found = spark.sparkContext.broadcast(key_filter(named.select("node").mapInArrow(_keyed, "key long")))
    plain = PLACES.removesuffix(", set binary")
    rows = scratch.cut(sketch.drop("set").mapInArrow(_filtered(found), plain).join(named, "node").drop("node"))
    found.unpersist()
    # by document first, so that a cluster's rows never meet in one task; written,
    # so that the join below can be split where a cluster has many rows
    by_doc = rows.groupBy("cluster", "doc_id").agg(F.count("*").alias("n"), F.min("start").alias("start"))
    clusters = scratch.cut(by_doc.groupBy("cluster").agg(
        F.sum("n").alias("copies"), F.min(F.struct("doc_id", "start")).alias("first")).select(
        "cluster", "copies", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start")))
    # runs of covered words of a text
    order = Window.partitionBy("doc_id", "same").orderBy("word", "words")
    reach = F.max(F.col("word") + F.col("words")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("opens", F.when(reach >= F.col("word"), 0).otherwise(1)).withColumn(
        "run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy("doc_id", "same", "run")
    rows = rows.withColumn("passage_words", (F.max(F.col("word") + F.col("words")).over(run) - F.min("word").over(run)))
    return rows.where(F.col("passage_words") >= least_passage).join(clusters, "cluster").select(
        "doc_id", "start", "stop", "first_doc_id", "first_start", "copies",
        ((F.col("doc_id") != F.col("first_doc_id")) | (F.col("start") != F.col("first_start"))).alias("removed"), "passage_words")


def _query(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    jobs.prepare(spark)
    scratch = Scratch(spark, "paragraphs")
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        return jobs.finish(paragraph_clusters(docs, scratch, **options), scratch)
    finally:
        scratch.close()


def op2_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph that has a copy or near copy and stands in a repeated
    passage of 12 words or more, with the first occurrence of its cluster and
    whether it is a removal. All words of all texts are compared."""
    return _query(spark, sf_dir, least_passage=LEAST_PASSAGE)


def op2_every_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for all sentences and whole lines by themselves, without a
    least passage."""
    return _query(spark, sf_dir, every=True).drop("passage_words")
