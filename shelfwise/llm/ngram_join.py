"""N-gram Jaccard join of documents by MinHash banding.

1. One Arrow pass gives each text a 128-bit hash of its word sequence and the
   hashes of its signature bands; bands and rows are chosen for the target
   recall. Equal word sequences are one class, named by that hash.
2. Band hashes shared by classes link every member to the smallest one (a
   grouped minimum, so a bucket never meets in one task). The components of
   these links are the candidate sets: every pair that shares a band is in one.
3. Candidate sets are dealt out in blocks, and block against block the full
   5-word shingle sets are intersected and pairs of Jaccard >= 0.8 counted.
   Only counts and links leave a task. A class comes as one shingle set, taken
   from a document whose text has that hash.
4. Components of the verified links are the near-duplicate classes.

Defined results: words are runs of letters and digits, case folded. A text of
1 to 4 words has one shingle, all its words. Texts without words (null, empty)
and rows with a null doc_id are alone: class_id is their doc_id, n_links 0.
Repeated rows count as copies; rows of one doc_id with different texts are
documents of their own. n_links is the number of other rows of Jaccard >= 0.8
found (copies included); class_id the smallest doc_id of the component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jobs, near, text
from shelfwise.operators.lineage import Scratch

RECALL = 0.9995


def _sketcher(bands: int, rows: int, seed: int):
    def run(batches):
        for batch in text.portions(batches):
            w = text.words_of(batch.column("text"))
            values, limits = text.shingles(w.hash, w.first)
            full = np.flatnonzero(np.diff(limits))
            found = np.zeros((0, bands), np.int64)
            if len(full):
                signatures = text.minima(values, np.r_[limits[:-1][full], limits[-1]], bands * rows, seed)
                found = text.band_hashes(signatures, bands, rows)
            lists = np.concatenate([[0], np.cumsum((np.diff(limits) > 0) * bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("same"), text.fixed_binary(text.pair_keys(w.hash, w.first)),
                pa.array(8 * np.diff(limits)), pa.ListArray.from_arrays(pa.array(lists), pa.array(found.ravel()))],
                ["doc_id", "same", "node", "bytes", "bands"])
    return run


def _sets(batches):
    """(node, set) of the texts that have a wanted hash."""
    for batch in text.portions(batches):
        w = text.words_of(batch.column("text"))
        nodes = text.fixed_binary(text.pair_keys(w.hash, w.first)).to_pylist()
        mine = np.flatnonzero([n == x for n, x in zip(nodes, batch.column("node").to_pylist(), strict=True)])
        values, limits = text.distinct_runs(*text.shingles(w.hash, w.first))
        take = pa.array(mine, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("node").take(take), text.binary_runs(values, limits).take(take)],
                                         ["node", "set"])


def same_text(column: str = "text"):
    """Tells texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(column).cast("string"), F.lit("")))


def similar_classes(docs: DataFrame, scratch: Scratch, recall: float = RECALL, seed: int = 11) -> DataFrame:
    """(doc_id, same, class_id, first, n_links) for every row of docs; see the
    module. ``same`` is same_text of its text, ``first`` tells the class's
    first rows: of its smallest doc_id, and one text of it."""
    bands, rows = text.banding(text.SIMILARITY, recall)
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = scratch.cut(texts.select("doc_id", "text", same_text().alias("same")).mapInArrow(
        _sketcher(bands, rows, seed), "doc_id long, same long, node binary, bytes long, bands array<long>"))
    usable = sketch.where(F.col("doc_id").isNotNull() & (F.size("bands") > 0))
    classes = scratch.cut(usable.groupBy("node").agg(
        F.min(F.struct("doc_id", "same")).alias("rep"), F.count("*").alias("n"), F.max("bytes").alias("bytes"),
        F.first("bands").alias("bands")))
    buckets = classes.select("node", F.posexplode("bands").alias("band", "value"))
    least = buckets.groupBy("band", "value").agg(F.min("node").alias("b"), F.count("*").alias("n")).where("n > 1")
    # `least` keeps shared buckets only: few against all bands of all classes
    pairs = (buckets.join(least, ["band", "value"]).where("node <> b")
             .groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("shared")))
    candidates = jobs.components(pairs.select("a", "b"), scratch)
    members = scratch.cut(near.deal(candidates.join(classes.select("node", "n", "bytes", "rep"), "node")))
    dealt, held = near.block_pairs(members, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if held:
        # a document of the class; if its id is repeated, the rows of that text
        wanted = members.select("node", F.col("rep.doc_id").alias("doc_id"))
        sets = (texts.join(jobs.sized(wanted, held), "doc_id").select("text", "node")
                .mapInArrow(_sets, "node binary, set binary").groupBy("node").agg(F.first("set").alias("set")))
        verified = scratch.cut(near.verify(dealt.join(sets, "node")))
    else:
        verified = spark.createDataFrame([], "node binary, links long, root binary")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    roots = jobs.components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    classes = scratch.cut(classes.select("node", "rep", "n").join(links, "node", "left").join(roots, "node", "left").select(
        "node", "rep", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    firsts = classes.groupBy("root").agg(F.min("rep").alias("first"))
    classes = classes.join(firsts, "root").select("node", "first", "n_links")
    mine = F.col("doc_id").isNotNull() & (F.size("bands") > 0)
    grouped = sketch.where(mine).select("doc_id", "same", "node").join(classes, "node").select(
        "doc_id", "same", F.col("first.doc_id").alias("class_id"), (F.struct("doc_id", "same") == F.col("first")).alias("first"),
        "n_links")
    alone = sketch.where(~mine).select("doc_id", "same", F.col("doc_id").alias("class_id"), F.lit(True).alias("first"),
                                       F.lit(0).cast("long").alias("n_links"))
    return grouped.unionByName(alone)


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with one row of each class. found: (doc_id, same, first) of the
    rows that have a link, as a written table."""
    same = "same"
    while same in docs.columns:
        same = "_" + same
    keys = ["doc_id", same]
    gone = found.where("not first").select("doc_id", F.col("same").alias(same)).distinct()
    kept = docs.withColumn(same, same_text()).join(jobs.sized(gone, gone.count()), keys, "left_anti")
    # a first row that is there more than once is its own copy
    again = (found.where("first").groupBy("doc_id", "same").agg(F.count("*").alias("n")).where("n > 1")
             .select("doc_id", F.col("same").alias(same)))
    repeated = again.count()
    if repeated:
        again = jobs.sized(again, repeated)
        kept = kept.join(again, keys, "left_anti").unionByName(kept.join(again, keys, "left_semi").dropDuplicates(keys))
    return kept.select(docs.columns)


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: doc_id, class_id, n_links."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "ngram")
    try:
        found = similar_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch)
        return jobs.finish(found.select("doc_id", "class_id", "n_links"), scratch)
    finally:
        scratch.close()


#: Words and their 5-word shingles, or all words of a text with fewer.
WORDS_SQL = r"""regexp_extract_all(lower(coalesce(text, '')), '[^\x00-/:-@\[-`{-\x7f]+')"""
SHINGLES_SQL = """CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END"""

SQL = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
s AS (SELECT r, unnest(s) AS s, len(s) AS n FROM (
  SELECT r, {SHINGLES_SQL} AS s FROM d WHERE doc_id IS NOT NULL AND len(w) > 0)),
p AS (SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.s = b.s AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n)),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
c(r, o) AS (SELECT r, r FROM d UNION SELECT c.r, e.b FROM c JOIN e ON c.o = e.a)
SELECT d.doc_id, CASE WHEN d.doc_id IS NOT NULL THEN min(o.doc_id) END AS class_id,
  (SELECT count(*) FROM e WHERE e.a = d.r) AS n_links
FROM d JOIN c ON c.r = d.r JOIN d o ON o.r = c.o GROUP BY d.r, d.doc_id"""
