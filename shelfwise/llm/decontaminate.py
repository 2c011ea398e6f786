"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by size (a factor of 2 each). For a partition
of items of up to s shingles, every document is read in overlapping windows
of about 1.25 s shingles, so an item inside a document meets a window of its
own size however long the document is, and the containment threshold becomes
a Jaccard of at least about 0.3 to some window. One minimum is one band: a
window and an item that share any of the minima are a candidate, verified by
the exact share of the item's 5-word shingles that the whole document holds.

The items are broadcast in blocks of bounded size, one pass over the
documents each; a document is read in one task and nothing is shuffled.

Items of one to four words have no 5-word shingle: they are found where their
words stand in a row, by the hash of that run (``least_words`` leaves such
items out, where a word or two is no reason to act on).

Defined results: words are runs of letters and digits, case folded. Null items
and items without words take no part; null and empty documents hold nothing. Repeated rows are searched like any
other. An item found is one whose shingles are in the document to 0.8 or more.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jobs, text
from shelfwise.llm.ngram_join import SHINGLES_SQL, WORDS_SQL

CONTAINMENT = 0.8
RECALL = 0.9999
GROWTH = 2.0
#: Shingles of the items in one broadcast block (8 bytes each, several copies).
BLOCK_SHINGLES = 2_000_000


class ItemIndex:
    """Items of one block: exact shingle sets and minima by size partition."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], words: list[int] | None = None, seed: int = 5):
        self.ids, self.sets = np.array(ids, np.int64), sets
        self.parts = []
        sizes = np.array([len(s) for s in sets])
        words = np.array(words) if words is not None else np.full(len(sets), text.SHINGLE)
        # short items by their number of words: hashes in order, and whose they are
        self.runs = []
        for n in np.unique(words[words < text.SHINGLE]):
            mine = np.flatnonzero(words == n)
            hashes = np.array([sets[i][0] for i in mine], np.uint64)
            order = np.argsort(hashes, kind="stable")
            self.runs.append((int(n), hashes[order], mine[order]))
        level = np.floor(np.log(np.maximum(sizes, 1)) / math.log(GROWTH) + 1e-9).astype(int)
        level[words < text.SHINGLE] = -1
        for k in np.unique(level[level >= 0]):
            mine = np.flatnonzero(level == k)
            top, low = int(sizes[mine].max()), int(sizes[mine].min())
            step = max(1, top // 4)
            # a run of `top` anywhere lies in a window of one step more
            window = step * math.ceil((top + step - 1) / step)
            # least Jaccard of an item held to the threshold and its window
            held = CONTAINMENT * low
            hit = held / (low + window - held)
            count = math.ceil(math.log(1 - RECALL) / math.log1p(-hit))
            values = np.concatenate([sets[i] for i in mine])
            limits = np.concatenate([[0], np.cumsum(sizes[mine])])
            wanted = text.minima(values, limits, count, seed)
            order = np.argsort(wanted, axis=0, kind="stable")
            self.parts.append((window, step, count, mine[order], np.take_along_axis(wanted, order, 0)))
        self.seed = seed

    def search(self, texts: pa.Array) -> list[list[tuple[int, float]]]:
        """For each text the items it holds, with their containment."""
        w = text.words_of(texts)
        values, limits = text.shingles(w.hash, w.first, short=False)
        candidates: set[tuple[int, int]] = set()
        lengths = np.diff(limits)
        full = np.flatnonzero(lengths)
        found: list[list[tuple[int, float]]] = [[] for _ in range(len(texts))]
        for n, wanted, items in self.runs:
            grams, ends = text.grams(w.hash, w.first, n)
            left = np.searchsorted(wanted, grams, "left")
            hit = np.flatnonzero(wanted[np.minimum(left, len(wanted) - 1)] == grams)
            right = np.searchsorted(wanted, grams[hit], "right")
            docs = np.searchsorted(ends, hit, "right") - 1
            pairs = {(int(d), int(i)) for d, a, b in zip(docs, left[hit], right, strict=True) for i in items[a:b]}
            for d, i in sorted(pairs):
                found[d].append((int(self.ids[i]), 1.0))
        if not len(full) or not self.parts:
            return found
        begins = np.r_[limits[:-1][full], limits[-1]]
        cuts, owners, lasts = [], [], []
        for _, step, _, _, _ in self.parts:
            pieces = -(-lengths[full] // step)
            owner, place = text.spread(pieces)
            cuts.append(np.r_[begins[:-1][owner] + place * step, begins[-1]])
            owners.append(owner)
            lasts.append(np.cumsum(pieces)[owner])
        most = max(p[2] for p in self.parts)
        for j, row in text.minima_rows(values, cuts, most, self.seed):
            for part, owner, last, pieces in zip(self.parts, owners, lasts, row, strict=True):
                window, step, count, items, wanted = part
                if j >= count:
                    continue
                # windows are runs of pieces of one document
                column = pieces.copy()
                for r in range(1, window // step):
                    at = np.arange(r, len(column) + r)
                    inside = np.flatnonzero(at < last)
                    column[inside] = np.minimum(column[inside], pieces[at[inside]])
                left = np.searchsorted(wanted[:, j], column, "left")
                hit = np.flatnonzero(wanted[np.minimum(left, len(wanted) - 1), j] == column)
                right = np.searchsorted(wanted[:, j], column[hit], "right")
                for p, stop in zip(hit, right, strict=True):
                    d = int(full[owner[p]])
                    candidates.update((d, int(i)) for i in items[left[p]:stop, j])
        by_doc: dict[int, list[int]] = {}
        for d, i in candidates:
            by_doc.setdefault(d, []).append(i)
        for d, items in by_doc.items():
            own = np.unique(values[limits[d]:limits[d + 1]])
            for i in sorted(items):
                at = np.searchsorted(own, self.sets[i])
                hits = int((own[np.minimum(at, len(own) - 1)] == self.sets[i]).sum())
                if hits >= CONTAINMENT * len(self.sets[i]):
                    found[d].append((int(self.ids[i]), hits / len(self.sets[i])))
        return found


def item_blocks(benchmark: DataFrame, most: int = BLOCK_SHINGLES, least_words: int = 1):
    """Indexes over blocks of items, streamed to the driver a partition at a
    time; a block ends when its shingles reach the bound."""
    def sets(batches):
        for batch in batches:
            w = text.words_of(batch.column("text"))
            values, limits = text.distinct_runs(*text.shingles(w.hash, w.first))
            yield pa.RecordBatch.from_arrays([
                batch.column("item_id"), pa.array(np.minimum(np.diff(w.first), text.SHINGLE).astype(np.int32)),
                text.binary_runs(values, limits)], ["item_id", "words", "own"])
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .where("item_id is not null and text is not null")
             .mapInArrow(sets, "item_id long, words int, own binary").where(F.col("words") >= max(1, least_words))
             .dropDuplicates().orderBy("item_id", "own"))
    ids, own, words, held = [], [], [], 0
    for row in items.toLocalIterator():
        s = np.frombuffer(row.own, np.uint64)
        if ids and held + len(s) > most:
            yield ItemIndex(ids, own, words)
            ids, own, words, held = [], [], [], 0
        ids.append(row.item_id)
        own.append(s)
        words.append(row.words)
        held += len(s)
    if ids:
        yield ItemIndex(ids, own, words)


def items_in(docs: DataFrame, benchmark: DataFrame, least_words: int = 1):
    """Column of docs: an array of (item_id, containment) of the items each
    whole text holds, ordered by item_id."""
    spark = docs.sparkSession
    kind = "array<struct<item_id:bigint,containment:double>>"
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("containment", pa.float64())]))

    def column(index):
        shared = spark.sparkContext.broadcast(index)

        @F.arrow_udf(kind)
        def held(texts: pa.Array) -> pa.Array:
            return pa.array([[{"item_id": i, "containment": c} for i, c in sorted(row)] for a, b in text.cuts_of(texts)
                             for row in shared.value.search(texts[a:b])], arrow)

        return held(F.col("text").cast("string"))

    parts = [column(index) for index in item_blocks(benchmark, least_words=least_words)]
    if not parts:
        return F.array().cast(kind)
    return F.array_sort(F.concat(*parts)) if len(parts) > 1 else parts[0]


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) of containment >= 0.8: doc_id,
    item_id, containment."""
    jobs.prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = items_in(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.select("doc_id", F.explode(found).alias("item")).select("doc_id", "item.item_id", "item.containment")


SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
g AS (SELECT DISTINCT r, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
  SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT unnest(range(1, 6)) AS k)
  WHERE k = 5 OR k IN (SELECT len({WORDS_SQL}) FROM benchmark))),
i AS MATERIALIZED (SELECT row_number() OVER () AS j, item_id, least(len(w), 5) AS k, {SHINGLES_SQL} AS s FROM (
  SELECT DISTINCT item_id, {WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL) WHERE len(w) > 0),
t AS (SELECT j, item_id, k, len(s) AS n, unnest(s) AS s FROM i)
SELECT d.doc_id, t.item_id, count(*) / CAST(t.n AS DOUBLE) AS containment
FROM t JOIN g ON g.k = t.k AND g.s = t.s JOIN d ON d.r = g.r
GROUP BY d.r, d.doc_id, t.j, t.item_id, t.n HAVING count(*) >= 0.8 * t.n"""
