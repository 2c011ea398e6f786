"""Filter interaction audit by incremental retraction streaming.

Documents are read as a stream of files, in available-now micro-batches. For
each row the JVM works out its part, the key of its text (SHA-256) and a mask
of the filters A to D that it fails. Filter E, a text that a smaller id has
too, isn't known before all files are read, so it is kept up to date:

- A task passes a row on as a sure failure of E if it has seen the same text
  under a smaller id itself; only new smallest ids go to the state. A text
  that a third of all rows share thus reaches its state as a few rows.
- The state, keyed by text, holds the smallest id so far with its mask, parts
  and counts. Rows that come with a larger id fail E. When a smaller id comes,
  the rows that held the place are retracted: -1 for their old mask, +1 for
  the mask with E. Texts share a state key by hash, TEXTS_A_KEY to a key on
  average, since a key costs a call of Python in every batch.
- The changes are appended to a table of (doc_id, part, mask, change), exactly
  once by the stream's own checkpoint. More files can come later: the stream
  goes on from there, and sums of changes are right after every batch.

The part counters are sums of changes by part, mask and label, small whatever
the input. All 120 orders of the five filters are read off them: a row is
removed by the first filter of an order that its mask holds.

Defined results: a null text is empty, a null lang the part ''. A row without
an id is neither a copy of another nor makes one. Repeated rows of one id and
text fail E together or not at all. A document's labels are 1 if any of its
label rows is; rows without labels are neither good nor toxic.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jobs
from shelfwise.operators.lineage import Scratch

FILTERS = "ABCDE"
COPY = 16                   # the mask's bit of filter E
LEAST_WORDS = 200
TEXTS_A_KEY = 256
#: Micro-batches of a backlog of files: each batch rewrites the state it meets.
BATCHES = 4
#: Texts whose smallest id a task remembers.
SEEN = 1 << 16


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, hash) of documents; mask has bits 1 to 8 for the
    filters A to D."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    first = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                        text.alias("text"), split.alias("words"))
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    failed = [n < LEAST_WORDS, 100 * distinct < 50 * n, 100 * capitals > 3 * F.length("text"), F.col("text").rlike(r"[#$%&*|]")]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))
    return first.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2("text", 256)).alias("hash"))


def _sifted(keys: int, spread: int):
    """Adds the state key of each row, and whether E is settled for it."""
    def run(batches):
        least: dict[bytes, int] = {}
        n = 0
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            hashes = batch.column("hash").to_pylist()
            sure = np.zeros(len(ids), bool)
            mask = batch.column("mask").to_numpy(zero_copy_only=False).copy()
            key = np.empty(len(ids), np.int64)
            for i, (d, h) in enumerate(zip(ids, hashes, strict=True)):
                known = least.get(h)
                if d is None or known is not None and known < d:
                    sure[i] = True
                    mask[i] |= 0 if d is None else COPY
                    key[i] = -1 - (n + i) % spread          # nothing to keep: dealt round
                else:
                    if known is None and len(least) >= SEEN:
                        least.clear()
                    least[h] = d
                    key[i] = int.from_bytes(h[:8], "big") % keys
            n += len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), batch.column("doc_id"), batch.column("part"), pa.array(mask, pa.int32()),
                 batch.column("hash"), pa.array(sure)], ["key", "doc_id", "part", "mask", "hash", "sure"])
    return run


CHANGE = "doc_id long, part string, mask int, change long"
STATE = pa.schema([("hash", pa.binary()), ("doc_id", pa.int64()), ("mask", pa.int32()), ("part", pa.string()), ("n", pa.int64())])


def kept_state(state: dict) -> bytes:
    rows = [(h, d, m, p, n) for h, (d, m, parts) in state.items() for p, n in parts.items()]
    batch = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), STATE, strict=True)], schema=STATE)
    return batch.serialize().to_pybytes()


def read_state(blob: bytes) -> dict:
    state: dict = {}
    batch = pa.ipc.read_record_batch(pa.py_buffer(blob), STATE)
    for h, d, m, p, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        state.setdefault(h, (d, m, {}))[2][p] = n
    return state


def follow(state: dict, rows) -> list[tuple]:
    """Brings the state {hash: (smallest id, mask, {part: rows})} up to date
    with rows (doc_id, part, mask, hash); the changes that follow from it."""
    out = []
    for d, p, m, h in rows:
        known = state.get(h)
        if known is not None and known[0] < d:
            out.append((d, p, m | COPY, 1))
            continue
        if known is not None and known[0] > d:                     # retract
            for part, n in known[2].items():
                out.append((known[0], part, known[1], -n))
                out.append((known[0], part, known[1] | COPY, n))
            known = None
        if known is None:
            known = state[h] = (d, m, {})
        known[2][p] = known[2].get(p, 0) + 1
        out.append((d, p, m, 1))
    return out


def _stateful(key, frames, held):
    if key[0] < 0:
        for frame in frames:
            yield frame[["doc_id", "part", "mask"]].assign(change=1)
        return
    state = read_state(held.get[0]) if held.exists else {}
    out = []
    for frame in frames:
        out += follow(state, zip(frame["doc_id"].tolist(), frame["part"].tolist(), frame["mask"].tolist(),
                                 frame["hash"].tolist(), strict=True))
    held.update((kept_state(state),))
    if out:
        yield pd.DataFrame(out, columns=["doc_id", "part", "mask", "change"])


def stream_changes(spark: SparkSession, path: str, out: str, checkpoint: str, keys: int, batch_files: int) -> None:
    """Reads all files of documents that have come under ``path`` since the
    last run and appends their changes to ``out``."""
    schema = spark.read.parquet(path).select("doc_id", "text", "lang").schema
    # as a pattern, the path may name a folder of files or one file
    path = path.rstrip("/")
    docs = spark.readStream.schema(schema).option("maxFilesPerTrigger", batch_files).parquet(f"{path[:-1]}[{path[-1]}]")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = masks(docs).mapInArrow(_sifted(keys, spread), "key long, doc_id long, part string, mask int, hash binary, sure boolean")
    changes = rows.groupBy("key").applyInPandasWithState(_stateful, CHANGE, "blob binary", "append", "NoTimeout")
    query = (changes.writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        query.awaitTermination()
    finally:
        query.stop()


def counters(changes: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): rows of each kind, from the changes."""
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).where("good + toxic > 0")
    # rows without an id have no labels: they don't meet at one null key
    named = changes.where("doc_id is not null").join(marked, "doc_id", "left").select(
        "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), "change")
    rest = changes.where("doc_id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "change")
    return (named.unionByName(rest).groupBy("part", "mask", "good", "toxic").agg(F.sum("change").alias("n")))


def interactions(counted: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step; see the module."""
    spark = counted.sparkSession
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            steps.append((name, step, 1 << f, before))
            before |= 1 << f
    steps = spark.createDataFrame(steps, "filter_order string, step int, own int, before int")
    rows = counted.crossJoin(F.broadcast(steps))                    # 600 rows, fixed
    mask, own, before = (F.col(c) for c in ("mask", "own", "before"))
    fails, clean = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) == 0
    removed = fails & clean
    orders = 120 / F.greatest(F.lit(1), F.bit_count(mask))          # in which a filter comes first of those failed
    total = lambda when, weight=F.lit(1): F.coalesce(
        F.sum(F.when(when, F.col("n") * weight)), F.lit(0)).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(clean & ~fails).alias("kept"), total(removed).alias("removed"), total(fails & ~clean).alias("redundant"),
        total(mask == own).alias("unique_fails"), total(removed & (F.col("good") == 1)).alias("good_lost"),
        total(removed & (F.col("toxic") == 1)).alias("toxic_lost"), total(fails, orders.cast("long")).alias("shapley"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept, removed and redundant rows of every part, order and step."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "audit")
    try:
        path = f"{sf_dir}/documents.parquet"
        docs = spark.read.parquet(path)
        rows, files = docs.count(), len(docs.inputFiles())
        out = scratch.folder("changes")
        stream_changes(spark, path, out, scratch.folder("stream"), max(1, rows // TEXTS_A_KEY), max(1, -(-files // BATCHES)))
        changes = spark.read.schema(CHANGE).parquet(out)
        counted = scratch.cut(counters(changes, spark.read.parquet(f"{sf_dir}/labels.parquet")))
        return jobs.finish(interactions(counted), scratch)
    finally:
        scratch.close()


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
m AS (
  SELECT doc_id, part,
         CAST(len(words) < 200 AS INTEGER) + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INTEGER)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INTEGER)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER) + 16 * CAST(coalesce(doc_id > first, FALSE) AS INTEGER) AS mask
  FROM w),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic
      FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS (SELECT part, mask, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, count(*) AS n
      FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
f AS (SELECT chr(CAST(65 + i AS INTEGER)) AS letter, CAST(1 << i AS INTEGER) AS bit FROM range(5) t(i)),
orders AS (
  SELECT letter AS filter_order, bit AS mask, 1 AS step FROM f
  UNION ALL
  SELECT filter_order || letter, mask | bit, step + 1 FROM orders JOIN f ON mask & bit = 0),
steps AS (
  SELECT o.filter_order, CAST(s AS INTEGER) AS step, f.bit AS own,
         CAST((SELECT coalesce(sum(g.bit), 0) FROM f g WHERE strpos(o.filter_order, g.letter) < s) AS INTEGER) AS before
  FROM orders o, range(1, 6) r(s), f WHERE o.step = 5 AND f.letter = substr(o.filter_order, CAST(s AS INTEGER), 1))
SELECT part, filter_order, step,
       CAST(coalesce(sum(n) FILTER (mask & before = 0 AND mask & own = 0), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (mask & before <> 0 AND mask & own <> 0), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (mask = own), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(n) FILTER (good AND mask & before = 0 AND mask & own <> 0), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(n) FILTER (toxic AND mask & before = 0 AND mask & own <> 0), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * 120 // greatest(1, bit_count(mask))) FILTER (mask & own <> 0), 0) AS BIGINT) AS shapley
FROM c, steps GROUP BY part, filter_order, step"""
