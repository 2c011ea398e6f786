"""Language-model scoring by prediction by partial matching (PPM).

The model is a byte-context trie of orders 5 to 0, learnt from the training
documents. A byte is predicted at the longest context the trie knows; a byte
not seen there escapes to the next shorter one, with the probability of
method C (distinct successors d among t occurrences: d / (t + d)). Symbols
seen at the longer context are excluded at the shorter one, and below order 0
all bytes never seen are equally likely. Each text is preceded by ORDER zero
bytes and ended by one, so the scores of all texts are a distribution.

Beside it stands the task's base score: word counts with one added.

How the corpus is gathered. Documents are read once into blocks of some MB;
a block's distinct words and 6-byte runs, with their training counts, are
sorted, split into buckets and packed, a few bytes each. A bucket joins the
blocks' shares: a word's counts are added up, and since a bucket holds all runs
of a 3-byte context it holds the trie above that context whole; orders 0 to 2
come from the counts of 3-byte runs, 2^24 at most. Each block gets back one
number for each of its keys and adds them up by document. Nothing as large as
the vocabulary or the trie is ever in one place.

Defined results: null and empty texts have the end token alone. A null doc_id
has the fold of the empty text. Repeated rows are scored, and learnt, each.
With no training rows N and V are 0 and every byte has probability 1/256.
Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jobs, text
from shelfwise.operators.lineage import Scratch

ORDER = 5
#: Contexts of this many bytes share a bucket; shorter ones have a common table.
SHARED = 3
BLOCK_BYTES = 12 << 20
BUCKET_BYTES = 16 << 20
_PART = 1 << 20            # bytes looked at at once
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- packed columns ---------------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers as planes of bytes: high planes are mostly zero."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")
    all_keys = all_keys[order]
    if not len(all_keys):
        return all_keys, all_counts
    begin = np.flatnonzero(np.r_[True, all_keys[1:] != all_keys[:-1]])
    return all_keys[begin], np.add.reduceat(all_counts[order], begin)


# --- what a block of documents holds ----------------------------------------

class Block:
    """Words and padded bytes of some documents."""

    def __init__(self, texts: pa.Array):
        data, offsets = text.buffer_of(texts)
        data = _LOWER[data]
        self.words = text.split_words(data, offsets, text.INK_BYTES)
        lengths = np.diff(offsets) + ORDER + 1
        self.limits = np.concatenate([[0], np.cumsum(lengths)])
        self.bytes = np.zeros(self.limits[-1], np.uint8)
        for at, low, high in zip(self.limits[:-1] + ORDER, offsets[:-1], offsets[1:], strict=True):
            self.bytes[at:at + high - low] = data[low:high]

    def word_parts(self):
        """(hashes, documents) of some words at a time."""
        doc = np.repeat(np.arange(len(self.words.first) - 1), np.diff(self.words.first))
        for at in range(0, len(doc), _PART):
            yield self.words.hash[at:at + _PART], doc[at:at + _PART]

    def run_parts(self):
        """(runs of ORDER + 1 bytes, documents) of some places at a time: one
        run ends at each byte of a text and at its end."""
        n = len(self.bytes)
        for at in range(0, n, _PART):
            stop = min(n, at + _PART)
            low = max(0, at - ORDER)
            window = self.bytes[low:stop].astype(np.uint64)
            runs = np.zeros(stop - at, np.uint64)
            for k in range(ORDER, -1, -1):
                begin = at - low - k
                part = window[max(0, begin):begin + stop - at]
                runs = (runs << np.uint64(8)) | np.concatenate([np.zeros(len(runs) - len(part), np.uint64), part])
            a, b = np.searchsorted(self.limits, [at, stop - 1], "right") - 1
            limits = np.clip(self.limits[a:b + 2], at, stop)
            owner = np.repeat(np.arange(a, b + 1), np.diff(limits))
            ends = np.arange(at, stop) - self.limits[owner] >= ORDER
            yield runs[ends], owner[ends]

    @staticmethod
    def distinct(parts, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys of all documents with their training counts."""
        keys, counts = [], []
        for values, doc in parts:
            for mine, weight in ((values[train[doc]], 1), (values[~train[doc]], 0)):
                if len(mine):
                    k, c = np.unique(mine, return_counts=True)
                    keys.append(k)
                    counts.append(c.astype(np.int64) * weight)
        return merge_counts(keys, counts)


def word_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys % np.uint64(buckets)).astype(np.int64)


def run_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    context = (keys >> np.uint64(8)) & np.uint64((1 << 8 * SHARED) - 1)
    return (text.mix(context) % np.uint64(buckets)).astype(np.int64) + buckets


def by_bucket(keys: np.ndarray, bucket: np.ndarray):
    """Places of the keys of each bucket, in key order."""
    order = np.argsort(bucket, kind="stable")
    names, begin = np.unique(bucket[order], return_index=True)
    return dict(zip(names.tolist(), np.split(order, begin[1:]), strict=True)) if len(keys) else {}


_SCHEMA = ("kind int, block long, doc_id long, train boolean, text string, bucket int, keys binary, counts binary")
DOC, SHARE, LOW = 0, 1, 2


def _reader(buckets: int):
    """Rows of documents with their block, of a block's keys by bucket, and of
    its counts of runs of SHARED bytes."""
    arrow = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("doc_id", pa.int64()), ("train", pa.bool_()),
                       ("text", pa.string()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def shares(block: int, held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held)
        train = table.column("train").to_numpy().astype(bool)
        content = Block(table.column("text").combine_chunks())
        rows = []
        words, word_counts = Block.distinct(content.word_parts(), train)
        runs, run_counts = Block.distinct(content.run_parts(), train)
        for keys, counts, bucket in ((words, word_counts, word_bucket(words, buckets)), (runs, run_counts, run_bucket(runs, buckets))):
            for b, at in by_bucket(keys, bucket).items():
                rows.append({"kind": SHARE, "block": block, "bucket": b, "keys": pack_sorted(keys[at]), "counts": pack(counts[at])})
        low, low_counts = merge_counts([runs & np.uint64((1 << 8 * SHARED) - 1)], [run_counts])
        some = low_counts > 0
        rows.append({"kind": LOW, "block": block, "bucket": -1, "keys": pack_sorted(low[some]), "counts": pack(low_counts[some])})
        return pa.RecordBatch.from_pylist(rows, arrow)

    def run(batches):
        block, held, size = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if block is None:
                block = batch.column("part")[0].as_py() << 24
            batch = batch.select(["doc_id", "train", "text"])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([DOC] * n, pa.int32()), pa.array([block] * n, pa.int64()), *batch.columns,
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], schema=arrow)
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= BLOCK_BYTES:
                yield shares(block, held)
                block, held, size = block + 1, [], 0
        if held:
            yield shares(block, held)
    return run


def _merge_low(batches):
    """One row with the summed counts of the batches' rows."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in batches:
        for k, c in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            keys, counts = merge_counts([keys, unpack_sorted(k)], [counts, unpack(c).astype(np.int64)])
    yield pa.RecordBatch.from_arrays([pa.array([pack_sorted(keys)], pa.binary()), pa.array([pack(counts)], pa.binary())],
                                     ["keys", "counts"])


# --- the trie ---------------------------------------------------------------

def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


class Level:
    """One order of the trie: runs of order + 1 bytes with counts; by context
    the total, the number of successors, and what these have at the order below."""

    def __init__(self, order: int, keys: np.ndarray, counts: np.ndarray):
        self.order, self.keys, self.counts = order, keys, counts
        self.contexts, begin = np.unique(keys >> np.uint64(8), return_index=True)
        self.total = np.add.reduceat(counts, begin) if len(keys) else counts
        self.distinct = np.diff(np.r_[begin, len(keys)])
        self.begin = begin

    def below(self, lower: "Level") -> np.ndarray:
        """By context: the lower order's counts of its successors."""
        at, _ = _find(lower.keys, self.keys & np.uint64((1 << 8 * self.order) - 1))
        return np.add.reduceat(lower.counts[at], self.begin) if len(self.keys) else self.counts


def levels_of(keys: np.ndarray, counts: np.ndarray, orders: range) -> list[Level]:
    out = []
    for order in orders:
        keys, counts = merge_counts([keys & np.uint64((1 << 8 * (order + 1)) - 1)], [counts])
        out.append(Level(order, keys, counts))
    return out


def log_probabilities(runs: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 of the probability of each run's last byte after the others;
    levels from the highest order down to 0."""
    n = len(runs)
    out, open_ = np.zeros(n), np.ones(n, bool)
    gone, gone_distinct = np.zeros(n), np.zeros(n)     # excluded by the context above
    for i, level in enumerate(levels):
        key = runs & np.uint64((1 << 8 * (level.order + 1)) - 1)
        c, known = _find(level.contexts, key >> np.uint64(8))
        if not len(level.contexts):
            continue
        at, seen = _find(level.keys, key)
        total = level.total[c] - gone
        distinct = level.distinct[c] - gone_distinct
        hit = open_ & known & seen
        out[hit] += np.log10(level.counts[at[hit]] / (total[hit] + distinct[hit]))
        miss = open_ & known & ~seen & (distinct > 0)
        out[miss] += np.log10(distinct[miss] / (total[miss] + distinct[miss]))
        open_ &= ~hit
        if level.order:
            under = level.below(levels[i + 1])
            gone = np.where(known, under[c], 0)
            gone_distinct = np.where(known, level.distinct[c], 0)
    ever = len(levels[-1].keys)
    out[open_] += math.log10(1 / (256 - ever)) if ever < 256 else 0.0
    return out


def _resolver(buckets: int, low: tuple[np.ndarray, np.ndarray]):
    """For the shares of one bucket: a word's corpus count, or a run's log10
    probability as float32, for each key asked, in the order asked."""
    def run(table: pa.Table) -> pa.Table:
        asked = [unpack_sorted(k) for k in table.column("keys").to_pylist()]
        counts = [unpack(c).astype(np.int64) for c in table.column("counts").to_pylist()]
        keys, total = merge_counts(asked, counts)
        words = table.column("bucket")[0].as_py() < buckets
        if words:
            values = total
        else:
            some = total > 0
            high = levels_of(keys[some], total[some], range(ORDER, SHARED - 1, -1))
            values = log_probabilities(keys, [*high, *levels_of(*low, range(SHARED - 1, -1, -1))]).astype(np.float32)
        answers = []
        for a in asked:
            v = values[np.searchsorted(keys, a)]
            answers.append(pack(v) if words else v.tobytes())
        n = np.zeros(len(asked), np.int64)
        v = np.zeros(len(asked), np.int64)
        if words:
            n[0], v[0] = total.sum(), (total > 0).sum()
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "answers": pa.array(answers, pa.binary()), "n": n, "v": v})
    return run


def _scorer(buckets: int):
    """Sums by document of one block's answers."""
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        by = dict(zip(answers.column("bucket").to_pylist(), answers.column("answers").to_pylist(), strict=True))
        n = docs.num_rows
        if not n:
            return _RESULT.empty_table()
        content = Block(docs.column("text").combine_chunks())
        anyone = np.zeros(n, bool)
        sums, known = [], np.zeros(n, np.int64)
        for words, parts, bucket_of in ((True, content.word_parts, word_bucket), (False, content.run_parts, run_bucket)):
            keys, _ = Block.distinct(parts(), anyone)
            value = np.zeros(len(keys))
            for b, at in by_bucket(keys, bucket_of(keys, buckets)).items():
                value[at] = unpack(by[b]).astype(np.float64) if words else np.frombuffer(by[b], np.float32)
            total = np.zeros(n)
            for part, doc in parts():
                got = value[np.searchsorted(keys, part)]
                if words:
                    known += np.bincount(doc, got > 0, n).astype(np.int64)
                    got = np.log10(got + 1)
                total += np.bincount(doc, got, n)
            sums.append(total)
        return pa.table({"doc_id": docs.column("doc_id"), "train": docs.column("train"),
                         "words": np.diff(content.words.first), "known": known, "base": sums[0], "score": sums[1]}).cast(_RESULT)
    return run


_RESULT = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("words", pa.int64()), ("known", pa.int64()),
                     ("base", pa.float64()), ("score", pa.float64())])


def score_documents(docs: DataFrame, held_out, scratch: Scratch) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every row; held_out is a column, true for rows not learnt from."""
    spark = docs.sparkSession
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out).alias("train"), body.alias("text"))
    volume, trained = rows.agg(F.sum(F.octet_length("text")), F.sum(F.col("train").cast("long"))).first()
    trained = trained or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (volume or 0) // BUCKET_BYTES + 1)
    read = scratch.cut(rows.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(_reader(buckets), _SCHEMA))
    shares = read.where(F.col("kind") == SHARE).select("block", "bucket", "keys", "counts")
    low = read.where(F.col("kind") == LOW).select("keys", "counts")
    # merged where they are, then in about sqrt(tasks) tasks, then in one
    for tasks in (None, max(1, int(math.sqrt(buckets))), 1):
        low = (low.repartition(tasks) if tasks else low).mapInArrow(_merge_low, "keys binary, counts binary")
    merged = low.collect()
    keys, counts = merge_counts([unpack_sorted(r["keys"]) for r in merged], [unpack(r.counts).astype(np.int64) for r in merged])
    answers = scratch.cut(shares.groupBy("bucket").applyInArrow(
        _resolver(buckets, (keys, counts)), "block long, bucket int, answers binary, n long, v long"))
    n, v = answers.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    tokens, kinds = n + trained, v + (trained > 0)
    scored = (read.where(F.col("kind") == DOC).select("block", "doc_id", "train", "text").groupBy("block")
              .cogroup(answers.select("block", "bucket", "answers").groupBy("block"))
              .applyInArrow(_scorer(buckets), "doc_id long, train boolean, words long, known long, base double, score double"))
    n_tokens = F.col("words") + 1
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), n_tokens.alias("n_tokens"),
        (F.col("known") + int(trained > 0)).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(trained + 1) - n_tokens * math.log10(tokens + kinds + 1)).alias("base_score"), "score")


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base score and PPM score of every document."""
    from shelfwise.llm.toxicity import crc_fold
    jobs.prepare(spark)
    scratch = Scratch(spark, "ppm")
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        return jobs.finish(score_documents(docs, crc_fold("doc_id", 7) == 2, scratch), scratch)
    finally:
        scratch.close()
