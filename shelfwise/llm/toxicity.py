"""Toxicity: a convolutional text classifier trained in numpy.

A word is the concatenation of three hashed embeddings (whole word, first 5
and first 7 bytes). Filters of widths 1, 2 and 3 run over the words of the
whole text, each is max-pooled, and a logistic layer reads the pooled
values. Training uses a bounded sample of labelled rows on the driver;
scoring is one Arrow pass over the whole table without a shuffle. Scores are
calibrated on all labelled rows of fold 1, at their own class shares, from
counts by language, label and bin of the logit.

Defined results: null and empty texts have no windows, so their pooled
values are 0 and they get the score of the output bias. Rows with null or
repeated doc_id are scored like all others. Labels with null doc_id or null
toxic are not used; of several labels of one document the larger counts.
With no usable positive or negative label every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jobs, text

BUCKETS = 1 << 16
PREFIXES = (5, 7)
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 12
#: Bounds of the training sample: rows of each label, and bytes of their texts.
MAX_POSITIVE, MAX_NEGATIVE, MAX_BYTES = 3000, 6000, 32_000_000
#: Bins of a unit of the logit, and the logit beyond which all are one bin.
BINS, MOST_LOGIT = 256, 60


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids, shape (words, 3), limits by document)."""
    w = text.words_of(texts)
    kinds = [w.hash]
    for n in PREFIXES:
        kinds.append(text.range_hashes(w.data, w.start, np.minimum(w.end, w.start + n)) if len(w.start) else w.hash)
    ids = np.stack([((k >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int32) for k in kinds], 1)
    return ids, w.first


@dataclass
class Network:
    tables: np.ndarray            # (3, BUCKETS, DIM)
    filters: list[np.ndarray]     # by width: (width, 3 * DIM, FILTERS)
    shift: np.ndarray             # (len(WIDTHS) * FILTERS,)
    out: np.ndarray
    bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    constant: bool = False

    @staticmethod
    def fresh(seed: int = 7) -> "Network":
        rng = np.random.default_rng(seed)
        wide = (1 + len(PREFIXES)) * DIM
        return Network(
            rng.normal(0, 0.02, (1 + len(PREFIXES), BUCKETS, DIM)).astype(np.float32),
            [rng.normal(0, (w * wide) ** -0.5, (w, wide, FILTERS)).astype(np.float32) for w in WIDTHS],
            np.zeros(len(WIDTHS) * FILTERS, np.float32),
            rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)

    def embed(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate([self.tables[k][ids[:, k]] for k in range(ids.shape[1])], 1)

    def responses(self, words: np.ndarray, width: int) -> np.ndarray:
        """Filter values at every window start (words - width + 1 rows)."""
        f = self.filters[WIDTHS.index(width)]
        n = len(words) - width + 1
        return sum(words[k:k + n] @ f[k] for k in range(width))

    def pooled(self, ids: np.ndarray, first: np.ndarray, chunk: int = 1 << 15) -> np.ndarray:
        """Max-pooled filter values by document, no less than 0."""
        docs = len(first) - 1
        out = np.zeros((docs, len(self.out)), np.float32)
        owner = np.repeat(np.arange(docs), np.diff(first))
        total = len(owner)
        for at in range(0, total, chunk):
            words = self.embed(ids[at:at + chunk + max(WIDTHS) - 1])
            for j, width in enumerate(WIDTHS):
                n = min(chunk, len(words) - width + 1)
                if n <= 0:
                    continue
                # the last windows of a text would run into the next one
                mine = owner[at:at + n]
                ok = np.flatnonzero(first[1:][mine] - np.arange(at, at + n) >= width)
                if not len(ok):
                    continue
                cols = slice(j * FILTERS, (j + 1) * FILTERS)
                values = (self.responses(words[:n + width - 1], width) + self.shift[cols])[ok]
                mine = mine[ok]
                begin = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                best = np.maximum.reduceat(values, begin, axis=0)
                out[mine[begin], cols] = np.maximum(out[mine[begin], cols], best)
        return out

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(ids, first).astype(np.float64) @ self.out.astype(np.float64) + self.bias

    def scores(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant:
            return np.zeros(len(first) - 1)
        return self.scaled(self.logits(ids, first))

    def scaled(self, logits: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * logits + b, -60, 60)))


def train(docs: list[np.ndarray], labels: np.ndarray, epochs: int = 6, batch: int = 32, rate: float = 0.08,
          seed: int = 7) -> Network:
    """Fit by Adagrad on the logistic loss; the max pool sends each gradient
    to the one window that won. Positive rows weigh as much as negative ones."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    grown = {id_: np.full_like(a, 1e-3) for id_, a in (("t", net.tables), ("s", net.shift), ("o", net.out))}
    grown["f"] = [np.full_like(f, 1e-3) for f in net.filters]
    grown["b"] = 1e-3
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum())) * len(labels)
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            ids = np.concatenate([docs[i] for i in rows])
            first = np.concatenate([[0], np.cumsum([len(docs[i]) for i in rows])])
            words = net.embed(ids)
            pool = np.zeros((len(rows), len(net.out)), np.float32)
            where = np.full((len(rows), len(net.out)), -1)
            for j, width in enumerate(WIDTHS):
                if len(words) < width:
                    continue
                cols = slice(j * FILTERS, (j + 1) * FILTERS)
                values = net.responses(words, width) + net.shift[cols]
                for d in range(len(rows)):
                    a, b = first[d], first[d + 1] - width + 1
                    if b > a:
                        best = values[a:b].argmax(0)
                        top = values[a:b][best, np.arange(FILTERS)]
                        pool[d, cols] = np.maximum(top, 0)
                        where[d, cols] = np.where(top > 0, best + a, -1)
            keep = (rng.random(pool.shape) < 0.8).astype(np.float32) / 0.8   # dropout
            p = 1 / (1 + np.exp(-np.clip((pool * keep) @ net.out + net.bias, -30, 30)))
            g = ((p - labels[rows]) * weight[rows] / len(rows)).astype(np.float32)
            g_pool = np.outer(g, net.out) * keep * (where >= 0)
            g_out = (pool * keep).T @ g + 1e-4 * net.out
            g_words = {}
            d_at, f_at = np.nonzero(where >= 0)
            touched, grads = [], []
            for j, width in enumerate(WIDTHS):
                pick = (f_at >= j * FILTERS) & (f_at < (j + 1) * FILTERS)
                f, pos = f_at[pick] - j * FILTERS, where[d_at[pick], f_at[pick]]
                amount = g_pool[d_at[pick], f_at[pick]]
                g_f = np.zeros_like(net.filters[j])
                for k in range(width):
                    step = np.zeros((FILTERS, words.shape[1]), np.float32)
                    np.add.at(step, f, amount[:, None] * words[pos + k])
                    g_f[k] = step.T
                    touched.append(pos + k)
                    grads.append(amount[:, None] * net.filters[j][k][:, f].T)
                g_f += 1e-4 * net.filters[j]
                grown["f"][j] += g_f ** 2
                net.filters[j] -= rate * g_f / np.sqrt(grown["f"][j])
            g_shift = g_pool.sum(0)
            for name, a, ga in (("s", net.shift, g_shift), ("o", net.out, g_out)):
                grown[name] += ga ** 2
                a -= rate * ga / np.sqrt(grown[name])
            grown["b"] += float(g.sum()) ** 2
            net.bias -= rate * float(g.sum()) / grown["b"] ** 0.5
            touched, grads = np.concatenate(touched), np.concatenate(grads)
            for k in range(ids.shape[1]):
                rows_k, back = np.unique(ids[touched, k], return_inverse=True)
                g_k = np.zeros((len(rows_k), DIM), np.float32)
                np.add.at(g_k, back, grads[:, k * DIM:(k + 1) * DIM])
                grown["t"][k][rows_k] += g_k ** 2
                net.tables[k][rows_k] -= rate * g_k / np.sqrt(grown["t"][k][rows_k])
    return net


def calibrate(net: Network, bins: np.ndarray, n: np.ndarray, hits: np.ndarray, langs: np.ndarray, least: int = 20) -> None:
    """A threshold for each language, the one of best F1 on the calibration
    rows (midway between the neighbouring bins): n rows, of them hits toxic, by
    bin and language. Languages with fewer than ``least`` rows of either label
    take the threshold of all rows ("")."""
    def best(mine: np.ndarray) -> float:
        down, back = np.unique(-bins[mine], return_inverse=True)
        y = np.bincount(back, hits[mine])
        f1 = 2 * np.cumsum(y) / (np.cumsum(np.bincount(back, n[mine])) + y.sum())
        k = int(np.argmax(f1))
        low = net.scaled(-down[k] / BINS)
        below = net.scaled((1 - down[k + 1]) / BINS) if k + 1 < len(down) else 0.0
        return float((low + below) / 2)
    net.thresholds = {"": best(np.ones(len(bins), bool)) if 0 < hits.sum() < n.sum() else 0.5}
    for lang in np.unique(langs):
        mine = langs == lang
        if min(hits[mine].sum(), (n - hits)[mine].sum()) >= least:
            net.thresholds[str(lang)] = best(mine)


def platt(net: Network, logits: np.ndarray, n: np.ndarray, hits: np.ndarray) -> None:
    """Slope and shift of the logits by Newton steps on counts of calibration
    rows, with a weak prior, so that 0.5 is the even point."""
    def loss(a: float, b: float) -> float:
        z = a * logits + b
        return (n * np.logaddexp(0, z) - hits * z).sum() + (a - 1.0) ** 2 / 2 + 0.05 * b * b

    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -500, 500)))
        w = n * np.maximum(p * (1 - p), 1e-9)
        off = n * p - hits
        g = np.array([(off * logits).sum() + (a - 1.0), off.sum() + 0.1 * b])
        h = np.array([[(w * logits ** 2).sum() + 1.0, (w * logits).sum()], [(w * logits).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        # halved until the loss falls: far from the end a full step can overshoot
        while np.abs(step).max() >= 1e-8 and loss(a - step[0], b - step[1]) > loss(a, b):
            step /= 2
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    if a > 0:
        net.scale = (float(a), float(b))


def _ids_batches(batches):
    for batch in text.portions(batches):
        ids, first = word_ids(batch.column("text"))
        yield pa.RecordBatch.from_arrays([
            batch.column("label"), batch.column("fold"), batch.column("lang"),
            pa.array([ids[first[d]:first[d + 1]].tobytes() for d in range(batch.num_rows)], pa.binary())],
            ["label", "fold", "lang", "ids"])


def crc_fold(column: str, parts: int):
    """crc32 of the id written as text, by parts (null id: empty text)."""
    return (F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts).cast("int")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold_parts: int = 5,
        max_positive: int = MAX_POSITIVE, max_negative: int = MAX_NEGATIVE, max_bytes: int = MAX_BYTES) -> Network:
    """Train and calibrate on labelled rows whose crc fold is not 0. Training
    rows are the first by hash of their id within the documented bounds (one that
    does not fit is passed over) and not of fold 1, all of which calibrate. If a
    label is missing on either side, all rows serve there."""
    rated = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
             .withColumn("fold", crc_fold("doc_id", fold_parts)).where("fold <> 0"))
    # all rows of an id come with it
    sized = (docs.where("doc_id is not null").select("doc_id", F.octet_length("text").alias("bytes")).join(rated, "doc_id")
             .groupBy("doc_id", "label", "fold").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")))
    picked = []
    for value, most in ((1, max_positive), (0, max_negative)):
        mine = sized.where(F.col("label") == value)
        apart = mine.where("fold <> 1")
        mine = mine if apart.isEmpty() else apart
        # the first by hash that fit; if none does, the shortest alone
        ranked = (mine.where(F.col("bytes") <= max_bytes // 2).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
                  or mine.orderBy("bytes", "doc_id").limit(1).collect())
        total = 0
        for i, r in enumerate(ranked):
            if i and total + r.bytes > max_bytes // 2:
                continue
            total += r.bytes
            picked.append((r.doc_id, r.label, r.fold))
    net = Network.fresh()
    net.constant = not {0, 1} <= {p[1] for p in picked}
    net.thresholds = {"": 0.5}
    if net.constant:
        return net
    spark = docs.sparkSession
    chosen = spark.createDataFrame(picked, "doc_id long, label int, fold int")
    rows = (docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"))
            .join(F.broadcast(chosen), "doc_id").select("label", "fold", "lang", "text")
            .mapInArrow(_ids_batches, "label int, fold int, lang string, ids binary").collect())
    rows.sort(key=lambda r: (r.label, r.fold, r.lang, r.ids))
    net = train([np.frombuffer(r.ids, np.int32).reshape(-1, 1 + len(PREFIXES)) for r in rows],
                np.array([r.label for r in rows], np.float32))
    counts = _counts(docs, rated.where("fold = 1"), net, fold_parts)
    if not {0, 1} <= {r.label for r in counts}:
        counts = _counts(docs, rated, net, fold_parts)
    bins, n, y = (np.array([r[k] for r in counts], np.int64) for k in ("bin", "n", "label"))
    platt(net, (bins + 0.5) / BINS, n, n * y)
    calibrate(net, bins, n, n * y, np.array([r.lang for r in counts]))
    return net


def _counts(docs: DataFrame, rated: DataFrame, net: Network, fold_parts: int) -> list:
    """Rows of rated documents by (lang, bin of the logit, label). Texts are
    read where they are; only ids and bins meet the labels."""
    folds = [r.fold for r in rated.select("fold").distinct().collect()]
    most = MOST_LOGIT * BINS
    logit = scorer(docs.sparkSession, net, raw=True)(F.col("text").cast("string"))
    binned = (docs.where(F.col("doc_id").isNotNull() & crc_fold("doc_id", fold_parts).isin(folds))
              .select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"),
                      F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(logit * BINS))).cast("int").alias("bin")))
    return (binned.join(rated, "doc_id").groupBy("lang", "bin", "label").agg(F.count("*").alias("n"))
            .orderBy("lang", "bin", "label").collect())


def scorer(spark: SparkSession, net: Network, raw: bool = False):
    """Column function: the score of a whole text (``raw``: its logit)."""
    shared = spark.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        rate = shared.value.logits if raw else shared.value.scores
        parts = [rate(*word_ids(texts[a:b])) for a, b in text.cuts_of(texts)]
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return scores


def threshold(net: Network):
    """Column: the calibrated threshold of the row's language."""
    cut = F.lit(net.thresholds.get("", 0.5))
    for lang, t in sorted(net.thresholds.items()):
        if lang:
            cut = F.when(F.coalesce("lang", F.lit("")) == lang, F.lit(t)).otherwise(cut)
    return cut


def score(docs: DataFrame, net: Network):
    """Column: the score, which reads the text alone."""
    return scorer(docs.sparkSession, net)(F.col("text").cast("string"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document: doc_id, held_out, score, predicted, and the
    calibrated threshold of its language with the decision by it."""
    jobs.prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    net = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rated = docs.select("doc_id", score(docs, net).alias("score"), threshold(net).alias("threshold"))
    return rated.select(
        "doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold",
        (F.col("score") >= F.col("threshold")).alias("rejected"))
