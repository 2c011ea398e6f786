"""Corpus pipeline: documents in, tokenized documents out.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept, and returns a DataFrame that is written as Parquet and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bpe, decontaminate, jobs, ngram_join, pii, text, toxicity
from shelfwise.operators.lineage import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at or above the threshold of their language go."""
    jobs.prepare(spark)
    net = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score(docs, net) < toxicity.threshold(net))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents linked by a 5-word Jaccard >= 0.8, one row
    of the smallest doc_id stays. Texts without words are no copies."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "near")
    try:
        found = ngram_join.similar_classes(docs, scratch).where("n_links > 0").select("doc_id", "same", "first")
        linked = jobs.finish(found, scratch)
    finally:
        scratch.close()
    return ngram_join.keep_first(docs, linked)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item of five words or more go (a run
    of fewer is no reason to drop a document)."""
    jobs.prepare(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return docs.where(F.size(decontaminate.items_in(docs, items, text.SHINGLE)) == 0)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in each text is replaced by its kind in angle brackets;
    n_chars counts the new text. Texts without any (nulls too) stay as they are."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "personal")
    try:
        weights = pii.fit(scratch.cut(pii.candidates(docs.select("text")).select("pii_spans")))
    finally:
        scratch.close()
    prefix = "pii_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    found = pii.settle(pii.candidates(docs, prefix=prefix), weights, prefix + "spans", prefix + "all")
    spans = F.col(prefix + "all")
    some = F.size(spans) > 0
    clear = F.when(some, pii.redacted(F.col("text"), spans)).otherwise(F.col("text"))
    changed = {"text": clear}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(some, F.length(clear)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.withColumns(changed).select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its ids by the BPE automaton, their number, and the
    digests of ids and decoded text."""
    jobs.prepare(spark)
    return bpe.tokenized(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", redact_personal),
    ("tokenize", tokenize),
]

#: No stage's model, banding or automaton can be written in SQL; the tests
#: hold each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the session's
    checkpoint folder and read again. The last one is returned from there."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    try:
        for _, stage in STAGES[:-1]:
            docs = scratch.cut(stage(spark, docs, sf_dir))
        return jobs.finish(STAGES[-1][1](spark, docs, sf_dir), scratch)
    finally:
        scratch.close()
