"""A small table of difficult documents, and the plain words of a text."""

import re

from pyspark.sql import types as T

BASE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, BASE, "en", "a", 84),
    (2, BASE, "en", "a", 84),                       # exact copy
    (2, BASE, "en", "a", 84),                       # repeated row
    (3, None, "en", None, None),                    # null text
    (4, "", None, "b", 0),                          # empty text, null language
    (None, BASE + " again", "en", "b", 90),         # null id
    (5, "too short", "en", "b", 9),
    (6, LONG, "de", "c", len(LONG)),                # very long text
    (7, LONG + " end", "de", "c", len(LONG) + 4),   # its near copy
    (8, "   \n\t ", "fr", "c", 6),                  # white space only
    (9, "Écrivez à jean.dupont@example.org ou +33 1 42 68 53 00, 192.168.1.20.", "fr", "c", 70),
    (10, "<|endoftext|> x <|endoftext|>", "en", "c", 30),
]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
#: Names that operators use inside.
CLASHING = ("score", "threshold", "shard", "slot", "hilbert", "node", "root", "bucket", "pii_spans", "items", "at", "h", "n",
            "bytes", "class_id", "label", "fold", "part", "block")


def table(spark, rows=ROWS, extra=True):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in CLASHING:
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("own"))
    return df


def folder(spark, tmp_path, rows=ROWS, extra=True):
    """The rows as documents.parquet with labels, benchmark and embeddings."""
    from pyspark.sql import functions as F
    path = str(tmp_path / "data")
    table(spark, rows, extra).coalesce(1).write.parquet(f"{path}/documents.parquet")
    labels = [(1, 1, 0), (2, 0, 1), (5, None, None), (None, 1, 1), (9, 1, 0), (7, 0, 1)] if rows else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("score", F.lit(1)).write.parquet(
        f"{path}/labels.parquet")
    items = [(1, BASE), (2, None), (3, ""), (None, BASE), (4, "one two"), (1, BASE)] if rows else []
    spark.createDataFrame(items, "item_id long, text string").withColumn("own", F.lit(1)).write.parquet(f"{path}/benchmark.parquet")
    vectors = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (101, [0.0, 1.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
               (6, [0.0, 0.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [float("inf"), 1.0]), (9, []), (10, [1.0, 0.1])]
    labelled = [(i, v, None if i == 101 else (i or 0) % 2) for i, v in vectors] if rows else []
    spark.createDataFrame(labelled, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit(1)).withColumn(
        "slice", F.lit("own")).write.parquet(
        f"{path}/embeddings.parquet")
    return path


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
