"""Readers (A1, A2, A3, A8).

Raw files are read with explicit schemas so identifiers stay strings
(inference would make them integers) and no inference pass runs.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfwise.sources import schemas


def read_parquet(spark: SparkSession, path: str, columns=None,
                 schema: T.StructType | None = None) -> DataFrame:
    """A1: parquet scan with a column list (pruned at the scan)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_raw(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Read one raw source table with its declared schema."""
    schema = schemas.RAW[table]
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).parquet(path)


def csv_to_parquet(spark: SparkSession, src: str, out: str, schema: T.StructType,
                   mode: str = "overwrite") -> str:
    """A2: CSV with header -> parquet, streamed partition by partition
    (never materialised in one process). ``mode='ignore'`` skips work when
    the output exists (A5)."""
    spark.read.schema(schema).option("header", True).csv(src).write.mode(mode).parquet(out)
    return out


def write_raw_tables(tables: dict[str, DataFrame], out_dir: str, mode: str = "ignore") -> dict:
    """A3 + A5: one parquet folder per source table; existing outputs are
    kept (skip work) unless mode='overwrite'."""
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir}/{name}"
        df.write.mode(mode).parquet(path)
        paths[name] = path
    return paths


def read_mart_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet mart read-back."""
    return spark.read.parquet(path)


def read_mart_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON mart read-back (records array or single object files)."""
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def json_object(spark: SparkSession, path: str) -> dict:
    """A8 for one-object marts: the single (small) record as a dict."""
    row = read_mart_json(spark, path).first()
    return json.loads(json.dumps(row.asDict(recursive=True))) if row else {}


def select_category(mart: DataFrame, category: str, column: str = "category") -> DataFrame:
    """B21 (with B16): a viewer page's category filter on a mart; labels are
    title-cased in marts, so compare upper-cased."""
    from pyspark.sql import functions as F
    return mart.filter(F.upper(F.col(column)) == category.upper())


# Display names of the optimal-discount table.
OPTIMAL_DISCOUNT_DISPLAY = {
    "category": "Category",
    "promo_type": "Promo type",
    "combined_slope_k": "Combined slope",
    "model_optimal_discount_pct": "Model optimal discount, percent",
    "current_avg_discount_pct": "Current average discount, percent",
}


def display_optimal_discount(mart: DataFrame) -> DataFrame:
    """Rename the optimal-discount mart's columns for display."""
    return mart.withColumnsRenamed(OPTIMAL_DISCOUNT_DISPLAY)
