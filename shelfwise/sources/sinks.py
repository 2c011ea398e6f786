"""Sinks for result marts.

Marts are small (tens to thousands of rows), so each is written as one
file. JSON marts come in the two shapes the viewer reads: a records array
(one file holding ``[{...}, ...]``) or a single object.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RECORDS = 100_000


def write_parquet_mart(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A6."""
    df.repartition(1).write.mode(mode).parquet(path)
    return path


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A7 records-array form: to_json(collect_list(struct(*))) then one text
    file. Raises for more than MAX_RECORDS rows: the array is one value."""
    if df.limit(MAX_RECORDS + 1).count() > MAX_RECORDS:
        raise ValueError(f"a records mart has at most {MAX_RECORDS} rows")
    arr = df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    arr.write.mode(mode).text(path)
    return path


def write_json_object(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A7 single-object form for one-row marts."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")) \
        .repartition(1).write.mode(mode).text(path)
    return path
