"""Join helpers: size-checked broadcast and the promotion attach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Row bound under which a dimension-like side is broadcast. Sides above it
# are left to the planner (sort-merge / shuffled hash, AQE may still convert
# at runtime from measured sizes).
BROADCAST_MAX_ROWS = 2_000_000
# Byte budget for a broadcast side (rows x estimated row width).
BROADCAST_MAX_BYTES = 128 * 1024 * 1024
# The same for a dimension that a shuffle may join as well: it passes the driver.
DIMENSION_MAX_BYTES = 32 * 1024 * 1024


def _width(dt: T.DataType) -> int:
    if isinstance(dt, (T.BooleanType, T.ByteType)):
        return 1
    if isinstance(dt, (T.IntegerType, T.DateType, T.FloatType, T.ShortType)):
        return 4
    if isinstance(dt, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    return 32   # strings and the rest: a generous estimate


def row_bound(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
              max_bytes: int = BROADCAST_MAX_BYTES) -> int:
    """Largest row count that fits both budgets for df's row width."""
    width = sum(_width(f.dataType) for f in df.schema.fields) + 16
    return max(1, min(max_rows, max_bytes // width))


PROMO_KEYS = ["product_id", "store_id", "week"]


def bounded(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when df has at most max_rows rows (default: the row/byte budget
    for its width); stops reading at max_rows+1."""
    n = row_bound(df, max_bytes=DIMENSION_MAX_BYTES) if max_rows is None else max_rows
    return df.limit(n + 1).count() <= n


def broadcast_checked(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Broadcast hint only behind a size check."""
    return F.broadcast(df) if bounded(df, max_rows) else df


def attach_promotions(cells: DataFrame, promotions: DataFrame, keys=PROMO_KEYS,
                      dedupe: bool = False, products: DataFrame | None = None) -> DataFrame:
    """Left join promotion flags on (product, store, week); miss -> 0.

    ``products`` (optional) semi-reduces the promotion table to the products
    the cells can match before the shuffle. ``dedupe`` collapses duplicated
    promotion keys to the max flag (trap T1); off by default to keep plain
    left-join semantics.
    """
    promo = promotions.select(*keys, "is_displayed", "is_mailed")
    if products is not None:
        # a broadcast keeps the promotions' own partitioning (a stored one too)
        promo = promo.join(broadcast_checked(products.select("product_id")), "product_id", "left_semi")
    if dedupe:
        promo = promo.groupBy(*keys).agg(F.max("is_displayed").alias("is_displayed"),
                                         F.max("is_mailed").alias("is_mailed"))
    joined = cells.join(promo, list(keys), "left")
    return (joined
            .withColumn("is_displayed", F.coalesce(F.col("is_displayed"), F.lit(0)))
            .withColumn("is_mailed", F.coalesce(F.col("is_mailed"), F.lit(0))))
