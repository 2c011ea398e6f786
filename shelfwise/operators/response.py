"""Response curves (H1, H2): predicted promotion lift over a grid.

The grid is ``spark.range(n)`` cross-joined with the per-category
coefficient row (C10); both sides are tiny and bounded by n x categories.
Grid points follow numpy's linspace (last point set to the stop value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import columns as C
from shelfwise.operators.describe import quantiles
from shelfwise.operators.joins import broadcast_checked
from shelfwise.operators.models import pivot_coefficients

CAT = "product_category"


def grid(spark: SparkSession, start: float, stop: float, n: int, name: str) -> DataFrame:
    """n evenly spaced points from start to stop."""
    s, e = float(start), float(stop)
    step = (e - s) / (n - 1)
    i = F.col("id")
    x = F.when(i == n - 1, F.lit(e)).otherwise(F.lit(s) + i.cast("double") * F.lit(step))
    return spark.range(n).select(i.cast("int").alias("point"), x.alias(name))


def lift_by_store_size(panel: DataFrame, coefs: DataFrame, n_points: int = 40,
                       lo_q: float = 0.05, hi_q: float = 0.95) -> DataFrame:
    """H1: display lift (exp(b_d + b_ds * s) - 1) * 100 over the lo..hi
    quantile range of centred log store size (panel rows, all categories)."""
    spark = panel.sparkSession
    q = quantiles(panel, "log_store_size_c", [lo_q, hi_q])
    lo, hi = q.columns
    pts = spark.range(n_points).select(F.col("id").cast("int").alias("point"))
    g = (pts.crossJoin(F.broadcast(q))
         .select("point", F.when(F.col("point") == n_points - 1, F.col(hi)).otherwise(
             F.col(lo) + F.col("point").cast("double")
             * ((F.col(hi) - F.col(lo)) / F.lit(float(n_points - 1)))).alias("log_store_size_c")))
    w = pivot_coefficients(coefs, ["is_displayed", "is_displayed:log_store_size_c"])
    return (g.crossJoin(broadcast_checked(w))
            .select(C.title_label(CAT).alias("category"), "point", "log_store_size_c",
                    ((F.exp(F.col("is_displayed") + F.col("is_displayed:log_store_size_c")
                            * F.col("log_store_size_c")) - 1) * 100).alias("predicted_lift_pct")))


def lift_by_discount(coefs: DataFrame, spark: SparkSession, n_points: int = 40,
                     max_depth: float = 0.5) -> DataFrame:
    """H2: display and mailer lift over discount depth 0..max_depth, depth
    reported in percent."""
    g = grid(spark, 0.0, max_depth, n_points, "depth")
    terms = ["is_displayed", "is_displayed:discount_pct", "is_mailed", "is_mailed:discount_pct"]
    w = pivot_coefficients(coefs, terms)
    cross = g.crossJoin(broadcast_checked(w))
    parts = []
    for flag, label in [("is_displayed", "Display"), ("is_mailed", "Mailer")]:
        parts.append(cross.select(
            C.title_label(CAT).alias("category"), "point",
            (F.col("depth") * 100).alias("discount_pct"), F.lit(label).alias("promo_type"),
            ((F.exp(F.col(flag) + F.col(f"{flag}:discount_pct") * F.col("depth")) - 1) * 100)
            .alias("predicted_lift_pct")))
    return parts[0].unionByName(parts[1])
