"""Discount optimisation and revenue scenarios.

All steps are joins of the (promoted) panel with the per-category
coefficient row (broadcast, one row per category) and grouped sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import columns as C
from shelfwise.operators import describe
from shelfwise.operators.joins import broadcast_checked
from shelfwise.operators.models import pivot_coefficients

CAT = "product_category"
PROMO_FLAGS = {"Display": "is_displayed", "Mailer": "is_mailed"}

# The four programs of the reference scenario table, in the
# reference's order (category position among the two focus categories,
# promotion type, target discount depth, label).
REFERENCE_PROGRAMS = [
    (0, "Mailer", 0.40, "Mailer to 40% discount"),
    (0, "Display", 0.0, "Display to 0% discount"),
    (1, "Display", 0.0, "Display to 0% discount"),
    (1, "Mailer", 0.0, "Mailer to 0% discount"),
]


def combined_slopes(coefs: DataFrame) -> DataFrame:
    """k = b_discount + b_promo:discount per category x promo type."""
    terms = ["discount_pct", "is_displayed:discount_pct", "is_mailed:discount_pct"]
    w = pivot_coefficients(coefs, terms)
    parts = [w.select(CAT, F.lit(label).alias("promo_type"),
                      (F.col("discount_pct") + F.col(f"{flag}:discount_pct")).alias("k"))
             for label, flag in PROMO_FLAGS.items()]
    return parts[0].unionByName(parts[1])


def optimal_depth(k):
    """H3: revenue (1-d) e^{kd} peaks at d* = 1 - 1/k when k > 1, else 0."""
    return F.when(k > 1, F.greatest(F.lit(0.0), 1 - 1 / k)).otherwise(F.lit(0.0))


def optimal_discount(panel: DataFrame, coefs: DataFrame) -> DataFrame:
    """H3 + H4 + D17: model optimum vs current mean depth (percent)."""
    cur = describe.current_discount(panel)
    return (combined_slopes(coefs).join(cur, [CAT, "promo_type"], "left")
            .select(C.title_label(CAT).alias("category"), "promo_type",
                    F.col("k").alias("combined_slope_k"),
                    (optimal_depth(F.col("k")) * 100).alias("model_optimal_discount_pct"),
                    (F.col("current_avg_discount") * 100).alias("current_avg_discount_pct")))


def programs_frame(spark, categories, programs=REFERENCE_PROGRAMS) -> DataFrame:
    rows = [(categories[ci], promo, float(target), label) for ci, promo, target, label in programs]
    return spark.createDataFrame(rows, f"{CAT} string, promo_type string, target double, "
                                       "change string")


def revenue_scenarios(panel: DataFrame, coefs: DataFrame, programs: DataFrame) -> DataFrame:
    """H5 + H6: per promoted cell, quantity at the target depth
    qty * exp((d_new - d) * k) at net price price * (1 - d_new); summed per
    program against actual sales. A cell both displayed and mailed counts in
    both programs (trap T5). All programs in one pass."""
    cells = describe.promo_long(panel.select(CAT, "quantity", "sales_value", "unit_price",
                                             "discount_pct", "is_displayed", "is_mailed"))
    k = combined_slopes(coefs)
    j = (cells.join(F.broadcast(programs), [CAT, "promo_type"])      # fixed program list
         .join(broadcast_checked(k), [CAT, "promo_type"]))
    new_rev = (F.col("unit_price") * (1 - F.col("target"))
               * F.col("quantity") * F.exp((F.col("target") - F.col("discount_pct")) * F.col("k")))
    agg = j.groupBy(CAT, "promo_type", "change").agg(
        F.sum("sales_value").alias("actual_revenue"), F.sum(new_rev).alias("scenario_revenue"),
        F.count(F.lit(1)).alias("n_cells"))
    return agg.select(C.title_label(CAT).alias("category"), "promo_type", "change",
                      "actual_revenue", "scenario_revenue",
                      (F.col("scenario_revenue") - F.col("actual_revenue")).alias("delta"),
                      ((F.col("scenario_revenue") - F.col("actual_revenue"))
                       / F.col("actual_revenue") * 100).alias("pct_change"), "n_cells")


def store_targeting(panel: DataFrame, coefs: DataFrame, category: str,
                    tercile: float = 2.0 / 3.0) -> DataFrame:
    """H7 + D20 + D21: move the mean centred size of displayed cells to the
    mean of the top size tercile of stores; revenue x exp(dsize * b_ds)."""
    cat = panel.filter(F.col(CAT) == category)
    disp = cat.filter(F.col("is_displayed") == 1).agg(
        F.avg("log_store_size_c").alias("current_avg_size"),
        F.sum("sales_value").alias("actual_revenue"))
    stores = cat.select("store_id", "log_store_size_c").dropDuplicates(["store_id"])
    cut = describe.quantiles(stores, "log_store_size_c", [tercile]).toDF("_cut")
    top = (stores.crossJoin(F.broadcast(cut)).filter(F.col("log_store_size_c") >= F.col("_cut"))
           .agg(F.avg("log_store_size_c").alias("top_tercile_avg_size")))
    b = (coefs.filter((F.col(CAT) == category)
                      & (F.col("term") == "is_displayed:log_store_size_c"))
         .select(F.col("coef").alias("_b")))
    scen = F.col("actual_revenue") * F.exp(
        (F.col("top_tercile_avg_size") - F.col("current_avg_size")) * F.col("_b"))
    return (disp.crossJoin(top).crossJoin(b)
            .select("current_avg_size", "top_tercile_avg_size", "actual_revenue",
                    scen.alias("scenario_revenue"),
                    (scen - F.col("actual_revenue")).alias("delta"),
                    ((scen / F.col("actual_revenue") - 1) * 100).alias("pct_change")))


def overview_summary(panel: DataFrame, scenarios: DataFrame) -> DataFrame:
    """H8 + D22 + D23: totals for the overview page (one row). Totals are
    published as whole numbers, cut off, and the category revenue is so before
    the opportunity is divided by it; scenario rows come as published."""
    per_cat = panel.groupBy(CAT, "product_id").agg(F.count(F.lit(1)).alias("_cells"), F.sum("sales_value").alias("_revenue"))
    tot = per_cat.agg(F.sum("_cells").alias("n_transactions"),
                      F.count(F.lit(1)).alias("n_products"),
                      F.sum("_revenue").cast("long").alias("total_category_revenue"))
    sc = scenarios.agg(F.sum("delta").alias("_delta"), F.sum("actual_revenue").alias("_actual"))
    return tot.crossJoin(sc).select(
        "n_transactions", "n_products", F.col("_delta").cast("long").alias("total_combined_delta"),
        F.col("_actual").cast("long").alias("total_promo_revenue"),
        (F.col("_delta") / F.col("_actual") * 100).alias("pct_opportunity_vs_promo_revenue"),
        "total_category_revenue",
        (F.col("_delta") / F.col("total_category_revenue") * 100)
        .alias("pct_opportunity_vs_total_category_revenue"))
