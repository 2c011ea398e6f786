"""Result-mart job (A6, A7): build the base panel once, fit the models it
needs, and write the ten small result files a viewer reads.

The base panel (gross price, store size, all focus categories) is
persisted once and reused by every mart, and the two models with effects share
one absorption; the reference rebuilds the panel for each analysis.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import columns as C
from shelfwise.operators import describe, models, optimize, panels, response
from shelfwise.session import ensure_checkpoint_dir
from shelfwise.sources import sinks

PARQUET_MARTS = ["weekly_trends", "price_by_promo", "store_size_curve", "discount_depth_curve"]
RECORD_MARTS = ["elasticity_comparison", "promo_uplift", "optimal_discount_table",
                "optimization_scenarios"]
OBJECT_MARTS = ["store_targeting_scenario", "summary"]
ALL_MARTS = PARQUET_MARTS + RECORD_MARTS + OBJECT_MARTS

# The decimals each mart publishes (B17), half to even.
DECIMALS = {
    "promo_uplift": {"pct_lift": 1, "p_value": 4},
    "optimal_discount_table": {"combined_slope_k": 3, "model_optimal_discount_pct": 1,
                               "current_avg_discount_pct": 1},
    "optimization_scenarios": {"actual_revenue": 0, "scenario_revenue": 0, "delta": 0, "pct_change": 1},
    "store_targeting_scenario": {"current_avg_size": 3, "top_tercile_avg_size": 3, "actual_revenue": 0,
                                 "scenario_revenue": 0, "delta": 0, "pct_change": 1},
    "summary": {"pct_opportunity_vs_promo_revenue": 1, "pct_opportunity_vs_total_category_revenue": 1},
}


def published(df: DataFrame, mart: str) -> DataFrame:
    """The mart's columns at its published decimals."""
    return df.withColumns({c: F.bround(c, d) for c, d in DECIMALS.get(mart, {}).items()})


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def base_panel(txn: DataFrame, products: DataFrame, promos: DataFrame, categories) -> DataFrame:
    return panels.with_store_size(panels.gross_panel(txn, products, promos, categories),
                                  panels.store_size(txn))


def build_marts(spark: SparkSession, txn: DataFrame, products: DataFrame, promos: DataFrame,
                categories, out_dir: str, which=None) -> dict[str, str]:
    """Write the selected marts (all by default) under out_dir."""
    which = set(which or ALL_MARTS)
    panel = base_panel(txn, products, promos, categories).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _write_marts(spark, panel, categories, out_dir, which)
    finally:
        panel.unpersist()


def _write_marts(spark: SparkSession, panel: DataFrame, categories, out_dir: str, which: set) -> dict[str, str]:
    out: dict[str, str] = {}

    def path(name, ext):
        out[name] = f"{out_dir}/{name}.{ext}"
        return out[name]

    if "weekly_trends" in which:
        sinks.write_parquet_mart(describe.weekly_trend(panel, "net_unit_price"),
                                 path("weekly_trends", "parquet"))
    if "price_by_promo" in which:
        extract = panel.select("product_category", "is_promo",
                               F.col("net_unit_price").alias("unit_price"))
        extract.write.mode("overwrite").parquet(path("price_by_promo", "parquet"))
    needs_fixed = which & {"elasticity_comparison", "promo_uplift"}
    needs_unified = which & {"store_size_curve", "discount_depth_curve", "optimal_discount_table",
                             "optimization_scenarios", "store_targeting_scenario", "summary"}
    if needs_fixed and needs_unified:
        found = models.mart_models(panel)
        fixed, coefs = found["fixed"], found["unified"]
    else:
        fixed = models.fe_ols(panel, models.MART_FORMULA) if needs_fixed else None
        coefs = models.unified_model(panel) if needs_unified else None
    if "elasticity_comparison" in which:
        naive = models.naive_ols(panel, models.MART_FORMULA)
        sinks.write_json_records(models.elasticity_comparison(naive, fixed, "log_net_price"),
                                 path("elasticity_comparison", "json"))
    if "promo_uplift" in which:
        sinks.write_json_records(published(models.promo_uplift(fixed).drop("z"), "promo_uplift"),
                                 path("promo_uplift", "json"))
    if needs_unified:
        if "store_size_curve" in which:
            sinks.write_parquet_mart(response.lift_by_store_size(panel, coefs, 40).drop("point"),
                                     path("store_size_curve", "parquet"))
        if "discount_depth_curve" in which:
            sinks.write_parquet_mart(response.lift_by_discount(coefs, spark, 40, 0.5).drop("point"),
                                     path("discount_depth_curve", "parquet"))
        if "optimal_discount_table" in which:
            sinks.write_json_records(published(optimize.optimal_discount(panel, coefs), "optimal_discount_table"),
                                     path("optimal_discount_table", "json"))
        # the published totals add up the published (rounded) scenario rows
        scen = None
        if which & {"optimization_scenarios", "summary"}:
            scen = published(optimize.revenue_scenarios(panel, coefs, optimize.programs_frame(spark, list(categories))),
                             "optimization_scenarios").drop("promo_type", "n_cells")
        if "optimization_scenarios" in which:
            sinks.write_json_records(scen, path("optimization_scenarios", "json"))
        if "store_targeting_scenario" in which:
            sinks.write_json_object(published(optimize.store_targeting(panel, coefs, list(categories)[0]),
                                              "store_targeting_scenario"), path("store_targeting_scenario", "json"))
        if "summary" in which:
            names = F.array(*[C.title_label(F.lit(c)) for c in categories])
            sinks.write_json_object(published(optimize.overview_summary(panel, scen), "summary").withColumn(
                "categories", names), path("summary", "json"))
    return out
