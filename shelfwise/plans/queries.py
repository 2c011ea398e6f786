"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the whole test tables through the binding, runs the
library operators and rounds doubles at the edge (6 dp) for comparison.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import columns as C

from shelfwise.operators import (campaigns, describe, lineage, models, optimize, panels, response,
                                 warehouse)
from shelfwise.plans import marts
from shelfwise.sources import readers, schemas
from shelfwise.streaming import ingest
from shelfwise.plans.context import FOCUS, MONEY, Context, rounded

CAT = "product_category"


def _ctx(spark: SparkSession, sf_dir: str) -> Context:
    return Context(spark, sf_dir)


# ---------------------------------------------------------------- step 1
def q_dim_product(spark, sf_dir):
    return _ctx(spark, sf_dir).products


def q_dim_household(spark, sf_dir):
    return _ctx(spark, sf_dir).households


def q_dim_campaign(spark, sf_dir):
    return _ctx(spark, sf_dir).table("dim_campaign")


def q_fact_transactions(spark, sf_dir):
    return rounded(_ctx(spark, sf_dir).txn)


def q_fact_promotions(spark, sf_dir):
    return _ctx(spark, sf_dir).promos


def q_row_counts(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    names = ["fact_transactions", "fact_promotions", "dim_product", "dim_household",
             "dim_campaign"]
    return warehouse.row_counts({n: ctx.table(n) for n in names})


def _closed(tag: str, spark: SparkSession, use) -> DataFrame:
    """use(scratch) as a checkpointed result, the scratch tables deleted."""
    scratch = lineage.Scratch(spark, tag)
    try:
        return use(scratch).checkpoint()
    finally:
        scratch.close()


# ---------------------------------------------------------------- step 2
def _lines(ctx: Context, categories=FOCUS) -> DataFrame:
    return panels.line_panel(ctx.txn, ctx.products, ctx.promos, categories)


def _on_lines(spark, sf_dir, columns, use, categories=FOCUS, overrides=None) -> DataFrame:
    """use(lines): the joins behind the line panel run once, and every use
    reads these columns (and the frequency) of its written copy."""
    def run(scratch):
        lines = scratch.cut(_lines(_ctx(spark, sf_dir), categories).select(CAT, *columns, "n_lines"))
        return rounded(use(lines), overrides=overrides)
    return _closed("lines", spark, run)


def q_category_summary(spark, sf_dir):
    return rounded(describe.category_summary(_lines(_ctx(spark, sf_dir))), overrides=MONEY)


def q_weekly_trend_lines(spark, sf_dir):
    return rounded(describe.weekly_trend(_lines(_ctx(spark, sf_dir))))


# ---------------------------------------------------------------- step 3
def _net(ctx: Context, categories=FOCUS) -> DataFrame:
    return panels.net_panel(ctx.txn, ctx.products, ctx.promos, categories)


def _gross(ctx: Context, categories=FOCUS) -> DataFrame:
    return panels.gross_panel(ctx.txn, ctx.products, ctx.promos, categories)


def _gross_sized(ctx: Context, categories=FOCUS) -> DataFrame:
    return panels.with_store_size(_gross(ctx, categories), panels.store_size(ctx.txn))


def _hh(ctx: Context, categories=FOCUS) -> DataFrame:
    return panels.household_panel(ctx.txn, ctx.products, ctx.promos, ctx.households, categories)


def q_panel_net(spark, sf_dir):
    return rounded(_net(_ctx(spark, sf_dir)))


def q_panel_household(spark, sf_dir):
    return rounded(_hh(_ctx(spark, sf_dir)).drop("income_rank"))


def q_panel_gross(spark, sf_dir):
    return rounded(_gross(_ctx(spark, sf_dir)))


def q_panel_gross_sized(spark, sf_dir):
    return rounded(_gross_sized(_ctx(spark, sf_dir)))


def q_store_size(spark, sf_dir):
    return panels.store_size(_ctx(spark, sf_dir).txn)


# ---------------------------------------------------------------- step 4
def q_category_screening(spark, sf_dir):
    # Over all categories, as the screening step that picks the focus pair.
    return _on_lines(spark, sf_dir, ["product_id", "unit_price", "quantity", "sales_value", "is_promo"],
                     describe.category_screening, None, MONEY)


def q_price_by_promo(spark, sf_dir):
    return _on_lines(spark, sf_dir, ["is_promo", "unit_price"], describe.price_by_promo)


def q_boxplot_by_promo(spark, sf_dir):
    return _on_lines(spark, sf_dir, ["is_promo", "unit_price"], lambda lines: describe.boxplot_stats(lines, "is_promo"))


def _top_store_list(lines: DataFrame, n: int = 15) -> DataFrame:
    return describe.top_stores(lines, FOCUS[0], n)


def q_boxplot_by_store(spark, sf_dir):
    def use(lines):
        sub = lines.join(_top_store_list(lines).select("store_id"), "store_id", "left_semi")
        return describe.boxplot_stats(sub, "store_id")
    return _on_lines(spark, sf_dir, ["store_id", "unit_price", "quantity"], use)


def q_within_product_std(spark, sf_dir):
    return _on_lines(spark, sf_dir, ["product_id", "unit_price"], describe.within_product_std)


def q_panel_coverage(spark, sf_dir):
    return describe.panel_coverage(_net(_ctx(spark, sf_dir)))


def q_income_group_sizes(spark, sf_dir):
    return describe.income_group_sizes(_hh(_ctx(spark, sf_dir)))


def q_top_stores(spark, sf_dir):
    return _top_store_list(_lines(_ctx(spark, sf_dir)))


def q_top_products(spark, sf_dir):
    return rounded(describe.top_products(_net(_ctx(spark, sf_dir)), 6))


def q_store_price_order(spark, sf_dir):
    return _on_lines(spark, sf_dir, ["store_id", "unit_price", "quantity"],
                     lambda lines: describe.store_price_order(lines, _top_store_list(lines)))


def q_ever_promoted_share(spark, sf_dir):
    return describe.ever_promoted_share(_lines(_ctx(spark, sf_dir)))


def q_current_discount(spark, sf_dir):
    return rounded(describe.current_discount(_gross(_ctx(spark, sf_dir))))


def q_discount_support(spark, sf_dir):
    return rounded(describe.discount_support(_gross(_ctx(spark, sf_dir)), 0.40))


def q_untreated_cells(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    cells = _net(ctx).select("product_id", "store_id", "week", CAT, "quantity")
    return rounded(panels.untreated_cells(cells, ctx.promos))


def q_weekly_trend_cells(spark, sf_dir):
    return rounded(describe.weekly_trend(_gross(_ctx(spark, sf_dir)), "net_unit_price"))


def q_promo_overlap(spark, sf_dir):
    return describe.promo_overlap(_gross(_ctx(spark, sf_dir)))


# ---------------------------------------------------------------- steps 5-8
def _net_sized(ctx: Context, categories=FOCUS) -> DataFrame:
    return panels.with_store_size(_net(ctx, categories), panels.store_size(ctx.txn))


#: What a fit of the mart formula reads of the panel.
MART_COLUMNS = [CAT, "product_id", "store_id", "week", "log_qty", "log_net_price", "is_displayed", "is_mailed"]


def _mart_fixed(ctx: Context) -> DataFrame:
    return models.fe_ols(_gross(ctx), models.MART_FORMULA)


def q_ols_naive(spark, sf_dir):
    return rounded(models.coefficient_view(models.naive_ols(_net(_ctx(spark, sf_dir)))))


def q_fe_elasticity(spark, sf_dir):
    return rounded(models.coefficient_view(models.fe_ols(_net(_ctx(spark, sf_dir)))))


def q_elasticity_comparison(spark, sf_dir):
    """G14; both fits read the panel's written copy."""
    def run(scratch):
        panel = scratch.cut(_gross(_ctx(spark, sf_dir)).select(*MART_COLUMNS))
        naive, fixed = models.naive_ols(panel, models.MART_FORMULA), models.fe_ols(panel, models.MART_FORMULA)
        return rounded(models.elasticity_comparison(naive, fixed, "log_net_price"))
    return _closed("panel", spark, run)


def q_promo_uplift(spark, sf_dir):
    return rounded(models.promo_uplift(_mart_fixed(_ctx(spark, sf_dir))))


def q_sku_elasticity(spark, sf_dir):
    """Per-SKU fits; in the binding the SKU unit is the brand within a
    category (a part key has too few cells)."""
    res = models.sku_elasticity(_net(_ctx(spark, sf_dir)), sku="brand", attrs=())
    return rounded(res.withColumnRenamed("brand", "sku"))


def q_fe_income(spark, sf_dir):
    return rounded(models.coefficient_view(models.income_model(_hh(_ctx(spark, sf_dir)))))


def q_fe_store_size(spark, sf_dir):
    return rounded(models.coefficient_view(
        models.store_size_model(_net_sized(_ctx(spark, sf_dir)))))


def q_fe_discount_depth(spark, sf_dir):
    return rounded(models.coefficient_view(
        models.discount_depth_model(_gross(_ctx(spark, sf_dir)))))


def q_fe_unified(spark, sf_dir):
    return rounded(models.coefficient_view(
        models.unified_model(_gross_sized(_ctx(spark, sf_dir)))))


# ---------------------------------------------------------------- step 9
REVENUE = {c: 2 for c in ("actual_revenue", "scenario_revenue", "delta", "total_combined_delta",
                          "total_promo_revenue", "total_category_revenue")}


def _on_unified(spark, sf_dir, use, overrides=None) -> DataFrame:
    """use(panel, coefficients): the panel is written once, and the fit and
    every use of its coefficients read this copy."""
    def run(scratch):
        panel = scratch.cut(_gross_sized(_ctx(spark, sf_dir)))
        return rounded(use(panel, models.unified_model(panel)), overrides=overrides)
    return _closed("panel", spark, run)


def q_lift_by_store_size(spark, sf_dir):
    return _on_unified(spark, sf_dir, lambda panel, coefs: response.lift_by_store_size(panel, coefs, 40))


def q_lift_by_discount(spark, sf_dir):
    return _on_unified(spark, sf_dir, lambda _, coefs: response.lift_by_discount(coefs, spark, 40, 0.5))


def q_optimal_discount(spark, sf_dir):
    return _on_unified(spark, sf_dir, optimize.optimal_discount)


def _scenarios(spark, panel, coefs):
    return optimize.revenue_scenarios(panel, coefs, optimize.programs_frame(spark, FOCUS))


def q_revenue_scenarios(spark, sf_dir):
    return _on_unified(spark, sf_dir, lambda panel, coefs: _scenarios(spark, panel, coefs), REVENUE)


def q_store_targeting(spark, sf_dir):
    return _on_unified(spark, sf_dir, lambda panel, coefs: optimize.store_targeting(panel, coefs, FOCUS[0]), REVENUE)


def q_overview_summary(spark, sf_dir):
    """H8 from published scenario rows."""
    return _on_unified(spark, sf_dir, lambda panel, coefs: optimize.overview_summary(
        panel, marts.published(_scenarios(spark, panel, coefs), "optimization_scenarios")))


def q_lift_by_store_size_notebook(spark, sf_dir):
    """H1 notebook variant: 50 points, store-size model (G5) on the
    net-price panel."""
    panel = _net_sized(_ctx(spark, sf_dir))
    return rounded(response.lift_by_store_size(panel, models.store_size_model(panel), 50))


def q_lift_by_discount_notebook(spark, sf_dir):
    """H2 notebook variant: depth 0..0.4 x 50 from the mechanism model."""
    coefs = models.discount_depth_model(_gross(_ctx(spark, sf_dir)))
    return rounded(response.lift_by_discount(coefs, spark, 50, 0.4))


def q_income_interactions(spark, sf_dir):
    """The income-group terms of the income model."""
    res = models.interaction_report(models.income_model(_hh(_ctx(spark, sf_dir))),
                                    "income_group")
    return rounded(models.coefficient_view(res))


def q_line_totals(spark, sf_dir):
    """Line count and distinct products of the line panel."""
    return describe.line_totals(_lines(_ctx(spark, sf_dir)))


# ---------------------------------------------------------------- steps 10-11
def _built(spark, sf_dir, scratch, which=None) -> dict[str, str]:
    ctx = _ctx(spark, sf_dir)
    return marts.build_marts(spark, ctx.txn, ctx.products, ctx.promos, FOCUS, scratch.folder("marts"), which)


def q_mart_roundtrip(spark, sf_dir):
    """A6 + A8: write the weekly-trend mart as parquet and read it back."""
    return _closed("marts", spark, lambda scratch: rounded(readers.read_mart_parquet(
        spark, _built(spark, sf_dir, scratch, ["weekly_trends"])["weekly_trends"])))


def q_mart_json_roundtrip(spark, sf_dir):
    """A7 + A8: write the optimal-discount mart as a JSON records array and
    read it back with its schema."""
    schema = ("category string, promo_type string, combined_slope_k double, "
              "model_optimal_discount_pct double, current_avg_discount_pct double")
    return _closed("marts", spark, lambda scratch: readers.read_mart_json(
        spark, _built(spark, sf_dir, scratch, ["optimal_discount_table"])["optimal_discount_table"], schema))


#: What the read-back query lists of each mart: the columns that tell its rows
#: apart, and its values.
READ_BACK = {
    "weekly_trends": (("product_category", "week"), ("avg_price", "total_qty", "n_txn", "promo_rate")),
    "price_by_promo": (("product_category", "is_promo"), ("unit_price",)),
    "store_size_curve": (("category",), ("log_store_size_c", "predicted_lift_pct")),
    "discount_depth_curve": (("category", "promo_type"), ("discount_pct", "predicted_lift_pct")),
    "elasticity_comparison": (("category", "model"), ("elasticity", "se")),
    "promo_uplift": (("category", "promo_type"), ("pct_lift", "p_value")),
    "optimal_discount_table": (("category", "promo_type"),
                               ("combined_slope_k", "model_optimal_discount_pct", "current_avg_discount_pct")),
    "optimization_scenarios": (("category", "change"), ("actual_revenue", "scenario_revenue", "delta", "pct_change")),
    "store_targeting_scenario": ((), ("current_avg_size", "top_tercile_avg_size", "actual_revenue", "scenario_revenue",
                                      "delta", "pct_change")),
    "summary": (("categories",), ("n_transactions", "n_products", "total_combined_delta", "total_promo_revenue",
                                  "pct_opportunity_vs_promo_revenue", "total_category_revenue",
                                  "pct_opportunity_vs_total_category_revenue")),
}


def q_marts_read_back(spark, sf_dir):
    """Build and write all ten marts, read each back, and list
    every value of every row: mart, row label ("a — b"), column, value."""
    def run(scratch):
        out, parts = _built(spark, sf_dir, scratch), []
        for name, (keys, values) in READ_BACK.items():
            read = readers.read_mart_parquet if name in marts.PARQUET_MARTS else readers.read_mart_json
            mart = read(spark, out[name])
            if "categories" in keys:
                mart = mart.withColumn("categories", F.array_join("categories", " — "))
            label = F.concat_ws(" — ", *[F.col(k).cast("string") for k in keys])
            parts.append(mart.select(F.lit(name).alias("mart"), label.alias("label"), F.explode(F.array(*[
                F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values])).alias("_m"))
                .select("mart", "label", "_m.metric", "_m.value"))
        # + 0.0: no negative zeros
        return rounded(reduce(DataFrame.unionByName, parts), digits=4).withColumn("value", F.col("value") + 0.0)
    return _closed("marts", spark, run)


def q_mart_views(spark, sf_dir):
    """One category of the optimal-discount mart, with the
    composite label, under its display names."""
    def run(scratch):
        out = _built(spark, sf_dir, scratch, ["optimal_discount_table"])
        mart = readers.read_mart_json(spark, out["optimal_discount_table"]).select(*readers.OPTIMAL_DISCOUNT_DISPLAY)
        page = readers.select_category(mart, FOCUS[1])
        return readers.display_optimal_discount(page.withColumn("label", C.composite_label("category", "promo_type")))
    return _closed("marts", spark, run)


def q_csv_to_parquet(spark, sf_dir):
    """A2 + A5 via Structured Streaming: raw promotion CSV files are
    ingested incrementally to parquet (typed with the raw schema, so ids
    are strings), then the warehouse promotion table is built on them."""
    def run(scratch):
        work = scratch.folder("ingest")
        _ctx(spark, sf_dir).raw("promotions").write.option("header", True).csv(f"{work}/csv")
        ingest.ingest_csv(spark, f"{work}/csv", schemas.RAW_PROMOTIONS, f"{work}/parquet", f"{work}/_checkpoint")
        return warehouse.fact_promotions(readers.read_raw(spark, f"{work}/parquet", "promotions"))
    return _closed("ingest", spark, run)


def q_raw_roundtrip(spark, sf_dir):
    """A3: all raw tables as parquet, one folder each, read back and counted:
    rows, columns, and rows without a NULL."""
    def run(scratch):
        ctx = _ctx(spark, sf_dir)
        paths = readers.write_raw_tables({n: ctx.raw(n) for n in schemas.RAW}, scratch.folder("raw"))
        parts = []
        for name, path in paths.items():
            df = readers.read_parquet(spark, path)
            whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in df.columns])
            parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.when(whole, 1).otherwise(0)).alias("n_whole")).select(
                F.lit(name).alias("tbl"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "n_whole"))
        return reduce(DataFrame.unionByName, parts)
    return _closed("raw", spark, run)


def _raw(ctx: Context) -> dict[str, DataFrame]:
    return {k: ctx.raw(k) for k in ("products", "demographics", "campaign_descriptions", "campaigns", "transactions",
                                    "promotions")}


def q_warehouse_rebuild(spark, sf_dir):
    """A4 + A5: the warehouse is written, the build run again, and each table
    counted as stored, with what either run did."""
    def run(scratch):
        out, raw = scratch.folder("warehouse"), _raw(_ctx(spark, sf_dir))
        first = warehouse.rebuild_warehouse(raw, out)
        second = {name: done for name, _, done in warehouse.rebuild_warehouse(raw, out)}
        with warehouse.Stored(spark, out) as tables:
            counts = {name: df.count() for name, df in tables.items()}
        return spark.createDataFrame([(name, counts[name], done, second[name]) for name, _, done in first],
                                     "tbl string, n_rows long, first_run string, second_run string")
    return _closed("warehouse", spark, run)


def q_warehouse_panel(spark, sf_dir):
    """A4 + C2: the gross panel by category, answered from a written
    warehouse whose buckets spare the shuffles."""
    def run(scratch):
        out = scratch.folder("warehouse")
        warehouse.build_warehouse(_raw(_ctx(spark, sf_dir)), out)
        with warehouse.Stored(spark, out) as t:
            panel = panels.gross_panel(t["fact_transactions"], t["dim_product"], t["fact_promotions"], FOCUS)
            return rounded(panel.groupBy(CAT).agg(
                F.count(F.lit(1)).alias("n_cells"), F.sum("is_promo").alias("n_promoted"), F.sum("quantity").alias("quantity"),
                F.sum("sales_value").alias("revenue"), F.avg("discount_pct").alias("avg_discount")), overrides=MONEY).checkpoint()
    return _closed("warehouse", spark, run)


def q_panel_dropped_rows(spark, sf_dir):
    """Cells that entered each of the three panels, stayed and dropped out."""
    ctx, seen = _ctx(spark, sf_dir), {n: panels.Observations(n) for n in ("net", "gross", "household")}
    return panels.row_account({
        "net": (panels.net_panel(ctx.txn, ctx.products, ctx.promos, FOCUS, observation=seen["net"]), seen["net"]),
        "gross": (panels.gross_panel(ctx.txn, ctx.products, ctx.promos, FOCUS, observation=seen["gross"]), seen["gross"]),
        "household": (panels.household_panel(ctx.txn, ctx.products, ctx.promos, ctx.households, FOCUS, seen["household"]),
                      seen["household"])})


#: The test tables have some 30 lines a product, nearly each in a store of its
#: own: products of 45 cells are fitted, with week effects alone (the reference
#: asks for 200 cells of its own data and takes store effects too).
FIXTURE_MIN_OBS, FIXTURE_EFFECTS = 45, ("week",)


def q_sku_elasticity_product(spark, sf_dir):
    """G3 + D14-D16 by product: the top products with brand and package,
    whether they pass, and the estimates of those that do."""
    return rounded(models.sku_elasticity(_net(_ctx(spark, sf_dir)), min_obs=FIXTURE_MIN_OBS, skipped=True,
                                         absorb=FIXTURE_EFFECTS))


def q_campaign_reach(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    return rounded(campaigns.campaign_reach(ctx.table("dim_campaign"),
                                            ctx.table("bridge_household_campaign"),
                                            ctx.households, ctx.txn),
                   overrides={"window_spend": 2})


def q_coupon_redemption(spark, sf_dir):
    ctx = _ctx(spark, sf_dir)
    return campaigns.coupon_redemption(ctx.raw("coupons"), ctx.raw("coupon_redemptions"))


QUERIES = {
    "dim_product": q_dim_product,
    "dim_household": q_dim_household,
    "dim_campaign": q_dim_campaign,
    "fact_transactions": q_fact_transactions,
    "fact_promotions": q_fact_promotions,
    "row_counts": q_row_counts,
    "category_summary": q_category_summary,
    "weekly_trend_lines": q_weekly_trend_lines,
    "panel_net": q_panel_net,
    "panel_household": q_panel_household,
    "panel_gross": q_panel_gross,
    "panel_gross_sized": q_panel_gross_sized,
    "store_size": q_store_size,
    "category_screening": q_category_screening,
    "price_by_promo": q_price_by_promo,
    "boxplot_by_promo": q_boxplot_by_promo,
    "boxplot_by_store": q_boxplot_by_store,
    "within_product_std": q_within_product_std,
    "panel_coverage": q_panel_coverage,
    "income_group_sizes": q_income_group_sizes,
    "top_stores": q_top_stores,
    "top_products": q_top_products,
    "store_price_order": q_store_price_order,
    "ever_promoted_share": q_ever_promoted_share,
    "current_discount": q_current_discount,
    "discount_support": q_discount_support,
    "untreated_cells": q_untreated_cells,
    "weekly_trend_cells": q_weekly_trend_cells,
    "promo_overlap": q_promo_overlap,
    "ols_naive": q_ols_naive,
    "fe_elasticity": q_fe_elasticity,
    "elasticity_comparison": q_elasticity_comparison,
    "promo_uplift": q_promo_uplift,
    "sku_elasticity": q_sku_elasticity,
    "fe_income": q_fe_income,
    "fe_store_size": q_fe_store_size,
    "fe_discount_depth": q_fe_discount_depth,
    "fe_unified": q_fe_unified,
    "lift_by_store_size": q_lift_by_store_size,
    "lift_by_discount": q_lift_by_discount,
    "optimal_discount": q_optimal_discount,
    "revenue_scenarios": q_revenue_scenarios,
    "store_targeting": q_store_targeting,
    "overview_summary": q_overview_summary,
    "lift_by_store_size_notebook": q_lift_by_store_size_notebook,
    "lift_by_discount_notebook": q_lift_by_discount_notebook,
    "income_interactions": q_income_interactions,
    "line_totals": q_line_totals,
    "mart_roundtrip": q_mart_roundtrip,
    "mart_json_roundtrip": q_mart_json_roundtrip,
    "marts_read_back": q_marts_read_back,
    "mart_views": q_mart_views,
    "csv_to_parquet": q_csv_to_parquet,
    "raw_roundtrip": q_raw_roundtrip,
    "warehouse_rebuild": q_warehouse_rebuild,
    "warehouse_panel": q_warehouse_panel,
    "panel_dropped_rows": q_panel_dropped_rows,
    "sku_elasticity_product": q_sku_elasticity_product,
    "campaign_reach": q_campaign_reach,
    "coupon_redemption": q_coupon_redemption,
}
