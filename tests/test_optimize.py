"""Optimisation: closed-form optimum, invariants, published arithmetic."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import optimize


@pytest.mark.parametrize("k,expected", [(1.671, 1 - 1 / 1.671), (0.173, 0.0), (0.117, 0.0),
                                        (-0.017, 0.0), (1.0, 0.0), (2.5, 0.6)])
def test_optimum_cases(spark, k, expected):
    got = spark.range(1).select(optimize.optimal_depth(F.lit(k)).alias("d")).first().d
    assert got == pytest.approx(expected, abs=1e-12)
    # d* maximises (1-d) e^{kd} on [0, 1) (fine grid check)
    grid = np.linspace(0, 0.99, 99001)
    best = grid[np.argmax((1 - grid) * np.exp(k * grid))]
    assert abs(best - expected) < 1e-4


def test_published_arithmetic():
    # k 1.671 -> 40.16%, published 40.1 because k was unrounded
    assert round((1 - 1 / 1.671) * 100, 1) == 40.2
    assert (1 - 1 / 1.6708) * 100 == pytest.approx(40.15, abs=0.02)
    # summary ratios
    assert round(6878 / 22218 * 100, 1) == 31.0
    assert round(6878 / 57296 * 100, 1) == 12.0


def _coefs(spark, b_disc, b_dd, b_md, b_d=0.1, b_m=0.2, b_ds=0.1):
    rows = [("C", "discount_pct", b_disc), ("C", "is_displayed:discount_pct", b_dd),
            ("C", "is_mailed:discount_pct", b_md), ("C", "is_displayed", b_d),
            ("C", "is_mailed", b_m), ("C", "is_displayed:log_store_size_c", b_ds)]
    return spark.createDataFrame(rows, "product_category string, term string, coef double")


def _panel(spark):
    rows = [("C", f"p{i}", f"s{i % 3}", 2.0 + i, 0.1 * (i % 4), 1.0 + 0.5 * i, i % 2,
             (i + 1) % 2, 0.2 * ((i % 3) - 1)) for i in range(12)]
    df = spark.createDataFrame(rows, "product_category string, product_id string, "
                                     "store_id string, quantity double, discount_pct double, "
                                     "unit_price double, is_displayed int, is_mailed int, "
                                     "log_store_size_c double")
    return df.withColumn("sales_value",
                         F.col("unit_price") * (1 - F.col("discount_pct")) * F.col("quantity"))


def test_scenario_at_own_depth_reproduces_actual(spark):
    """d_new = own d: gross x (1 - d) = sales, so scenario == actual."""
    panel = _panel(spark)
    coefs = _coefs(spark, 0.5, 0.3, 1.2)
    long = panel.withColumn("target", F.col("discount_pct"))
    k = optimize.combined_slopes(coefs)
    from shelfwise.operators.describe import promo_long
    j = promo_long(long).join(k, ["product_category", "promo_type"])
    out = j.agg(F.sum("sales_value").alias("a"),
                F.sum(F.col("unit_price") * (1 - F.col("target")) * F.col("quantity")
                      * F.exp((F.col("target") - F.col("discount_pct")) * F.col("k")))
                .alias("s")).first()
    assert out.s == pytest.approx(out.a, rel=1e-12)


def test_revenue_scenarios_and_summary(spark):
    panel = _panel(spark)
    coefs = _coefs(spark, 0.5, 0.3, 1.2)
    progs = optimize.programs_frame(spark, ["C", "C"], [(0, "Mailer", 0.4, "M40"),
                                                          (0, "Display", 0.0, "D0")])
    sc = {r.change: r for r in optimize.revenue_scenarios(panel, coefs, progs).collect()}
    pdf = panel.toPandas()
    for label, flag, target, k in [("M40", "is_mailed", 0.4, 1.7), ("D0", "is_displayed", 0.0, 0.8)]:
        sub = pdf[pdf[flag] == 1]
        new = (sub.unit_price * (1 - target) * sub.quantity
               * np.exp((target - sub.discount_pct) * k)).sum()
        assert sc[label].scenario_revenue == pytest.approx(new, rel=1e-12)
        assert sc[label].actual_revenue == pytest.approx(sub.sales_value.sum(), rel=1e-12)
    summ = optimize.overview_summary(panel, optimize.revenue_scenarios(panel, coefs, progs)).first()
    assert summ.n_transactions == 12 and summ.n_products == 12
    delta, actual = (sum(r[c] for r in sc.values()) for c in ("delta", "actual_revenue"))
    # whole numbers, cut off; the category revenue before it is divided by
    assert (summ.total_combined_delta, summ.total_promo_revenue) == (int(delta), int(actual))
    assert summ.total_category_revenue == int(pdf.sales_value.sum())
    assert summ.pct_opportunity_vs_promo_revenue == pytest.approx(delta / actual * 100)
    assert summ.pct_opportunity_vs_total_category_revenue == pytest.approx(delta / int(pdf.sales_value.sum()) * 100)


def test_optimal_discount_table(spark):
    panel = _panel(spark)
    t = {r.promo_type: r for r in optimize.optimal_discount(panel, _coefs(spark, 0.5, 0.3, 1.2))
         .collect()}
    assert t["Mailer"].combined_slope_k == pytest.approx(1.7)
    assert t["Mailer"].model_optimal_discount_pct == pytest.approx((1 - 1 / 1.7) * 100)
    assert t["Display"].model_optimal_discount_pct == 0.0
    assert t["Display"].category == "C"


def test_store_targeting(spark):
    panel = _panel(spark)
    r = optimize.store_targeting(panel, _coefs(spark, 0.5, 0.3, 1.2, b_ds=0.2), "C").first()
    pdf = panel.toPandas()
    disp = pdf[pdf.is_displayed == 1]
    stores = pdf.drop_duplicates("store_id").log_store_size_c
    cut = np.quantile(stores, 2 / 3)
    top = stores[stores >= cut].mean()
    assert r.current_avg_size == pytest.approx(disp.log_store_size_c.mean())
    assert r.top_tercile_avg_size == pytest.approx(top)
    assert r.scenario_revenue == pytest.approx(
        disp.sales_value.sum() * math.exp((top - disp.log_store_size_c.mean()) * 0.2))
