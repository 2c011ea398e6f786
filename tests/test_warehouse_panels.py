"""Hand fixtures for the warehouse build and the panels (FIXTURES.md §3)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from shelfwise.functions.income import INCOME_BANDS, income_group
from shelfwise.operators import campaigns, describe, panels, warehouse
from shelfwise.operators.joins import attach_promotions
from shelfwise.sources import schemas

TS = dt.datetime(2020, 1, 6, 10, 30)


def txn_raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_TRANSACTIONS)


def line(pid, store, week, qty, sales, rdisc=0.0, cdisc=None, mdisc=None, hh="h1", basket="b1"):
    return (hh, store, basket, pid, week, TS, qty, sales, rdisc, cdisc, mdisc)


def test_txn_edges_filter_and_derived(spark):
    rows = [line("p1", "s1", 1, 0.0, 1.0), line("p1", "s1", 1, -1.0, 1.0),
            line("p1", "s1", 1, 2.0, 0.0), line("p1", "s1", 1, 2.0, -1.0),
            line("p1", "s1", 1, 4.0, 2.0, rdisc=None, cdisc=None, mdisc=None),
            line("p1", "s1", 1, 2.0, 3.0, rdisc=-0.5, cdisc=-0.25, mdisc=None)]
    out = warehouse.fact_transactions(txn_raw(spark, rows)).orderBy("sales_value").collect()
    assert [r.quantity for r in out] == [2.0, 4.0, 2.0]        # qty>0 and sales>=0 kept
    assert out[0].unit_price == 0.0
    assert out[1].unit_price == 0.5 and out[1].total_discount == 0.0   # NULLs coalesced
    assert out[2].total_discount == pytest.approx(-0.75)
    assert out[0].transaction_date == dt.date(2020, 1, 6)


def promo_raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_PROMOTIONS)


def test_promo_edges_flags_and_attach(spark):
    promos = warehouse.fact_promotions(promo_raw(spark, [
        ("p1", "s1", 1, "0", "0"), ("p2", "s1", 1, None, "A"), ("p3", "s1", 1, "3", "0"),
        ("p4", "s1", 1, "0", "D"), ("p5", "s1", 1, "1", "A"), ("p9", "s9", 9, "2", "0"),
        ("p6", "s1", 1, "3", "0"), ("p6", "s1", 1, "0", "A")]))
    flags = {r.product_id: (r.is_displayed, r.is_mailed) for r in promos.collect()
             if r.product_id != "p6"}
    assert flags == {"p1": (0, 0), "p2": (0, 1), "p3": (1, 0), "p4": (0, 1), "p5": (1, 1),
                     "p9": (1, 0)}
    cells = spark.createDataFrame([(p, "s1", 1, 1.0) for p in ["p1", "p2", "p5", "p6", "p7"]],
                                  "product_id string, store_id string, week int, quantity double")
    plain = attach_promotions(cells, promos)
    assert plain.count() == 6                                   # duplicated key fans out (T1)
    assert plain.filter(F.col("product_id") == "p7").first().is_displayed == 0   # miss -> 0
    deduped = attach_promotions(cells, promos, dedupe=True)
    assert deduped.count() == 5
    p6 = deduped.filter(F.col("product_id") == "p6").first()
    assert (p6.is_displayed, p6.is_mailed) == (1, 1)
    untreated = panels.untreated_cells(cells, promos).collect()
    assert {r.product_id for r in untreated} == {"p7"}


def products(spark):
    return spark.createDataFrame(
        [("p1", "m", "d", "B1", "CAT", "t", "10"), ("p2", "m", "d", "B2", "CAT", "t", "20"),
         ("p3", "m", "d", "B3", "OTHER", "t", "5")], schemas.RAW_PRODUCTS)


def test_panel_edges_gross_price_and_depth(spark):
    rows = [
        # gross value 0 -> price 0 -> dropped
        line("p1", "s1", 1, 1.0, 0.0, rdisc=0.0),
        # net value 0 with a discount: net price clipped at 0.01 in the log
        line("p1", "s1", 2, 2.0, 0.0, rdisc=-1.0),
        # negative retail_disc: sign irrelevant
        line("p2", "s1", 1, 2.0, 3.0, rdisc=-1.0),
        line("p2", "s1", 1, 1.0, 1.0, rdisc=-1.0),
        # all-NULL retail_disc cell -> NULL gross -> dropped
        line("p2", "s2", 3, 1.0, 2.0, rdisc=None),
        line("p3", "s1", 1, 1.0, 2.0),
    ]
    txn = warehouse.fact_transactions(txn_raw(spark, rows))
    promos = warehouse.fact_promotions(promo_raw(spark, [("p2", "s1", 1, "3", "0")]))
    g = panels.gross_panel(txn, products(spark), promos, ["CAT"]).collect()
    by = {(r.product_id, r.store_id, r.week): r for r in g}
    assert set(by) == {("p1", "s1", 2), ("p2", "s1", 1)}
    a = by[("p1", "s1", 2)]
    assert a.unit_price == 0.5 and a.discount_pct == 1.0
    assert a.log_net_price == pytest.approx(math.log(0.01))
    b = by[("p2", "s1", 1)]
    assert b.gross_value == 6.0 and b.unit_price == 2.0
    assert b.discount_pct == pytest.approx(2.0 / 6.0) and b.is_promo == 1


def test_net_panel_weighted_price_and_observation(spark):
    rows = [line("p1", "s1", 1, 1.0, 2.0), line("p1", "s1", 1, 3.0, 3.0),
            line("p2", "s1", 1, 1.0, 0.0)]
    txn = warehouse.fact_transactions(txn_raw(spark, rows))
    promos = warehouse.fact_promotions(promo_raw(spark, [("p9", "s1", 1, "3", "0")]))
    obs = panels.Observations("net")
    net = panels.net_panel(txn, products(spark), promos, ["CAT"], observation=obs).collect()
    assert len(net) == 1 and net[0].unit_price == pytest.approx(5.0 / 4.0)
    assert obs.get == {"rows_in": 2, "rows_kept": 1}


def test_income_edges(spark):
    vals = [b for b, _ in INCOME_BANDS] + [None, "Unknown band"]
    df = spark.createDataFrame([(v,) for v in vals], "income string")
    got = [r.g for r in df.select(income_group("income").alias("g")).collect()]
    assert got == [g for _, g in INCOME_BANDS] + [None, None]
    rows = [line("p1", "s1", 1, 1.0, 2.0, hh=h) for h in ["h1", "h2", "h3", "h4"]]
    txn = warehouse.fact_transactions(txn_raw(spark, rows))
    hh = spark.createDataFrame([("h1", "a", "Under 15K"), ("h2", "a", "250K+"),
                                ("h3", "a", "Unknown band")],
                               "household_id string, age string, income string")
    promos = warehouse.fact_promotions(promo_raw(spark, [("p9", "s1", 1, "3", "0")]))
    p = panels.household_panel(txn, products(spark), promos, hh, ["CAT"]).collect()
    assert sorted((r.household_id, r.income_group, r.income_rank) for r in p) == [
        ("h1", "Low", 0), ("h2", "High", 2)]


def test_store_size_and_centring(spark):
    rows = ([line("p1", "s1", w, 1.0, 1.0) for w in range(1, 4)]
            + [line("p3", "s2", 1, 1.0, 1.0)] + [line("p1", "s2", 2, 1.0, 1.0)])
    txn = warehouse.fact_transactions(txn_raw(spark, rows))
    sizes = {r.store_id: r.store_total_txns for r in panels.store_size(txn).collect()}
    assert sizes == {"s1": 3, "s2": 2}                          # all categories counted
    promos = warehouse.fact_promotions(promo_raw(spark, [("p9", "s1", 1, "3", "0")]))
    g = panels.with_store_size(panels.gross_panel(txn, products(spark), promos, ["CAT"]),
                               panels.store_size(txn))
    vals = [r.log_store_size_c for r in g.collect()]
    assert len(vals) == 4 and abs(sum(vals)) < 1e-12           # centred over panel rows


def test_ties_and_singletons(spark):
    df = spark.createDataFrame(
        [("C", "p1", 5.0, 1.0), ("C", "p2", 5.0, 2.0), ("C", "p3", 5.0, 3.0), ("C", "p3", 1.0, 5.0)],
        "product_category string, product_id string, quantity double, unit_price double")
    top = describe.top_products(df, 2).collect()
    assert [r.product_id for r in top] == ["p3", "p1"]          # volume, then key order
    std = describe.within_product_std(df).first().within_product_std
    assert std == pytest.approx(math.sqrt(2.0))                 # singletons skipped (NULL)
    lines = df.withColumn("store_id", F.col("product_id")).withColumn("is_promo", F.lit(0))
    stores = describe.top_stores(lines, "C", 2).collect()
    assert [(r.store_id, r.n_lines) for r in stores] == [("p3", 2), ("p1", 1)]


def test_compressed_line_panel_is_exact(spark):
    """Repeated identical lines (n_lines > 1): every line statistic equals
    the uncompressed line-level result."""
    import random
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        p = rnd.choice(["p1", "p2", "p3"])
        price = rnd.choice([1.0, 1.5, 2.0, 2.25, 7.0])
        qty = float(rnd.randint(1, 4))
        rows.append(line(p, rnd.choice(["s1", "s2"]), rnd.randint(1, 3), qty, price * qty,
                         hh=f"h{rnd.randint(1, 9)}"))
    txn = warehouse.fact_transactions(txn_raw(spark, rows))
    promos = warehouse.fact_promotions(promo_raw(spark, [("p1", "s1", 1, "3", "0"),
                                                        ("p2", "s2", 2, "0", "A")]))
    comp = panels.line_panel(txn, products(spark), promos, ["CAT", "OTHER"], compress=True)
    full = panels.line_panel(txn, products(spark), promos, ["CAT", "OTHER"], compress=False)
    assert comp.count() < full.count()
    checks = [
        (describe.category_summary, ["product_category"]),
        (describe.category_screening, ["product_category"]),
        (describe.weekly_trend, ["product_category", "week"]),
        (describe.price_by_promo, ["product_category", "is_promo"]),
        (lambda d: describe.boxplot_stats(d, "is_promo"), ["product_category", "is_promo"]),
        (describe.within_product_std, ["product_category"]),
        (lambda d: describe.top_stores(d, "CAT", 2), ["store_id"]),
        (describe.line_totals, []),
    ]
    for fn, keys in checks:
        a = fn(comp).toPandas().sort_values(keys).reset_index(drop=True) if keys else \
            fn(comp).toPandas()
        b = fn(full).toPandas().sort_values(keys).reset_index(drop=True) if keys else \
            fn(full).toPandas()
        assert list(a.columns) == list(b.columns)
        for c in a.columns:
            if a[c].dtype.kind == "f":
                assert ((a[c] - b[c]).abs().fillna(0) < 1e-9).all(), (fn, c)
            else:
                assert (a[c] == b[c]).all(), (fn, c)


def test_approx_quantiles_close_to_exact(spark):
    """approx=True (percentile_approx sketch) for unbounded-distinct values."""
    df = spark.range(2000).select(F.lit("C").alias("product_category"),
                                  (F.col("id") % 2).cast("int").alias("is_promo"),
                                  (F.col("id") / 7.0).alias("unit_price"))
    exact = {r.is_promo: r for r in describe.price_by_promo(df).collect()}
    approx = {r.is_promo: r for r in describe.price_by_promo(df, approx=True).collect()}
    for k in (0, 1):
        assert abs(exact[k].median_price - approx[k].median_price) < 0.5
        assert exact[k].n == approx[k].n == 1000


def test_coupon_redemption_expands_no_rows(spark):
    reds = spark.createDataFrame(
        [(1, "a", 10, "d1"), (1, "a", 10, "d2"), (2, "a", 10, "d1"), (None, "b", 10, "d1"), (3, None, 11, "d1"), (4, "a", None, "d1")],
        "household_id long, coupon_upc string, campaign_id long, redemption_date string")
    coupons = spark.createDataFrame([("a", 10, 7), ("a", 10, 8), ("b", 10, 7), ("c", 11, 9)],
                                    "coupon_upc string, campaign_id long, product_id long")
    out = campaigns.coupon_redemption(coupons, reds)
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.campaign_id: (r.n_redemptions, r.n_households, r.n_coupons, r.n_products) for r in out.collect()}
    assert got == {10: (4, 2, 2, 2), 11: (1, 1, 0, 0), None: (1, 1, 1, 0)}
