"""Estimator tests: planted truth, dense numpy oracle, invariants."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dense_ols import fit as dense_fit
from shelfwise.functions.stats import two_sided_p
from shelfwise.operators import models
from shelfwise.operators.fixed_effects import Model, NotConverged, fit


def planted_panel(seed=7, n_p=30, n_s=20, n_w=26, keep=0.6, interactions=False):
    """Price = product + store + week effects + promo cut + noise;
    log qty = -1.5 log price + 0.2 display + 0.3 mailer + effects + noise.
    The effects enter both price and demand (confounding)."""
    rng = np.random.default_rng(seed)
    pe, se, we = rng.normal(0, .5, n_p), rng.normal(0, .3, n_s), rng.normal(0, .2, n_w)
    rows = []
    for p in range(n_p):
        for s in range(n_s):
            for w in range(n_w):
                if rng.random() > keep:
                    continue
                d = int(rng.random() < .3)
                m = int(rng.random() < .25)
                depth = rng.uniform(0, .4) if (d or m) else 0.0
                lp = 1 + pe[p] + se[s] + we[w] - .1 * (d | m) + rng.normal(0, .1)
                inc = ["Low", "Mid", "High"][rng.integers(0, 3)]
                lq = (-1.5 * lp + .2 * d + .3 * m + 2 * pe[p] + se[s] - we[w]
                      + rng.normal(0, .2))
                if interactions:
                    lq += .5 * d * depth + .1 * m * (inc == "High")
                rows.append(dict(product_category="A" if p % 2 else "B",
                                 product_id=p, store_id=s, week=w, log_price=lp,
                                 is_displayed=d, is_mailed=m, discount_pct=depth,
                                 income_group=inc, household_id=int(rng.integers(0, 40)),
                                 log_qty=lq))
    return pd.DataFrame(rows)


@pytest.fixture(scope="module")
def planted(spark):
    pdf = planted_panel()
    return pdf, spark.createDataFrame(pdf)


def _by_term(res, cat):
    return {r.term: r for r in res.filter(F.col("product_category") == cat).collect()}


def test_fe_recovers_planted_and_naive_does_not(planted):
    pdf, df = planted
    fe = _by_term(fit(df, Model(models.NET_FORMULA)), "A")
    naive = _by_term(fit(df, Model(models.NET_FORMULA, absorb=())), "A")
    assert abs(fe["log_price"].coef + 1.5) < 0.05
    assert abs(fe["is_displayed"].coef - 0.2) < 0.05
    assert abs(fe["is_mailed"].coef - 0.3) < 0.05
    assert abs(naive["log_price"].coef + 1.5) > 0.2


@pytest.mark.parametrize("fes", [(), ("product_id", "store_id", "week")])
def test_matches_dense_cluster(planted, fes):
    pdf, df = planted
    res = fit(df, Model(models.NET_FORMULA, absorb=fes))
    for cat in ("A", "B"):
        sub = pdf[pdf.product_category == cat]
        b, se, k, r2 = dense_fit(sub, "log_qty", ["log_price", "is_displayed", "is_mailed"],
                                 fes, "product_id")
        got = _by_term(res, cat)
        terms = ["log_price", "is_displayed", "is_mailed"]
        np.testing.assert_allclose([got[t].coef for t in terms], b, atol=1e-7)
        np.testing.assert_allclose([got[t].se for t in terms], se, atol=1e-7)
        assert got["log_price"].n_params == k
        assert abs(got["log_price"].r2 - r2) < 1e-7


def test_hc1_two_way_matches_dense_with_components(spark):
    """Two disconnected store-week blocks: rank uses 2 components."""
    rng = np.random.default_rng(3)
    rows = []
    for s in range(8):
        weeks = range(0, 5) if s < 4 else range(5, 10)
        for w in weeks:
            for _ in range(2):
                lp = rng.normal(1, .2)
                rows.append(dict(product_category="A", sku="x", store_id=s, week=w,
                                 log_price=lp, is_displayed=int(rng.random() < .4),
                                 is_mailed=int(rng.random() < .3),
                                 log_qty=-1.2 * lp + rng.normal(0, .3) + .1 * s))
    pdf = pd.DataFrame(rows)
    res = fit(spark.createDataFrame(pdf),
              Model(models.NET_FORMULA, absorb=("store_id", "week"),
                    by=("product_category", "sku"), cluster=None, cov="hc1",
                    connected=False))
    b, se, _, _ = dense_fit(pdf, "log_qty", ["log_price", "is_displayed", "is_mailed"],
                            ("store_id", "week"), cov="hc1")
    got = {r.term: r for r in res.collect()}
    np.testing.assert_allclose([got[t].coef for t in ["log_price", "is_displayed", "is_mailed"]],
                               b, atol=1e-7)
    np.testing.assert_allclose([got[t].se for t in ["log_price", "is_displayed", "is_mailed"]],
                               se, atol=1e-7)


def test_absorbed_main_effect_is_dropped(spark):
    """A store-level regressor (trap T4) is absorbed; interactions stay."""
    pdf = planted_panel(seed=11)
    size = {s: math.log(10 + 5 * s) for s in range(20)}
    pdf["log_store_size_c"] = pdf.store_id.map(size)
    pdf["log_store_size_c"] -= pdf["log_store_size_c"].mean()
    res = fit(spark.createDataFrame(pdf), Model(models.SIZE_FORMULA))
    terms = {r.term for r in res.filter(F.col("product_category") == "A").collect()}
    assert "log_store_size_c" not in terms
    assert {"is_displayed:log_store_size_c", "is_mailed:log_store_size_c"} <= terms


def test_invariant_to_row_order_and_partitioning(planted):
    pdf, df = planted
    a = fit(df, Model(models.NET_FORMULA)).orderBy("product_category", "term")
    shuffled = df.orderBy(F.rand(5)).repartition(13)
    b = fit(shuffled, Model(models.NET_FORMULA)).orderBy("product_category", "term")
    for x, y in zip(a.collect(), b.collect()):
        assert abs(x.coef - y.coef) < 1e-10 and abs(x.se - y.se) < 1e-10


def test_invariant_to_store_level_shift(planted):
    pdf, df = planted
    shifted = df.withColumn("log_qty", F.when(F.col("store_id") == 3, F.col("log_qty") + 5.0)
                            .otherwise(F.col("log_qty")))
    a = _by_term(fit(df, Model(models.NET_FORMULA)), "B")
    b = _by_term(fit(shifted, Model(models.NET_FORMULA)), "B")
    assert abs(a["log_price"].coef - b["log_price"].coef) < 1e-7


def test_p_values_and_interaction_report(planted):
    pdf, df = planted
    res = fit(df, Model(models.NET_FORMULA))
    for r in res.collect():
        assert r.p_value == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)), rel=1e-12)
        assert r.significant == (r.p_value < 0.05)
    assert two_sided_p(1.959963984540054) == pytest.approx(0.05, rel=1e-12)
    rep = models.interaction_report(res, "is_")
    assert rep.count() == 4


def test_income_model_dummies(spark):
    pdf = planted_panel(seed=5, interactions=True)
    res = models.income_model(spark.createDataFrame(pdf))
    terms = {r.term for r in res.collect()}
    assert "C(income_group)[T.Mid]" in terms and "is_mailed:C(income_group)[T.High]" in terms
    assert not any("[T.Low]" in t for t in terms)


def test_looser_tolerance_agrees(planted):
    pdf, df = planted
    a = _by_term(fit(df, Model(models.NET_FORMULA)), "A")
    b = _by_term(fit(df, Model(models.NET_FORMULA, tol=1e-9)), "A")
    assert abs(a["log_price"].coef - b["log_price"].coef) < 1e-7


def test_too_few_steps_raise(planted):
    _, df = planted
    with pytest.raises(NotConverged, match="after 1 steps"):
        fit(df, Model(models.NET_FORMULA, max_steps=1, check_every=1))


def test_rows_with_null_keys_are_left_out(planted):
    pdf, df = planted
    holes = df.withColumn("store_id", F.when(F.col("week") % 7 == 0, None).otherwise(F.col("store_id")))
    a = _by_term(fit(holes, Model(models.NET_FORMULA)), "A")
    b = _by_term(fit(holes.where("store_id is not null"), Model(models.NET_FORMULA)), "A")
    for t in a:
        assert a[t].n_obs == b[t].n_obs and a[t].n_params == b[t].n_params
        assert abs(a[t].coef - b[t].coef) < 1e-9 and abs(a[t].se - b[t].se) < 1e-9


@pytest.mark.parametrize("cov,cluster", [("cluster", "product_id"), ("hc1", None)])
def test_groups_too_small_for_errors_have_none(planted, cov, cluster):
    """One cluster, or as many parameters as rows: the other groups' results
    stay and this group's errors are NULL."""
    pdf, df = planted
    tiny = pd.DataFrame([dict(pdf.iloc[0], product_category="T", product_id=900, store_id=i % 2, week=1,
                              log_price=float(i * i), is_displayed=i % 2, is_mailed=0, log_qty=float(i)) for i in range(3)])
    both = df.unionByName(df.sparkSession.createDataFrame(tiny[list(df.columns)]).select(
        *[F.col(f.name).cast(f.dataType) for f in df.schema.fields]))
    res = fit(both, Model(models.NET_FORMULA, cluster=cluster, cov=cov)).collect()
    small = [r for r in res if r.product_category == "T"]
    assert small and all(r.se is None and r.z is None and r.p_value is None and r.significant is None and r.ci_low is None
                         and r.coef is not None for r in small)
    assert all(r.se > 0 for r in res if r.product_category != "T")


def test_components_of_long_paths(spark):
    from shelfwise.operators.graph import components
    from shelfwise.operators.lineage import Scratch
    scratch = Scratch(spark, "graph")
    rows = [("p", i, i + 1) for i in range(300)] + [("p", 1000, 1001), ("q", 5, 6), ("q", 6, 6)]
    got = components(spark.createDataFrame(rows, "g string, a long, b long"), scratch, ["g"]).collect()
    assert {(r.g, r.root) for r in got} == {("p", 0), ("p", 1000), ("q", 5)}
    assert len(got) == 301 + 2 + 2
    scratch.close()


def test_hot_product_holding_a_third_of_rows(spark):
    """One product carries a third of all rows (skew): the fit runs through
    partial aggregates and still matches the dense oracle."""
    pdf = planted_panel(seed=9, n_p=12, n_s=10, n_w=12, keep=0.5)
    rng = np.random.default_rng(1)
    hot = pdf[pdf.product_id == 0]
    extra = hot.sample(n=len(pdf) // 2, replace=True, random_state=2).copy()
    extra["log_qty"] = extra["log_qty"] + rng.normal(0, .2, len(extra))
    skewed = pd.concat([pdf, extra], ignore_index=True)
    assert (skewed.product_id == 0).mean() > 1 / 3
    res = fit(spark.createDataFrame(skewed), Model(models.NET_FORMULA))
    for cat in ("A", "B"):
        sub = skewed[skewed.product_category == cat]
        b, se, _, _ = dense_fit(sub, "log_qty", ["log_price", "is_displayed", "is_mailed"],
                                ("product_id", "store_id", "week"), "product_id")
        got = _by_term(res, cat)
        np.testing.assert_allclose([got[t].coef for t in ["log_price", "is_displayed",
                                                          "is_mailed"]], b, atol=1e-7)
        np.testing.assert_allclose([got[t].se for t in ["log_price", "is_displayed",
                                                        "is_mailed"]], se, atol=1e-7)


def test_steps_over_the_panel_agree_with_counts(planted, monkeypatch):
    """Groups of too many pairs of levels are solved by steps over the panel."""
    from shelfwise.operators import fixed_effects
    _, df = planted
    a = {(r.product_category, r.term): r for r in fit(df, Model(models.NET_FORMULA)).collect()}
    monkeypatch.setattr(fixed_effects, "MAX_PAIRS", 0)
    b = {(r.product_category, r.term): r for r in fit(df, Model(models.NET_FORMULA)).collect()}
    assert set(a) == set(b)
    for k in a:
        assert abs(a[k].coef - b[k].coef) < 1e-9 and abs(a[k].se - b[k].se) < 1e-9
    with pytest.raises(NotConverged, match="after 1 steps"):
        fit(df, Model(models.NET_FORMULA, max_steps=1, check_every=1))


def test_models_that_share_one_absorption(planted, monkeypatch):
    from shelfwise.operators import fixed_effects
    _, df = planted
    wanted = {"net": Model(models.NET_FORMULA), "depth": Model(models.DEPTH_FORMULA)}
    apart = {name: {(r.product_category, r.term): r for r in fit(df, m).collect()} for name, m in wanted.items()}
    calls = []
    real = fixed_effects.absorb_effects
    monkeypatch.setattr(fixed_effects, "absorb_effects", lambda *a, **k: calls.append(1) or real(*a, **k))
    together = fixed_effects.fit_all(df, wanted)
    assert len(calls) == 1
    for name, rows in apart.items():
        got = {(r.product_category, r.term): r for r in together[name].collect()}
        assert set(got) == set(rows)
        for k, r in rows.items():
            for c in ("coef", "se", "r2"):
                assert abs(got[k][c] - r[c]) < 1e-9
            assert (got[k].n_obs, got[k].n_params, got[k].n_clusters) == (r.n_obs, r.n_params, r.n_clusters)
    # a model that can't use all rows of the others is fitted by itself
    holes = df.withColumn("discount_pct", F.when(F.col("week") > 3, F.col("discount_pct")))
    got = {(r.product_category, r.term): r.n_obs for r in fixed_effects.fit_all(holes, wanted)["net"].collect()}
    assert got == {k: r.n_obs for k, r in apart["net"].items()}
    with pytest.raises(ValueError):
        fixed_effects.fit_all(df, {"a": Model(models.NET_FORMULA), "b": Model(models.NET_FORMULA, absorb=("week",))})


def test_products_that_pass_and_products_that_do_not(spark):
    pdf = planted_panel(seed=21, n_p=6, n_s=6, n_w=10, keep=0.9)
    pdf["quantity"] = 10.0 - pdf.product_id
    pdf["brand"], pdf["package_size"] = "B" + pdf.product_id.astype(str), "1"
    pdf = pdf[(pdf.product_id != 2) | (pdf.week < 2)]
    rows = {r.product_id: r for r in models.sku_elasticity(spark.createDataFrame(pdf), min_obs=30, skipped=True).collect()}
    assert {k for k, r in rows.items() if not r.passed} == {2} and rows[2].elasticity is None and rows[2].brand == "B2"
    from dense_ols import fit as dense
    b, se, *_ = dense(pdf[pdf.product_id == 1], "log_qty", ["log_price", "is_displayed", "is_mailed"], ("store_id", "week"), cov="hc1")
    assert abs(rows[1].elasticity - b[0]) < 1e-7 and abs(rows[1].se - se[0]) < 1e-7
