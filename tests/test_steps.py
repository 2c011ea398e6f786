"""Steps over a panel of many levels: what they write, send and return."""

import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import fixed_effects, lineage, models
from shelfwise.operators.fixed_effects import Model, fit
from shelfwise.plans import queries

from conftest import SF
from test_estimators import planted_panel


@pytest.fixture(scope="module")
def panel(spark):
    pdf = planted_panel(seed=5, n_p=40, n_s=9, n_w=7, keep=0.3)
    return spark.createDataFrame(pdf).persist()


def _coefs(df):
    return {(r.product_category, r.term): (r.coef, r.se, r.r2, r.n_params, r.n_clusters)
            for r in fit(df, Model(models.NET_FORMULA)).collect()}


def test_steps_leave_the_largest_key_out(panel, monkeypatch):
    """The key with most levels is in no table of a step, and the pairs of a
    panel beyond the bound are not written."""
    wanted = _coefs(panel)
    tables, real = [], lineage.Scratch.cut

    def cut(self, df, keep=False):
        out = real(self, df, keep)
        if "_w0" in out.columns:
            tables.append({r[0] for r in out.select("_k").distinct().collect()})
        assert "_c" not in out.columns
        return out
    monkeypatch.setattr(lineage.Scratch, "cut", cut)
    monkeypatch.setattr(fixed_effects, "MAX_PAIRS", 0)
    got = _coefs(panel)
    assert tables and all(ks == {1, 2} for ks in tables)          # stores and weeks, no products
    assert set(got) == set(wanted)
    for k in wanted:
        assert got[k] == pytest.approx(wanted[k], abs=1e-9)


def test_steps_without_a_key_to_eliminate(panel, monkeypatch):
    """Levels too large for a task: no key is eliminated, same estimates."""
    wanted = _coefs(panel)
    monkeypatch.setattr(fixed_effects, "MAX_PAIRS", 0)
    monkeypatch.setattr(fixed_effects, "MAX_LEVEL_ROWS", 0)
    got = _coefs(panel)
    assert set(got) == set(wanted)
    for k in wanted:
        assert got[k] == pytest.approx(wanted[k], abs=1e-9)


def test_a_step_does_not_deal_out_the_rows(panel):
    """Deviations from the level means of the eliminated key need no shuffle
    of the panel that was dealt out by it."""
    rows = panel.repartition(4, "product_category", "product_id").sortWithinPartitions("product_category", "product_id").persist()
    try:
        rows.count()
        left = fixed_effects._deviations(rows.select("product_category", "product_id", "log_qty"), ["product_category"],
                                         "product_id", ["log_qty"])
        plan = left._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
        assert "Window" in plan and "Exchange" not in plan and "Sort " not in plan
    finally:
        rows.unpersist()


def test_level_tables_are_not_sent_to_the_driver(panel, monkeypatch):
    """Level tables that aren't small are shuffled to the pieces of the rows,
    which stay where they are; same estimates."""
    wanted = _coefs(panel)
    met, real = [], fixed_effects._meet

    def meet(rows, table, on, n_rows, pieces):
        out = real(rows, table, on, n_rows, pieces)
        met.append(out._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0])
        return out
    monkeypatch.setattr(fixed_effects, "_meet", meet)
    monkeypatch.setattr(fixed_effects, "MAX_PAIRS", 0)
    monkeypatch.setattr(fixed_effects, "SMALL_LEVELS_BYTES", 0)
    got = _coefs(panel)
    assert met and all("ShuffledHashJoin" in p for p in met)
    shuffles = [p.count("Exchange hashpartitioning(_piece") for p in met]
    assert max(shuffles) <= 2 and "BroadcastExchange HashedRelation" not in met[0]     # one for each level table, none of the rows
    assert set(got) == set(wanted)
    for k in wanted:
        assert got[k] == pytest.approx(wanted[k], abs=1e-9)


def test_what_is_left_is_read_without_a_join(panel, monkeypatch):
    """The sums of squares lie in the steps' table: a step broadcasts one
    table of a row per group, its inner products."""
    joined, real, steps, cut = [], fixed_effects._bc, [], lineage.Scratch.cut
    monkeypatch.setattr(fixed_effects, "_bc", lambda df, n: joined.append(n) or real(df, n))
    monkeypatch.setattr(lineage.Scratch, "cut", lambda self, df, keep=False: steps.append("_w0" in df.columns) or cut(self, df, keep))
    monkeypatch.setattr(fixed_effects, "MAX_PAIRS", 0)
    groups = len({k[0] for k in _coefs(panel)})
    assert sum(steps) and joined.count(groups) == sum(steps) + 2      # and the start's and the coefficients'


@pytest.mark.parametrize("name", ["lift_by_store_size", "store_targeting", "overview_summary", "mart_json_roundtrip", "mart_views"])
def test_a_query_sends_no_level_table_to_the_driver(spark, monkeypatch, name):
    """Whatever its levels, the fit behind it broadcasts tables of a row per
    category only (a few steps tell: the fit ends early here)."""
    sent, real = [], fixed_effects._bc
    monkeypatch.setattr(fixed_effects, "_bc", lambda df, n: sent.append(n) or real(df, n))
    monkeypatch.setattr(fixed_effects, "MAX_PAIRS", 0)
    monkeypatch.setattr(fixed_effects, "SMALL_LEVELS_BYTES", 0, raising=False)
    monkeypatch.setattr(models, "Model", partial(Model, tol=0.03))
    assert queries.QUERIES[name](spark, SF).count()
    assert sent and set(sent) == {len(queries.FOCUS)}


def _keys_broadcast(plan: str) -> list[list[str]]:
    """The types of the keys of each broadcast table of a plan."""
    return [re.findall(r"input\[\d+, (\w+)", keys) for keys in re.findall(r"HashedRelationBroadcastMode\(List\((.*?)\),", plan)]


def test_a_step_broadcasts_under_one_long_key(panel, monkeypatch):
    """A broadcast table under text or several columns takes a page (up to 64
    MB) of the driver's memory for two rows: no step has one, for its groups or levels."""
    wanted = _coefs(panel)
    met, real = [], fixed_effects._meet

    def meet(*args):
        out = real(*args)
        met.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(fixed_effects, "_meet", meet)
    monkeypatch.setattr(fixed_effects, "MAX_PAIRS", 0)
    got = _coefs(panel)
    keys = [k for plan in met for k in _keys_broadcast(plan)]
    assert keys and all(k == ["bigint"] for k in keys)
    assert got.keys() == wanted.keys() and all(got[k] == pytest.approx(wanted[k], abs=1e-9) for k in wanted)


def test_groups_are_told_apart_whatever_their_hashes(spark, panel, monkeypatch):
    """A seed under which groups share a number is passed over; a group of
    several columns has them back."""
    two = panel.withColumn("half", F.col("week") % 2)
    real = F.xxhash64
    monkeypatch.setattr(fixed_effects.F, "xxhash64", lambda *c: F.when(c[0] == 0, F.lit(7)).otherwise(real(*c)).cast("long"))
    model = Model(models.NET_FORMULA, by=("product_category", "half"))
    rows = fit(two, model).collect()
    monkeypatch.setattr(fixed_effects.F, "xxhash64", real)
    assert rows[0].__fields__[:3] == ["product_category", "half", "term"]
    for half in (0, 1):
        alone = fit(two.filter(F.col("half") == half), Model(models.NET_FORMULA)).collect()
        assert {(r.product_category, r.term): pytest.approx((r.coef, r.se, r.n_obs), abs=1e-9) for r in alone} == {
            (r.product_category, r.term): (r.coef, r.se, r.n_obs) for r in rows if r.half == half}


@pytest.mark.parametrize("name", ["store_targeting", "overview_summary", "mart_views"])
def test_a_query_broadcasts_its_groups_by_number(spark, monkeypatch, name):
    """What the fit behind it broadcasts is told by the groups' number, not
    by the categories' names (a few steps tell)."""
    sent, real = [], fixed_effects._bc
    monkeypatch.setattr(fixed_effects, "_bc", lambda df, n: sent.append(df.columns) or real(df, n))
    monkeypatch.setattr(fixed_effects, "MAX_PAIRS", 0)
    monkeypatch.setattr(models, "Model", partial(Model, tol=0.03))
    assert queries.QUERIES[name](spark, SF).count()
    assert sent and all("_g" in columns and "product_category" not in columns for columns in sent)
