"""What the input of the fits shuffles."""

from shelfwise.operators import panels
from shelfwise.plans import queries
from conftest import SF


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


def test_products_are_met_before_the_orders(spark):
    """The panels' semi-join of the category's products lies below the lines'
    join with their orders: lines of other products aren't shuffled."""
    ctx = queries._ctx(spark, SF)
    for panel in (queries._gross(ctx), queries._net(ctx), queries._hh(ctx)):
        plan = _plan(panel)
        orders = next(i for i, x in enumerate(plan) if "Join Inner" in x and "o_orderkey" in x)
        assert "Join LeftSemi" in plan[orders + 1] or "Join LeftSemi" in plan[orders + 2]


def test_store_sizes_meet_the_panel_where_it_is(spark):
    """The panel isn't dealt out by store for the sizes, whatever the planner's
    own bound on broadcasts, and the sizes are computed once."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ctx = queries._ctx(spark, SF)
        sized = panels.with_store_size(queries._gross(ctx), panels.store_size(ctx.txn))
        plan = sized._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(store_id" not in plan and "count(1)" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_elasticity_comparison_computes_the_panel_once(spark, monkeypatch):
    """Both of its fits read one written panel."""
    seen, real = [], queries.models.fit
    monkeypatch.setattr(queries.models, "fit", lambda panel, model: seen.append(
        panel._jdf.queryExecution().executedPlan().toString()) or real(panel, model))
    assert queries.q_elasticity_comparison(spark, SF).count() == 4
    assert len(seen) == 2 and not any("Exchange" in plan or "Join" in plan for plan in seen)
