"""Sources, sinks, streaming ingest, graph helper and the driver contract."""

import re
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF
from shelfwise.operators import lineage
from shelfwise.operators.graph import bipartite_components
from shelfwise.sources import readers, schemas, sinks
from shelfwise.streaming import ingest


def test_csv_to_parquet_keeps_string_ids(spark):
    d = tempfile.mkdtemp(prefix="sw-test-")
    with open(f"{d}/p.csv", "w") as f:
        f.write("product_id,store_id,week,display_location,mailer_location\n"
                "00123,7,3,0,A\n")
    readers.csv_to_parquet(spark, f"{d}/p.csv", f"{d}/out", schemas.RAW_PROMOTIONS)
    row = spark.read.parquet(f"{d}/out").first()
    assert row.product_id == "00123" and row.week == 3   # no integer inference


def test_write_raw_tables_skips_existing(spark):
    d = tempfile.mkdtemp(prefix="sw-test-")
    a = spark.range(3).withColumnRenamed("id", "x")
    readers.write_raw_tables({"t": a}, d)
    readers.write_raw_tables({"t": spark.range(10).withColumnRenamed("id", "x")}, d)
    assert spark.read.parquet(f"{d}/t").count() == 3     # second write skipped (A5)


def test_streaming_ingest_is_incremental(spark):
    d = tempfile.mkdtemp(prefix="sw-test-")
    os.makedirs(f"{d}/in")
    hdr = "product_id,store_id,week,display_location,mailer_location\n"
    with open(f"{d}/in/a.csv", "w") as f:
        f.write(hdr + "p1,s1,1,3,0\np2,s1,1,0,A\n")
    r1 = ingest.ingest_csv(spark, f"{d}/in", schemas.RAW_PROMOTIONS, f"{d}/out", f"{d}/ck")
    with open(f"{d}/in/b.csv", "w") as f:
        f.write(hdr + "p3,s2,2,0,A\n")
    r2 = ingest.ingest_csv(spark, f"{d}/in", schemas.RAW_PROMOTIONS, f"{d}/out", f"{d}/ck")
    assert r1["rows"] == 2 and r2["rows"] == 1           # only the new file is read
    assert spark.read.parquet(f"{d}/out").count() == 3


def test_json_marts_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="sw-test-")
    df = spark.createDataFrame([("Eggs", "Display", 0.173), ("Eggs", "Mailer", 1.671)],
                               "category string, promo_type string, k double")
    sinks.write_json_records(df, f"{d}/rec.json")
    files = [f for f in os.listdir(f"{d}/rec.json") if f.startswith("part-")]
    with open(f"{d}/rec.json/{files[0]}") as f:
        assert json.load(f)[1]["k"] == 1.671              # a records array
    back = readers.read_mart_json(spark, f"{d}/rec.json").orderBy("k").collect()
    assert [r.promo_type for r in back] == ["Display", "Mailer"]
    one = spark.createDataFrame([(0.059, 4032.0)], "current_avg_size double, actual double")
    sinks.write_json_object(one, f"{d}/obj.json")
    assert readers.json_object(spark, f"{d}/obj.json")["actual"] == 4032.0


def test_components(spark):
    edges = spark.createDataFrame([("g", 1, 10), ("g", 2, 10), ("g", 3, 11), ("h", 1, 1)],
                                  "grp string, s int, w int")
    sc = lineage.Scratch(spark, "test")
    got = {r.grp: r.comps for r in
           bipartite_components(edges, ["grp"], "s", "w", sc).collect()}
    assert got == {"g": 2, "h": 1}


def test_contract_queries_and_oracles(spark):
    import __spark_entry__ as E
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 49
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["category", "model", "elasticity", "se"]
    assert {(r.category, r.model) for r in rows} == {(c, m) for c in ("Medium", "Promo") for m in ("Naive", "Fixed Effects")}
    assert all(r.elasticity < 0 < r.se for r in rows)


@pytest.mark.parametrize("name", ["row_counts", "category_summary", "panel_coverage"])
def test_small_queries_run_on_smoke_data(spark, name):
    import __spark_entry__ as E
    assert E.queries()[name](spark, SF).count() > 0


def test_mart_views(spark):
    mart = spark.createDataFrame([("Eggs", "Display", 0.1, 0.0, 20.5),
                                  ("Bath Tissues", "Mailer", -0.01, 0.0, 27.6)],
                                 list(readers.OPTIMAL_DISCOUNT_DISPLAY))
    sub = readers.select_category(mart, "BATH TISSUES")
    assert sub.count() == 1
    shown = readers.display_optimal_discount(sub)
    assert shown.columns[0] == "Category" and "Model optimal discount, percent" in shown.columns


def test_a_mart_computes_what_it_publishes(spark, monkeypatch):
    """The optimal-discount mart alone needs no revenue scenarios."""
    from shelfwise.plans import marts
    table = spark.createDataFrame([("Eggs", "Display", 0.1, 0.0, 20.5)], list(readers.OPTIMAL_DISCOUNT_DISPLAY))
    monkeypatch.setattr(marts.models, "unified_model", lambda panel: None)
    monkeypatch.setattr(marts.optimize, "optimal_discount", lambda panel, coefs: table)
    monkeypatch.setattr(marts.optimize, "revenue_scenarios", lambda *a: pytest.fail("scenarios computed"))
    out = marts._write_marts(spark, table, ("A", "B"), tempfile.mkdtemp(prefix="sw-test-"), {"optimal_discount_table"})
    assert list(out) == ["optimal_discount_table"]
    assert readers.json_object(spark, out["optimal_discount_table"])["promo_type"] == "Display"


def test_build_warehouse_writes_all_tables(spark):
    from shelfwise.operators import warehouse
    from shelfwise.sources import binding
    d = tempfile.mkdtemp(prefix="sw-test-")
    raw = binding.raw_tables(spark, SF)
    paths = warehouse.build_warehouse(raw, d)
    assert set(paths) == {"dim_product", "dim_household", "dim_campaign",
                          "bridge_household_campaign", "fact_transactions", "fact_promotions"}
    written = {n: spark.read.parquet(p) for n, p in paths.items()}
    lazy = warehouse.warehouse_tables(raw)
    a = {r.tbl: r.n_rows for r in warehouse.row_counts(written).collect()}
    b = {r.tbl: r.n_rows for r in warehouse.row_counts(lazy).collect()}
    assert a == b and a["fact_transactions"] > 0


def test_mart_job_writes_and_reads_all_marts(spark):
    from shelfwise.plans import marts
    from shelfwise.plans.context import FOCUS, Context
    ctx = Context(spark, SF)
    out = marts.build_marts(spark, ctx.txn, ctx.products, ctx.promos, FOCUS,
                            marts.scratch_dir(spark, "marts-test"))
    assert set(out) == set(marts.ALL_MARTS)
    for name in marts.PARQUET_MARTS:
        assert readers.read_mart_parquet(spark, out[name]).count() > 0
    for name in marts.RECORD_MARTS:
        assert readers.read_mart_json(spark, out[name]).count() > 0
    summary = readers.json_object(spark, out["summary"])
    assert all(isinstance(summary[c], int) for c in ("n_transactions", "total_category_revenue", "total_combined_delta"))
    assert summary["n_transactions"] > 0 and "pct_opportunity_vs_promo_revenue" in summary
    curve = readers.read_mart_parquet(spark, out["discount_depth_curve"])
    assert curve.count() == 2 * 2 * 40


def test_ingest_counts_all_rows_and_raises_on_timeout(spark, tmp_path):
    from shelfwise.streaming.ingest import ingest_csv
    spark.range(200).selectExpr("cast(id as string) as a").repartition(12).write.option("header", True).csv(str(tmp_path / "in"))
    schema = "a string"
    from pyspark.sql import types as T
    kind = T.StructType([T.StructField("a", T.StringType())])
    got = ingest_csv(spark, str(tmp_path / "in"), kind, str(tmp_path / "out"), str(tmp_path / "ck"), max_files_per_trigger=3)
    assert got["rows"] == 200 and got["batches"] == 4
    assert spark.read.schema(schema).parquet(str(tmp_path / "out")).count() == 200
    with pytest.raises(TimeoutError):
        ingest_csv(spark, str(tmp_path / "in"), kind, str(tmp_path / "out2"), str(tmp_path / "ck2"), 1, timeout_s=0.01)


def test_records_mart_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "MAX_RECORDS", 3)
    with pytest.raises(ValueError):
        sinks.write_json_records(spark.range(4), str(tmp_path / "r.json"))


def test_group_quantiles_equal_numpy(spark):
    import numpy as np
    from shelfwise.operators.describe import group_quantiles
    rng = np.random.default_rng(4)
    rows = [("a", float(v), 1) for v in np.round(rng.lognormal(0, 2, 800), 3)]
    rows += [("b", float(v), int(w)) for v, w in zip(rng.integers(0, 9, 60), rng.integers(1, 6, 60))]
    rows += [("c", 5.0, 2), ("d", None, 3), ("e", -1.0, 1), ("e", 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, v double, n_lines long")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    got = {r.g: [r[n] for n in names] for r in group_quantiles(df, ["g"], "v", probs, names).collect()}
    for g in "abce":
        values = np.repeat([v for k, v, _ in rows if k == g], [w for k, _, w in rows if k == g])
        np.testing.assert_allclose(got[g], np.quantile(values, probs), rtol=1e-12)
    assert "d" not in got


def test_an_outlier_does_not_make_a_large_sort(spark, monkeypatch):
    """One value a million times larger, a group of most rows: what is put in
    order at once stays below the bound and the result is exact."""
    import numpy as np
    from shelfwise.operators import describe
    rng = np.random.default_rng(9)
    hot = np.concatenate([rng.lognormal(0, 1, 30_000), [1e6, 1e12, -5e9], np.repeat(1.25, 9_000)])
    rows = [("hot", float(v)) for v in hot] + [("small", float(v)) for v in rng.normal(size=50)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    monkeypatch.setattr(describe, "SORTED", 500)
    monkeypatch.setattr(describe, "BINS", 64)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    scratch = lineage.Scratch(spark, "ranks")
    try:
        values = scratch.cut(describe.value_counts(df, ["g"], "v"))
        spans = describe.rank_intervals(values, ["g"], probs, scratch).collect()
        assert max(r._rows for r in spans) <= 500 and sum(r._rows for r in spans if r.g == "hot") <= 500 * len(probs)
    finally:
        scratch.close()
    names = [f"q{i}" for i in range(len(probs))]
    got = {r.g: [r[n] for n in names] for r in describe.group_quantiles(df, ["g"], "v", probs, names).collect()}
    for g in ("hot", "small"):
        np.testing.assert_allclose(got[g], np.quantile([v for k, v in rows if k == g], probs), rtol=1e-12)
    assert set(got) == {"hot", "small"}


def test_warehouse_is_resumed_and_repaired(spark, tmp_path):
    from shelfwise.operators import warehouse
    from shelfwise.plans.context import Context
    from shelfwise.plans.queries import _raw
    raw, out = _raw(Context(spark, SF)), str(tmp_path / "wh")
    assert {done for *_, done in warehouse.rebuild_warehouse(raw, out)} == {"built"}
    assert {done for *_, done in warehouse.rebuild_warehouse(raw, out)} == {"skipped"}
    # a table that lost a file, one whose run ended before its entry, one of other columns
    lost = sorted(f for f in os.listdir(f"{out}/fact_promotions") if f.startswith("part-"))[0]
    os.remove(f"{out}/fact_promotions/{lost}")
    spark.range(3).selectExpr("id as half").write.mode("overwrite").parquet(f"{out}/dim_campaign")
    import shutil
    shutil.rmtree(f"{out}/_manifest/dim_campaign")
    raw["products"] = raw["products"].withColumn("brand", F.col("brand").cast("binary"))
    done = {name: d for name, _, d in warehouse.rebuild_warehouse(raw, out)}
    assert {n for n, d in done.items() if d == "repaired"} == {"fact_promotions", "dim_campaign", "dim_product"}
    with warehouse.Stored(spark, out) as tables:
        assert all(tables[n].count() == df.count() for n, df in warehouse.warehouse_tables(raw).items())


def test_stored_buckets_spare_the_shuffles(spark, tmp_path):
    """With static broadcasts off, a panel of the stored warehouse exchanges
    neither transactions nor promotions."""
    from shelfwise.operators import panels, warehouse
    from shelfwise.plans.context import FOCUS, Context
    from shelfwise.plans.queries import _raw
    out = str(tmp_path / "wh")
    warehouse.rebuild_warehouse(_raw(Context(spark, SF)), out)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with warehouse.Stored(spark, out) as t:
            panel = panels.gross_panel(t["fact_transactions"], t["dim_product"], t["fact_promotions"], FOCUS)
            plan = panel._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and plan.count("Bucketed: true") == 2
            assert panel.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lines_are_not_dealt_out_by_a_few_keys(spark):
    """With static broadcasts off, statistics by category and flag shuffle
    grouped rows only: no exchange of the lines on those keys."""
    from shelfwise.operators import describe
    lines = spark.range(20000).selectExpr("cast(id % 3 as string) as product_category", "cast(id % 2 as int) as is_promo",
                                          "id * 0.37 as unit_price", "id % 50 as product_id", "1.0 as quantity", "2.0 as sales_value")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted = describe.value_counts(lines, ["product_category", "is_promo"], "unit_price")
        assert "hashpartitioning(product_category" in (plan := counted._jdf.queryExecution().executedPlan().toString())
        assert all("_v#" in part.split(")")[0] for part in plan.split("Exchange hashpartitioning(")[1:])
        for df in (describe.boxplot_stats(lines, "is_promo"), describe.category_screening(lines)):
            plan = df._jdf.queryExecution().sparkPlan().toString()
            assert "BroadcastHashJoin" in plan
            executed = df._jdf.queryExecution().executedPlan().toString()
            for part in executed.split("Exchange hashpartitioning(product_category")[1:]:
                # what is exchanged: grouped rows or bins, never lines
                nodes = [re.sub(r"^[\s:+\-*()0-9]*", "", n) for n in part.split("\n")[1:]]
                made = next(n for n in nodes if not n.startswith(("Project", "Filter", "Sort ")))
                assert re.match("(Hash|Sort)Aggregate|Generate|Window", made), made
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
