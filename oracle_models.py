"""Generated DuckDB SQL for the estimator queries.

Alternating demeaning as a fixed chain of window CTEs, the normal
equations solved by Gauss-Jordan elimination written out as scalar
expressions (one row per group), and the clustered / HC1 sandwich from
residual score aggregates. Independent of the Spark implementation, which
uses grouped means and checkpointed effect tables instead of windows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

Z_CRIT = "1.959963984540054"


@dataclass
class SqlModel:
    panel: str                 # CTE with the panel rows
    group: list                # group columns
    y: str
    xs: list                   # (name, sql expression) identified regressors
    absorb: list               # effect key columns
    cluster: str | None
    cov: str = "cluster"
    sweeps: int = 16           # enough to converge on the household panel (8 is not)
    k_extra: int = 0           # design columns absorbed by an effect (counted in k)
    where: str = "TRUE"
    components: bool = False   # two-way HC1 rank via connected components
    tag: str = "m"
    extra_cols: dict = field(default_factory=dict)


def _gj_inverse(t: str, src: str, k: int, group: list) -> tuple[list, str]:
    """CTEs inverting the k x k matrix a_i_j (columns of ``src``)."""
    g = ", ".join(group)
    ctes = []
    prev = src
    cur_a = {(i, j): f"a_{i}_{j}" for i in range(k) for j in range(k)}
    cur_v = {(i, j): ("1.0" if i == j else "0.0") for i in range(k) for j in range(k)}
    # step 0: materialise identity
    sel = [f"{cur_a[(i, j)]}" for i in range(k) for j in range(k)]
    sel += [f"{cur_v[(i, j)]} AS v_{i}_{j}" for i in range(k) for j in range(k)]
    ctes.append(f"{t}_gj0 AS (SELECT {g}, {', '.join(sel)} FROM {prev})")
    prev = f"{t}_gj0"
    for p in range(k):
        exprs = []
        for j in range(k):
            exprs.append(f"a_{p}_{j} / a_{p}_{p} AS a_{p}_{j}")
            exprs.append(f"v_{p}_{j} / a_{p}_{p} AS v_{p}_{j}")
        for i in range(k):
            if i == p:
                continue
            for j in range(k):
                exprs.append(f"a_{i}_{j} - a_{i}_{p} * (a_{p}_{j} / a_{p}_{p}) AS a_{i}_{j}")
                exprs.append(f"v_{i}_{j} - a_{i}_{p} * (v_{p}_{j} / a_{p}_{p}) AS v_{i}_{j}")
        ctes.append(f"{t}_gj{p + 1} AS (SELECT {g}, {', '.join(exprs)} FROM {prev})")
        prev = f"{t}_gj{p + 1}"
    return ctes, prev


def model_sql(m: SqlModel, select_tail) -> str:
    """Return CTE text (starting with ', ') ending in a SELECT produced by
    ``select_tail(final_cte, names)``."""
    t = m.tag
    k = len(m.xs)
    nv = k + 1
    grp = ", ".join(m.group)
    keys = m.absorb if m.absorb else []
    carry = list(dict.fromkeys(m.group + keys + ([m.cluster] if m.cluster else [])))
    cs = ", ".join(carry)
    vals = [f"{m.y} AS v0"] + [f"{expr} AS v{i + 1}" for i, (_, expr) in enumerate(m.xs)]
    nn = " AND ".join([f"({m.y}) IS NOT NULL"] + [f"({e}) IS NOT NULL" for _, e in m.xs])
    ctes = [f"{t}_d0 AS (SELECT {cs}, {', '.join(vals)} FROM {m.panel} WHERE {m.where} AND {nn})"]
    prev = f"{t}_d0"
    step = 0
    eff = keys if keys else [None]
    sweeps = m.sweeps if len(eff) > 1 else 1
    for _ in range(sweeps):
        for key in eff:
            part = ", ".join(m.group + ([key] if key else []))
            dem = [f"v{i} - avg(v{i}) OVER (PARTITION BY {part}) AS v{i}" for i in range(nv)]
            step += 1
            ctes.append(f"{t}_d{step} AS (SELECT {cs}, {', '.join(dem)} FROM {prev})")
            prev = f"{t}_d{step}"
    dem_cte = prev
    # raw y sums, level counts
    lv = [f"count(DISTINCT {key}) AS lv{j}" for j, key in enumerate(keys)]
    ctes.append(f"{t}_raw AS (SELECT {grp}, count(*) AS n, sum(v0) AS sy, sum(v0 * v0) AS syy"
                + (", " + ", ".join(lv) if lv else "") + f" FROM {t}_d0 GROUP BY {grp})")
    mom = [f"sum(v{i + 1} * v{j + 1}) AS a_{i}_{j}" for i in range(k) for j in range(k)]
    mom += [f"sum(v{i + 1} * v0) AS b_{i}" for i in range(k)]
    ctes.append(f"{t}_mom AS (SELECT {grp}, {', '.join(mom)} FROM {dem_cte} GROUP BY {grp})")
    gj, inv = _gj_inverse(t, f"{t}_mom", k, m.group)
    ctes += gj
    beta = [" + ".join(f"i.v_{i}_{j} * mm.b_{j}" for j in range(k)) + f" AS beta_{i}"
            for i in range(k)]
    inv_cols = [f"i.v_{i}_{j} AS v_{i}_{j}" for i in range(k) for j in range(k)]
    on = " AND ".join(f"i.{c} = mm.{c}" for c in m.group)
    ctes.append(f"{t}_coef AS (SELECT {', '.join('i.' + c for c in m.group)}, {', '.join(beta)}, "
                f"{', '.join(inv_cols)} FROM {inv} i JOIN {t}_mom mm ON {on})")
    fit = " - ".join(["d.v0"] + [f"c.beta_{i} * d.v{i + 1}" for i in range(k)])
    on2 = " AND ".join(f"d.{c} = c.{c}" for c in m.group)
    ctes.append(f"{t}_res AS (SELECT d.*, {fit} AS u FROM {dem_cte} d JOIN {t}_coef c ON {on2})")
    if m.cov == "cluster":
        sc = [f"sum(v{i + 1} * u) AS s{i}" for i in range(k)]
        ctes.append(f"{t}_sc AS (SELECT {grp}, {m.cluster}, {', '.join(sc)}, sum(u * u) AS ssr "
                    f"FROM {t}_res GROUP BY {grp}, {m.cluster})")
        mt = [f"sum(s{i} * s{j}) AS mt_{i}_{j}" for i in range(k) for j in range(k)]
        ctes.append(f"{t}_meat AS (SELECT {grp}, count(*) AS ncl, sum(ssr) AS ssr, "
                    f"{', '.join(mt)} FROM {t}_sc GROUP BY {grp})")
    else:
        mt = [f"sum(v{i + 1} * v{j + 1} * u * u) AS mt_{i}_{j}" for i in range(k) for j in range(k)]
        ctes.append(f"{t}_meat AS (SELECT {grp}, CAST(NULL AS BIGINT) AS ncl, sum(u * u) AS ssr, "
                    f"{', '.join(mt)} FROM {t}_res GROUP BY {grp})")
    # degrees of freedom
    if keys:
        k_full = f"(1 + {k + m.k_extra} + " + " + ".join(f"(r.lv{j} - 1)" for j in range(len(keys))) + ")"
        if len(keys) == 2:
            rank_fe = "(r.lv0 + r.lv1 - cc.comps)" if m.components else "(r.lv0 + r.lv1 - 1)"
        else:
            rank_fe = "(1 + " + " + ".join(f"(r.lv{j} - 1)" for j in range(len(keys))) + ")"
    else:
        k_full, rank_fe = f"(1 + {k + m.k_extra})", "1"
    if m.cov == "cluster":
        factor = f"(mt.ncl / (mt.ncl - 1.0)) * ((r.n - 1.0) / (r.n - {k_full}))"
    else:
        factor = f"(r.n / (r.n - ({rank_fe} + {k})))"
    var = []
    for i in range(k):
        terms = [f"c.v_{i}_{j} * mt.mt_{j}_{l} * c.v_{l}_{i}" for j in range(k) for l in range(k)]
        var.append(f"({' + '.join(terms)}) * {factor} AS var_{i}")
    joins = (f"FROM {t}_coef c JOIN {t}_meat mt ON "
             + " AND ".join(f"c.{x} = mt.{x}" for x in m.group)
             + f" JOIN {t}_raw r ON " + " AND ".join(f"c.{x} = r.{x}" for x in m.group))
    if m.components:
        joins += f" JOIN {t}_cc cc ON " + " AND ".join(f"c.{x} = cc.{x}" for x in m.group)
        a, b = keys
        ctes.append(f"{t}_edges AS (SELECT DISTINCT {grp}, 'L:' || CAST({a} AS VARCHAR) AS na, "
                    f"'R:' || CAST({b} AS VARCHAR) AS nb FROM {t}_d0)")
        ctes.append(f"{t}_und AS (SELECT {grp}, na AS x, nb AS y FROM {t}_edges UNION ALL "
                    f"SELECT {grp}, nb AS x, na AS y FROM {t}_edges)")
        gsel = ", ".join(m.group)
        gjoin = " AND ".join(f"r.{x} = e.{x}" for x in m.group)
        ctes.append(f"{t}_reach ({gsel}, node, root) AS (SELECT DISTINCT {grp}, x, x FROM {t}_und "
                    f"UNION SELECT {', '.join('e.' + x for x in m.group)}, e.y, r.root "
                    f"FROM {t}_reach r JOIN {t}_und e ON {gjoin} AND r.node = e.x)")
        ctes.append(f"{t}_cc AS (SELECT {grp}, count(DISTINCT lab) AS comps FROM ("
                    f"SELECT {grp}, node, min(root) AS lab FROM {t}_reach GROUP BY {grp}, node) "
                    f"GROUP BY {grp})")
    sel = ", ".join(f"c.{x}" for x in m.group)
    ctes.append(f"{t}_fit AS (SELECT {sel}, r.n, {k_full} AS n_params, mt.ncl, "
                f"1 - mt.ssr / (r.syy - r.sy * r.sy / r.n) AS r2, "
                + ", ".join(f"c.beta_{i}" for i in range(k)) + ", " + ", ".join(var) + f" {joins})")
    names = [n for n, _ in m.xs]
    longs = []
    for i, name in enumerate(names):
        longs.append(f"SELECT {grp}, '{name}' AS term, beta_{i} AS coef, sqrt(var_{i}) AS se, "
                     f"beta_{i} / sqrt(var_{i}) AS z, n, n_params, ncl, r2 FROM {t}_fit")
    ctes.append(f"{t}_long AS ({' UNION ALL '.join(longs)})")
    return ",\n" + ",\n".join(ctes) + "\n" + select_tail(f"{t}_long", names)


def p_of(z: str) -> str:
    """Two-sided normal p-value: the integral from 0 to |z| as its series
    phi(z) * sum of z^(2k+1) / (1 * 3 * ... * (2k+1)); beyond 7 it is 0 here."""
    a = f"greatest(abs({z}), 1e-12)"
    term = (f"exp((2 * k + 1) * ln({a}) - (k + 1) * ln(2.0) - lgamma(k + 1.5) + 0.5 * ln(pi()))")
    total = f"list_sum(list_transform(range(0, 150), lambda k: {term}))"
    return (f"CASE WHEN abs({z}) > 7 THEN 0.0 ELSE "
            f"1 - 2 * exp(-0.5 * ({z}) * ({z})) / sqrt(2 * pi()) * {total} END")


def coef_table(long_cte: str, names) -> str:
    return f"""
SELECT product_category, term, round(coef, 6) AS coef, round(se, 6) AS se, round(z, 6) AS z,
       round({p_of("z")}, 6) AS p_value, round(coef - {Z_CRIT} * se, 6) AS ci_low,
       round(coef + {Z_CRIT} * se, 6) AS ci_high,
       abs(z) > {Z_CRIT} AS significant, n AS n_obs, CAST(n_params AS BIGINT) AS n_params,
       CAST(ncl AS BIGINT) AS n_clusters, round(r2, 6) AS r2
FROM {long_cte}"""


G = ["product_category"]
FE3 = ["product_id", "store_id", "week"]
BASIC = [("log_price", "log_price"), ("is_displayed", "is_displayed"), ("is_mailed", "is_mailed")]

NET_SIZED = """,
net_sized0 AS (
  SELECT n.*, s.store_total_txns, ln(s.store_total_txns) AS log_store_size
  FROM net_panel n LEFT JOIN store_size s ON n.store_id = s.store_id),
net_sized AS (
  SELECT *, log_store_size - avg(log_store_size) OVER () AS log_store_size_c FROM net_sized0)"""

INCOME_TERMS = [
    ("log_price", "log_price"), ("is_displayed", "is_displayed"),
    ("C(income_group)[T.Mid]", "CASE WHEN income_group = 'Mid' THEN 1.0 ELSE 0.0 END"),
    ("C(income_group)[T.High]", "CASE WHEN income_group = 'High' THEN 1.0 ELSE 0.0 END"),
    ("is_mailed", "is_mailed"),
    ("is_displayed:C(income_group)[T.Mid]",
     "is_displayed * CASE WHEN income_group = 'Mid' THEN 1.0 ELSE 0.0 END"),
    ("is_displayed:C(income_group)[T.High]",
     "is_displayed * CASE WHEN income_group = 'High' THEN 1.0 ELSE 0.0 END"),
    ("is_mailed:C(income_group)[T.Mid]",
     "is_mailed * CASE WHEN income_group = 'Mid' THEN 1.0 ELSE 0.0 END"),
    ("is_mailed:C(income_group)[T.High]",
     "is_mailed * CASE WHEN income_group = 'High' THEN 1.0 ELSE 0.0 END"),
]

SIZE_TERMS = [("log_price", "log_price"), ("is_displayed", "is_displayed"),
              ("is_mailed", "is_mailed"),
              ("is_displayed:log_store_size_c", "is_displayed * log_store_size_c"),
              ("is_mailed:log_store_size_c", "is_mailed * log_store_size_c")]

DEPTH_TERMS = [("log_price", "log_price"), ("is_displayed", "is_displayed"),
               ("discount_pct", "discount_pct"), ("is_mailed", "is_mailed"),
               ("is_displayed:discount_pct", "is_displayed * discount_pct"),
               ("is_mailed:discount_pct", "is_mailed * discount_pct")]

UNIFIED_TERMS = [("log_price", "log_price"), ("is_displayed", "is_displayed"),
                 ("discount_pct", "discount_pct"), ("is_mailed", "is_mailed"),
                 ("is_displayed:discount_pct", "is_displayed * discount_pct"),
                 ("is_mailed:discount_pct", "is_mailed * discount_pct"),
                 ("is_displayed:log_store_size_c", "is_displayed * log_store_size_c"),
                 ("is_mailed:log_store_size_c", "is_mailed * log_store_size_c")]


def _ols_naive():
    return model_sql(SqlModel("net_panel", G, "log_qty", BASIC, [], "product_id", tag="nv"),
                     coef_table)


def _fe_elasticity():
    return model_sql(SqlModel("net_panel", G, "log_qty", BASIC, FE3, "product_id", tag="fe"),
                     coef_table)


# The household panel is sparse and converges slowly: 50 sweeps reach the
# fixed point even on the smallest fixture (16 do on sf0.01 only).
HH_SWEEPS = 50


def _fe_income():
    return model_sql(SqlModel("hh_panel", G, "log_qty", INCOME_TERMS, FE3, "household_id",
                              where="income_group IS NOT NULL", sweeps=HH_SWEEPS, tag="inc"),
                     coef_table)


def _fe_store_size():
    return NET_SIZED + model_sql(SqlModel("net_sized", G, "log_qty", SIZE_TERMS, FE3,
                                          "product_id", k_extra=1, tag="ss"), coef_table)


def _fe_discount_depth():
    return model_sql(SqlModel("gross_panel", G, "log_qty", DEPTH_TERMS, FE3, "product_id",
                              tag="dd"), coef_table)


def _fe_unified():
    return model_sql(SqlModel("gross_sized", G, "log_qty", UNIFIED_TERMS, FE3, "product_id",
                              k_extra=1, tag="un"), coef_table)


MART_TERMS = [("log_net_price", "log_net_price"), ("is_displayed", "is_displayed"),
              ("is_mailed", "is_mailed")]


def _elasticity_comparison():
    def tail_naive(long_cte, names):
        return ""
    nv = model_sql(SqlModel("gross_panel", G, "log_qty", MART_TERMS, [], "product_id", tag="mn"),
                   lambda c, n: "")
    fe = model_sql(SqlModel("gross_panel", G, "log_qty", MART_TERMS, FE3, "product_id", tag="mf"),
                   lambda c, n: "")
    return nv + fe + """
SELECT upper(substr(product_category, 1, 1)) || lower(substr(product_category, 2)) AS category,
       'Naive' AS model, round(coef, 6) AS elasticity, round(se, 6) AS se
FROM mn_long WHERE term = 'log_net_price'
UNION ALL
SELECT upper(substr(product_category, 1, 1)) || lower(substr(product_category, 2)) AS category,
       'Fixed Effects' AS model, round(coef, 6) AS elasticity, round(se, 6) AS se
FROM mf_long WHERE term = 'log_net_price'"""


def _promo_uplift():
    fe = model_sql(SqlModel("gross_panel", G, "log_qty", MART_TERMS, FE3, "product_id", tag="mf"),
                   lambda c, n: "")
    return fe + f"""
SELECT upper(substr(product_category, 1, 1)) || lower(substr(product_category, 2)) AS category,
       CASE term WHEN 'is_displayed' THEN 'In-store display' ELSE 'Mailer/flyer feature' END
         AS promo_type,
       round((exp(coef) - 1) * 100, 6) AS pct_lift, round(z, 6) AS z,
       round({p_of("z")}, 6) AS p_value,
       abs(z) > {Z_CRIT} AS significant
FROM mf_long WHERE term IN ('is_displayed', 'is_mailed')"""


SKU_SWEEPS = 30


def _sku_elasticity():
    prefix = """,
sku_cells AS (SELECT *, brand AS sku FROM net_panel),
sku_rank AS (
  SELECT product_category, sku, sum(quantity) AS total_qty, count(*) AS n_obs,
         stddev_samp(log_price) AS sd_lp,
         row_number() OVER (PARTITION BY product_category ORDER BY sum(quantity) DESC, sku ASC)
           AS volume_rank
  FROM sku_cells GROUP BY product_category, sku),
sku_eligible AS (
  SELECT product_category, sku FROM sku_rank
  WHERE volume_rank <= 6 AND n_obs >= 200 AND sd_lp >= 0.01),
sku_panel AS (
  SELECT c.* FROM sku_cells c JOIN sku_eligible e
    ON c.product_category = e.product_category AND c.sku = e.sku)"""
    body = model_sql(SqlModel("sku_panel", ["product_category", "sku"], "log_qty", BASIC,
                              ["store_id", "week"], None, cov="hc1", sweeps=SKU_SWEEPS,
                              components=True, tag="sk"), lambda c, n: f"""
SELECT product_category, sku, n AS n_obs, round(coef, 6) AS elasticity, round(se, 6) AS se,
       round(z, 6) AS z, round({p_of("z")}, 6) AS p_value, abs(z) > {Z_CRIT} AS significant
FROM {c} WHERE term = 'log_price'""")
    return prefix + body


FIXTURE_MIN_OBS = 45


def _sku_elasticity_product():
    prefix = f""",
sp_rank AS (
  SELECT product_category, product_id, min(brand) AS brand, min(package_size) AS package_size, count(*) AS n,
         stddev_samp(log_price) AS sd_log_price,
         CAST(row_number() OVER (PARTITION BY product_category ORDER BY sum(quantity) DESC, product_id ASC) AS INTEGER)
           AS volume_rank
  FROM net_panel GROUP BY product_category, product_id),
sp_top AS (
  SELECT *, n >= {FIXTURE_MIN_OBS} AND coalesce(sd_log_price, 0) >= 0.01 AS passed FROM sp_rank WHERE volume_rank <= 6),
sp_panel AS (
  SELECT n.* FROM net_panel n JOIN sp_top t ON n.product_id = t.product_id AND n.product_category = t.product_category AND t.passed)"""
    body = model_sql(SqlModel("sp_panel", ["product_category", "product_id"], "log_qty", BASIC, ["week"], None,
                              cov="hc1", tag="sp"), lambda c, n: f""",
sp_found AS (SELECT * FROM {c} WHERE term = 'log_price')
SELECT t.product_category, t.product_id, t.volume_rank, t.brand, t.package_size, t.n,
       round(t.sd_log_price, 6) AS sd_log_price, t.passed, round(f.coef, 6) AS elasticity, round(f.se, 6) AS se,
       round(f.z, 6) AS z, round({p_of("f.z")}, 6) AS p_value, abs(f.z) > {Z_CRIT} AS significant
FROM sp_top t LEFT JOIN sp_found f ON t.product_category = f.product_category AND t.product_id = f.product_id""")
    return prefix + body


def _unified_wide():
    return model_sql(SqlModel("gross_sized", G, "log_qty", UNIFIED_TERMS, FE3, "product_id",
                              k_extra=1, tag="un"), lambda c, n: "") + """,
un_w AS (
  SELECT product_category,
         max(CASE WHEN term = 'is_displayed' THEN coef END) AS b_d,
         max(CASE WHEN term = 'is_mailed' THEN coef END) AS b_m,
         max(CASE WHEN term = 'discount_pct' THEN coef END) AS b_disc,
         max(CASE WHEN term = 'is_displayed:discount_pct' THEN coef END) AS b_dd,
         max(CASE WHEN term = 'is_mailed:discount_pct' THEN coef END) AS b_md,
         max(CASE WHEN term = 'is_displayed:log_store_size_c' THEN coef END) AS b_ds
  FROM un_long GROUP BY product_category),
un_k AS (
  SELECT product_category, 'Display' AS promo_type, b_disc + b_dd AS k FROM un_w
  UNION ALL SELECT product_category, 'Mailer', b_disc + b_md FROM un_w),
programs (product_category, promo_type, target, change) AS (
  VALUES ('MEDIUM', 'Mailer', 0.40, 'Mailer to 40% discount'),
         ('MEDIUM', 'Display', 0.0, 'Display to 0% discount'),
         ('PROMO', 'Display', 0.0, 'Display to 0% discount'),
         ('PROMO', 'Mailer', 0.0, 'Mailer to 0% discount')),
scen AS (
  SELECT p.product_category, p.promo_type, pr.change, sum(p.sales_value) AS actual_revenue,
         sum(p.unit_price * (1 - pr.target) * p.quantity
             * exp((pr.target - p.discount_pct) * k.k)) AS scenario_revenue,
         count(*) AS n_cells
  FROM gross_sized_long p
  JOIN programs pr ON p.product_category = pr.product_category AND p.promo_type = pr.promo_type
  JOIN un_k k ON p.product_category = k.product_category AND p.promo_type = k.promo_type
  GROUP BY p.product_category, p.promo_type, pr.change)"""


SIZED_LONG = """,
gross_sized_long AS (
  SELECT *, 'Display' AS promo_type FROM gross_sized WHERE is_displayed = 1
  UNION ALL
  SELECT *, 'Mailer' AS promo_type FROM gross_sized WHERE is_mailed = 1)"""

TITLE = "upper(substr({c}, 1, 1)) || lower(substr({c}, 2))"


def _lift_by_store_size():
    return SIZED_LONG + _unified_wide() + """,
q AS (SELECT quantile_cont(log_store_size_c, 0.05) AS lo,
             quantile_cont(log_store_size_c, 0.95) AS hi FROM gross_sized),
g AS (SELECT CAST(range AS INTEGER) AS point,
             CASE WHEN range = 39 THEN hi
                  ELSE lo + CAST(range AS DOUBLE) * ((hi - lo) / 39.0) END AS s
      FROM range(40), q)
SELECT """ + TITLE.format(c="w.product_category") + """ AS category, g.point,
       round(g.s, 6) AS log_store_size_c,
       round((exp(w.b_d + w.b_ds * g.s) - 1) * 100, 6) AS predicted_lift_pct
FROM g, un_w w"""


def _lift_by_discount():
    return SIZED_LONG + _unified_wide() + """,
g AS (SELECT CAST(range AS INTEGER) AS point,
             CASE WHEN range = 39 THEN 0.5 ELSE 0.0 + CAST(range AS DOUBLE) * (0.5 / 39.0) END AS d
      FROM range(40))
SELECT """ + TITLE.format(c="w.product_category") + """ AS category, g.point,
       round(g.d * 100, 6) AS discount_pct, 'Display' AS promo_type,
       round((exp(w.b_d + w.b_dd * g.d) - 1) * 100, 6) AS predicted_lift_pct FROM g, un_w w
UNION ALL
SELECT """ + TITLE.format(c="w.product_category") + """ AS category, g.point,
       round(g.d * 100, 6) AS discount_pct, 'Mailer' AS promo_type,
       round((exp(w.b_m + w.b_md * g.d) - 1) * 100, 6) AS predicted_lift_pct FROM g, un_w w"""


def _optimal_discount():
    return SIZED_LONG + _unified_wide() + """,
cur AS (SELECT product_category, promo_type, avg(discount_pct) AS cur
        FROM gross_sized_long GROUP BY product_category, promo_type)
SELECT """ + TITLE.format(c="k.product_category") + """ AS category, k.promo_type,
       round(k.k, 6) AS combined_slope_k,
       round(CASE WHEN k.k > 1 THEN greatest(0.0, 1 - 1 / k.k) ELSE 0.0 END * 100, 6)
         AS model_optimal_discount_pct,
       round(c.cur * 100, 6) AS current_avg_discount_pct
FROM un_k k LEFT JOIN cur c ON k.product_category = c.product_category
                           AND k.promo_type = c.promo_type"""


def _optimal_mart(tail: str = "") -> str:
    """The optimal-discount table at its published decimals."""
    return _optimal_discount().replace("round(k.k, 6)", "round(k.k, 3)").replace(
        "ELSE 0.0 END * 100, 6)", "ELSE 0.0 END * 100, 1)").replace("round(c.cur * 100, 6)", "round(c.cur * 100, 1)") + tail


def _mart_views():
    head, select = _optimal_mart().rsplit("\nSELECT ", 1)
    return head + ", opt AS (SELECT " + select + """)
SELECT category AS "Category", promo_type AS "Promo type", combined_slope_k AS "Combined slope",
       model_optimal_discount_pct AS "Model optimal discount, percent",
       current_avg_discount_pct AS "Current average discount, percent",
       category || ' — ' || promo_type AS label
FROM opt WHERE category = 'Promo'"""


def _marts_read_back():
    fits = "".join(model_sql(SqlModel("gross_panel", G, "log_qty", MART_TERMS, keys, "product_id", tag=tag),
                             lambda c, n: "") for tag, keys in (("mn", []), ("mf", FE3)))
    t = TITLE.format(c="product_category")
    weeks = ("(SELECT product_category, week, avg(net_unit_price) AS avg_price, sum(quantity) AS total_qty, "
             "count(quantity) AS n_txn, avg(is_promo) AS promo_rate FROM gross_panel GROUP BY product_category, week)")
    size_points = ("(SELECT lo + i * (hi - lo) / 39.0 AS x FROM range(40) r(i), (SELECT "
                   "quantile_cont(log_store_size_c, 0.05) AS lo, quantile_cont(log_store_size_c, 0.95) AS hi FROM gross_sized))")
    depth_points = "(SELECT i * 0.5 / 39.0 AS x FROM range(40) r(i))"
    # mart, label, {column: value}, FROM ...
    lists = [
        ("weekly_trends", "product_category || ' — ' || week",
         {c: c for c in ("avg_price", "total_qty", "n_txn", "promo_rate")}, weeks),
        ("price_by_promo", "product_category || ' — ' || is_promo", {"unit_price": "net_unit_price"}, "gross_panel"),
        ("store_size_curve", t, {"log_store_size_c": "x", "predicted_lift_pct": "(exp(b_d + b_ds * x) - 1) * 100"},
         f"{size_points}, un_w"),
        *[("discount_depth_curve", f"{t} || ' — {kind}'",
           {"discount_pct": "x * 100", "predicted_lift_pct": f"(exp({b} + {bd} * x) - 1) * 100"},
           f"{depth_points}, un_w") for kind, b, bd in (("Display", "b_d", "b_dd"), ("Mailer", "b_m", "b_md"))],
        *[("elasticity_comparison", f"{t} || ' — {kind}'", {"elasticity": "coef", "se": "se"},
           f"{tag}_long WHERE term = 'log_net_price'") for kind, tag in (("Naive", "mn"), ("Fixed Effects", "mf"))],
        ("promo_uplift", f"{t} || ' — ' || if(term = 'is_displayed', 'In-store display', 'Mailer/flyer feature')",
         {"pct_lift": "round((exp(coef) - 1) * 100, 1)", "p_value": f"round({p_of('z')}, 4)"},
         "mf_long WHERE term IN ('is_displayed', 'is_mailed')"),
        ("optimal_discount_table", "category || ' — ' || promo_type",
         {c: c for c in ("combined_slope_k", "model_optimal_discount_pct", "current_avg_discount_pct")}, "opt"),
        ("optimization_scenarios", f"{t} || ' — ' || change",
         {"actual_revenue": "round(actual_revenue)", "scenario_revenue": "round(scenario_revenue)",
          "delta": "round(scenario_revenue - actual_revenue)",
          "pct_change": "round((scenario_revenue - actual_revenue) / actual_revenue * 100, 1)"}, "scen"),
        ("store_targeting_scenario", "''",
         {"current_avg_size": "round(current_avg_size, 3)", "top_tercile_avg_size": "round(top_tercile_avg_size, 3)",
          "actual_revenue": "round(actual_revenue)", "scenario_revenue": "round(scenario_revenue)", "delta": "round(delta)",
          "pct_change": "round(pct_change, 1)"}, "target"),
        ("summary", "'Medium — Promo'",
         {"n_transactions": "cells", "n_products": "products", "total_combined_delta": "d", "total_promo_revenue": "a",
          "pct_opportunity_vs_promo_revenue": "round(d / a * 100, 1)", "total_category_revenue": "revenue",
          "pct_opportunity_vs_total_category_revenue": "round(d / revenue * 100, 1)"},
         "(SELECT sum(round(scenario_revenue - actual_revenue)) AS d, sum(round(actual_revenue)) AS a FROM scen), "
         "(SELECT sum(n) AS cells, sum(p) AS products, trunc(sum(r)) AS revenue FROM (SELECT count(*) AS n, "
         "count(DISTINCT product_id) AS p, sum(sales_value) AS r FROM gross_sized GROUP BY product_category))"),
    ]
    head, opt = _optimal_mart().rsplit("\nSELECT ", 1)
    target = _store_targeting()[len(SIZED_LONG + _unified_wide()):]
    tail_head, tail_select = target.rsplit("\nSELECT ", 1)
    exact = tail_select.replace(", 6)", ", 12)").replace(", 2)", ", 12)")
    long = " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, {label} AS label, '{column}' AS metric, round(CAST({value} AS DOUBLE), 4) + 0.0 AS value FROM {source}"
        for mart, label, columns, source in lists for column, value in columns.items())
    return head + ", opt AS (SELECT " + opt + ")" + tail_head + ", target AS (SELECT " + exact + ")" + fits + "\n" + long


def _revenue_scenarios():
    return SIZED_LONG + _unified_wide() + """
SELECT """ + TITLE.format(c="product_category") + """ AS category, promo_type, change,
       round(actual_revenue, 2) AS actual_revenue, round(scenario_revenue, 2) AS scenario_revenue,
       round(scenario_revenue - actual_revenue, 2) AS delta,
       round((scenario_revenue - actual_revenue) / actual_revenue * 100, 6) AS pct_change, n_cells
FROM scen"""


def _store_targeting():
    return SIZED_LONG + _unified_wide() + """,
cat AS (SELECT * FROM gross_sized WHERE product_category = 'MEDIUM'),
disp AS (SELECT avg(log_store_size_c) AS cur, sum(sales_value) AS actual
         FROM cat WHERE is_displayed = 1),
st AS (SELECT DISTINCT store_id, log_store_size_c FROM cat),
cut AS (SELECT quantile_cont(log_store_size_c, 2.0 / 3.0) AS c FROM st),
top AS (SELECT avg(log_store_size_c) AS top FROM st, cut WHERE log_store_size_c >= cut.c),
b AS (SELECT b_ds FROM un_w WHERE product_category = 'MEDIUM')
SELECT round(cur, 6) AS current_avg_size, round(top, 6) AS top_tercile_avg_size,
       round(actual, 2) AS actual_revenue,
       round(actual * exp((top - cur) * b_ds), 2) AS scenario_revenue,
       round(actual * exp((top - cur) * b_ds) - actual, 2) AS delta,
       round((actual * exp((top - cur) * b_ds) / actual - 1) * 100, 6) AS pct_change
FROM disp, top, b"""


def _overview_summary():
    return SIZED_LONG + _unified_wide() + """,
pc AS (SELECT product_category, count(*) AS cells, count(DISTINCT product_id) AS products,
              sum(sales_value) AS revenue FROM gross_sized GROUP BY product_category),
tot AS (SELECT CAST(sum(cells) AS BIGINT) AS n_transactions,
               CAST(sum(products) AS BIGINT) AS n_products,
               CAST(trunc(sum(revenue)) AS BIGINT) AS total_category_revenue FROM pc),
sc AS (SELECT sum(round(scenario_revenue - actual_revenue)) AS delta, sum(round(actual_revenue)) AS actual FROM scen)
SELECT n_transactions, n_products, CAST(delta AS BIGINT) AS total_combined_delta,
       CAST(actual AS BIGINT) AS total_promo_revenue,
       round(delta / actual * 100, 6) AS pct_opportunity_vs_promo_revenue,
       total_category_revenue,
       round(delta / total_category_revenue * 100, 6) AS pct_opportunity_vs_total_category_revenue
FROM tot, sc"""


def _lift_by_store_size_notebook():
    return NET_SIZED + model_sql(SqlModel("net_sized", G, "log_qty", SIZE_TERMS, FE3,
                                          "product_id", k_extra=1, tag="ss"),
                                 lambda c, n: "") + """,
w AS (SELECT product_category,
             max(CASE WHEN term = 'is_displayed' THEN coef END) AS b_d,
             max(CASE WHEN term = 'is_displayed:log_store_size_c' THEN coef END) AS b_ds
      FROM ss_long GROUP BY product_category),
q AS (SELECT quantile_cont(log_store_size_c, 0.05) AS lo,
             quantile_cont(log_store_size_c, 0.95) AS hi FROM net_sized),
g AS (SELECT CAST(range AS INTEGER) AS point,
             CASE WHEN range = 49 THEN hi
                  ELSE lo + CAST(range AS DOUBLE) * ((hi - lo) / 49.0) END AS s
      FROM range(50), q)
SELECT """ + TITLE.format(c="w.product_category") + """ AS category, g.point,
       round(g.s, 6) AS log_store_size_c,
       round((exp(w.b_d + w.b_ds * g.s) - 1) * 100, 6) AS predicted_lift_pct
FROM g, w"""


def _lift_by_discount_notebook():
    return model_sql(SqlModel("gross_panel", G, "log_qty", DEPTH_TERMS, FE3, "product_id",
                              tag="dd"), lambda c, n: "") + """,
w AS (SELECT product_category,
             max(CASE WHEN term = 'is_displayed' THEN coef END) AS b_d,
             max(CASE WHEN term = 'is_mailed' THEN coef END) AS b_m,
             max(CASE WHEN term = 'is_displayed:discount_pct' THEN coef END) AS b_dd,
             max(CASE WHEN term = 'is_mailed:discount_pct' THEN coef END) AS b_md
      FROM dd_long GROUP BY product_category),
g AS (SELECT CAST(range AS INTEGER) AS point,
             CASE WHEN range = 49 THEN 0.4 ELSE 0.0 + CAST(range AS DOUBLE) * (0.4 / 49.0) END AS d
      FROM range(50))
SELECT """ + TITLE.format(c="w.product_category") + """ AS category, g.point,
       round(g.d * 100, 6) AS discount_pct, 'Display' AS promo_type,
       round((exp(w.b_d + w.b_dd * g.d) - 1) * 100, 6) AS predicted_lift_pct FROM g, w
UNION ALL
SELECT """ + TITLE.format(c="w.product_category") + """ AS category, g.point,
       round(g.d * 100, 6) AS discount_pct, 'Mailer' AS promo_type,
       round((exp(w.b_m + w.b_md * g.d) - 1) * 100, 6) AS predicted_lift_pct FROM g, w"""


def _income_interactions():
    return model_sql(SqlModel("hh_panel", G, "log_qty", INCOME_TERMS, FE3, "household_id",
                              where="income_group IS NOT NULL", sweeps=HH_SWEEPS, tag="inc"),
                     lambda c, n: coef_table(c, n) + " WHERE term LIKE '%income_group%'")


MODEL_BODIES = {
    "mart_views": _mart_views,
    "marts_read_back": _marts_read_back,
    "ols_naive": _ols_naive,
    "fe_elasticity": _fe_elasticity,
    "elasticity_comparison": _elasticity_comparison,
    "promo_uplift": _promo_uplift,
    "sku_elasticity": _sku_elasticity,
    "sku_elasticity_product": _sku_elasticity_product,
    "fe_income": _fe_income,
    "fe_store_size": _fe_store_size,
    "fe_discount_depth": _fe_discount_depth,
    "fe_unified": _fe_unified,
    "lift_by_store_size": _lift_by_store_size,
    "lift_by_discount": _lift_by_discount,
    "optimal_discount": _optimal_discount,
    "revenue_scenarios": _revenue_scenarios,
    "store_targeting": _store_targeting,
    "overview_summary": _overview_summary,
    "lift_by_store_size_notebook": _lift_by_store_size_notebook,
    "lift_by_discount_notebook": _lift_by_discount_notebook,
    "income_interactions": _income_interactions,
}
