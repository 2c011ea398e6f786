"""The model catalogue (G1-G7) and the tables built from coefficients
(G14 comparison, G15 uplift, G16 interaction report)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import columns as C
from shelfwise.functions.income import INCOME_GROUPS
from shelfwise.operators import describe
from shelfwise.operators.joins import broadcast_checked
from shelfwise.operators.fixed_effects import DEFAULT_ABSORB, Model, fit, fit_all

CAT = "product_category"

NET_FORMULA = "log_qty ~ log_price + is_displayed + is_mailed"
MART_FORMULA = "log_qty ~ log_net_price + is_displayed + is_mailed"
INCOME_FORMULA = ("log_qty ~ log_price + is_displayed*C(income_group)"
                  " + is_mailed*C(income_group)")
SIZE_FORMULA = ("log_qty ~ log_price + is_displayed*log_store_size_c"
                " + is_mailed*log_store_size_c")
DEPTH_FORMULA = "log_qty ~ log_price + is_displayed*discount_pct + is_mailed*discount_pct"
UNIFIED_FORMULA = ("log_qty ~ log_price + is_displayed*discount_pct + is_mailed*discount_pct"
                   " + is_displayed*log_store_size_c + is_mailed*log_store_size_c")

PROMO_LABELS = {"is_displayed": "In-store display", "is_mailed": "Mailer/flyer feature"}


def naive_ols(panel: DataFrame, formula: str = NET_FORMULA, cluster: str = "product_id",
              by=(CAT,)) -> DataFrame:
    """G1: pooled OLS with intercept per category, clustered errors."""
    return fit(panel, Model(formula, absorb=(), by=tuple(by), cluster=cluster))


def fe_ols(panel: DataFrame, formula: str = NET_FORMULA, cluster: str = "product_id",
           absorb=DEFAULT_ABSORB, by=(CAT,), categorical: dict | None = None) -> DataFrame:
    """Absorbed product, store and week effects."""
    return fit(panel, Model(formula, absorb=tuple(absorb), by=tuple(by), cluster=cluster,
                            categorical=categorical or {}))


def income_model(hh_panel: DataFrame) -> DataFrame:
    """display/mailer x income group (base Low), clustered by household."""
    return fe_ols(hh_panel, INCOME_FORMULA, cluster="household_id",
                  categorical={"income_group": INCOME_GROUPS})


def store_size_model(sized_net_panel: DataFrame) -> DataFrame:
    """G5 (the size main effect is absorbed by store effects and dropped)."""
    return fe_ols(sized_net_panel, SIZE_FORMULA)


def discount_depth_model(gross_panel: DataFrame) -> DataFrame:
    """Regular price with discount depth interactions."""
    return fe_ols(gross_panel, DEPTH_FORMULA)


def unified_model(sized_gross_panel: DataFrame) -> DataFrame:
    """The model used by every optimisation step."""
    return fe_ols(sized_gross_panel, UNIFIED_FORMULA)


def mart_models(sized_gross_panel: DataFrame) -> dict[str, DataFrame]:
    """G2 (mart variant) and G7 from one absorption of their columns."""
    return fit_all(sized_gross_panel, {"fixed": Model(MART_FORMULA), "unified": Model(UNIFIED_FORMULA)})


def sku_eligibility(panel: DataFrame, sku: str = "product_id", n_top: int = 6, min_obs: int = 200, min_sd: float = 0.01,
                    attrs=("brand", "package_size")) -> DataFrame:
    """The top-N SKUs by volume per category, with rows, sample
    std(log price), attributes, and whether they pass for a fit of their own
    (n >= min_obs and std >= min_sd). One aggregate of the panel by SKU."""
    keep = [a for a in attrs if a != sku and a in panel.columns]
    # the attributes of one row, not each one's own minimum
    stats = panel.groupBy(CAT, sku).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("log_price").alias("sd_log_price"),
        *([F.min(F.struct(*keep)).alias("_of")] if keep else []))
    found = describe.top_products(panel, n_top, key=sku).join(stats, [CAT, sku])
    passed = (F.col("n") >= min_obs) & (F.coalesce("sd_log_price", F.lit(0.0)) >= min_sd)
    return found.select(CAT, sku, "volume_rank", *(["_of.*"] if keep else []), "n", "sd_log_price", passed.alias("passed"))


def sku_elasticity(panel: DataFrame, sku: str = "product_id", n_top: int = 6,
                   min_obs: int = 200, min_sd: float = 0.01,
                   attrs=("brand", "package_size"), skipped: bool = False, absorb=("store_id", "week")) -> DataFrame:
    """Per-SKU elasticity with store and week effects and HC1 errors,
    for the top-N SKUs by volume per category (E2) that pass the
    eligibility rule (D15). All SKUs are fitted in one job (the SKU joins the
    group key); the rank for HC1 counts store-week components per SKU.
    ``skipped`` reports the SKUs that don't pass too, without estimates."""
    report = sku_eligibility(panel, sku, n_top, min_obs, min_sd, attrs).checkpoint()
    sub = panel.join(broadcast_checked(report.filter("passed").select(CAT, sku)), [CAT, sku], "left_semi")
    res = fit(sub, Model(NET_FORMULA, absorb=tuple(absorb), by=(CAT, sku), cluster=None,
                         cov="hc1", connected=False))
    out = (res.filter(F.col("term") == "log_price")
           .select(CAT, sku, "n_obs", F.col("coef").alias("elasticity"), "se", "z", "p_value",
                   "significant"))
    if skipped:
        return report.join(out.drop("n_obs"), [CAT, sku], "left")
    extra = [a for a in attrs if a in report.columns and a != sku]
    return out.join(report.select(CAT, sku, *extra), [CAT, sku]) if extra else out


def elasticity_comparison(naive: DataFrame, fixed: DataFrame,
                          price_term: str = "log_price") -> DataFrame:
    """Naive vs fixed-effects price coefficient per category."""
    def pick(res, label):
        return (res.filter(F.col("term") == price_term)
                .select(C.title_label(CAT).alias("category"), F.lit(label).alias("model"),
                        F.col("coef").alias("elasticity"), "se"))
    return pick(naive, "Naive").unionByName(pick(fixed, "Fixed Effects"))


def promo_uplift(fixed: DataFrame) -> DataFrame:
    """(exp(beta) - 1) * 100 per promotion type, with p and flag."""
    label = F.create_map(*[F.lit(x) for kv in PROMO_LABELS.items() for x in kv])
    return (fixed.filter(F.col("term").isin(list(PROMO_LABELS)))
            .select(C.title_label(CAT).alias("category"),
                    F.element_at(label, F.col("term")).alias("promo_type"),
                    ((F.exp("coef") - 1) * 100).alias("pct_lift"),
                    "z", "p_value", "significant"))


def interaction_report(res: DataFrame, pattern: str) -> DataFrame:
    """Rows whose term matches a pattern (e.g. 'income_group')."""
    return res.filter(F.col("term").rlike(pattern))


def coefficient_view(res: DataFrame) -> DataFrame:
    """Columns compared against the SQL oracle."""
    return res.select(CAT, "term", "coef", "se", "z", "p_value", "ci_low", "ci_high", "significant",
                      "n_obs", "n_params", "n_clusters", "r2")


def pivot_coefficients(res: DataFrame, terms: list[str]) -> DataFrame:
    """Coefficient table -> one row per category with a column per term
    (for the per-row application in C9). Small: one row per category."""
    sub = res.filter(F.col("term").isin(terms))
    return sub.groupBy(CAT).pivot("term", terms).agg(F.first("coef"))
