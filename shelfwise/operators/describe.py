"""Descriptive aggregates over panels.

Every function is a grouped aggregate with map-side partial aggregation.
Exact quantiles are selected by rank: the lines are counted by group and value
once, as a written table, and the intervals that hold the wanted ranks are
cut down, all probabilities in one pass, until what is put in order at once is
small. Functions with quantiles run when called and return a small table.
Tables of one row per group go back to the lines by a size-checked broadcast,
so lines are never dealt out by a few group keys.
Top-N per group uses ``row_number() <= N``; Spark inserts a partial
window-group limit before the shuffle, so each group ships at most N rows
per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators import lineage
from shelfwise.operators.joins import broadcast_checked, row_bound

CAT = "product_category"

PROMO_TYPES = [("is_displayed", "Display"), ("is_mailed", "Mailer")]


def _w(df: DataFrame):
    """Frequency weight: ``n_lines`` on a compressed line panel, else 1."""
    return F.col("n_lines") if "n_lines" in df.columns else F.lit(1).cast("long")


def _wcount(df: DataFrame, c: str):
    return F.sum(F.when(F.col(c).isNotNull(), _w(df))).cast("long")


def _wavg(df: DataFrame, c: str):
    return F.sum(F.col(c) * _w(df)) / F.sum(F.when(F.col(c).isNotNull(), _w(df)))


#: Bins of a cut, and the different values of an interval that are put in order at once.
BINS = 4096
SORTED = 65_536


def value_counts(df: DataFrame, keys: list, c: str) -> DataFrame:
    """(keys, _v, _wt): the values of c by group with their frequency (NULL
    and NaN left out). Dealt out by the value too, so a group with most of the
    lines is many rows of many tasks."""
    rows = df.select(*keys, F.col(c).cast("double").alias("_v"), _w(df).alias("_wt"))
    return rows.filter(F.col("_v").isNotNull() & ~F.isnan("_v")).groupBy(*keys, "_v").agg(F.sum("_wt").alias("_wt"))


def _beside(values: DataFrame, spans: DataFrame, n: int, keys: list) -> DataFrame:
    """Values inside these intervals of their group; n intervals."""
    table = F.broadcast(spans) if n <= row_bound(spans) else spans
    return values.join(table, keys).filter((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))


def _ranks(probs: list):
    """The ranks (from 0) on either side of each probability."""
    return [f(F.lit(p) * (F.col("_n") - 1)).cast("long") for p in probs for f in (F.floor, F.ceil)]


def rank_intervals(values: DataFrame, keys: list, probs: list, scratch: lineage.Scratch, rounds: int | None = None) -> DataFrame:
    """(keys, _n, _rows, _in, _lo, _hi, _below): intervals of values that hold
    every wanted rank, with their different values, their frequency and the
    frequency below them. A round cuts each one of more than SORTED values
    into BINS of equal width between its own least and largest value, keeps the
    bins that hold a rank and draws them in to their values, so an outlier costs
    one round. It ends when no interval is too large (or after ``rounds``)."""
    spans = scratch.cut(values.groupBy(*keys).agg(
        F.sum("_wt").alias("_n"), F.count(F.lit(1)).alias("_rows"), F.sum("_wt").alias("_in"), F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi")).withColumn("_below", F.lit(0).cast("long")))
    large = (F.col("_rows") > SORTED) & (F.col("_lo") < F.col("_hi"))
    while rounds is None or rounds > 0:
        n = spans.filter(large).count()
        if not n:
            break
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        place = F.least(F.lit(BINS - 1), F.floor(share * BINS)).cast("int")
        inside = _beside(values, spans.filter(large).drop("_rows", "_in"), n, keys)
        bins = inside.groupBy(*keys, "_n", "_below", F.col("_lo").alias("_of"), place.alias("_bin")).agg(
            F.count(F.lit(1)).alias("_rows"), F.sum("_wt").alias("_in"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = F.sum("_in").over(Window.partitionBy(*keys, "_of").orderBy("_bin"))
        bins = bins.withColumn("_below", F.col("_below") + upto - F.col("_in"))
        wanted = F.exists(F.array(*_ranks(probs)), lambda r: (r >= F.col("_below")) & (r < F.col("_below") + F.col("_in")))
        spans = scratch.cut(spans.filter(~large).unionByName(bins.filter(wanted).drop("_of", "_bin")))
        rounds = None if rounds is None else rounds - 1
    return spans


def select_ranks(values: DataFrame, keys: list, probs: list, names: list, scratch: lineage.Scratch,
                 approx: bool = False) -> DataFrame:
    """(keys, names): quantiles of counted values (linear interpolation
    between ranks). ``approx`` reads the place of a rank off the intervals left
    after two cuts, without putting values in order."""
    spans = rank_intervals(values, keys, probs, scratch, 2 if approx else None)
    if approx:
        rows = spans.withColumns({"_from": F.col("_below"), "_to": F.col("_below") + F.col("_in")})
        value = lambda r: F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (r - F.col("_from")) / F.greatest(F.lit(1), F.col("_in") - 1)
    else:
        inside = _beside(values, spans.drop("_rows", "_in"), spans.count(), keys)
        upto = F.sum("_wt").over(Window.partitionBy(*keys, "_lo").orderBy("_v"))
        rows = inside.withColumn("_to", F.col("_below") + upto).withColumn("_from", F.col("_to") - F.col("_wt"))
        value = lambda r: F.col("_v")
    ranks = _ranks(probs)
    picked = rows.groupBy(*keys, "_n").agg(*[
        F.max(F.when((r >= F.col("_from")) & (r < F.col("_to")), value(r))).alias(f"_{i}") for i, r in enumerate(ranks)])

    def between(i, p):
        at = F.lit(p) * (F.col("_n") - 1)
        low, high = F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}")
        return low + (at - F.floor(at)) * (high - low)
    return picked.select(*keys, *[between(i, p).alias(n) for i, (p, n) in enumerate(zip(probs, names))])


def group_quantiles(df: DataFrame, keys: list, c: str, probs: list, names: list,
                    approx: bool = False) -> DataFrame:
    """Quantiles of c by group (linear interpolation between ranks, frequency
    weights honoured, NULLs left out), a column for each probability. df is
    read once."""
    scratch = lineage.Scratch(df.sparkSession, "quantiles")
    try:
        values = scratch.cut(value_counts(df, keys, c))
        return select_ranks(values, keys, probs, names, scratch, approx).checkpoint()
    finally:
        scratch.close()


def weighted_std(df: DataFrame, keys: list, c: str, name: str) -> DataFrame:
    """Sample std of c per group, honouring frequency weights. Two passes
    (group mean, then centred squares) so equal values give exactly 0; the
    means table is one row per group and joins back on the group key."""
    w = _w(df)
    means = df.groupBy(*keys).agg(_wavg(df, c).alias("_mu"))
    n = F.sum(F.when(F.col(c).isNotNull(), w))
    ss = F.sum(w * (F.col(c) - F.col("_mu")) * (F.col(c) - F.col("_mu")))
    return (df.join(broadcast_checked(means), keys).groupBy(*keys)
            .agg(F.when(n > 1, F.sqrt(ss / (n - 1))).alias(name)))


def category_summary(lines: DataFrame) -> DataFrame:
    """Lines, revenue and mean unit price per category."""
    return lines.groupBy(CAT).agg(_wcount(lines, "quantity").alias("transactions"),
                                  F.sum("sales_value").alias("revenue"),
                                  _wavg(lines, "unit_price").alias("avg_price"))


def category_screening(lines: DataFrame, min_lines: int = 0, min_cv: float = 0.0,
                       min_promo_rate: float = 0.0) -> DataFrame:
    """Screening table over all categories (sample std for the CV), then
    the selection thresholds."""
    out = lines.groupBy(CAT).agg(
        _wcount(lines, "quantity").alias("transactions"),
        F.countDistinct("product_id").alias("n_products"),
        F.sum("sales_value").alias("revenue"),
        _wavg(lines, "unit_price").alias("avg_price"),
        _wavg(lines, "is_promo").alias("promo_rate"))
    sd = weighted_std(lines, [CAT], "unit_price", "_sd")
    out = (out.join(sd, CAT)
           .withColumn("price_cv", F.col("_sd") / F.col("avg_price")).drop("_sd")
           .select(CAT, "transactions", "n_products", "revenue", "avg_price", "price_cv",
                   "promo_rate"))
    return out.filter((F.col("transactions") >= min_lines)
                      & (F.coalesce(F.col("price_cv"), F.lit(0.0)) >= min_cv)
                      & (F.col("promo_rate") >= min_promo_rate))


def weekly_trend(panel: DataFrame, price: str = "unit_price") -> DataFrame:
    """Per category x week. Line-weighted on the line panel, cell-weighted
    on a cell panel (the caller picks the input, trap T3)."""
    return panel.groupBy(CAT, "week").agg(
        _wavg(panel, price).alias("avg_price"),
        F.sum("quantity").alias("total_qty"),
        _wcount(panel, "quantity").alias("n_txn"),
        _wavg(panel, "is_promo").alias("promo_rate"))


def price_by_promo(lines: DataFrame, price: str = "unit_price", approx: bool = False) -> DataFrame:
    """Mean, median and count of price by promotion status."""
    keys = [CAT, "is_promo"]
    out = lines.groupBy(*keys).agg(_wavg(lines, price).alias("mean_price"), _wcount(lines, price).alias("n"))
    median = group_quantiles(lines, keys, price, [0.5], ["median_price"], approx)
    return out.join(broadcast_checked(median), keys, "left").select(*keys, "mean_price", "median_price", "n")


def boxplot_stats(lines: DataFrame, group: str, value: str = "unit_price",
                  approx: bool = False, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (most extreme values inside Q1-1.5 IQR and
    Q3+1.5 IQR) and outlier count per category x group. Lines are read for the
    counts and for their values by frequency; the rest comes from these."""
    keys = [CAT, group]
    scratch = lineage.Scratch(lines.sparkSession, "boxplot")
    try:
        values = scratch.cut(value_counts(lines, keys, value))
        q = scratch.cut(select_ranks(values, keys, [0.25, 0.5, 0.75], ["q1", "median", "q3"], scratch, approx)
                        .withColumn("iqr", F.col("q3") - F.col("q1"))
                        .withColumn("_lo", F.col("q1") - whisker * F.col("iqr"))
                        .withColumn("_hi", F.col("q3") + whisker * F.col("iqr")))
        inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
        stats = (values.join(broadcast_checked(q), keys).groupBy(*keys, "q1", "median", "q3", "iqr")
                 .agg(F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
                      F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
                      F.sum(F.when(~inside, F.col("_wt")).otherwise(0)).cast("long").alias("n_outliers"))).checkpoint()
    finally:
        scratch.close()
    return (lines.groupBy(*keys).agg(_wcount(lines, value).alias("n")).join(broadcast_checked(stats), keys, "left")
            .select(*keys, "n", "q1", "median", "q3", "iqr", "whisker_low", "whisker_high",
                    F.coalesce("n_outliers", F.lit(0)).cast("long").alias("n_outliers")))


def within_product_std(lines: DataFrame, price: str = "unit_price") -> DataFrame:
    """Mean over products of the per-product sample std (n=1 -> NULL,
    skipped)."""
    per = weighted_std(lines, [CAT, "product_id"], price, "_sd")
    return per.groupBy(CAT).agg(F.avg("_sd").alias("within_product_std"))


def panel_coverage(panel: DataFrame) -> DataFrame:
    """Distinct products, distinct stores and rows per category. Cells
    are counted by (product, store) once and both kinds of keys from there, so
    no row is read twice for two distinct counts."""
    pairs = panel.groupBy(CAT, "product_id", "store_id").agg(F.count("quantity").alias("_n"))
    products = pairs.groupBy(CAT, "product_id").agg(F.sum("_n").alias("_n")).groupBy(CAT).agg(
        F.count(F.lit(1)).alias("n_products"), F.sum("_n").alias("n_obs"))
    stores = pairs.groupBy(CAT, "store_id").agg(F.count(F.lit(1)).alias("_n")).groupBy(CAT).agg(F.count(F.lit(1)).alias("n_stores"))
    return products.join(stores, CAT).select(CAT, "n_products", "n_stores", "n_obs")


def income_group_sizes(hh_panel: DataFrame) -> DataFrame:
    """Observed (category, income group) sizes."""
    return hh_panel.groupBy(CAT, "income_group", "income_rank").agg(
        F.count(F.lit(1)).alias("n_obs"))


def line_totals(lines: DataFrame) -> DataFrame:
    """Line count and distinct products."""
    return lines.agg(F.sum(_w(lines)).cast("long").alias("n_lines"),
                     F.countDistinct("product_id").alias("n_products"))


def top_stores(lines: DataFrame, category: str, n: int = 15) -> DataFrame:
    """E1 (+D10-like count): top-N stores by line count within one category;
    ties broken by store id. TakeOrderedAndProject keeps N per task."""
    return (lines.filter(F.col(CAT) == category).groupBy("store_id")
            .agg(_wcount(lines, "quantity").alias("n_lines"))
            .orderBy(F.desc("n_lines"), F.asc("store_id")).limit(n))


def top_products(panel: DataFrame, n: int = 6, key: str = "product_id") -> DataFrame:
    """D14 + E2: top-N keys by volume per category (ties by key)."""
    vol = panel.groupBy(CAT, key).agg(F.sum("quantity").alias("total_qty"))
    w = Window.partitionBy(CAT).orderBy(F.desc("total_qty"), F.asc(key))
    return vol.withColumn("volume_rank", F.row_number().over(w)).filter(F.col("volume_rank") <= n)


def store_price_order(lines: DataFrame, stores: DataFrame, price: str = "unit_price",
                      approx: bool = False) -> DataFrame:
    """C5 + E3: price median per (category, store) for the given stores,
    with the display order of stores by median."""
    sub = lines.join(broadcast_checked(stores.select("store_id")), "store_id", "left_semi")
    keys = [CAT, "store_id"]
    med = (sub.groupBy(*keys).agg(_wcount(lines, price).alias("n"))
           .join(broadcast_checked(group_quantiles(sub, keys, price, [0.5], ["median_price"], approx)), keys, "left")
           .select(*keys, "median_price", "n"))
    w = Window.partitionBy(CAT).orderBy(F.asc("median_price"), F.asc("store_id"))
    return med.withColumn("order", F.row_number().over(w))


def ever_promoted_share(lines: DataFrame) -> DataFrame:
    """Products ever promoted / products, per category."""
    per = lines.groupBy(CAT, "product_id").agg(F.max("is_promo").alias("_ever"))
    return per.groupBy(CAT).agg(F.sum("_ever").cast("long").alias("n_promoted"),
                                F.count(F.lit(1)).alias("n_products"))


def promo_long(panel: DataFrame, cols=("discount_pct",)) -> DataFrame:
    """Unpivot the two promotion flags (stack) and keep the promoted rows:
    one row per (cell, promo type). A cell with both flags appears twice
    (trap T5), as in the reference programs."""
    rest = [c for c in panel.columns]
    stacked = panel.select(*rest, F.explode(F.array(*[
        F.struct(F.lit(label).alias("promo_type"), F.col(flag).alias("_flag"))
        for flag, label in PROMO_TYPES])).alias("_p"))
    return (stacked.filter(F.col("_p._flag") == 1)
            .withColumn("promo_type", F.col("_p.promo_type")).drop("_p"))


def current_discount(panel: DataFrame) -> DataFrame:
    """Mean discount depth of promoted cells per category x promo type."""
    return (promo_long(panel).groupBy(CAT, "promo_type")
            .agg(F.avg("discount_pct").alias("current_avg_discount"),
                 F.count(F.lit(1)).alias("n_cells")))


def discount_support(panel: DataFrame, threshold: float = 0.40) -> DataFrame:
    """Share of promoted cells deeper than the threshold and max depth."""
    return (promo_long(panel).groupBy(CAT, "promo_type")
            .agg(F.avg(F.when(F.col("discount_pct") > threshold, 1.0).otherwise(0.0))
                 .alias("share_above"),
                 F.max("discount_pct").alias("max_discount"),
                 F.count(F.lit(1)).alias("n_cells")))


def promo_overlap(panel: DataFrame) -> DataFrame:
    """T5 companion: promoted cells and those both displayed and mailed."""
    return panel.groupBy(CAT).agg(
        F.sum(F.col("is_promo")).cast("long").alias("n_promoted"),
        F.sum((F.col("is_displayed") * F.col("is_mailed"))).cast("long").alias("n_both"))


def quantiles(df: DataFrame, value: str, probs, by=None, approx: bool = False) -> DataFrame:
    """Exact (linear interpolation) quantiles, optionally per group."""
    names = [f"q{int(round(p * 1000)):04d}" for p in probs]
    keys = list(by or ["_all"])
    out = group_quantiles(df if by else df.withColumn("_all", F.lit(0)), keys, value, list(probs), names, approx)
    return out if by else out.drop("_all")
