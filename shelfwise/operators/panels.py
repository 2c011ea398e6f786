"""Panels: line panel, product x store x week cells, household cells.

Plan shape (all panels): transactions are semi-joined to the products of
the chosen categories (broadcast, size checked), aggregated on the cell key
with map-side partial aggregation, then the category attributes are
attached with a broadcast join (keeps the cell-key hash partitioning) and
promotions are left-joined on the same key, so only the promotion side is
shuffled for the attach. Promotions are semi-reduced to category products
before their shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfwise.functions import columns as C
from shelfwise.functions.income import income_group, income_group_rank
from shelfwise.operators.joins import PROMO_KEYS, attach_promotions, broadcast_checked

CELL_KEYS = PROMO_KEYS  # product_id, store_id, week


def category_products(dim_product: DataFrame, categories=None,
                      attrs=("product_category", "brand", "package_size")) -> DataFrame:
    """Products of the chosen categories (all categories when None)."""
    p = dim_product.select("product_id", *attrs)
    if categories is not None:
        p = p.filter(F.col("product_category").isin(list(categories)))
    return p


def _semi(txn: DataFrame, products: DataFrame) -> DataFrame:
    return txn.join(broadcast_checked(products.select("product_id")), "product_id", "left_semi")


def line_panel(txn: DataFrame, dim_product: DataFrame, promotions: DataFrame,
               categories=None, compress: bool = True) -> DataFrame:
    """C1 + C2 + B8: transaction lines with category and promotion flags.

    With ``compress`` (default) identical lines are pre-aggregated before
    the promotion attach: one row per (product, store, week, unit price)
    with ``n_lines`` and summed quantity/sales (map-side combine), so the
    attach shuffles distinct price points per cell instead of every line.
    The describe operators read ``n_lines`` as a frequency weight, which
    keeps every line-level statistic exact (counts, means, sample std,
    exact quantiles via percentile with frequency, min/max)."""
    prods = category_products(dim_product, categories, ("product_category",))
    if compress:
        lines = (_semi(txn, prods)
                 .groupBy("product_id", "store_id", "week", "unit_price")
                 .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("quantity").alias("quantity"),
                      F.sum("sales_value").alias("sales_value"))
                 .join(broadcast_checked(prods), "product_id"))
    else:
        lines = (txn.select("household_id", "store_id", "product_id", "week", "quantity",
                            "sales_value", "unit_price")
                 .join(broadcast_checked(prods), "product_id"))
    out = attach_promotions(lines, promotions, products=prods)
    return out.withColumn("is_promo", C.any_promo())


def _cells(txn: DataFrame, prods: DataFrame, keys, sums: dict) -> DataFrame:
    aggs = [F.sum(src).alias(name) for name, src in sums.items()]
    return _semi(txn, prods).groupBy(*keys).agg(*aggs)


def net_panel(txn: DataFrame, dim_product: DataFrame, promotions: DataFrame,
              categories=None, attrs=("product_category", "brand", "package_size"),
              drop_invalid: bool = True, observation: Observations | None = None) -> DataFrame:
    """D3: Σqty and quantity-weighted net price Σsales/Σqty per cell, with
    promotion flags; B9 drops zero/NULL price rows, B10 adds logs."""
    prods = category_products(dim_product, categories, attrs)
    cells = _cells(txn, prods, CELL_KEYS, {"quantity": "quantity", "_sales": "sales_value"})
    cells = (cells.join(broadcast_checked(prods), "product_id")
             .withColumn("unit_price", C.safe_div("_sales", "quantity")).drop("_sales"))
    panel = attach_promotions(cells, promotions, products=prods)
    if drop_invalid:
        panel = drop_invalid_prices(panel, "unit_price", observation)
    return (panel.withColumn("log_qty", C.log_positive("quantity"))
            .withColumn("log_price", C.log_positive("unit_price")))


class Observations:
    """Row counts of a panel on its way, gathered while it is computed: no
    extra pass. ``get`` waits for an action on the panel."""

    def __init__(self, name: str):
        self.of = {part: Observation(f"{name} {part}") for part in ("rows_in", "rows_kept")}

    @property
    def get(self) -> dict[str, int]:
        return {part: o.get[part] for part, o in self.of.items()}


def _counted(panel: DataFrame, observation: Observations | None, part: str) -> DataFrame:
    if observation is None:
        return panel
    return panel.observe(observation.of[part], F.count(F.lit(1)).alias(part))


def drop_invalid_prices(panel: DataFrame, price: str = "unit_price",
                        observation: Observations | None = None) -> DataFrame:
    """Keep price > 0 with quantity present; optionally report the number
    of rows in and out."""
    keep = (F.col(price) > 0) & F.col("quantity").isNotNull()
    return _counted(_counted(panel, observation, "rows_in").filter(keep), observation, "rows_kept")


def household_panel(txn: DataFrame, dim_product: DataFrame, promotions: DataFrame,
                    dim_household: DataFrame, categories=None, observation: Observations | None = None) -> DataFrame:
    """D4 + C3 + B14: household x product x store x week cells with income
    group; households without demographics or an unknown band drop out."""
    prods = category_products(dim_product, categories, ("product_category",))
    keys = ["household_id", *CELL_KEYS]
    cells = _cells(txn, prods, keys, {"quantity": "quantity", "_sales": "sales_value"})
    cells = (cells.join(broadcast_checked(prods), "product_id")
             .withColumn("unit_price", C.safe_div("_sales", "quantity")).drop("_sales"))
    panel = _counted(attach_promotions(cells, promotions, products=prods), observation, "rows_in")
    hh = dim_household.select("household_id", "income").filter(F.col("income").isNotNull())
    panel = (panel.join(broadcast_checked(hh), "household_id")
             .filter(F.col("unit_price") > 0)
             .withColumn("income_group", income_group("income"))
             .filter(F.col("income_group").isNotNull())
             .withColumn("income_rank", income_group_rank("income_group")))
    panel = _counted(panel, observation, "rows_kept")
    return (panel.withColumn("log_qty", C.log_positive("quantity"))
            .withColumn("log_price", C.log_positive("unit_price")))


def gross_panel(txn: DataFrame, dim_product: DataFrame, promotions: DataFrame,
                categories=None, attrs=("product_category",), observation: Observations | None = None) -> DataFrame:
    """D5 + B11-B13: Σqty, Σsales, Σretail_disc per cell; regular price,
    discount depth, net price, logs. Σretail_disc ignores NULLs, so an
    all-NULL cell has NULL gross value and is dropped by price > 0."""
    prods = category_products(dim_product, categories, attrs)
    cells = _cells(txn, prods, CELL_KEYS, {"quantity": "quantity", "sales_value": "sales_value",
                                           "retail_disc": "retail_disc"})
    cells = cells.join(broadcast_checked(prods), "product_id")
    panel = attach_promotions(cells, promotions, products=prods)
    panel = (panel
             .withColumn("gross_value", C.gross_value())
             .withColumn("unit_price", C.safe_div("gross_value", "quantity"))
             .withColumn("net_unit_price", C.safe_div("sales_value", "quantity"))
             .withColumn("discount_pct", C.discount_depth()))
    panel = _counted(_counted(panel, observation, "rows_in").filter(F.col("unit_price") > 0), observation, "rows_kept")
    return (panel
            .withColumn("log_qty", C.log_positive("quantity"))
            .withColumn("log_price", C.log_positive("unit_price"))
            .withColumn("log_net_price", C.clipped_log("net_unit_price", 0.01))
            .withColumn("is_promo", C.any_promo()))


def store_size(txn: DataFrame) -> DataFrame:
    """Line count per store over all products (partial aggregation)."""
    return txn.groupBy("store_id").agg(F.count(F.lit(1)).alias("store_total_txns"))


def with_store_size(panel: DataFrame, sizes: DataFrame) -> DataFrame:
    """C4 + B10 + B15: attach store size, log it and centre it on the mean
    over all panel rows (all categories pooled). The mean is a one-row
    aggregate cross-joined as a broadcast, not a global window."""
    # An aggregate of the whole fact table: computed once, then it is known
    # whether it is small enough for the panel to stay where it is.
    p = (panel.join(broadcast_checked(sizes.checkpoint()), "store_id", "left")
         .withColumn("log_store_size", C.log_positive("store_total_txns")))
    mean = p.agg(F.avg("log_store_size").alias("_mean_log_size"))
    return (p.crossJoin(F.broadcast(mean))
            .withColumn("log_store_size_c", F.col("log_store_size") - F.col("_mean_log_size"))
            .drop("_mean_log_size"))


def row_account(panels_by_name: dict[str, tuple[DataFrame, Observations]]) -> DataFrame:
    """Rows that entered each panel, stayed and were dropped. Computes
    the panels whole; the counts come from the same run."""
    rows = []
    for name, (panel, seen) in panels_by_name.items():
        panel.write.format("noop").mode("overwrite").save()
        counts = seen.get
        rows.append((name, counts["rows_in"], counts["rows_kept"], counts["rows_in"] - counts["rows_kept"]))
        spark = panel.sparkSession
    return spark.createDataFrame(rows, "panel string, rows_in long, rows_kept long, rows_dropped long")


def untreated_cells(cells: DataFrame, promotions: DataFrame) -> DataFrame:
    """Cells with no promotion row (the untreated baseline)."""
    return cells.join(promotions.select(*PROMO_KEYS), PROMO_KEYS, "left_anti")
