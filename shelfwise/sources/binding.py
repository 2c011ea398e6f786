"""Stand-in raw inputs built from the driver's TPC-H-like test tables.

These functions only rename and derive columns so the rows have the raw
schema the warehouse build expects; they do none of the warehouse,
panel or estimation work. Keys stay integers (cheaper joins); the
library's operators are type-agnostic about keys.

Fixed binding rules (shared with the DuckDB oracle in ``oracles.py``):
  transactions  lineitem JOIN orders ON l_orderkey = o_orderkey
                household o_custkey, store l_suppkey, basket l_orderkey,
                product l_partkey, week weekofyear(l_shipdate),
                sales l_extendedprice*(1-l_discount), retail_disc
                l_extendedprice*l_discount, coupon discounts NULL when
                l_tax = 0 else 0.0
  promotions    per (l_partkey, l_suppkey, weekofyear(l_shipdate)):
                display code max('3' if l_returnflag = 'R' else '0'),
                mailer code max('A' if l_linestatus = 'F' and
                l_discount >= 0.05 else '0'); rows with some promotion only
  products      part: category p_type, brand p_brand, package p_size
  demographics  every customer; income band number
                least(11, greatest(0, floor((c_acctbal+1000)/917)))
  campaigns     region rows; households targeted via nation's region
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.income import INCOME_BANDS

# Fixed values of the binding (see module docstring).
DISPLAY_CODE = "3"
MAILER_CODE = "A"
NO_PROMO_CODE = "0"
INCOME_BAND_WIDTH = 917.0
INCOME_BAND_OFFSET = 1000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    coupon = F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(F.lit(0.0))
    # columns are derived below the join: above it they'd keep the planner
    # from taking a semi-join of the products down to the lines
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_orderkey").alias("basket_id"),
        F.col("l_partkey").alias("product_id"),
        F.weekofyear("l_shipdate").alias("week"),
        F.col("l_shipdate").alias("transaction_timestamp"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sales_value"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("retail_disc"),
        coupon.alias("coupon_disc"),
        coupon.alias("coupon_match_disc"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("household_id"))
    return li.join(orders, li.basket_id == orders.o_orderkey).select("household_id", *li.columns)


def raw_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    # max over 0/1 indicators (hash aggregate), then the code; equal to the
    # max of the code strings since '3' and 'A' sort after '0'.
    disp = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    mail = F.when((F.col("l_linestatus") == "F") & (F.col("l_discount") >= 0.05), 1).otherwise(0)
    promos = (li.groupBy(F.col("l_partkey").alias("product_id"),
                         F.col("l_suppkey").alias("store_id"),
                         F.weekofyear("l_shipdate").alias("week"))
              .agg(F.max(disp).alias("_d"), F.max(mail).alias("_m"))
              .select("product_id", "store_id", "week",
                      F.when(F.col("_d") == 1, DISPLAY_CODE).otherwise(NO_PROMO_CODE)
                      .alias("display_location"),
                      F.when(F.col("_m") == 1, MAILER_CODE).otherwise(NO_PROMO_CODE)
                      .alias("mailer_location")))
    return promos.filter((F.col("display_location") != NO_PROMO_CODE)
                         | (F.col("mailer_location") != NO_PROMO_CODE))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("manufacturer_id"),
        F.col("p_type").alias("department"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_category"),
        F.col("p_name").alias("product_type"),
        F.col("p_size").cast("string").alias("package_size"))


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = F.least(F.lit(11), F.greatest(F.lit(0), F.floor(
        (F.col("c_acctbal") + INCOME_BAND_OFFSET) / INCOME_BAND_WIDTH).cast("int")))
    labels = F.array(*[F.lit(b) for b, _ in INCOME_BANDS])
    return (table(spark, sf_dir, "customer")
            .select(F.col("c_custkey").alias("household_id"),
                    F.col("c_mktsegment").alias("age"),
                    F.element_at(labels, band + 1).alias("income"),
                    F.lit("Unknown").alias("home_ownership"),
                    F.lit("Unknown").alias("marital_status"),
                    F.lit("1").alias("household_size"),
                    F.lit("Unknown").alias("household_comp"),
                    F.lit("0").alias("kids_count")))


def raw_campaign_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").alias("campaign_id"),
                    F.col("r_name").alias("campaign_type"),
                    F.make_date(1996 + F.col("r_regionkey"), F.lit(1), F.lit(1)).alias("start_date"),
                    F.make_date(1996 + F.col("r_regionkey"), F.lit(3), F.lit(31)).alias("end_date"))


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("n_regionkey").alias("campaign_id"),
                    F.col("c_custkey").alias("household_id")))


def raw_coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One coupon per (part, supplier) offer; issued by the supplier's region."""
    ps = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (ps.join(s, ps.l_suppkey == s.s_suppkey).join(n, F.col("s_nationkey") == n.n_nationkey)
            .select(F.concat_ws("-", "l_partkey", "l_suppkey").alias("coupon_upc"),
                    F.col("l_partkey").alias("product_id"),
                    F.col("n_regionkey").alias("campaign_id")))


def raw_coupon_redemptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A redemption is a line bought with the top discount (0.10)."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_discount") >= 0.1).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(s, li.l_suppkey == s.s_suppkey)
            .join(n, F.col("s_nationkey") == n.n_nationkey)
            .select(F.col("o_custkey").alias("household_id"),
                    F.concat_ws("-", "l_partkey", "l_suppkey").alias("coupon_upc"),
                    F.col("n_regionkey").alias("campaign_id"),
                    F.col("l_shipdate").cast("date").alias("redemption_date")))


RAW_BUILDERS = {
    "transactions": raw_transactions,
    "promotions": raw_promotions,
    "products": raw_products,
    "demographics": raw_demographics,
    "campaign_descriptions": raw_campaign_descriptions,
    "campaigns": raw_campaigns,
    "coupons": raw_coupons,
    "coupon_redemptions": raw_coupon_redemptions,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
