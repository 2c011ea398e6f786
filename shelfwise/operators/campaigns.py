"""Campaign and coupon analytics.

C7: households targeted per campaign (bridge x campaign x demographics)
and their spend inside the campaign window -- an equi-join of the
bridge to transactions on household, then the date-range predicate
``transaction_date BETWEEN start_date AND end_date`` as a filter (no
range/cross join). C8: coupon redemptions linked to the coupon's products
and campaign.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import broadcast_checked


def campaign_reach(dim_campaign: DataFrame, bridge: DataFrame, dim_household: DataFrame,
                   txn: DataFrame) -> DataFrame:
    camp = dim_campaign.select("campaign_id", "campaign_type", "start_date", "end_date")
    targeted = bridge.select("campaign_id", "household_id").dropDuplicates()
    hh = dim_household.select("household_id", F.lit(1).alias("_has_demo"))
    reach = (targeted.join(hh, "household_id", "left")
             .groupBy("campaign_id")
             .agg(F.count(F.lit(1)).alias("n_households"),
                  F.count("_has_demo").alias("n_with_demographics")))
    # Pre-aggregate lines to household-days inside the campaigns' overall date
    # span (map-side combine) before the household join shuffles them.
    # The span is two dates, so it reaches the scan as literals.
    low, high = camp.agg(F.min("start_date"), F.max("end_date")).first()
    daily = (txn.select("household_id", "transaction_date", "sales_value")
             .filter(F.col("transaction_date").between(F.lit(low).cast("date"), F.lit(high).cast("date")))
             .groupBy("household_id", "transaction_date")
             .agg(F.count(F.lit(1)).alias("_lines"), F.sum("sales_value").alias("_spend")))
    window = (targeted.join(broadcast_checked(camp), "campaign_id")
              .join(daily, "household_id")
              .filter(F.col("transaction_date").between(F.col("start_date"), F.col("end_date")))
              .groupBy("campaign_id")
              .agg(F.sum("_lines").alias("n_window_lines"),
                   F.sum("_spend").alias("window_spend"),
                   F.countDistinct("household_id").alias("n_active_households")))
    return (camp.join(reach, "campaign_id", "left").join(window, "campaign_id", "left")
            .select("campaign_id", "campaign_type", "start_date", "end_date",
                    F.coalesce("n_households", F.lit(0)).alias("n_households"),
                    F.coalesce("n_with_demographics", F.lit(0)).alias("n_with_demographics"),
                    F.coalesce("n_active_households", F.lit(0)).alias("n_active_households"),
                    F.coalesce("n_window_lines", F.lit(0)).alias("n_window_lines"),
                    F.coalesce("window_spend", F.lit(0.0)).alias("window_spend")))


def coupon_redemption(coupons: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Per campaign: redemptions, redeeming households, coupons and the
    products those redeemed coupons apply to."""
    red = redemptions.select("household_id", "coupon_upc", "campaign_id", "redemption_date")
    cp = coupons.select("coupon_upc", "campaign_id", "product_id")
    # distinct counts by levels: one key at a time, so no row is expanded
    per_campaign = (red.groupBy("campaign_id", "household_id").agg(F.count(F.lit(1)).alias("n"))
                    .groupBy("campaign_id").agg(F.sum("n").alias("n_redemptions"),
                                                F.count("household_id").alias("n_households")))
    used = red.select("campaign_id", "coupon_upc").distinct()
    n_coupons = used.groupBy(F.col("campaign_id").alias("_campaign")).agg(F.count("coupon_upc").alias("n_coupons"))
    products = (used.join(cp, ["coupon_upc", "campaign_id"])
                .groupBy("campaign_id").agg(F.countDistinct("product_id").alias("n_products")))
    return (per_campaign.join(n_coupons, F.col("campaign_id").eqNullSafe(F.col("_campaign"))).drop("_campaign")
            .join(products, "campaign_id", "left").fillna({"n_products": 0}))
