"""Schemas of the raw inputs and of the star-schema warehouse tables."""

from pyspark.sql import types as T

S, I, D, DT, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.TimestampType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw inputs (what the acquisition step lands as parquet/CSV).
RAW_TRANSACTIONS = _struct(
    ("household_id", S), ("store_id", S), ("basket_id", S), ("product_id", S),
    ("week", I), ("transaction_timestamp", TS), ("quantity", D), ("sales_value", D),
    ("retail_disc", D), ("coupon_disc", D), ("coupon_match_disc", D))

RAW_PROMOTIONS = _struct(
    ("product_id", S), ("store_id", S), ("week", I),
    ("display_location", S), ("mailer_location", S))

RAW_PRODUCTS = _struct(
    ("product_id", S), ("manufacturer_id", S), ("department", S), ("brand", S),
    ("product_category", S), ("product_type", S), ("package_size", S))

RAW_DEMOGRAPHICS = _struct(
    ("household_id", S), ("age", S), ("income", S), ("home_ownership", S),
    ("marital_status", S), ("household_size", S), ("household_comp", S), ("kids_count", S))

RAW_CAMPAIGN_DESCRIPTIONS = _struct(
    ("campaign_id", S), ("campaign_type", S), ("start_date", DT), ("end_date", DT))

RAW_CAMPAIGNS = _struct(("campaign_id", S), ("household_id", S))

RAW_COUPONS = _struct(("coupon_upc", S), ("product_id", S), ("campaign_id", S))

RAW_COUPON_REDEMPTIONS = _struct(
    ("household_id", S), ("coupon_upc", S), ("campaign_id", S), ("redemption_date", DT))

RAW = {
    "transactions": RAW_TRANSACTIONS,
    "promotions": RAW_PROMOTIONS,
    "products": RAW_PRODUCTS,
    "demographics": RAW_DEMOGRAPHICS,
    "campaign_descriptions": RAW_CAMPAIGN_DESCRIPTIONS,
    "campaigns": RAW_CAMPAIGNS,
    "coupons": RAW_COUPONS,
    "coupon_redemptions": RAW_COUPON_REDEMPTIONS,
}

# Warehouse column lists (A1/B1 projections).
DIM_PRODUCT_COLS = ["product_id", "manufacturer_id", "department", "brand",
                    "product_category", "product_type", "package_size"]
DIM_HOUSEHOLD_COLS = ["household_id", "age", "income", "home_ownership", "marital_status",
                      "household_size", "household_comp", "kids_count"]
DIM_CAMPAIGN_COLS = ["campaign_id", "campaign_type", "start_date", "end_date"]
BRIDGE_COLS = ["campaign_id", "household_id"]
