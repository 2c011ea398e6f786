"""Star-schema build.

Each builder takes the raw DataFrame and returns the warehouse table as a
lazy DataFrame; ``build_warehouse`` writes all six (CTAS, create or
replace) and ``row_counts`` is the sanity query.

Both fact tables are stored in buckets of the cell key (product, store, week),
sorted: panels aggregate and attach promotions without a shuffle of either.
Every finished table has an entry in a manifest (rows, columns, buckets); a
re-run skips tables that are as their entry says and writes the others anew,
also those that an earlier run left half-written.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import columns as C
from shelfwise.operators.joins import PROMO_KEYS
from shelfwise.session import hadoop_path
from shelfwise.sources import schemas

#: Tables stored in buckets, and the keys of these.
BUCKETED = {"fact_transactions": PROMO_KEYS, "fact_promotions": PROMO_KEYS}


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(*schemas.DIM_PRODUCT_COLS)


def dim_household(demographics: DataFrame) -> DataFrame:
    return demographics.select(*schemas.DIM_HOUSEHOLD_COLS)


def dim_campaign(campaign_descriptions: DataFrame) -> DataFrame:
    return campaign_descriptions.select(*schemas.DIM_CAMPAIGN_COLS)


def bridge_household_campaign(campaigns: DataFrame) -> DataFrame:
    return campaigns.select(*schemas.BRIDGE_COLS)


def fact_transactions(transactions: DataFrame) -> DataFrame:
    """B2 valid-line filter (pushed to the scan), B3 price, B4 stack, B5 date."""
    return (transactions
            .filter((F.col("quantity") > 0) & (F.col("sales_value") >= 0))
            .select("household_id", "store_id", "basket_id", "product_id", "week",
                    F.col("transaction_timestamp").cast("date").alias("transaction_date"),
                    "quantity", "sales_value", "retail_disc", "coupon_disc", "coupon_match_disc",
                    C.guarded_unit_price().alias("unit_price"),
                    C.discount_stack("retail_disc", "coupon_disc", "coupon_match_disc")
                    .alias("total_discount")))


def fact_promotions(promotions: DataFrame) -> DataFrame:
    """B6 flags from the location codes."""
    return promotions.select(
        "product_id", "store_id", "week", "display_location", "mailer_location",
        C.location_flag("display_location").alias("is_displayed"),
        C.location_flag("mailer_location").alias("is_mailed"))


def warehouse_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_product": dim_product(raw["products"]),
        "dim_household": dim_household(raw["demographics"]),
        "dim_campaign": dim_campaign(raw["campaign_descriptions"]),
        "bridge_household_campaign": bridge_household_campaign(raw["campaigns"]),
        "fact_transactions": fact_transactions(raw["transactions"]),
        "fact_promotions": fact_promotions(raw["promotions"]),
    }


MANIFEST = "tbl string, n_rows long, columns string, buckets int"


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _stored(df: DataFrame, path: str, keys: list, buckets: int) -> None:
    """Writes a table, in sorted buckets if it has keys: rows are dealt out by
    the hash that buckets go by, so a task writes one file of one bucket."""
    if not keys:
        df.write.mode("overwrite").parquet(path)
        return
    name = f"shelfwise_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).mode("overwrite").saveAsTable(name))
    df.sparkSession.sql(f"DROP TABLE {name}")      # its files stay


def _entry(spark: SparkSession, out_dir: str, name: str):
    """A table's manifest entry, or None."""
    place, fs = hadoop_path(spark, f"{out_dir}/_manifest/{name}/_SUCCESS")
    return spark.read.schema(MANIFEST).parquet(f"{out_dir}/_manifest/{name}").first() if fs.exists(place) else None


def rebuild_warehouse(raw: dict[str, DataFrame], out_dir: str, buckets: int | None = None) -> list[tuple[str, int, str]]:
    """A4 + A5: (table, rows, what was done): 'built', 'skipped' because the
    stored table has the rows and columns of its manifest entry, or 'repaired'."""
    out = []
    for name, df in warehouse_tables(raw).items():
        spark, path = df.sparkSession, f"{out_dir}/{name}"
        place, fs = hadoop_path(spark, path)
        there, entry = fs.exists(place), _entry(spark, out_dir, name)
        if there and entry is not None and entry.columns == _columns(df):
            if spark.read.schema(df.schema).parquet(path).count() == entry.n_rows:
                out.append((name, entry.n_rows, "skipped"))
                continue
        # the entry goes first: a run that ends here leaves a table without one
        fs.delete(hadoop_path(spark, f"{out_dir}/_manifest/{name}")[0], True)
        keys = BUCKETED.get(name, [])
        n = int(buckets or spark.conf.get("spark.sql.shuffle.partitions")) if keys else 0
        _stored(df, path, keys, n)
        rows = spark.read.schema(df.schema).parquet(path).count()
        spark.createDataFrame([(name, rows, _columns(df), n)], MANIFEST).coalesce(1).write.parquet(f"{out_dir}/_manifest/{name}")
        out.append((name, rows, "repaired" if there else "built"))
    return out


def build_warehouse(raw: dict[str, DataFrame], out_dir: str, buckets: int | None = None) -> dict[str, str]:
    """A4: paths of all tables, written unless they are there."""
    return {name: f"{out_dir}/{name}" for name, _, _ in rebuild_warehouse(raw, out_dir, buckets)}


class Stored:
    """The tables of a written warehouse; buckets are known to the planner
    while it is open."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.names, self.tables = spark, [], {}
        for entry in spark.read.schema(MANIFEST).parquet(f"{out_dir}/_manifest/*").collect():
            path, schema = f"{out_dir}/{entry.tbl}", T.StructType.fromDDL(entry.columns)
            if not entry.buckets:
                self.tables[entry.tbl] = spark.read.schema(schema).parquet(path)
                continue
            name, keys = f"shelfwise_{uuid.uuid4().hex[:12]}", ", ".join(BUCKETED[entry.tbl])
            spark.sql(f"CREATE TABLE {name} ({entry.columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                      f"INTO {entry.buckets} BUCKETS LOCATION '{path}'")
            self.names.append(name)
            self.tables[entry.tbl] = spark.table(name)

    def __enter__(self) -> dict[str, DataFrame]:
        return self.tables

    def __exit__(self, *_) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE {name}")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """D24 + E5: one row per main table, UNION ALL of counts."""
    order = ["fact_transactions", "fact_promotions", "dim_product", "dim_household",
             "dim_campaign"]
    parts = [tables[n].agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(n).alias("tbl"), "n_rows") for n in order]
    return reduce(DataFrame.unionByName, parts)
