"""Per-run context: the warehouse tables over a test-data folder."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import warehouse
from shelfwise.sources import binding

# The two focus categories of the binding (stand-ins for the reference's two
# focus categories, in the same order).
FOCUS = ("MEDIUM", "PROMO")


@dataclass
class Context:
    spark: SparkSession
    sf_dir: str
    _tables: dict = field(default_factory=dict)

    def raw(self, name: str) -> DataFrame:
        return binding.RAW_BUILDERS[name](self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            raw = {k: self.raw(k) for k in ("products", "demographics", "campaign_descriptions",
                                            "campaigns", "transactions", "promotions")}
            self._tables.update(warehouse.warehouse_tables(raw))
        return self._tables[name]

    @property
    def txn(self) -> DataFrame:
        return self.table("fact_transactions")

    @property
    def promos(self) -> DataFrame:
        return self.table("fact_promotions")

    @property
    def products(self) -> DataFrame:
        return self.table("dim_product")

    @property
    def households(self) -> DataFrame:
        return self.table("dim_household")


def round_half_away(c, digits: int = 6):
    """round(x * 10^d) / 10^d in binary floating point, half away from zero
    (the arithmetic SQL engines use for DOUBLE; Spark's own ``round``
    rounds the decimal form instead and can differ on ties)."""
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale)) / F.lit(scale)


def rounded(df: DataFrame, digits: int = 6, overrides: dict | None = None) -> DataFrame:
    """Round every double column at the edge so results hash stably across
    engines (summation order differs in the last bits). Large money sums
    take 2 dp through ``overrides``."""
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = overrides.get(f.name, digits)
            cols.append(round_half_away(F.col(f.name), d).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


MONEY = {"revenue": 2}
