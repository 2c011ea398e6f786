"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode raises on x/0)."""
    return col(num) / F.nullif(col(den), F.lit(0))


def guarded_unit_price(sales: str = "sales_value", qty: str = "quantity") -> Column:
    """CASE WHEN quantity > 0 THEN sales / quantity ELSE NULL END."""
    return F.when(col(qty) > 0, col(sales) / col(qty))


def discount_stack(*components: str) -> Column:
    """Sum of coalesced discount components."""
    total = F.lit(0.0)
    for c in components:
        total = total + F.coalesce(col(c), F.lit(0.0))
    return total


def location_flag(code: str) -> Column:
    """1 when the location code is not '0'; NULL code -> 0."""
    return F.when(col(code) != "0", F.lit(1)).otherwise(F.lit(0))


def any_promo(displayed: str = "is_displayed", mailed: str = "is_mailed") -> Column:
    """Displayed OR mailed as 0/1."""
    return ((col(displayed) == 1) | (col(mailed) == 1)).cast("int")


def log_positive(c: Column | str) -> Column:
    """ln(x) for x > 0, NULL otherwise (callers filter first)."""
    return F.when(col(c) > 0, F.log(col(c)))


def gross_value(sales: str = "sales_value", retail_disc: str = "retail_disc") -> Column:
    """Pre-discount value; the sign of the stored discount is irrelevant."""
    return col(sales) + F.abs(col(retail_disc))


def discount_depth(retail_disc: str = "retail_disc", gross: str = "gross_value") -> Column:
    """|disc| / gross, 0 when gross is 0 (or the discount is NULL)."""
    return F.coalesce(F.abs(col(retail_disc)) / F.nullif(col(gross), F.lit(0.0)), F.lit(0.0))


def clipped_log(c: Column | str, floor: float = 0.01) -> Column:
    """ln(max(x, floor))."""
    return F.log(F.greatest(col(c), F.lit(floor)))


def title_label(c: Column | str) -> Column:
    """B16: 'BATH TISSUES' -> 'Bath Tissues'."""
    return F.initcap(F.lower(col(c)))


def composite_label(a: Column | str, b: Column | str, sep: str = " — ") -> Column:
    """B19: 'category — promo type'."""
    return F.concat_ws(sep, col(a), col(b))


# Two-sided 5% critical value of the standard normal (fixed value).
Z_CRIT_95 = 1.959963984540054
