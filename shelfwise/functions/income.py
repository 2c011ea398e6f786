"""Income banding (B14): twelve reported bands -> ordered Low < Mid < High."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The closed set of income bands, in order, with their group.
INCOME_BANDS = [
    ("Under 15K", "Low"), ("15-24K", "Low"), ("25-34K", "Low"),
    ("35-49K", "Mid"), ("50-74K", "Mid"), ("75-99K", "Mid"),
    ("100-124K", "High"), ("125-149K", "High"), ("150-174K", "High"),
    ("175-199K", "High"), ("200-249K", "High"), ("250K+", "High"),
]
INCOME_GROUPS = ["Low", "Mid", "High"]


def income_group(income: Column | str) -> Column:
    """Band label -> group; an unknown or NULL band maps to NULL."""
    col = F.col(income) if isinstance(income, str) else income
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(INCOME_BANDS)])
    return F.try_element_at(lookup, col)


def income_group_rank(group: Column | str) -> Column:
    """Ordered categorical as an explicit rank column (Low=0, Mid=1, High=2)."""
    col = F.col(group) if isinstance(group, str) else group
    lookup = F.create_map(*[F.lit(x) for i, g in enumerate(INCOME_GROUPS) for x in (g, i)])
    return F.try_element_at(lookup, col)
