"""Regressor specification.

A model is ``y ~ terms + absorbed effects``. Terms are column names or
interactions ``a*b`` (expands to a, b, a:b; duplicates removed, first
occurrence wins) or ``a:b`` (product only). Categorical terms ``C(x)``
expand to treatment dummies with the first level as base; the levels are
a fixed, caller-given list (e.g. income groups) so no data is scanned.
Absorbed effects (product, store, week) are never expanded to dummies.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Term:
    name: str          # output name, e.g. 'is_displayed:discount_pct'
    factors: tuple     # tuple of factor names


@dataclass
class Spec:
    y: str
    terms: list[Term]
    categorical: dict = field(default_factory=dict)   # var -> list of levels

    @property
    def names(self) -> list[str]:
        return [t.name for t in self.terms]


_CAT = re.compile(r"^C\((\w+)\)$")


def _factor_columns(factor: str, categorical: dict) -> list[tuple[str, Column]]:
    m = _CAT.match(factor)
    if m:
        var = m.group(1)
        levels = categorical[var]
        return [(f"C({var})[T.{lvl}]",
                 F.when(F.col(var) == F.lit(lvl), 1.0).otherwise(0.0)) for lvl in levels[1:]]
    return [(factor, F.col(factor).cast("double"))]


def parse(formula: str, categorical: dict | None = None) -> Spec:
    """'log_qty ~ log_price + is_displayed*discount_pct' -> Spec."""
    categorical = categorical or {}
    lhs, rhs = [s.strip() for s in formula.split("~")]
    seen, terms = set(), []

    def add(factors):
        key = tuple(factors)
        if key not in seen:
            seen.add(key)
            terms.append(Term(":".join(factors), key))

    for part in [p.strip() for p in rhs.split("+") if p.strip()]:
        if "*" in part:
            a, b = [s.strip() for s in part.split("*")]
            add([a]); add([b]); add([a, b])
        elif ":" in part:
            add([s.strip() for s in part.split(":")])
        else:
            add([part])
    # Patsy orders main effects before interactions.
    terms.sort(key=lambda t: len(t.factors))
    return Spec(lhs, terms, categorical)


def design_columns(spec: Spec) -> list[tuple[str, Column]]:
    """Expand terms to (name, Column) pairs, products taken before demeaning."""
    out = []
    for t in spec.terms:
        expanded = [_factor_columns(f, spec.categorical) for f in t.factors]
        combos = [("", F.lit(1.0))]
        for cols in expanded:
            combos = [((n0 + ":" + n1) if n0 else n1, c0 * c1)
                      for n0, c0 in combos for n1, c1 in cols]
        out.extend(combos)
    return out
