"""Queries that read the line panel more than once compute it once."""

import pytest

from shelfwise.operators import lineage
from shelfwise.plans import queries
from conftest import SF


@pytest.mark.parametrize("name", ["store_price_order", "boxplot_by_store"])
def test_lines_are_computed_once(spark, monkeypatch, name):
    made, real = [], queries.panels.line_panel
    written, cut = [], lineage.Scratch.cut
    monkeypatch.setattr(queries.panels, "line_panel", lambda *a, **k: made.append(1) or real(*a, **k))
    monkeypatch.setattr(lineage.Scratch, "cut", lambda self, df, keep=False: written.append(df.columns) or cut(self, df, keep))
    assert queries.QUERIES[name](spark, SF).count()
    assert len(made) == 1 and written[0] == ["product_category", "store_id", "unit_price", "quantity", "n_lines"]
