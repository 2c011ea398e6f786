"""One-bit codes against plain numpy: popcount products, bounds, a list that
holds most rows, repeated rows and ids, and recall on a larger table."""

import math

import numpy as np
import pytest

from shelfwise.llm import ann, slices
from shelfwise.llm.queries import QUERIES
from shelfwise.operators.lineage import Scratch

LARGE = "/root/testdata/sf0.1"


def brute(rows, asked, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for q, v in asked.items():
        d = np.sqrt(((x - np.array(v, float)) ** 2).sum(1))
        d[ids == q] = np.inf
        best = [b for b in np.lexsort((ids, d))[:k] if d[b] < np.inf]
        out[q] = [(int(ids[b]), float(d[b])) for b in best]
    return out


def run(spark, rows, asked, k, **options):
    schema = "vec_id long, v array<double>"
    scratch = Scratch(spark, "codes")
    try:
        df = spark.createDataFrame(rows, schema)
        found = ann.nearest(df, spark.createDataFrame(list(asked.items()), schema), k, scratch, **options).collect()
    finally:
        scratch.close()
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("dim", [1, 3, 63, 64, 65, 200])
def test_products_of_packed_codes(dim):
    rng = np.random.default_rng(dim)
    turned, signs = rng.normal(size=(7, dim)), rng.normal(size=(50, dim)) >= 0
    turned[3] = 0.25
    code = ann.pack_words(signs)
    assert code.shape == (50, -(-dim // 64))
    got, error = ann.inner_products(turned, code, np.bitwise_count(code).sum(1).astype(float))
    want = turned @ np.where(signs, 1, -1).T / math.sqrt(dim)
    assert (np.abs(got - want) <= error[:, None] + 1e-12).all()
    assert error.max() < 0.05 * np.abs(turned).max() * math.sqrt(dim)


def test_rotated_rows_keep_lengths():
    turn = ann.rotation(40)
    assert np.allclose(turn @ turn.T, np.eye(40))


def test_a_list_with_most_rows(spark, monkeypatch):
    """Two thirds of the rows lie about one centre and fill several slices."""
    monkeypatch.setattr(slices, "rows_of_slice", lambda dim: 64)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 32)) * 5
    which = np.where(rng.random(1500) < 0.67, 0, rng.integers(1, 6, 1500))
    x = centres[which] + rng.normal(size=(1500, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    asked = {i: rows[i][1] for i in range(0, 1500, 50)}
    got, want = run(spark, rows, asked, 10), brute(rows, asked, 10)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.99 * sum(map(len, want.values()))
    for q, found in got.items():
        assert [d for _, d in found] == pytest.approx([d for _, d in want[q]], rel=1e-6)


def test_repeats_and_ties(spark):
    """Copies of one vector, ids that repeat, fewer candidates than asked."""
    same = [(i, [1.0, 2.0, 2.0]) for i in range(300)]
    got = run(spark, same, {0: same[0][1], 7: same[7][1]}, 10)
    assert got == {0: [(i, 0.0) for i in range(1, 11)], 7: [(i, 0.0) for i in [*range(7), 8, 9, 10]]}
    own = [(5, [float(i), 1.0]) for i in range(40)] + [(6, [100.0, 1.0]), (8, [-50.0, 1.0]), (8, [-50.0, 1.0])]
    got = run(spark, own, {5: own[0][1]}, 2)
    assert got == {5: [(8, 50.0), (8, 50.0)]}
    assert run(spark, own[39:41], {5: own[39][1]}, 10) == {5: [(6, 61.0)]}
    assert run(spark, own, {}, 3) == {} and run(spark, [], {1: [1.0]}, 3) == {}


def test_lists_out_of_reach_are_not_read(spark):
    """Far clusters: the triangle inequality leaves most lists out."""
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(40, 8)) * 1000, 40, axis=0) + rng.normal(size=(1600, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, v array<double>")
    scratch = Scratch(spark, "codes")
    try:
        index, directory, _ = ann.build_index(df, 8, 1600, scratch)
        assert index.count() == 1600 and index.select("slice").distinct().count() <= directory.slices.sum()
    finally:
        scratch.close()
    _, bound = directory.order(x[:1])
    worst = np.sort(np.sqrt(((x - x[0]) ** 2).sum(1)))[10]
    assert 1 <= (bound[0] <= worst).sum() < 0.3 * len(directory.list)


def test_recall(spark):
    table = spark.read.parquet(f"{LARGE}/embeddings.parquet").collect()
    rows = [(r.vec_id, r.embedding) for r in table]
    want = brute(rows, {i: v for i, v in rows if i % 100 == 0}, 10)
    got = {}
    for r in QUERIES["op9_rotated_codes"](spark, LARGE).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {i for i, _ in f}) for q, f in want.items()) >= 0.99 * sum(map(len, want.values()))
