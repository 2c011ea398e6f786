"""Hard negatives, exact top-k search and the filter audit, against plain
Python on small, skewed and difficult tables."""

import itertools
import math
import random
import re
from collections import Counter

import edge
import pytest
from pyspark.sql import functions as F
from test_brute_force import SF

from shelfwise.llm import audit, negatives, slices, topk
from shelfwise.llm.queries import QUERIES
from shelfwise.operators.lineage import Scratch


def whole(rows, factor):
    """(id, whole vector, label) of the rows that take part, for factor."""
    rows = [r for r in rows if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    sizes = Counter(len(r[1]) for r in rows)
    dim = min(sizes, key=lambda d: (-sizes[d], d)) if sizes else 0
    cut = lambda x: max(-slices.MOST, min(slices.MOST, math.floor(float(x) * factor)))
    return [(i, tuple(map(cut, v)), label) for i, v, label in rows if len(v) == dim]


def dot(a, b):
    return max(-(1 << 63) + 1, min((1 << 63) - 1, sum(x * y for x, y in zip(a, b, strict=True))))


def best(rows, every=100, k=10):
    out = set()
    asked = {i: min(v for j, v, _ in rows if j == i) for i in {r[0] for r in rows if r[0] % every == 0}}
    for q, v in asked.items():
        found = sorted((-dot(v, w), i) for i, w, _ in rows if i != q)[:k]
        out |= {(q, place, i, -s) for place, (s, i) in enumerate(found, 1)}
    return out


def hard(rows, every=50):
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows if label is not None]
    out = []
    for a in {r[0] for r in rows if r[0] % every == 0}:
        label, vector = min((str(l), v) for i, v, l in rows if i == a)
        scored = sorted((-dot(vector, v), i, str(l)) for i, v, l in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            inside = [(n, i) for n, i, l in scored if l != label and -50 * s <= -100 * n <= -95 * s][:3]
            out += [(a, p, place, i, -s, -n) for place, (n, i) in enumerate(inside, 1)]
    return Counter(out)


def embeddings(spark, path):
    return [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]


def asked(spark, path):
    a = {(r.query_id, r["rank"], r.vec_id, r.score) for r in QUERIES["op13_pivot_index"](spark, path).collect()}
    rows = QUERIES["op11_hard_negatives"](spark, path).collect()
    return a, Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in rows)


@pytest.fixture
def fine(monkeypatch):
    """Many slices, rings and rounds on small tables."""
    monkeypatch.setattr(slices, "SLICE_BYTES", 1)
    monkeypatch.setattr(topk, "RING_ROWS", 16)


def test_on_the_given_table(spark, fine):
    rows = embeddings(spark, SF)
    a, b = asked(spark, SF)
    assert a == best(whole(rows, 1024)) and b == hard(whole(rows, 256)) and a and b


def test_hot_label_repeated_vectors_and_ties(spark, tmp_path, fine):
    rng = random.Random(3)
    draw = lambda: [round(rng.gauss(0, 1), 1) for _ in range(3)]
    rows = [(i, draw(), 4 if i % 3 else rng.randrange(10)) for i in range(900)]
    rows += [(2000 + i, [0.5, 0.5, 0.5], 4) for i in range(500)]        # one vector, a third of all rows
    rows += [(100, [0.25, 0.0, 1.0], 1), (100, [0.25, 0.0, 1.0], 1), (8, [1.0, 1.0, 1.0], 2), (8, [1.0, 1.0, 1.0], 2)]
    rows += [(5000, [0.0, 0.0, 0.0], 4), (5001, [9.0, 9.0], 1), (5002, draw(), None)]
    path = str(tmp_path)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5).write.parquet(
        f"{path}/embeddings.parquet")
    rows = embeddings(spark, path)
    a, b = asked(spark, path)
    assert a == best(whole(rows, 1024)) and b == hard(whole(rows, 256))


def test_components_beyond_exact_doubles(spark, tmp_path):
    rows = [(50 * i, [3.0e15 + 7 * i, float(i), -1e300 if i == 3 else 2.0], i % 2) for i in range(8)]
    path = str(tmp_path)
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{path}/embeddings.parquet")
    a, b = asked(spark, path)
    assert a == best(whole(rows, 1024)) and b == hard(whole(rows, 256))


def test_edges(spark, tmp_path):
    path = edge.folder(spark, tmp_path)
    rows = embeddings(spark, path)
    a, b = asked(spark, path)
    assert a == best(whole(rows, 1024)) and b == hard(whole(rows, 256)) and {q for q, *_ in a} == {0, 100}


def test_search_leaves_far_rings_out(spark, fine):
    """Rows in far clusters of equal norm: most annuli are never visited."""
    rows = [(i, [int(1000 * math.cos(i % 8 * math.pi / 4 + i * 1e-4)), int(1000 * math.sin(i % 8 * math.pi / 4 + i * 1e-4))])
            for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    scratch = Scratch(spark, "rings")
    try:
        index, directory = topk.build_index(slices.narrow(df, 2, 1000), 2, len(rows), scratch)
        got = topk.top_k(df, df.where("vec_id = 0"), 3, scratch).collect()
        order, bound = directory.order(slices.np.array([rows[0][1]], float))
        assert index.count() == len(rows) and index.select("slice").distinct().count() == directory.slices.sum()
        assert (bound[0] >= min(r.score for r in got)).mean() < 0.3
    finally:
        scratch.close()
    want = sorted((-sum(x * y for x, y in zip(rows[0][1], v, strict=True)), i) for i, v in rows if i)[:3]
    assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == want


# ------------------------------------------------------------------ audit
def audited(docs, labels):
    """docs (doc_id, text, lang); labels (doc_id, quality, toxic)."""
    marks = {}
    for d, q, t in labels:
        if d is not None:
            good, toxic = marks.get(d, (False, False))
            marks[d] = good or q == 1, toxic or t == 1
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    rows = []
    for d, t, lang in docs:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = "".join(name for name, yes in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            re.search("[#$%&*|]", t), d is not None and d > least[t]), strict=True) if yes)
        rows.append((lang or "", fails, *marks.get(d, (False, False))))
    out, kinds = {}, Counter(rows)
    for part in {r[0] for r in rows}:
        mine = [(f, g, t, n) for (p, f, g, t), n in kinds.items() if p == part]
        shapley = {x: sum(n * 120 // len(f) for f, _, _, n in mine if x in f) for x in "ABCDE"}
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, x in enumerate(order, 1):
                left = [r for r in mine if not set(order[:step - 1]) & set(r[0])]
                gone = [r for r in left if x in r[0]]
                total = lambda rs: sum(r[3] for r in rs)
                out[part, order, step] = (total(left) - total(gone), total(gone),
                                          total(r for r in mine if x in r[0]) - total(gone), total(r for r in mine if r[0] == x),
                                          total(r for r in gone if r[1]), total(r for r in gone if r[2]), shapley[x])
    return out


NUMBERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def table(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in NUMBERS) for r in df.collect()}


def test_audit_of_edge_rows(spark, tmp_path):
    path = edge.folder(spark, tmp_path)
    docs = [(d, t, lang) for d, t, lang, *_ in edge.ROWS]
    labels = [tuple(r) for r in spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert table(QUERIES["op12_filter_audit"](spark, path)) == audited(docs, labels)


def rising_files(spark, path, groups):
    for k, rows in enumerate(groups):
        spark.createDataFrame(rows, edge.SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_smaller_ids_retract_and_later_files_go_on(spark, tmp_path):
    """Files in falling order of ids, one to a batch, a third of all rows of
    one text; then more files, for which the stream goes on."""
    rng = random.Random(5)
    texts = ["one text", "Another $ text", "w " * 300, " ".join(f"word{i}" for i in range(250))]
    rows = [(i, "the hot text" if rng.random() < 0.34 else rng.choice(texts), rng.choice(["en", "de", None]), "s", 1)
            for i in range(600)]
    rows += [(None, "the hot text", "en", "s", 1), (7, "one text", "de", "s", 1), (7, "one text", "en", "s", 1)]
    falling = sorted(rows, key=lambda r: -(r[0] or 0))
    groups = [falling[i:i + 101] for i in range(0, len(falling), 101)]
    path, scratch = str(tmp_path / "docs"), Scratch(spark, "audit-test")
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(0, 600, 4)], "doc_id long, quality int, toxic boolean")
    labels = labels.select("doc_id", "quality", F.col("toxic").cast("int").alias("toxic"))
    marks = [tuple(r) for r in labels.collect()]
    try:
        out, state = scratch.folder("changes"), scratch.folder("stream")
        done = []
        for part in (groups[:4], groups[4:]):
            rising_files(spark, path, part)
            done += [r for g in part for r in g]
            audit.stream_changes(spark, path, out, state, keys=3, batch_files=1)
            changes = spark.read.schema(audit.CHANGE).parquet(out)
            got = table(audit.interactions(audit.counters(changes, labels)))
            assert got == audited([(d, t, lang) for d, t, lang, *_ in done], marks)
        assert changes.where("change < 0").count() > 0
        assert changes.agg(F.sum("change")).first()[0] == len(rows)
    finally:
        scratch.close()


def test_state_is_kept_whole():
    state = {b"a" * 32: (5, 3, {"en": 2, "": 1}), b"\0" * 32: (-1, 0, {"de": 7})}
    assert audit.read_state(audit.kept_state(state)) == state
    changes = audit.follow(state, [(4, "fr", 3, b"a" * 32), (9, "en", 3, b"a" * 32)])
    assert state[b"a" * 32] == (4, 3, {"fr": 1})
    assert Counter({(d, p, m): n for d, p, m, n in changes}) == {
        (5, "en", 3): -2, (5, "en", 19): 2, (5, "", 3): -1, (5, "", 19): 1, (4, "fr", 3): 1, (9, "en", 19): 1}
