"""Every operator and stage on nulls, empties, repeats, a very long text,
clashing columns, and empty tables."""

import zlib

import edge
import pytest

import corpus_pipeline
from shelfwise.llm.queries import QUERIES

PLAIN = [(i, f"text number {i} about {'fish ' * (i % 7)}and boats", "en", "s", 20) for i in range(40)]


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    return edge.folder(spark, tmp_path_factory.mktemp("edge"))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return edge.folder(spark, tmp_path_factory.mktemp("empty"), rows=[])


def run(spark, name, path):
    return QUERIES[name](spark, path).collect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert run(spark, name, empty) == []


def test_toxicity(spark, path):
    rows = run(spark, "op1_toxicity", path)
    assert len(rows) == len(edge.ROWS)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 8)}) == 1          # null, empty, blank
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)


def test_paragraphs(spark, path):
    rows = run(spark, "op2_paragraph_dedup", path)
    base = sorted(r.doc_id for r in rows if r.first_doc_id == 1)
    assert base == [1, 2, 2] and all(r.copies == 3 for r in rows if r.first_doc_id == 1)
    assert {r.doc_id for r in rows if r.removed} == {2, 7}
    assert {r.doc_id for r in rows} == {1, 2, 6, 7}


def test_shards(spark, path):
    rows = run(spark, "op3_hilbert_shards", path)
    assert len(rows) == len(edge.ROWS)
    sizes = {}
    for r in rows:
        sizes.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in sizes.values())
    assert max(map(len, sizes.values())) - (min(map(len, sizes.values())) if len(sizes) == 40 else 0) <= 1
    assert {r["size"] for r in rows if r.doc_id in (3, 4)} == {16}


def test_personal_data(spark, path):
    rows = {r.doc_id: r for r in run(spark, "op4_pii", path)}
    assert (rows[9].n_email, rows[9].n_ip, rows[9].n_card, rows[9].n_phone) == (1, 1, 0, 1)
    text = edge.ROWS[10][1]
    assert {text[int(s.split(":")[1]):int(s.split(":")[2])] for s in rows[9].spans.split(",")} >= {
        "jean.dupont@example.org", "192.168.1.20", "+33 1 42 68 53 00"}
    assert rows[3].spans == rows[4].spans == ""


def test_model(spark, path):
    rows = {r.doc_id: r for r in run(spark, "op5_ppm", path)}
    assert rows[3].n_tokens == rows[4].n_tokens == rows[8].n_tokens == 1
    assert rows[3].score == rows[4].score and all(r.score < 0 and r.base_score < 0 for r in rows.values())


def test_contamination(spark, path):
    rows = run(spark, "op6_decontaminate", path)
    assert sorted((r.doc_id or 0, r.item_id) for r in rows) == [(0, 1), (1, 1), (2, 1), (2, 1)]


def test_join(spark, path):
    rows = sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in run(spark, "op7_ngram_join", path))
    assert rows == sorted([(1, 1, 2), (2, 1, 2), (2, 1, 2), (3, 3, 0), (4, 4, 0), (0, 0, 0), (5, 5, 0), (6, 6, 1), (7, 6, 1),
                           (8, 8, 0), (9, 9, 0), (10, 10, 0)])


def test_suffixes(spark, path):
    rows = run(spark, "op8_suffix_dedup", path)
    assert {(r.doc_id, r.first_doc_id, r.removed) for r in rows} == {(6, 6, False), (7, 6, True)}
    assert {r.n_words for r in rows} == {60_000}


def test_neighbours(spark, path):
    rows = run(spark, "op9_rotated_codes", path)
    found = {(r.query_id, r["rank"]): r.vec_id for r in rows}
    assert found == {(0, 1): 10, (0, 2): 100, (0, 3): 101, (100, 1): 101, (100, 2): 10, (100, 3): 0}


def test_tokens(spark, path):
    rows = {r.doc_id: r for r in run(spark, "op10_bpe", path)}
    assert rows[3].n_tokens == rows[4].n_tokens == 0 and rows[10].n_tokens == 4


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages(spark, path, empty, stage):
    function = dict(corpus_pipeline.STAGES)[stage]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    out = function(spark, docs, path)
    if stage != "tokenize":
        assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    if stage == "near_copies":
        assert sorted(k for k in kept if k is not None) == [1, 3, 4, 5, 6, 8, 9, 10] and None in kept
    if stage == "decontamination":
        assert sorted(k for k in kept if k) == [3, 4, 5, 6, 7, 8, 9, 10]
    if stage == "personal_data":
        text = next(r.text for r in out.collect() if r.doc_id == 9)
        assert text == "Écrivez à <email> ou <phone>, <ip>."
    nothing = spark.read.parquet(f"{empty}/documents.parquet")
    assert function(spark, nothing, empty).count() == 0
