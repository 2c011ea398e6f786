"""The whole pipeline on a small folder, against a brute-force version of
what its stages decide."""

import hashlib

import edge
from tokenizers import Tokenizer

import corpus_pipeline
from shelfwise.llm import bpe


def test_all_stages_in_a_row(spark, tmp_path):
    clean = [f"Report {i}: the boats of harbour {i * 7} came home with {i} crates of fish and a letter for house {i * 3}." for i in range(60)]
    toxic = [f"vile vermin scum number {i}, you filthy vermin scum of vile lot {i * 5}" for i in range(40)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean)]
    rows += [(100 + i, t, "en", "s", len(t)) for i, t in enumerate(toxic)]
    copy = clean[3] + " The end."
    rows += [(200, copy, "en", "s", len(copy)), (3, clean[3], "en", "s", len(clean[3])),
             (201, "Read this: " + edge.BASE + " and more.", "en", "s", 1),
             (202, "Write to ann@example.org or call +49 170 1234567 today.", "en", "s", 1), (203, None, "en", "s", None)]
    path = edge.folder(spark, tmp_path, rows=rows)
    labels = [(r[0], 1, int(100 <= r[0] < 140)) for r in rows if r[0] < 200]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    out = corpus_pipeline.run(spark, path)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert out.columns == docs.columns + ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    got = {r.doc_id: r for r in out.collect()}
    # toxic documents, near copies (and the repeated row) and the benchmark's text are gone
    assert set(got) == {*range(60), 202, 203} and out.count() == len(got)
    assert got[202].text == "Write to <email> or call <phone> today." and got[202].n_chars == len(got[202].text)
    ref = Tokenizer.from_file(bpe.vocabulary_path())
    for r in got.values():
        ids = ref.encode(r.text or "", add_special_tokens=False).ids
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
        assert r.own if hasattr(r, "own") else True
