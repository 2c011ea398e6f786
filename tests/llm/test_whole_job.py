"""Cases that an operator once left out."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import edge
import numpy as np
from pyspark.sql import functions as F
from test_brute_force import SF, base_spans, similar, union_find

import corpus_pipeline
from shelfwise.llm import bpe, decontaminate, hilbert, pii, suffix_dedup, toxicity
from shelfwise.llm.queries import QUERIES
from shelfwise.operators.lineage import Scratch


def paragraphs(t):
    """Word places of all sentences and all lines of a text, each once."""
    found = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", t)]
    gaps = [t[a[1]:b[0]] for a, b in zip(found, found[1:], strict=False)]
    ends = lambda g: bool(re.search(r"[\n\r]", g))
    stops = lambda g: ends(g) or bool(re.search(r"[.!?]", g) and re.search(r"[\t ]", g))
    out = set()
    for cut in (ends, stops):
        at = 0
        for i in range(1, len(found) + 1):
            if i == len(found) or cut(gaps[i - 1]):
                out.add((found[at][0], found[i - 1][1], i - at))
                at = i
    return sorted(out)


def joined_paragraphs(t):
    """Places of long sentences, and of runs of short ones that begin within
    the same eight words of their run."""
    found = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", t)]
    sentences, now = [], []
    for i, (a, b) in enumerate(found):
        gap = t[found[i - 1][1]:a] if now else ""
        line = bool(re.search(r"[\n\r]", gap))
        if line or re.search(r"[.!?]", gap) and re.search(r"[\t ]", gap):
            sentences.append((now, line))
            now = []
        now.append((a, b))
    sentences.append((now, True))
    out, run, words = [], [], 0
    def close():
        nonlocal run, words
        if run:
            out.append((run[0][0], run[-1][1], len(run)))
        run = []
    for s, line_ends in sentences:
        if len(s) >= 8:
            close()
            out.append((s[0][0], s[-1][1], len(s)))
            words = 0
        elif s:
            if run and words // 8 != (words - last) // 8:
                close()
            run = run + s
            last = len(s)
            words += len(s)
        if line_ends:
            close()
            words = 0
    return out


def clustered(docs, parts):
    """{(doc, start, stop): (first doc, first start, copies, words of its
    passage)} of all paragraphs that have a copy; repeated rows not handled."""
    spots, sets, keys, longs = [], [], [], []
    for d, t in docs:
        for a, b, n in parts(t):
            spots.append((d, a, b))
            keys.append(tuple(edge.words(t[a:b])))
            if n >= 8:
                longs.append(len(spots) - 1)
                sets.append(frozenset(edge.shingles(t[a:b])))
    links = [(longs[i], longs[j]) for i, j in similar(sets)]
    seen = {}
    links += [(seen.setdefault(k, i), i) for i, k in enumerate(keys)]
    groups = defaultdict(list)
    for spot, root in zip(spots, union_find(len(spots), links), strict=True):
        groups[root].append(spot)
    found = {s: (min(g)[0], min(g)[1], len(g)) for g in groups.values() if len(g) > 1 for s in g}
    passage = {}
    for d, t in docs:
        places = [m.start() for m in re.finditer(r"[^\W_]+", t)]
        ranges = {s: (places.index(s[1]), places.index(s[1]) + len(edge.words(t[s[1]:s[2]]))) for s in found if s[0] == d}
        inside = {k for a, b in ranges.values() for k in range(a, b)}
        for s, (a, b) in ranges.items():
            while a - 1 in inside:
                a -= 1
            while b in inside:
                b += 1
            passage[s] = b - a
    return {s: (*v, passage[s]) for s, v in found.items()}


def test_every_paragraph(spark):
    """Lines and short sentences, against plain Python."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = clustered(docs, paragraphs)
    rows = QUERIES["op2_every_paragraph"](spark, SF).collect()
    assert {(r.doc_id, r.start, r.stop): (r.first_doc_id, r.first_start, r.copies) for r in rows} == {
        s: v[:3] for s, v in want.items()}
    assert len(rows) == len(want)


def test_paragraphs_and_passages(spark):
    """Long sentences and joined short ones, against plain Python."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert all(sum(n for *_, n in joined_paragraphs(t)) == len(edge.words(t)) for _, t in docs)
    want = clustered(docs, joined_paragraphs)
    rows = QUERIES["op2_paragraph_dedup"](spark, SF).collect()
    assert {(r.doc_id, r.start, r.stop): (r.first_doc_id, r.first_start, r.copies, r.passage_words) for r in rows} == {
        s: v for s, v in want.items() if v[3] >= 12}
    assert len({s for s, v in want.items() if v[3] < 12}) > 10


def test_short_sentences_join_to_a_passage(spark, tmp_path):
    verse = "The sea is wide. The boat is low. The wind is up. We row."
    rows = [(1, f"First own words stand here\n{verse}", "en", "s", 1), (2, f"{verse}\nOther words end it. We row.", "en", "s", 1),
            (3, "We row. Something else here", "en", "s", 1)]
    path = edge.folder(spark, tmp_path, rows=rows, extra=False)
    found = QUERIES["op2_paragraph_dedup"](spark, path).collect()
    assert {(r.doc_id, r.passage_words) for r in found} == {(1, 14), (2, 14)}
    assert Counter(r.doc_id for r in found) == {1: 2, 2: 2} and {r.removed for r in found if r.doc_id == 1} == {False}
    assert {r.doc_id for r in QUERIES["op2_every_paragraph"](spark, path).collect()} == {1, 2, 3}


def test_one_id_with_two_texts(spark, tmp_path):
    """Classes are named by their text, not by the id of a row."""
    a = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi"
    b = " ".join(reversed(a.split())) + " one two three four five six seven"
    rows = [(1, a, "en", "s", 1), (2, b, "en", "s", 1), (2, a + " omega", "en", "s", 1), (3, b + " eight", "en", "s", 1),
            (4, "Some text of its own stands here.", "en", "s", 1), (4, "Some text of its own stands here.", "en", "s", 1)]
    path = edge.folder(spark, tmp_path, rows=rows, extra=False)
    found = sorted((r.doc_id, r.class_id, r.n_links) for r in QUERIES["op7_ngram_join"](spark, path).collect())
    assert found == [(1, 1, 1), (2, 1, 1), (2, 2, 1), (3, 2, 1), (4, 4, 1), (4, 4, 1)]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = sorted((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, path).collect())
    assert kept == [(1, a), (2, b), (4, rows[4][1])]


def test_line_of_short_sentences(spark, tmp_path):
    """A 9-word line of two sentences, verse, and a one-word list entry."""
    verse = "Roses are red.\nViolets are blue"
    rows = [(1, f"alpha\nOne two three four. Five six seven eight nine.\n{verse}", "en", "s", 1),
            (2, f"One two three four. Five six seven eight nine.\nbeta\n{verse}\nalpha", "en", "s", 1)]
    path = edge.folder(spark, tmp_path, rows=rows, extra=False)
    found = Counter(rows[r.doc_id - 1][1][r.start:r.stop] for r in QUERIES["op2_every_paragraph"](spark, path).collect())
    assert found == {k: 2 for k in ("alpha", "One two three four. Five six seven eight nine", "One two three four",
                                    "Five six seven eight nine", "Roses are red", "Violets are blue")}


def test_numbers_spaced_digit_by_digit(spark, tmp_path):
    texts = ["card 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "call +4 9 1 5 1 2 3 4 5 6 7 now", "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1",
             "+4.9.1.5.1.2.3.4.5.6.7", "on 1.2.3.4", "+4"]
    path = edge.folder(spark, tmp_path, rows=[(i, t, "en", "s", 1) for i, t in enumerate(texts)], extra=False)
    rows = {r.doc_id: r for r in QUERIES["op4_pii"](spark, path).collect()}
    assert [(r.n_ip, r.n_card, r.n_phone) for _, r in sorted(rows.items())] == [
        (0, 1, 0), (0, 0, 1), (0, 1, 0), (2, 0, 1), (1, 0, 0), (0, 0, 0)]
    for i, t in enumerate(texts):
        assert rows[i].base_sha256 == hashlib.sha256(",".join(base_spans(t)).encode()).hexdigest()
    docs = spark.read.parquet(f"{path}/documents.parquet").where(F.col("doc_id") < 2)
    clear = corpus_pipeline.redact_personal(spark, docs, path).collect()
    assert sorted(r.text for r in clear) == ["call <phone> now", "card <card>"]


def test_a_long_text_does_not_end_the_sample(spark):
    """The first text of each label by hash is over the byte bound."""
    order = [r.id for r in spark.range(120).orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(i, ("bad " if k % 2 else "good ") * (4000 if k < 20 else 8), "en", k % 2) for k, i in enumerate(order)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    for least in (0, 20):                              # also with nothing that fits
        some = docs.where(F.octet_length("text") > 1000) if least else docs
        net = toxicity.fit(some.drop("toxic"), some.select("doc_id", "toxic"), max_bytes=8000)
        assert not net.constant
    net = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"), max_bytes=8000)
    scored = docs.select("toxic", toxicity.score(docs, net).alias("s")).groupBy("toxic").agg(F.avg("s").alias("s")).collect()
    assert {r.toxic for r in scored if r.s > 0.5} == {1}


def test_scores_keep_the_share_of_all_labels(spark):
    """A sample of equal classes, out of a table where a tenth is toxic."""
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        bad = rng.random() < 0.2
        toxic = int(rng.random() < (0.45 if bad else 0.02))
        rows.append((i, " ".join(rng.choice("abcdefghij") * 3 for _ in range(8)) + (" vile" if bad else " kind"), "en", toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    net = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"), max_positive=100, max_negative=100)
    r = docs.where(toxicity.crc_fold("doc_id", 5) == 1).agg(
        F.avg(toxicity.score(docs, net)).alias("score"), F.avg("toxic").alias("toxic")).first()
    assert abs(r.score - r.toxic) < 0.02


def test_runs_of_one_document_over_many_partitions(spark):
    """Its neighbours of other documents may be several partitions away."""
    rows = [(1, b"aaaabbbb", 5, 0)] + [(1, b"aaaa" + bytes([98 + k % 3]) * 4, 7, k) for k in range(3000)]
    rows += [(1, b"aaaadddd", 9, 0)] + [(2, b"aaaa", 7, 9000 + k) for k in range(50)]
    df = spark.createDataFrame(rows, "h long, right binary, doc_id long, at int").selectExpr("*", "5L AS first")
    scratch = Scratch(spark, "runs")
    try:
        got = {(r.doc_id, r.at): r.extent for r in suffix_dedup.neighbours(df, "right", scratch).collect()}
    finally:
        scratch.close()
    common = lambda a, b: next((k for k in range(2) if a[4 * k:4 * k + 4] != b[4 * k:4 * k + 4]), 2)
    kinds = {(h, x, d) for h, x, d, _ in rows}
    best = {k: max((common(k[1], o[1]) for o in kinds if o[0] == k[0] and o[2] != k[2]), default=-1) for k in kinds}
    assert got == {(d, at): best[h, x, d] for h, x, d, at in rows}


def repeated(texts, n=50):
    """{(doc_id, text): [(start, stop, holders of its runs)]} by plain Python."""
    holders = defaultdict(set)
    for d, t in texts:
        w = edge.words(t)
        for i in range(len(w) - n + 1):
            holders[tuple(w[i:i + n])].add(d)
    out = {}
    for d, t in texts:
        w, runs = edge.words(t), []
        for i in range(len(w) - n + 1):
            held = holders[tuple(w[i:i + n])]
            if len(held) < 2:
                continue
            if runs and runs[-1][1] >= i:
                runs[-1] = (runs[-1][0], i + n, runs[-1][2] | held)
            else:
                runs.append((i, i + n, set(held)))
        out[d, t] = runs
    return out


def test_passages_equal_plain_python(spark):
    """Pieces put together from several documents, short periods, runs of just
    under and over 50 words, edits, and two texts under one id."""
    rng = random.Random(17)
    word = lambda: f"w{rng.randrange(5000)}"
    run = lambda n: [word() for _ in range(n)]
    one, two = run(45), run(45)
    texts = [(1, run(30) + one + run(30)), (2, run(9) + two + run(40)), (3, run(20) + one + two + run(20))]
    pool = [run(rng.choice([49, 50, 51, 60, 74, 90, 200])) for _ in range(12)]
    pool += [(run(p) * 90)[:rng.choice([60, 77, 130])] for p in (1, 2, 3, 7, 13, 26)]
    for d in range(4, 90):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            piece = list(rng.choice(pool))
            if rng.random() < 0.5:                     # a piece of it, or one word changed
                a, b = sorted(rng.sample(range(len(piece) + 1), 2))
                piece = piece[a:b] if rng.random() < 0.5 else piece[:a] + [word()] + piece[a:]
            parts += piece + run(rng.choice([0, 0, 1, 5, 30]))
        texts.append((d if d % 10 else 7, parts))
    texts = [(d, " ".join(t)) for d, t in texts] + [(500, " ".join(["la"] * 400)), (501, "so " + " ".join(["la"] * 300)), (None, "x"), (502, None)]
    texts.append(texts[20])
    df = spark.createDataFrame(texts, "doc_id long, text string")
    scratch = Scratch(spark, "passages")
    try:
        got = suffix_dedup.repeated_passages(df, scratch).collect()
    finally:
        scratch.close()
    want = repeated([(d, t) for d, t in dict.fromkeys(texts) if d is not None and t])
    assert not want[texts[0]] and not want[texts[2]]   # 90 words, but no 50 of one document
    assert sorted((r.doc_id, r.start_word, r.stop_word) for r in got) == sorted(
        (d, a, b) for (d, _), runs in want.items() for a, b, _ in runs)
    spans = defaultdict(set)
    for (d, _), runs in want.items():
        for a, b, held in runs:
            spans[d, a, b] |= held
    for r in got:
        assert r.first_doc_id in spans[r.doc_id, r.start_word, r.stop_word] and r.first_doc_id <= r.doc_id
        assert r.removed == (r.first_doc_id != r.doc_id) and r.n_words == r.stop_word - r.start_word


def test_many_spans_in_one_text(spark, tmp_path):
    """20,000 addresses of two kinds each: no work that grows with pairs of
    spans, and every base span at its place."""
    rng = random.Random(11)
    parts = [f"{rng.choice(['é', 'x', 'ß', '漢'])} 10.{i % 256}.{i // 256 % 256}.7 mail u{i}@host{i}.org," for i in range(20_000)]
    text = " ".join(parts)
    path = edge.folder(spark, tmp_path, rows=[(1, text, "en", "s", 1), (2, "call +49 170 1234567 now", "en", "s", 1)], extra=False)
    began = time.monotonic()
    rows = {r.doc_id: r for r in QUERIES["op4_pii"](spark, path).collect()}
    assert (rows[1].n_ip, rows[1].n_email) == (20_000, 20_000)
    assert rows[1].base_sha256 == hashlib.sha256(",".join(base_spans(text)).encode()).hexdigest()
    docs = spark.read.parquet(f"{path}/documents.parquet")
    clear = {r.doc_id: r.text for r in corpus_pipeline.redact_personal(spark, docs, path).collect()}
    assert clear[1] == re.sub(r"10\.\d+\.\d+\.7", "<ip>", re.sub(r"u\d+@host\d+\.org", "<email>", text))
    assert clear[2] == "call <phone> now"
    assert time.monotonic() - began < 60


def test_redaction_of_overlapping_spans(spark):
    """The first of overlapping spans covers, wherever a part of the text ends."""
    rng = random.Random(2)
    rows = []
    for _ in range(60):
        text = "".join(rng.choice("abé漢\U0001f600 ") for _ in range(rng.randrange(80)))
        spans = sorted({(a, min(len(text), a + rng.randrange(1, 9))) for a in (rng.randrange(len(text)) for _ in range(rng.randrange(9)))}
                       if text else [])
        rows.append((text, [(a, b, "k") for a, b in spans if a < b]))
    df = spark.createDataFrame(rows, "text string, spans array<struct<start:int,stop:int,kind:string>>")
    for r in df.select("text", "spans", pii.redacted(F.col("text"), F.col("spans")).alias("out")).collect():
        want, at = "", 0
        for a, b, _ in r.spans:
            want += r.text[at:a] if a > at else ""
            want += "<k>" if b > at else ""
            at = max(at, b)
        assert r.out == want + r.text[at:]


def test_automaton_equals_its_gadgets():
    """Arcs against states and arcs built one gadget at a time; words read
    together against words read alone."""
    rng = random.Random(8)
    for _ in range(20):
        vocab, merges = {bytes([c]): i for i, c in enumerate(b"abc")}, []
        while len(merges) < 25:
            u, v = rng.choice(list(vocab)), rng.choice(list(vocab))
            if u + v not in vocab and len(u + v) < 9:
                merges.append((u, v))
                vocab[u + v] = len(vocab)
        a = bpe.Automaton(vocab, merges, {})
        states = [{i: 0 for i in range(3)}]
        for u, v in merges:
            u, v, uv = vocab[u], vocab[v], vocab[u + v]
            to = next((s[u] for s in states if u in s), None)
            if to is None or v not in states[to]:
                continue
            after = states[to][v]
            states.append({t: s for t, s in states[to].items() if t != v})
            for s in states:
                if u in s:
                    s[u], s[uv] = len(states) - 1, after
        live = set(states[0])
        assert live == set(a.live.values())
        pairs = [(u, v) for u in live for v in live]
        want = [v in states[states[0][u]] for u, v in pairs]
        assert [a.follows(u, v) for u, v in pairs] == want
        u, v = (np.array(x) for x in zip(*pairs, strict=True))
        assert a.follow_all(u, v).tolist() == want
        words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 33))) for _ in range(200)})
        rng.shuffle(words)
        ids, sizes = a.encode_words(np.array(words, "S32").view(np.uint8).reshape(-1, 32), np.array([len(w) for w in words]))
        together = [tuple(x.tolist()) for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert together == [a.encode_word(w) for w in words]
        for w, ids in zip(words, together, strict=True):
            state = 0
            for t in ids:
                state = states[state][t]
            assert b"".join(a.label[t] for t in ids) == w


def test_short_items_are_found(spark, tmp_path):
    """Items of one to four words, as runs of words of the documents."""
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("ab Cd ef g h".split()) for _ in range(rng.randrange(9))), "en", "s", 1) for i in range(60)]
    path = edge.folder(spark, tmp_path, rows=rows, extra=False)
    items = [(n, "-".join(rng.choice("AB cd ef g h".split()) for _ in range(n % 6))) for n in range(24)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    want = set()
    for d, t, *_ in rows:
        w = edge.words(t)
        for i, item in items:
            own = edge.words(item)
            runs = {tuple(w[k:k + len(own)]) for k in range(len(w) - len(own) + 1)}
            if own and (tuple(own) in runs if len(own) < 5 else 5 * len(edge.shingles(item) & {
                    tuple(w[k:k + 5]) for k in range(len(w) - 4)}) >= 4 * len(edge.shingles(item))):
                want.add((d, i))
    found = docs.select("doc_id", F.explode(decontaminate.items_in(docs, bench)).alias("x")).select("doc_id", "x.*").collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want) and len(want) > 100
    long = docs.select("doc_id", F.explode(decontaminate.items_in(docs, bench, 5)).alias("x")).select("x.item_id").distinct()
    assert all(i % 6 == 5 for (i,) in long.collect())


def test_sources_that_share_a_long_prefix(spark):
    """Strings are told apart by all of their bytes, and every row gets a place."""
    rng = random.Random(7)
    rows = [(i, rng.choice([None, *[f"https://crawl-2024/{k:03d}" for k in range(40)]]), rng.random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, source string, x double")
    scratch = Scratch(spark, "cells")
    try:
        cells = {r.source: r.cell_0 for r in hilbert.quantised(df, ["source", "x"], 5, scratch).collect()}
        found = hilbert.hilbert_shards(df, ["source", "x"], ["id"], 7, scratch).collect()
    finally:
        scratch.close()
    names = [None, *sorted(k for k in cells if k)]
    assert [cells[k] for k in names] == sorted(cells.values()) and cells[None] == 0 and len(set(cells.values())) >= 28
    sizes = Counter(r.shard for r in found)
    assert len(found) == 2000 and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in found if r.shard == s) == list(range(n)) for s, n in sizes.items())
    # runs of the curve: a shard's rows follow those of the one before
    assert all(max(r.hilbert for r in found if r.shard == s) <= min(r.hilbert for r in found if r.shard == s + 1) for s in range(6))
