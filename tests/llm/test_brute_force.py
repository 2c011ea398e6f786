"""Operators against plain Python on the smallest test tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import edge
import numpy as np
import pytest

from shelfwise.llm import bpe, hilbert, pii, ppm, suffix_dedup, text, toxicity
from shelfwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def union_find(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def similar(sets):
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    common = Counter(p for v in index.values() for p in itertools.combinations(v, 2))
    return [p for p, c in common.items() if 5 * c >= 4 * (len(sets[p[0]]) + len(sets[p[1]]) - c)]


def test_join_finds_every_pair(spark, docs):
    docs = sorted(docs)
    links = similar([edge.shingles(t) for _, t in docs])
    roots = union_find(len(docs), links)
    n = Counter(i for p in links for i in p)
    want = {d: (docs[roots[i]][0], n[i]) for i, (d, _) in enumerate(docs)}
    assert {r.doc_id: (r.class_id, r.n_links) for r in QUERIES["op7_ngram_join"](spark, SF).collect()} == want


def covered(words, n):
    """(document, place) of all words in a run of n that another document has."""
    holders = defaultdict(set)
    runs = {d: [tuple(w[i:i + n]) for i in range(len(w) - n + 1)] for d, w in words.items()}
    for d, found in runs.items():
        for r in found:
            holders[r].add(d)
    return {(d, i + k) for d, found in runs.items() for i, r in enumerate(found) if len(holders[r]) > 1 for k in range(n)}


def test_passages_are_shared_runs(spark, docs):
    words = {d: edge.words(t) for d, t in docs}
    got = {(r.doc_id, k) for r in QUERIES["op8_suffix_dedup"](spark, SF).collect() for k in range(r.start_word, r.stop_word)}
    assert got == covered(words, suffix_dedup.LEAST_WORDS)


def test_contamination(spark, docs):
    items = {r.item_id: edge.shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()
             if len(edge.words(r.text)) >= 5}
    want = {(d, i) for d, t in docs for own in [edge.shingles(t)] for i, s in items.items() if 5 * len(s & own) >= 4 * len(s)}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op6_decontaminate"](spark, SF).collect()} == want


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(t):
    out = []
    for o, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, t):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), o, kind, m.end()))
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_base_spans(spark, tmp_path, docs):
    rng = random.Random(3)
    made = ["".join(rng.choice("01234567890.@-+ ()ab_%é\U0001f600") for _ in range(rng.randrange(120))) for _ in range(300)]
    made += ["4111111111111111 x", "a" * 5000 + "@", "1" * 5000, "a@b.c_x@y.z a@b.c@d.e", "+1" * 50, "1.2.3.4.5.6.7.8 256.1.1.1"]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([t for _, t in docs] + made)]
    path = edge.folder(spark, tmp_path, rows=rows, extra=False)
    for r in QUERIES["op4_pii"](spark, path).collect():
        want = base_spans(rows[r.doc_id][1])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), rows[r.doc_id][1][:200]
        assert set(want) <= set(r.spans.split(",")) or not want
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]


def test_reliabilities_tell_good_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    votes = [(truth if k < 4 else rng.random(4000) < 0.5) ^ (rng.random(4000) < 0.1) for k in range(6)]
    counts = Counter(zip(*[v.astype(int).tolist() for v in votes], strict=True))
    rows = [{"kind": "card", "n": n, **dict(zip(pii.LABELERS, v, strict=True)), **dict.fromkeys(pii.SHAPES, 0)} for v, n in counts.items()]
    posterior = pii.reliabilities(rows)
    decided = [posterior[("card", *map(int, v))] > 0.5 for v in zip(*votes, strict=True)]
    assert np.mean(np.array(decided) == truth) > 0.93
    weights = pii.span_classifier(rows, posterior)
    good = weights["card/pattern/1"] - weights["card/pattern/0"]
    assert good > 3 * abs(weights["card/grouping/1"] - weights["card/grouping/0"])


def test_language_model(spark, docs):
    rows = {r.doc_id: r for r in QUERIES["op5_ppm"](spark, SF).collect()}
    lower = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t)
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs}
    tokens = {d: [*[x for x in re.split("[\x20\x09-\x0d]+", lower(t)) if x], None] for d, t in docs}
    count = Counter(x for d, w in tokens.items() if not held[d] for x in w)
    n, v = sum(count.values()), len(count)
    order = ppm.ORDER
    trie = [defaultdict(Counter) for _ in range(order + 1)]
    padded = {d: bytes(order) + lower(t).encode() + b"\0" for d, t in docs}
    for d, b in padded.items():
        for p in range(order, len(b)) if not held[d] else ():
            for k in range(order + 1):
                trie[k][b[p - k:p]][b[p]] += 1

    def log_p(context, symbol):
        gone, out = set(), 0.0
        for k in range(order, -1, -1):
            seen = trie[k].get(context[order - k:])
            if not seen:
                continue
            left = {s: c for s, c in seen.items() if s not in gone}
            whole = sum(left.values()) + len(left)
            if symbol in left:
                return out + math.log10(left[symbol] / whole)
            if left:
                out += math.log10(len(left) / whole)
            gone |= set(seen)
        return out - math.log10(256 - len(gone))

    for d, w in tokens.items():
        r = rows[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(w), sum(count[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
    for d, b in [x for x in padded.items() if len(x[1]) < 1500][:25]:
        assert rows[d].score == pytest.approx(sum(log_p(b[p - order:p], b[p]) for p in range(order, len(b))), rel=1e-6)
    assert sum(10 ** log_p(b"e the"[:order], s) for s in range(256)) == pytest.approx(1)


def test_codes_find_the_nearest(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in QUERIES["op9_rotated_codes"](spark, SF).collect()}
    assert len(found) == 10 * sum(ids % 100 == 0)
    hits = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((ids, d))[:10]
        hits += len(set(ids[best]) & {found[(ids[q], k)][0] for k in range(1, 11)})
        assert found[(ids[q], 1)][1] == pytest.approx(d[best[0]], rel=1e-12)
    assert hits >= 0.9 * len(found)


def test_tokens_equal_the_library(spark, docs):
    from tokenizers import Tokenizer
    ref = Tokenizer.from_file(bpe.vocabulary_path())
    a = bpe.compiled(bpe.vocabulary_path())
    rng = random.Random(5)
    made = ["".join(rng.choice("aaabcdeth st'\"0159.-_é漢\U0001f600\n\t \x1c\x85　") for _ in range(rng.randrange(150))) for _ in range(1500)]
    for t in [*made, "a" * 3000, "x<|endoftext|>y <|endoftext|>", " " * 700, "\x00\x01  \n\n y", *[t for _, t in docs]]:
        ids = ref.encode(t, add_special_tokens=False).ids
        assert a.encode(t) == ids
        assert a.decode(ids) == ref.decode(ids, skip_special_tokens=False)
    rows = {r.doc_id: r for r in QUERIES["op10_bpe"](spark, SF).collect()}
    for d, t in docs:
        ids = ref.encode(t, add_special_tokens=False).ids
        assert rows[d].n_tokens == len(ids)
        assert rows[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_encode_and_decode_columns(spark):
    df = spark.createDataFrame([(1, "Hello there,  world\n"), (2, None)], "doc_id long, text string")
    back = bpe.decode_ids(bpe.encode_documents(df)).orderBy("doc_id").collect()
    assert [r.decoded for r in back] == ["Hello there,  world\n", ""]


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_steps_are_one(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hilbert.hilbert_index(grid, bits)
    assert sorted(index) == list(range(len(grid)))
    assert np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(1).max() == 1


def test_banding_reaches_its_recall():
    for recall in (0.9, 0.999, 0.9995):
        bands, rows = text.banding(0.8, recall)
        assert 1 - (1 - 0.8 ** rows) ** bands >= recall and bands * rows <= 128


def test_toxicity_held_out(spark):
    """Accuracy on rows whose labels were not learnt from."""
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op1_toxicity"](spark, sf).where("held_out").select("doc_id", "score").collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").collect()}
    rated = sorted((r.score, label[r.doc_id]) for r in rows if r.doc_id in label)
    positive = [i for i, (_, y) in enumerate(rated) if y]
    n, m = len(positive), len(rated) - len(positive)
    area = (sum(positive) - n * (n - 1) / 2) / (n * m)
    assert area > 0.9


def test_training_learns_a_phrase():
    """A filter of width two sees an order of words that no single word tells."""
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(200)]
    import pyarrow as pa
    texts, y = [], []
    for i in range(600):
        t = list(rng.choice(words, 30))
        at = rng.integers(0, 28)
        t[at:at + 2] = ["bad", "thing"] if i % 2 else ["thing", "bad"]
        texts.append(" ".join(t))
        y.append(i % 2)
    ids, first = toxicity.word_ids(pa.array(texts))
    y = np.array(y, np.float32)
    net = toxicity.train([ids[first[i]:first[i + 1]] for i in range(400)], y[:400], epochs=15)
    scores = net.scores(ids, first)[400:]
    assert ((scores > 0.5) == y[400:]).mean() > 0.9
