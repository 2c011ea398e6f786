"""Personal data by weak supervision, in DataFrame functions only.

1. Fixed base patterns give the base spans, wider patterns more candidates.
   Places come from splitting a text at a pattern's matches: the lengths of
   pieces and matches add up to offsets in code points.
2. Six labelers vote on each candidate (1 yes, 0 no, -1 none): the base
   pattern, a checksum or range, a gazetteer (top-level domains, dialling
   codes, issuer prefixes), words of the context, the limits of the span, and
   its grouping. Candidates are counted by kind, votes and shape.
3. Expectation-maximisation on those counts estimates, by kind, each
   labeler's reliability and the posterior of each pattern of votes.
4. A logistic span classifier by kind learns the posteriors from votes and
   shape. Candidates of 0.5 or more that touch no base span are added.

Only the count table reaches the driver; its rows are bounded by the votes and
shapes there are (3^6 * 72 for a kind), whatever the size of the documents.

Defined results: null texts are empty and have no spans; base spans always
stay; repeated rows get equal results. All of a text is read.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import jobs
from shelfwise.operators.lineage import Scratch

KINDS = ("email", "ip", "card", "phone")

# The task's base patterns. A run is entered at its first character or where
# the match before ended (the same matches, without trying each character of
# a long run), and what can't match otherwise is possessive.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![\w.%+-])[\w.%+-]{1,64}+\x20?(?:@|[\[(]at[\])])\x20?[\w-]{1,63}+(?:\x20?(?:\.|[\[(]dot[\])])\x20?[\w-]{2,24}+){1,4}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\x20\.\x20|\.)[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[\x20./_-]?[0-9]){12,18}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])(?:00)?\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,4}){2,4}+(?![0-9A-Za-z])",
}
# What every match of a pattern holds: texts without it are not searched.
NEEDS = {
    "base": {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"},
    "wide": {"email": r"@|[\[(]at[\])]", "ip": r"[0-9](?:\[\.\]|\x20\.\x20|\.)[0-9]", "card": r"[0-9][\x20./_-]?[0-9]",
             "phone": r"[0-9]{2}"},
}

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP_RANGE = rf"^{_PART}(?:\.{_PART}){{3}}$"
TOP_LEVEL = r"(?i)\.(?:com|org|net|edu|gov|int|info|io|dev|app|de|fr|es|uk|eu|it|nl|ch|at|be|us|ca|example|test)$"
DIALLING = r"^(?:\+|00)(?:1|7|20|27|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)"
CONTEXT = {
    "email": r"(?i)(?:mail|contact|kontakt|correo|courriel|write|schreib)",
    "ip": r"(?i)(?:\bip\b|host|server|address|adresse|addr|login)",
    "card": r"(?i)(?:card|karte|carte|tarjeta|visa|credit|payment|iban)",
    "phone": r"(?i)(?:phone|tel|call|fax|mobil|handy|whatsapp|llam)",
}
AGAINST = r"(?i)(?:version|isbn|order|token|hash|serial|commit|sha|key|page|seite|id[:=#])"
GROUPED = {
    "email": r"^[a-z0-9._%+-]+@[a-z0-9.-]+$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})$",
    "phone": r"^\+?[0-9]+(?:[\x20.()-]{1,2}[0-9]{2,})+$",
}
LABELERS = ("pattern", "checked", "gazetteer", "context", "limits", "grouping")

_SPAN = "array<struct<start:int,stop:int,span:string,before:string,after:string>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digit string passes the Luhn check (from the right, every
    second digit doubled)."""
    places = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(places, F.lit(0), lambda acc, i: acc + _luhn_digit(F.substr(digits, -i, F.lit(1)).cast("int"), i))
    return (F.length(digits) > 0) & (total % 10 == 0)


def _luhn_digit(d: Column, i: Column) -> Column:
    twice = d * 2
    return F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)


def _let(value: Column, body) -> Column:
    """body(value) with the value worked out once, also where lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _steps(values: Column) -> Column:
    """Numbers of the blocks of about sqrt(n) places, and their length b."""
    return F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values)))).cast("int")


def _numbers(values: Column, b: Column) -> Column:
    return F.when(F.size(values) > 0, F.sequence(F.lit(0), F.floor((F.size(values) - 1) / b).cast("int"))).otherwise(
        F.array().cast("array<int>"))


def _running(values: Column, merge) -> Column:
    """For each place the sum (by ``merge``, from 0) of all values before it:
    of the blocks before its own, and of its block up to it."""
    total = lambda some: F.aggregate(some, F.lit(0), merge)
    part = lambda v, k, b: F.slice(v, k * b + 1, b)

    def of(s):
        at = lambda i: F.floor(i / s.b).cast("int")
        sums = F.transform(_numbers(s.v, s.b), lambda k: total(part(s.v, k, s.b)))
        heads = lambda t: F.transform(_numbers(s.v, s.b), lambda k: total(F.slice(t, F.lit(1), k)))
        return _let(_let(sums, heads), lambda h: F.transform(s.v, lambda _, i: merge(
            F.get(h, at(i)), total(F.slice(s.v, at(i) * s.b + 1, i - at(i) * s.b)))))
    return _let(F.struct(values.alias("v"), _steps(values).alias("b")), of)


def _blocks(spans: Column) -> Column:
    """Spans in order of start, in blocks with their least start and last stop."""
    def of(s):
        return F.transform(_numbers(s.v, s.b), lambda k: _let(F.slice(s.v, k * s.b + 1, s.b), lambda items: F.struct(
            F.array_min(F.transform(items, lambda o: o.start)).alias("low"),
            F.array_max(F.transform(items, lambda o: o.stop)).alias("high"), items.alias("items"))))
    return _let(F.struct(spans.alias("v"), _steps(spans).alias("b")), of)


def _touched(blocks: Column, x: Column, by=None) -> Column:
    """Whether a span of these blocks (for which ``by`` holds) overlaps x."""
    def near(o):
        touch = (o.start < x.stop) & (x.start < o.stop)
        return touch if by is None else touch & by(o)
    return F.exists(blocks, lambda b: (b.low < x.stop) & (x.start < b.high) & F.exists(b["items"], near))


def _placed(found: Column, pieces: Column) -> Column:
    """Spans of matches that stand between these pieces of a text."""
    lengths = F.zip_with(found, F.slice(pieces, F.lit(1), F.size(found)), lambda m, p: F.length(m) + F.length(p))

    def place(before):
        def one(m, i):
            p = F.get(pieces, i)
            start = F.get(before, i) + F.length(p)
            return F.struct(start.alias("start"), (start + F.length(m)).alias("stop"), m.alias("span"),
                            F.right(p, F.lit(24)).alias("before"), F.left(F.get(pieces, i + 1), F.lit(1)).alias("after"))
        return F.transform(found, one).cast(_SPAN)

    return F.when(F.size(found) > 0, _let(_running(lengths, lambda a, c: a + c), place)).otherwise(F.array().cast(_SPAN))


def _valid(kind: str, span: Column) -> Column:
    """The base pattern's own condition on a match."""
    count = F.length(_digits(span))
    return {
        "email": F.lit(True),
        "ip": span.rlike(IP_RANGE),
        "card": F.when(count.between(14, 19), _luhn(_digits(span))).otherwise(False),
        "phone": count.between(10, 15),
    }[kind]


def _only_valid(kind: str, column: Column) -> Column:
    return F.filter(column, lambda x: _valid(kind, x.span))


def _votes(kind: str, x: Column, base: Column) -> dict[str, Column]:
    span, digits = x.span, _digits(x.span)
    yes = lambda c: F.when(c, 1).otherwise(0)
    checked = {
        "email": span.rlike(r"^[^@]+@[^@]+\.[A-Za-z]{2,}$"),
        "ip": F.regexp_replace(span, r"[^0-9.]", "").rlike(IP_RANGE),
        "card": _luhn(digits),
        "phone": F.length(digits).between(10, 15),
    }[kind]
    known = {"email": span.rlike(TOP_LEVEL), "ip": ~span.rlike(r"^(?:0|255)\."), "card": digits.rlike(ISSUER),
             "phone": span.rlike(DIALLING)}[kind]
    context = (F.when(x.before.rlike(CONTEXT[kind]), 1).when(x.before.rlike(AGAINST), 0).otherwise(-1))
    limits = ~(F.right(x.before, F.lit(1)).rlike(r"[\p{L}0-9]") | x.after.rlike(r"[\p{L}0-9]"))
    return dict(zip(LABELERS, (yes(base), yes(checked), yes(known), context, yes(limits),
                               yes(span.rlike(GROUPED[kind]))), strict=True))


def _shape(x: Column) -> dict[str, Column]:
    digits = F.length(_digits(x.span))
    return {
        "length": F.least(F.floor(F.length(x.span) / 8), F.lit(3)).cast("int"),
        "separators": F.when(x.span.rlike(r"\x20"), 2).when(x.span.rlike(r"[-/_()]"), 1).otherwise(0),
        "digits": F.when(digits == 0, 0).when(digits < F.length(x.span) * 0.6, 1).otherwise(2),
        "opens": F.when(x.before.rlike(r"[:=]\x20?[\"']?$"), 1).otherwise(0),
    }


SHAPES = ("length", "separators", "digits", "opens")


def candidates(docs: DataFrame, text: str = "text", prefix: str = "pii_") -> DataFrame:
    """All rows and columns of docs plus, for each kind, arrays of base spans
    (<prefix>base_<kind>) and of further candidates (<prefix>more_<kind>:
    place, votes and shape)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    own = list(docs.columns)
    p = lambda *names: prefix + "_".join(names)
    none = F.array().cast("array<string>")
    sets = [("base", BASE), ("wide", WIDE)]
    frame = docs.select("*", *[
        F.when(body.rlike(NEEDS[name][k]), F.regexp_extract_all(body, F.lit(patterns[k]), F.lit(0))).otherwise(none)
        .alias(p("found", name, k)) for name, patterns in sets for k in KINDS])
    frame = frame.select("*", *[
        F.when(F.size(p("found", name, k)) > 0, F.split(body, patterns[k], -1)).otherwise(none)
        .alias(p("pieces", name, k)) for name, patterns in sets for k in KINDS])
    # one expression for all kinds: a long one is slow to analyse
    all_ = [(name, k) for name, _ in sets for k in KINDS]
    frame = frame.select(*own, F.transform(F.array(*[
        F.struct(F.col(p("found", *x)).alias("found"), F.col(p("pieces", *x)).alias("pieces")) for x in all_]),
        lambda x: _placed(x.found, x.pieces)).alias(p("placed")))
    at = {x: F.get(p("placed"), F.lit(i)) for i, x in enumerate(all_)}
    frame = frame.select(*own, *[at["wide", k].alias(p("wide", k)) for k in KINDS], *[
        _only_valid(k, at["base", k]).alias(p("base", k)) for k in KINDS])
    frame = frame.select(*own, *[p("base", k) for k in KINDS], F.transform(F.array(*[
        F.struct(F.col(p("base", k)).alias("base"), F.col(p("wide", k)).alias("wide")) for k in KINDS]),
        lambda x: _let(_blocks(x.base), lambda base: F.filter(x.wide, lambda w: ~_touched(base, w)))).alias(p("far")))

    def described(i, k):
        def one(x, base):
            return F.struct(F.lit(k).alias("kind"), x.start.alias("start"), x.stop.alias("stop"), base.alias("base"),
                            *[c.cast("int").alias(n) for n, c in (_votes(k, x, base) | _shape(x)).items()])
        return F.concat(F.transform(p("base", k), lambda x: one(x, F.lit(True))),
                        F.transform(F.get(p("far"), F.lit(i)), lambda x: one(x, F.lit(False))))

    return frame.select(*own, F.concat(*[described(i, k) for i, k in enumerate(KINDS)]).alias(p("spans")))


def reliabilities(counts: list[dict], rounds: int = 200) -> dict[tuple, float]:
    """Posterior of each (kind, votes) by expectation-maximisation on counts
    of patterns: votes are independent given the truth, and abstaining is a
    vote of its own."""
    posterior: dict[tuple, float] = {}
    for kind in KINDS:
        patterns: dict[tuple, int] = defaultdict(int)
        for row in counts:
            if row["kind"] == kind:
                patterns[tuple(row[n] for n in LABELERS)] += row["n"]
        if not patterns:
            continue
        votes = np.array(list(patterns))
        n = np.array(list(patterns.values()), float)
        given = (votes >= 0).sum(1)
        q = ((votes == 1).sum(1) + 0.5) / (given + 1.0)
        for _ in range(rounds):
            log = np.zeros((len(n), 2))
            for y, w in ((1, n * q), (0, n * (1 - q))):
                log[:, y] = math.log((w.sum() + 1) / (n.sum() + 2))
                for j in range(votes.shape[1]):
                    # a weak prior: a labeler is right more often than not
                    share = {v: w[votes[:, j] == v].sum() + (2.0 if v == y else 1.0) for v in (-1, 0, 1)}
                    total = sum(share.values())
                    log[:, y] += np.log(np.vectorize(lambda v: share[v] / total)(votes[:, j]))  # noqa: B023
            new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
            moved = np.abs(new - q).max()
            q = new
            if moved < 1e-9:
                break
        posterior |= {(kind, *map(int, v)): float(p) for v, p in zip(votes, q, strict=True)}
    return posterior


def span_classifier(counts: list[dict], posterior: dict[tuple, float], steps: int = 400, rate: float = 0.5) -> dict[str, float]:
    """Logistic weights, keyed "kind/feature/value" and "kind" for the bias,
    learnt from the posteriors with each pattern weighted by its count."""
    weights: dict[str, float] = {}
    for kind in KINDS:
        rows = [r for r in counts if r["kind"] == kind]
        if not rows:
            continue
        names = sorted({(f, r[f]) for r in rows for f in LABELERS + SHAPES})
        x = np.array([[float(r[f] == v) for f, v in names] for r in rows])
        y = np.array([posterior[(kind, *(r[n] for n in LABELERS))] for r in rows])
        n = np.sqrt(np.array([r["n"] for r in rows], float))
        n /= n.sum()
        w, b = np.zeros(len(names)), 0.0
        for _ in range(steps):
            g = n * (1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50))) - y)
            w -= rate * (x.T @ g + 1e-4 * w)
            b -= rate * g.sum()
        weights |= {f"{kind}/{f}/{v}": float(k) for (f, v), k in zip(names, w, strict=True)} | {kind: float(b)}
    return weights


def fit(found: DataFrame, column: str = "pii_spans") -> dict[str, float]:
    """Weights of the span classifier from all candidates found."""
    counts = [r.asDict() for r in found.select(F.explode(column).alias("x")).select("x.*")
              .groupBy("kind", *LABELERS, *SHAPES).agg(F.count("*").alias("n"))
              .orderBy("kind", *LABELERS, *SHAPES).collect()]
    return span_classifier(counts, reliabilities(counts))


def accepted(weights: dict[str, float], column: str = "pii_spans") -> Column:
    """The spans that count, in order of start and kind: all base ones, and
    candidates of probability 0.5 or more that touch neither a base span nor a
    better candidate."""
    if not weights:
        return F.array().cast("array<struct<start:int,order:int,stop:int,base:boolean,logit:double,kind:string>>")
    table = F.create_map(*[F.lit(v) for pair in sorted(weights.items()) for v in pair])

    def logit(x):
        parts = [F.coalesce(F.element_at(table, F.concat(x.kind, F.lit(f"/{f}/"), x[f].cast("string"))), F.lit(0.0))
                 for f in LABELERS + SHAPES]
        return sum(parts, F.coalesce(F.element_at(table, x.kind), F.lit(0.0)))

    order = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    rated = F.transform(column, lambda x: F.struct(
        x.start.alias("start"), F.element_at(order, x.kind).alias("order"), x.stop.alias("stop"), x.base.alias("base"),
        F.when(x.base, F.lit(0.0)).otherwise(logit(x)).alias("logit"), x.kind.alias("kind")))
    return F.array_sort(F.filter(rated, lambda x: x.base | (x.logit >= 0)))


def settle(found: DataFrame, weights: dict[str, float], column: str = "pii_spans", out: str = "pii_all") -> DataFrame:
    """Column ``out`` for ``column``: the accepted spans."""
    frame = found.withColumn(out, accepted(weights, column))
    if not weights:
        return frame.drop(column)
    better = lambda x: lambda o: o.base | (o.logit > x.logit) | ((o.logit == x.logit) & (o.order < x.order))
    return frame.withColumn(out, _let(_blocks(F.col(out)), lambda all_: F.filter(
        out, lambda x: x.base | ~_touched(all_, x, better(x))))).drop(column)


def written(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x.kind, x.start.cast("string"), x.stop.cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets (of
    spans that overlap, the first covers and the rest is cut with it). A text
    of many spans is cut into about as many parts as the root of their number
    and each part written by itself, so that no span is sought from the text's
    beginning."""
    before = _running(F.transform(spans, lambda x: x.stop), lambda a, c: F.greatest(a, c))
    clear = _let(before, lambda b: F.filter(F.transform(spans, lambda x, i: F.struct(
        F.greatest(x.start, F.get(b, i)).alias("start"), x.stop.alias("stop"), x.kind.alias("kind"))), lambda x: x.start < x.stop))

    def of(s):
        size = F.greatest(F.lit(1), F.ceil(F.length(s.text) / F.ceil(F.sqrt(F.greatest(F.lit(1), F.size(s.spans)))))).cast("int")

        def part(k):
            low, high = k * size, (k + 1) * size
            mine = F.filter(s.spans, lambda x: (x.start < high) & (low < x.stop))

            def written_part(p):
                after = lambda i: F.greatest(low, F.coalesce(F.get(p.mine, i).stop, low))
                pieces = F.transform(p.mine, lambda x, i: F.concat(
                    F.substring(p.text, after(i - 1) - low + 1, F.greatest(F.lit(0), x.start - after(i - 1))),
                    F.when(x.start >= low, F.concat(F.lit("<"), x.kind, F.lit(">"))).otherwise(F.lit(""))))
                end = after(F.size(p.mine) - 1)
                return F.concat(F.array_join(pieces, ""), F.substring(p.text, end - low + 1, F.greatest(F.lit(0), high - end)))
            return _let(F.struct(mine.alias("mine"), F.substring(s.text, low + 1, size).alias("text")), written_part)
        return F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.length(s.text) - 1) / size).cast("int")), part), "")

    whole = F.coalesce(text, F.lit(""))
    return F.when(F.length(whole) == 0, whole).otherwise(_let(F.struct(whole.alias("text"), clear.alias("spans")), of))


def base_count(kind: str) -> Column:
    return F.size(F.filter("pii_all", lambda x: x.base & (x.kind == kind))).cast("long")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of base spans, their digest, and all spans of every document."""
    jobs.prepare(spark)
    scratch = Scratch(spark, "pii")
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
        found = scratch.cut(candidates(docs).drop("text"))
        spans = settle(found, fit(found))
        base = F.filter("pii_all", lambda x: x.base)
        return jobs.finish(spans.select(
            "doc_id",
            *[base_count(k).alias(f"n_{k}") for k in KINDS],
            F.sha2(written(base), 256).alias("base_sha256"), written(F.col("pii_all")).alias("spans"),
            F.size("pii_all").cast("long").alias("n_spans")), scratch)
    finally:
        scratch.close()
