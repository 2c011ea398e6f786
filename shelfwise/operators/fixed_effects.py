"""Fixed-effects OLS with cluster-robust / HC1 errors as Spark jobs.

Covers G1 (pooled OLS: group means alone), G2-G7 (three-way absorbed effects),
G3 (per-SKU fits: the SKU joins ``by``), G8 (C(x) effects are absorbed, never
one-hot), G10-G13. Several models of one panel can share one absorption.

Plan:
1. ``base``: y and the expanded regressors (interactions are products
   taken before demeaning) with the group, effect and cluster keys, cached.
   Rows with a NULL in y, a regressor or any key are left out, as a formula
   interface does.
2. Absorb the effects by conjugate gradients on the normal equations of the
   effect dummies, D'D e = D'v, for all value columns at once. D is never
   built. D'D holds the row counts of levels and of pairs of levels: two
   grouped counts of the panel. Where every group has at most MAX_PAIRS pairs
   (counted, some 40 MB), a group's system is solved in one task on these
   counts. Beyond that the panel itself is the matrix. The key with most
   levels is eliminated (its effects are the means of what the others leave):
   the rows are dealt out by it once, so a step takes deviations from its
   level means without a shuffle, and only the other keys' levels are joined
   to the rows, added up by level in one grouped aggregate and written. Level
   tables are shuffled to each piece of the rows, not broadcast: nothing that
   grows with the levels passes the driver. Groups go by a number, so that the
   tables of a row per group that a step broadcasts are small there too. A key
   of which one level has over MAX_LEVEL_ROWS rows is not eliminated. The two
   inner products of a step are one aggregate. Either way it stops when the
   remaining level means are negligible and raises if that is not reached. A
   single key needs no steps: its effects are its means.
3. Moments of the demeaned columns per group: one aggregate, K(K+3)/2 sums
   (of the columns of all models together).
4. Solve per group and model (numpy under mapInPandas on the moment table: one
   row per group, so it scales with the number of groups, not rows).
5. Scores: residuals from the broadcast coefficients, summed per
   (group, cluster), then outer products summed per group, all models in one
   pass; the sandwich is again a per-group numpy step.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import formula as FM
from shelfwise.functions.stats import Z_CRIT_95, select_identified, sym_from_upper, two_sided_p
from shelfwise.operators import lineage
from shelfwise.operators.joins import row_bound

DEFAULT_ABSORB = ("product_id", "store_id", "week")

#: Pairs of levels of a group up to which its effects are solved in one task.
MAX_PAIRS = 1_000_000

#: Rows of one level up to which its key may be eliminated: they meet in one task.
MAX_LEVEL_ROWS = 1_000_000

#: Rows of a piece of the panel dealt out by the eliminated key. Each piece is
#: sent, and sends, a value for every level of the other keys: few send less.
ROWS_A_TASK = 6_000_000

#: Bytes of a level table up to which a step broadcasts it. None: under a key of
#: two columns each broadcast takes a page of the driver's memory (up to 64 MB),
#: however few its rows, and a step would take one more for every key.
SMALL_LEVELS_BYTES = 0


@dataclass
class Model:
    formula: str
    absorb: tuple = DEFAULT_ABSORB
    by: tuple = ("product_category",)
    cluster: str | None = "product_id"
    cov: str = "cluster"              # 'cluster' or 'hc1'
    tol: float = 1e-12                # remaining level means, relative to the values
    max_steps: int = 2000             # safety bound: beyond it the fit raises
    check_every: int = 1              # steps between convergence checks
    categorical: dict = field(default_factory=dict)
    connected: bool = True            # HC1 rank: count components (two-way) when False


class NotConverged(RuntimeError):
    """The absorbed effects did not settle within ``max_steps``."""


def _bc(df: DataFrame, n_rows: int | None) -> DataFrame:
    """Broadcast an effect/coefficient table whose row count is known and
    within the row and byte budget; otherwise leave the join to the planner
    (sort-merge, with AQE splitting hot keys)."""
    return F.broadcast(df) if n_rows is not None and n_rows <= row_bound(df) else df


@contextmanager
def _pieces_kept(spark: SparkSession):
    """In this block rows that were dealt out by piece are joined by piece and
    level as they lie."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _piece_ids(spark: SparkSession, n: int) -> list[int]:
    """n numbers that a shuffle to n partitions deals one to each."""
    part = F.pmod(F.hash("id"), F.lit(n))
    found = spark.range(40 * n).select(F.col("id").cast("int").alias("id")).groupBy(part.alias("part")).agg(F.min("id").alias("id"))
    ids = {r["part"]: r["id"] for r in found.collect()}
    return [ids[i] for i in range(n) if i in ids]


def _dealt(base: DataFrame, on: list, n: int) -> tuple[DataFrame, list[int]]:
    """The rows in n pieces (``_piece``) by these keys, sorted by them, cached."""
    ids = _piece_ids(base.sparkSession, n)
    piece = F.element_at(F.array(*[F.lit(i) for i in ids]), F.pmod(F.hash(*on), F.lit(len(ids))) + 1)
    rows = base.withColumn("_piece", piece).repartition(len(ids), "_piece").sortWithinPartitions("_piece", *on)
    return rows.persist(StorageLevel.MEMORY_AND_DISK), ids


def _meet(rows: DataFrame, table: DataFrame, on: list, n_rows: int | None, pieces: tuple | list) -> DataFrame:
    """Rows with their level's row of the table, which is shuffled to each
    piece (broadcast within SMALL_LEVELS_BYTES); without pieces as ``_bc`` does."""
    small = SMALL_LEVELS_BYTES and n_rows is not None and n_rows <= row_bound(table, max_bytes=SMALL_LEVELS_BYTES)
    if not pieces or small:
        return rows.join(_bc(table, n_rows), on)
    each = F.explode(F.array(*[F.lit(i) for i in pieces])).alias("_piece")
    return rows.join(table.select("*", each).repartition(len(pieces), "_piece").hint("shuffle_hash"), ["_piece", *on])


def _unique(cols):
    return list(dict.fromkeys(c for c in cols if c))


def prepare(panel: DataFrame, models: list[Model]):
    """(names of all regressors, each model's places among them, keys, rows).
    A row takes part if any model can use it; ``_all`` tells that all can."""
    first = models[0]
    if any((m.by, m.absorb, m.cluster, m.cov, m.connected) != (first.by, first.absorb, first.cluster, first.cov, first.connected)
           for m in models):
        raise ValueError("models of one absorption share groups, effects, clusters and errors")
    by, absorb = list(first.by), list(first.absorb)
    keys = absorb if absorb else ["_const"]
    columns, places, usable = {}, [], []
    specs = [FM.parse(m.formula, m.categorical) for m in models]
    if len({spec.y for spec in specs}) > 1:
        raise ValueError("models of one absorption have one y")
    y = F.col(specs[0].y).cast("double")
    for spec in specs:
        design = FM.design_columns(spec)
        for name, c in design:
            columns.setdefault(name, c)
        places.append([list(columns).index(name) + 1 for name, _ in design])
    vals = [y.alias("_v0"), *[c.alias(f"_v{i + 1}") for i, c in enumerate(columns.values())]]
    data = panel.select(*[F.col(c) for c in _unique(by + absorb + [first.cluster])], *vals)
    if not absorb:
        data = data.withColumn("_const", F.lit(0))
    known = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    for own in places:
        usable.append(reduce(lambda a, b: a & b, [known(f"_v{i}") for i in [0, *own]]))
    keyed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in _unique(by + keys + [first.cluster])])
    data = data.filter(keyed & reduce(lambda a, b: a | b, usable)).withColumn("_all", reduce(lambda a, b: a & b, usable))
    return list(columns), places, keys, data


def _numbered(data: DataFrame, by: list, used: list, scratch: lineage.Scratch) -> tuple[DataFrame, DataFrame]:
    """The rows with a number ``_g`` for their group in place of ``by``, and the
    groups with theirs. One long key makes a broadcast table of a row per group
    1 MB; text or several columns take a page (up to 64 MB) each time. The
    number is a hash under the first seed that tells all groups apart."""
    groups, seed = scratch.cut(data.select(*by).distinct()), 0
    number = lambda seed: F.xxhash64(F.lit(seed), *by)
    while True:
        found, told = groups.agg(F.count(F.lit(1)), F.count_distinct(number(seed))).first()
        if found == told:
            break
        seed += 1
    rows = data.withColumn("_g", number(seed)).drop(*[c for c in by if c not in used])
    return rows, groups.withColumn("_g", number(seed))


def _level_type(base: DataFrame, keys: list) -> str:
    kinds = {f.name: f.dataType for f in base.schema.fields}
    return "long" if all(isinstance(kinds[k], T.IntegralType) for k in keys) else "string"


def _by_level(rows: DataFrame, by: list, keys: list, kind: str, sums: list, without: str | None = None) -> DataFrame:
    """Sums over rows by group, key (its index, ``_k``) and level (``_l``)."""
    each = F.explode(F.array(*[F.struct(F.lit(j).alias("_k"), F.col(k).cast(kind).alias("_l"))
                               for j, k in enumerate(keys) if k != without]))
    return rows.withColumn("_kl", each).select("*", "_kl._k", "_kl._l").groupBy(*by, "_k", "_l").agg(*sums)


def _of_key(vec: DataFrame, by: list, keys: list, j: int, cols: dict, base: DataFrame) -> DataFrame:
    """Columns of key j's level rows, under the key's own name and type."""
    kind = next(f.dataType for f in base.schema.fields if f.name == keys[j])
    return vec.filter(F.col("_k") == j).select(*by, F.col("_l").cast(kind).alias(keys[j]),
                                               *[F.col(c).alias(n) for c, n in cols.items()])


def _deviations(rows: DataFrame, by: list, inner: str | None, names: list) -> DataFrame:
    """These columns less their means over the levels of the eliminated key."""
    if inner is None:
        return rows
    level = Window.partitionBy(*[c for c in rows.columns if c == "_piece"], *by, inner)
    return rows.withColumns({c: F.col(c) - F.avg(c).over(level) for c in names})


@dataclass
class Absorbed:
    """Effect tables by key (of all keys but ``inner``, the eliminated one),
    the rows they belong to and their pieces, level counts by key, and the
    steps taken."""
    rows: DataFrame
    effects: dict
    sizes: dict
    levels: DataFrame
    steps: int
    inner: str | None = None
    pieces: tuple | list = ()


def absorb_effects(base: DataFrame, by: list, keys: list, n_vals: int, model: "Model",
                   scratch: lineage.Scratch, held: list, max_pairs: int | None = None) -> Absorbed:
    """Effects of every key for every value column. What it caches is added
    to ``held``."""
    kind, vals, inner, rows, pieces = _level_type(base, keys), range(n_vals), None, base, ()
    bound = MAX_PAIRS if max_pairs is None else max_pairs
    count = F.count(F.lit(1)).alias("_n")
    sums = [F.sum(f"_v{i}").alias(f"_r{i}") for i in vals]

    def sized(levels: DataFrame) -> dict:
        return {keys[r["_k"]]: r for r in levels.groupBy("_k").agg(
            F.count(F.lit(1)).alias("levels"), F.max("_n").alias("most"), F.sum("_n").alias("rows")).collect()}

    pairs = None
    if len(keys) == 1 or _may_fit(base, by, keys, bound):
        levels = scratch.cut(_by_level(base, by, keys, kind, [
            count, *sums, *[F.sum(F.col(f"_v{i}") * F.col(f"_v{i}")).alias(f"_ss{i}") for i in vals]]))
        found = sized(levels)
        if len(keys) > 1 and found:
            pairs = scratch.cut(_pair_counts(base, by, keys, kind))
            if pairs.groupBy(*by).count().agg(F.max("count")).first()[0] > bound:
                pairs = None
    else:
        levels = scratch.cut(_by_level(base, by, keys, kind, [count]))
        found = sized(levels)
    sizes = {k: r["levels"] for k, r in found.items()}
    if len(keys) == 1 or not sizes:
        vec, steps = levels.select(*by, "_k", "_l", *[(F.col(f"_r{i}") / F.col("_n")).alias(f"_x{i}") for i in vals]), 0
    else:
        if pairs is not None:
            vec, worst, steps = _solved_by_group(levels, pairs, by, kind, n_vals, model, scratch)
        else:
            inner = max((k for k in keys if found[k]["most"] <= MAX_LEVEL_ROWS), key=sizes.get, default=None)
            if inner is not None:
                tasks = max(base.sparkSession.sparkContext.defaultParallelism, -(-found[inner]["rows"] // ROWS_A_TASK))
                rows, pieces = _dealt(base, [*by, inner], tasks)
                held.append(rows)
                rows.count()           # how they lie is known to later plans
            left = _deviations(rows, by, inner, [f"_v{i}" for i in vals])
            start = scratch.cut(_by_level(left, by, keys, kind, [count, *sums], inner))
            vec, worst, steps = _stepped(rows, start, by, keys, kind, n_vals, model, sizes, scratch, inner, pieces)
        if worst > model.tol:
            raise NotConverged(f"effects of {keys}: remaining level means {worst:.3g} after {steps} steps")
    effects = {k: _of_key(vec, by, keys, j, {f"_x{i}": f"_e{j}_{i}" for i in vals}, base)
               for j, k in enumerate(keys) if k != inner}
    return Absorbed(rows, effects, {k: sizes.get(k, 0) for k in keys}, levels.select(*by, "_k"), steps, inner, pieces)


def _may_fit(base: DataFrame, by: list, keys: list, bound: int) -> bool:
    """Whether the groups may have no more pairs than the bound, by estimated
    counts (some 2 %): spares counting the pairs of a panel far beyond it."""
    pairs = [(keys[i], keys[j]) for i in range(len(keys)) for j in range(i + 1, len(keys))]
    about = reduce(lambda a, b: a + b, [F.approx_count_distinct(F.struct(*p), 0.02) for p in pairs])
    return (base.groupBy(*by).agg(about.alias("_about")).agg(F.max("_about")).first()[0] or 0) <= 1.2 * bound


def _pair_counts(base: DataFrame, by: list, keys: list, kind: str) -> DataFrame:
    """Rows of every pair of levels of different keys: the part of D'D that
    is off its diagonal."""
    pairs = F.explode(F.array(*[F.struct(
        F.lit(i).alias("_k"), F.col(keys[i]).cast(kind).alias("_l"), F.lit(j).alias("_k2"), F.col(keys[j]).cast(kind).alias("_l2"))
        for i in range(len(keys)) for j in range(i + 1, len(keys))]))
    return base.select(*by, pairs.alias("_p")).select(*by, "_p.*").groupBy(*by, "_k", "_l", "_k2", "_l2").agg(
        F.count(F.lit(1)).alias("_c"))


def _conjugate_gradients(n, rhs, scale, first, second, count, tol: float, max_steps: int):
    """(solution, what is left, steps) of the level equations of one group."""
    x, r = np.zeros_like(rhs), rhs.copy()
    z = r / n[:, None]
    p, rz = z.copy(), (r * z).sum(0)
    left = lambda: float(np.sqrt(np.divide(rz, scale, out=np.zeros_like(rz), where=scale > 0)).max(initial=0.0))
    steps = 0
    while left() > tol and steps < max_steps:
        ap = n[:, None] * p
        for i in range(p.shape[1]):
            ap[:, i] += np.bincount(first, count * p[second, i], len(n)) + np.bincount(second, count * p[first, i], len(n))
        q = (p * ap).sum(0)
        # a column that has settled stays: what is left of it is rounding
        go = (q > 0) & (rz > (0.1 * tol) ** 2 * scale)
        step = np.divide(rz, q, out=np.zeros_like(rz), where=go)
        x += step * p
        r -= step * ap
        z = r / n[:, None]
        new = (r * z).sum(0)
        p = z + np.divide(new, rz, out=np.zeros_like(rz), where=rz > 0) * p
        rz = new
        steps += 1
    return x, left(), steps


def _solved_by_group(start: DataFrame, pairs: DataFrame, by: list, kind: str, n_vals: int, model: "Model",
                     scratch: lineage.Scratch):
    """Level effects of each group from its counts alone; a group's levels
    and pairs meet in one task, their number bounded by the caller."""
    tol, max_steps = model.tol, model.max_steps

    def solve(levels: pa.Table, counts: pa.Table) -> pa.Table:
        of = lambda t, name: t.column(name).to_numpy()
        names = pa.chunked_array([c for t, n in ((levels, "_l"), (counts, "_l"), (counts, "_l2")) for c in t.column(n).chunks],
                                 levels.column("_l").type)
        code = names.combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        width = int(code.max()) + 1
        rows, some = levels.num_rows, counts.num_rows
        own = of(levels, "_k") * width + code[:rows]
        order = np.argsort(own)
        place = lambda k, c: order[np.searchsorted(own[order], k * width + c)]
        first = place(of(counts, "_k"), code[rows:rows + some])
        second = place(of(counts, "_k2"), code[rows + some:])
        rhs = np.stack([of(levels, f"_r{i}") for i in range(n_vals)], 1).astype(float)
        # sums of squares of a group: those of any one key's levels
        scale = np.stack([of(levels, f"_ss{i}") for i in range(n_vals)], 1)[of(levels, "_k") == 0].sum(0)
        x, left, steps = _conjugate_gradients(of(levels, "_n").astype(float), rhs, scale, first, second,
                                              of(counts, "_c").astype(float), tol, max_steps)
        out = levels.select([*by, "_k", "_l"])
        for i in range(n_vals):
            out = out.append_column(f"_x{i}", pa.array(x[:, i]))
        return out.append_column("_left", pa.array(np.full(rows, left))).append_column("_steps", pa.array(np.full(rows, steps)))

    group = by or ["_group"]
    if not by:
        start, pairs = start.withColumn("_group", F.lit(0)), pairs.withColumn("_group", F.lit(0))
    head = T.StructType([f for f in start.schema.fields if f.name in by])
    schema = T.StructType([*head.fields, T.StructField("_k", T.IntegerType()), start.schema["_l"],
                           *[T.StructField(f"_x{i}", T.DoubleType()) for i in range(n_vals)],
                           T.StructField("_left", T.DoubleType()), T.StructField("_steps", T.LongType())])
    vec = scratch.cut(start.groupBy(*group).cogroup(pairs.groupBy(*group)).applyInArrow(solve, schema))
    worst, steps = vec.agg(F.max("_left"), F.max("_steps")).first()
    return vec, worst or 0.0, steps or 0


def _stepped(base: DataFrame, start: DataFrame, by: list, keys: list, kind: str, n_vals: int, model: "Model", sizes: dict,
             scratch: lineage.Scratch, inner: str | None = None, pieces: tuple | list = ()):
    """The same by steps over the panel, without the effects of ``inner``. The
    inner products that a step needs are sums over its one written table (both
    at once, the search direction's image being carried along), taken up when
    the next step reads it. What is left is read off that table too, before
    the next step goes over the panel."""
    vals, outer, zero, own = range(n_vals), [k for k in keys if k != inner], F.lit(0.0), ["_piece"] if pieces else []
    scale = scratch.cut(base.groupBy(*by).agg(*[F.sum(F.col(f"_v{i}") * F.col(f"_v{i}")).alias(f"_ss{i}") for i in vals]))
    n_groups = scale.count()

    def beside(vec: DataFrame, table: DataFrame) -> DataFrame:
        return vec.join(_bc(table, n_groups), by) if by else vec.crossJoin(F.broadcast(table))

    height = [F.sum(F.col(f"_r{i}") * F.col(f"_r{i}") / F.col("_n")).alias(f"_h{i}") for i in vals]
    vec = beside(start, scale).select("*", *[zero.alias(f"_{c}{i}") for i in vals for c in ("x", "p", "s", "g", "a")])
    steps, worst = 0, float("inf")
    while True:
        if steps % model.check_every == 0 or steps >= model.max_steps:
            worst = vec.groupBy(*by).agg(*height, *[F.max(f"_ss{i}").alias(f"_ss{i}") for i in vals]).agg(F.max(F.greatest(zero, *[
                F.when(F.col(f"_ss{i}") > 0, F.sqrt(F.col(f"_h{i}") / F.col(f"_ss{i}"))).otherwise(0.0)
                for i in vals]))).first()[0]
            if worst <= model.tol or steps >= model.max_steps:
                return scratch.cut(vec.select(*by, "_k", "_l", *[f"_x{i}" for i in vals])), worst, steps
        rows = base.select(*own, *by, *keys)
        for k in outer:
            j, mean = keys.index(k), vec.select("*", *[(F.col(f"_r{i}") / F.col("_n")).alias(f"_u{i}") for i in vals])
            rows = _meet(rows, _of_key(mean, by, keys, j, {f"_u{i}": f"_u{j}_{i}" for i in vals}, base), by + [k], sizes.get(k), pieces)
        total = [reduce(lambda a, b: a + b, [F.col(f"_u{keys.index(k)}_{i}") for k in outer]) for i in vals]
        rows = rows.select(*own, *by, *keys, *[t.alias(f"_t{i}") for i, t in zip(vals, total)])
        moved = _by_level(_deviations(rows, by, inner, [f"_t{i}" for i in vals]),
                          by, keys, kind, [F.sum(f"_t{i}").alias(f"_w{i}") for i in vals], inner)
        new = scratch.cut(vec.join(moved.hint("merge"), by + ["_k", "_l"]))
        products = new.groupBy(*by).agg(
            *height, *[F.sum(F.col(f"_w{i}") * F.col(f"_r{i}") / F.col("_n")).alias(f"_d{i}") for i in vals])
        steps += 1
        carried, turned = [*by, "_k", "_l", "_n", *[f"_ss{i}" for i in vals]], []
        for i in vals:
            x, r, p, s, g, a, w, h, d = (F.col(f"_{c}{i}") for c in "xrpsgawhd")
            go = h > (0.1 * model.tol) ** 2 * F.col(f"_ss{i}")
            beta = F.when(go & (g > 0), h / g).otherwise(0.0)
            bottom = d - F.when(a > 0, beta * h / a).otherwise(0.0)
            step = F.when(go & (bottom > 0), h / bottom).otherwise(0.0)
            turned += [x.alias(f"_x{i}"), r.alias(f"_r{i}"), (r / F.col("_n") + beta * p).alias(f"_p{i}"),
                       (w + beta * s).alias(f"_s{i}"), h.alias(f"_g{i}"), step.alias(f"_a{i}")]
        vec = beside(new, products).select(*carried, *turned)
        vec = vec.select(*carried, *[c for i in vals for c in (
            (F.col(f"_x{i}") + F.col(f"_a{i}") * F.col(f"_p{i}")).alias(f"_x{i}"),
            (F.col(f"_r{i}") - F.col(f"_a{i}") * F.col(f"_s{i}")).alias(f"_r{i}"),
            *[F.col(f"_{c}{i}") for c in "psga"])])


def demeaned(found: Absorbed, by: list, keys: list, n_vals: int, extra: list) -> DataFrame:
    d, names = found.rows, [f"_t{i}" for i in range(n_vals)]
    for k in found.effects:
        d = _meet(d, found.effects[k], by + [k], found.sizes[k], found.pieces)
    tilde = []
    for i in range(n_vals):
        e = F.col(f"_v{i}")
        for k in found.effects:
            e = e - F.col(f"_e{keys.index(k)}_{i}")
        tilde.append(e.alias(names[i]))
    raw = [F.col(f"_v{i}") for i in range(n_vals)]
    own = _unique(by + extra)
    d = d.select(*[F.col(c) for c in _unique([*own, found.inner, "_piece" if found.pieces else None])], *raw, *tilde)
    return _deviations(d, by, found.inner, names).select(*own, *[f"_v{i}" for i in range(n_vals)], *names)


def _moments(d: DataFrame, by: list, n_vals: int) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("_v0").alias("sy"),
            F.sum(F.col("_v0") * F.col("_v0")).alias("syy")]
    for i in range(n_vals):
        for j in range(i, n_vals):
            aggs.append(F.sum(F.col(f"_t{i}") * F.col(f"_t{j}")).alias(f"m_{i}_{j}"))
    for i in range(1, n_vals):
        aggs.append(F.sum(f"_v{i}").alias(f"s_{i}"))
        aggs.append(F.sum(F.col(f"_v{i}") * F.col(f"_v{i}")).alias(f"ss_{i}"))
    return d.groupBy(*by).agg(*aggs)


def _solve_fn(places: list, by: list, n_vals: int):
    """Coefficients of the regressors at these places of the moment table."""
    k = len(places)
    take = [0, *places]

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                m = sym_from_upper(r, n_vals, "m")[np.ix_(take, take)]
                a, b = m[1:, 1:], m[1:, 0]
                n = r["n"]
                raw_ss = np.array([r[f"ss_{i}"] - r[f"s_{i}"] ** 2 / n for i in places])
                kept = select_identified(a, raw_ss)
                beta = np.full(k, np.nan)
                ainv = np.zeros((k, k))
                if kept:
                    sub = np.linalg.inv(a[np.ix_(kept, kept)])
                    ainv[np.ix_(kept, kept)] = sub
                    beta[kept] = sub @ b[kept]
                row = {c: r[c] for c in by}
                row.update({f"b_{i}": float(beta[i]) for i in range(k)})
                row.update({f"ai_{i}_{j}": float(ainv[i, j]) for i in range(k) for j in range(k)})
                row.update({"n": int(n), "rank_x": len(kept),
                            "sst": float(r["syy"] - r["sy"] ** 2 / n)})
                out.append(row)
            yield pd.DataFrame(out, columns=[*by, *[f"b_{i}" for i in range(k)],
                                             *[f"ai_{i}_{j}" for i in range(k) for j in range(k)],
                                             "n", "rank_x", "sst"])
    return run


def _sandwich_fn(model: Model, names: list, by: list, n_fe: list):
    k = len(names)

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                ainv = np.array([[r[f"ai_{i}_{j}"] for j in range(k)] for i in range(k)])
                meat = sym_from_upper(r, k, "mt")
                n = r["n"]
                levels = [int(r[f"lv_{j}"]) for j in range(len(n_fe))]
                if model.absorb:
                    k_full = 1 + k + sum(lv - 1 for lv in levels)
                    if len(levels) == 2:
                        rank_fe = levels[0] + levels[1] - int(r["comps"])
                    else:
                        rank_fe = 1 + sum(lv - 1 for lv in levels)
                else:
                    k_full, rank_fe = 1 + k, 1
                # no error where clusters or degrees of freedom do not suffice
                g, free = r["n_clusters"], n - (k_full if model.cov == "cluster" else rank_fe + r["rank_x"])
                if free <= 0 or (model.cov == "cluster" and g < 2):
                    v = np.full((k, k), np.nan)
                elif model.cov == "cluster":
                    v = ainv @ meat @ ainv * (g / (g - 1.0)) * ((n - 1.0) / free)
                else:
                    v = ainv @ meat @ ainv * (n / free)
                r2 = 1.0 - r["ssr"] / r["sst"] if r["sst"] > 0 else float("nan")
                for i, name in enumerate(names):
                    b = r[f"b_{i}"]
                    if b is None or np.isnan(b):
                        continue
                    se = float(np.sqrt(v[i, i])) if v[i, i] > 0 else float("nan")
                    z = b / se if se and se > 0 else float("nan")
                    row = {c: r[c] for c in by}
                    known = np.isfinite(se)
                    row.update(term=name, term_index=i, coef=float(b), se=se if known else None,
                               z=float(z) if known else None,
                               p_value=two_sided_p(z) if known else None,
                               significant=bool(abs(z) > Z_CRIT_95) if known else None,
                               ci_low=float(b - Z_CRIT_95 * se) if known else None,
                               ci_high=float(b + Z_CRIT_95 * se) if known else None,
                               n_obs=int(n), n_params=int(k_full),
                               n_clusters=(int(r["n_clusters"]) if model.cov == "cluster" else None),
                               r2=float(r2))
                    out.append(row)
            yield pd.DataFrame(out, columns=[*by, *RESULT_COLS]).astype({"significant": object})
    return run


RESULT_COLS = ["term", "term_index", "coef", "se", "z", "p_value", "significant", "ci_low",
               "ci_high", "n_obs", "n_params", "n_clusters", "r2"]
RESULT_TYPES = [T.StringType(), T.IntegerType(), T.DoubleType(), T.DoubleType(), T.DoubleType(),
                T.DoubleType(), T.BooleanType(), T.DoubleType(), T.DoubleType(), T.LongType(),
                T.LongType(), T.LongType(), T.DoubleType()]


def fit(panel: DataFrame, model: Model) -> DataFrame:
    """Fit ``model`` per group of ``model.by``; returns the coefficient table
    (one row per group x identified term). The fit runs when called; the
    small result is read from the checkpoint folder. A group without the
    clusters or degrees of freedom for errors has them NULL."""
    return fit_all(panel, {"": model})[""]


def fit_all(panel: DataFrame, models: dict[str, Model]) -> dict[str, DataFrame]:
    """Fits of several models on one panel, by name. Models of the same y,
    groups, effects, clusters and errors share one absorption if they use the
    same rows; else each is fitted by itself."""
    names, places, keys, data = prepare(panel, list(models.values()))
    scratch = lineage.Scratch(panel.sparkSession, "fe")
    held = [data.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        if len(models) > 1 and not data.filter("not _all").isEmpty():
            return {name: fit(panel, m) for name, m in models.items()}
        with _pieces_kept(panel.sparkSession):
            return dict(zip(models, _fit(data, list(models.values()), names, places, keys, scratch, held), strict=True))
    finally:
        for df in held:
            df.unpersist()
        scratch.close()


def _fit(base: DataFrame, models: list, names: list, places: list, keys: list, scratch: lineage.Scratch, held: list) -> list:
    model = models[0]
    by, groups = list(model.by), None
    nv = len(names) + 1
    if by:
        base, groups = _numbered(base, by, [*keys, model.cluster], scratch)
        by = ["_g"]
    key_schema = [f for f in base.schema.fields if f.name in by]
    found = absorb_effects(base, by, keys, nv, model, scratch, held)
    d = demeaned(found, by, keys, nv, [model.cluster]).persist(StorageLevel.MEMORY_AND_DISK)
    held.append(d)
    moments = scratch.cut(_moments(d, by, nv))
    n_groups = moments.count()
    coefs = []
    for own in places:
        k = len(own)
        schema = T.StructType(
            key_schema + [T.StructField(f"b_{i}", T.DoubleType()) for i in range(k)]
            + [T.StructField(f"ai_{i}_{j}", T.DoubleType()) for i in range(k) for j in range(k)]
            + [T.StructField("n", T.LongType()), T.StructField("rank_x", T.LongType()),
               T.StructField("sst", T.DoubleType())])
        coefs.append(scratch.cut(moments.mapInPandas(_solve_fn(own, by, nv), schema)))

    # Scores and meat, of all models in one pass.
    r = d
    for m, (own, coef) in enumerate(zip(places, coefs)):
        b = coef.select(*by, *[F.coalesce(F.col(f"b_{i}"), F.lit(0.0)).alias(f"b{m}_{i}") for i in range(len(own))])
        r = r.join(_bc(b, n_groups), by) if by else r.crossJoin(F.broadcast(b))
    left = [reduce(lambda a, c: a - c, [F.col(f"b{m}_{i}") * F.col(f"_t{at}") for i, at in enumerate(own)], F.col("_t0"))
            for m, own in enumerate(places)]
    r = r.select("*", *[u.alias(f"_u{m}") for m, u in enumerate(left)])
    pairs = [(m, i, j) for m, own in enumerate(places) for i in range(len(own)) for j in range(i, len(own))]
    squares = [F.sum(F.col(f"_u{m}") * F.col(f"_u{m}")).alias(f"ssr{m}") for m in range(len(places))]
    if model.cov == "cluster":
        sc = r.groupBy(*by, model.cluster).agg(
            *[F.sum(F.col(f"_t{at}") * F.col(f"_u{m}")).alias(f"_s{m}_{i}") for m, own in enumerate(places) for i, at in enumerate(own)],
            *squares)
        meat = sc.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n_clusters"), *[F.sum(f"ssr{m}").alias(f"ssr{m}") for m in range(len(places))],
            *[F.sum(F.col(f"_s{m}_{i}") * F.col(f"_s{m}_{j}")).alias(f"mt{m}_{i}_{j}") for m, i, j in pairs])
    else:
        meat = r.groupBy(*by).agg(
            F.lit(None).cast("long").alias("n_clusters"), *squares,
            *[F.sum(F.col(f"_t{places[m][i]}") * F.col(f"_t{places[m][j]}") * F.col(f"_u{m}") * F.col(f"_u{m}"))
              .alias(f"mt{m}_{i}_{j}") for m, i, j in pairs])

    # Effect level counts per group (for the small-sample factors).
    for j, key in enumerate(keys if model.absorb else []):
        lv = found.levels.filter(F.col("_k") == j).groupBy(*by).agg(F.count(F.lit(1)).alias(f"lv_{j}"))
        meat = meat.join(lv, by) if by else meat.crossJoin(F.broadcast(lv))
    if model.absorb and len(keys) == 2 and model.cov == "hc1":
        if model.connected:
            meat = meat.withColumn("comps", F.lit(1).cast("long"))
        else:
            from shelfwise.operators.graph import bipartite_components
            comps = bipartite_components(base.select(*by, *keys), by, keys[0], keys[1],
                                         scratch)
            meat = meat.join(comps, by, "left").fillna({"comps": 1})
    meat = scratch.cut(meat)
    out_schema = T.StructType(key_schema + [T.StructField(n, t) for n, t in
                                            zip(RESULT_COLS, RESULT_TYPES)])
    n_fe = list(keys) if model.absorb else []
    out = []
    for m, (own, coef) in enumerate(zip(places, coefs)):
        mine = meat.select(*by, "n_clusters", F.col(f"ssr{m}").alias("ssr"), *[c for c in meat.columns if c[:3] == "lv_" or c == "comps"],
                           *[F.col(f"mt{m}_{i}_{j}").alias(f"mt_{i}_{j}") for x, i, j in pairs if x == m])
        full = coef.join(mine, by) if by else coef.crossJoin(F.broadcast(mine))
        terms = [names[at - 1] for at in own]
        result = full.mapInPandas(_sandwich_fn(models[m], terms, by, n_fe), out_schema)
        if groups is not None:
            result = groups.join(result, "_g").drop("_g")
        out.append(result.checkpoint())
    return out
