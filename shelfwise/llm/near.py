"""Candidate sets and their exact check, shared by the near-copy operators.

Members come with their shingle set (sorted 64-bit hashes, 8 bytes each). A
set of members is checked all against all, in blocks of bounded members and
bytes; what leaves a task is counts and a link for each member, or the links of
a few members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import text

#: Members and bytes in a block of a candidate set, and bytes in a task's bin.
BLOCK_MEMBERS, BLOCK_BYTES, BIN_BYTES = 1024, 2 << 20, 2 << 20
#: Sets of up to so many members in a block pair are checked pair by pair.
SMALL = 8
#: Shingles of the pairs compared at a time.
AT_ONCE = 1 << 20


def deal(members: DataFrame) -> DataFrame:
    """members (node, root, bytes, ...) dealt out for block-against-block
    checks: adds block and blocks, never more blocks than members."""
    sizes = members.groupBy("root").agg(F.count("*").alias("docs"), F.sum("bytes").alias("volume"))
    sizes = sizes.select("root", F.least(F.col("docs"), F.greatest(
        F.ceil(F.col("docs") / BLOCK_MEMBERS), F.ceil(F.col("volume") / BLOCK_BYTES), F.lit(1))).cast("int").alias("blocks"))
    return members.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))


def block_pairs(members: DataFrame, least_bins: int) -> tuple[DataFrame, int]:
    """(node, n, block, pair, across, bin): a row for each member and each
    block it meets; and how many rows."""
    rows, volume = members.agg(F.sum("blocks"), F.sum(F.col("bytes") * F.col("blocks"))).first()
    bins = max(least_bins, (volume or 0) // BIN_BYTES + 1)
    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "n", "block", F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("pair"),
        (F.col("block") != F.col("other")).alias("across"))
    # two blocks that meet: both have the row, each also meets itself
    return pairs.withColumn("bin", F.pmod(F.col("pair"), F.lit(bins))), rows or 0


def common(values: np.ndarray, limits: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a[i] and b[i] (runs of values)."""
    lengths = np.diff(limits)
    out = np.zeros(len(a), np.int64)
    ends = np.cumsum(lengths[a] + lengths[b])
    at = 0
    while at < len(a):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + AT_ONCE, "right")))
        both = np.concatenate([a[at:stop], b[at:stop]])
        owner, place = text.spread(lengths[both])
        value = values[limits[both][owner] + place]
        owner = owner % (stop - at)
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        twice = (value[1:] == value[:-1]) & (owner[1:] == owner[:-1])
        out[at:stop] = np.bincount(owner[1:][twice], minlength=stop - at)
        at = stop
    return out


def _linked(table: pa.Table) -> pa.Table:
    """For the block pairs of one bin: how many rows each member is linked to,
    and a smaller relative of it here (or itself)."""
    table = table.combine_chunks()
    pair = table.column("pair").to_numpy()
    order = np.argsort(pair, kind="stable")
    limits = np.flatnonzero(np.r_[True, pair[order][1:] != pair[order][:-1], True])
    sizes = np.diff(limits)
    across, block = table.column("across").to_numpy(), table.column("block").to_numpy()
    weight = table.column("n").to_numpy()
    nodes = table.column("node")
    _, name = np.unique(np.array(nodes.to_pylist(), object).astype("S16"), return_inverse=True)
    sets = table.column("set").combine_chunks()
    values, starts = text.runs_of(sets)
    lengths = np.diff(starts)
    out = [[], [], []]                     # place of the member, links, place of the relative
    # small sets: all pairs at once
    left, right = [], []
    for size in range(2, SMALL + 1):
        rows = order[limits[:-1][sizes == size][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        left.append(rows[:, i].ravel())
        right.append(rows[:, j].ravel())
    a, b = np.concatenate(left), np.concatenate(right)
    # Jaccard >= 4/5 in whole numbers: 9 common >= 4 (|a| + |b|)
    can = (9 * np.minimum(lengths[a], lengths[b]) >= 4 * (lengths[a] + lengths[b])) & ~(across[a] & (block[a] == block[b]))
    a, b = a[can], b[can]
    link = 9 * common(values, starts, a, b) >= 4 * (lengths[a] + lengths[b])
    a, b = a[link], b[link]
    low = np.where(name[a] < name[b], a, b)
    for place, links, root in ((a, weight[b], low), (b, weight[a], low)):
        for column, part in zip(out, (place, links, root), strict=True):
            column.append(part)
    for k in np.flatnonzero(sizes > SMALL):
        rows = order[limits[k]:limits[k + 1]]
        rows = rows[np.argsort(name[rows])]
        hits = text.overlaps([values[starts[r]:starts[r + 1]] for r in rows])
        link = 9 * hits >= 4 * (lengths[rows][:, None] + lengths[rows][None, :])
        np.fill_diagonal(link, False)
        if across[rows[0]]:
            link &= block[rows][:, None] != block[rows][None, :]
        root = np.arange(len(rows))
        while True:
            new = np.minimum(root, np.where(link, root[None, :], root[:, None]).min(1))
            if (new == root).all():
                break
            root = new
        linked = np.flatnonzero(link.any(1))
        for column, part in zip(out, (rows[linked], (link @ weight[rows])[linked], rows[root[linked]]), strict=True):
            column.append(part)
    place, links, root = (np.concatenate(x).astype(np.int64) for x in out)
    return pa.table({"node": nodes.take(pa.array(place)), "links": pa.array(links), "root": nodes.take(pa.array(root))})


def verify(rows: DataFrame) -> DataFrame:
    """rows (bin, pair, across, block, node, n, set) -> (node, links, root):
    the exact 5-word Jaccard of all pairs of each block pair."""
    return rows.groupBy("bin").applyInArrow(_linked, "node binary, links long, root binary")
