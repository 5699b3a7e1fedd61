"""Near-duplicate vectors by cover trees and dual traversal.

A tree has nested levels with halving radii: a node's points lie within its level's radius of its centre, and its centre
is a centre on every level below. Two trees are walked together; a pair of nodes is dropped when their centres are farther
apart than both covering radii and the threshold allow, and taken as a whole when they are near enough for all points.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permitwright.llm.common import components, saved
from permitwright.llm.vectors import dimension, usable

RADII = (1.0, 0.5, 0.25, 0.125)
# Vectors that one tree holds, about.
BLOCK = 2000
# Rounding of distances; pairs nearer to the threshold than that are compared by the definition itself.
_EPS = 1e-7


@dataclass
class Level:
    centre: np.ndarray  # point of each node
    radius: np.ndarray  # largest distance of a node's points to its centre
    parent: np.ndarray  # node of the level above
    node: np.ndarray  # node of each point


def grow(points: np.ndarray) -> list[Level]:
    """The levels of a cover tree over unit vectors: a root, one per radius, and the points themselves."""
    n = len(points)
    node = np.zeros(n, np.int64)
    from_root = np.sqrt(np.maximum(2 - 2 * points @ points[0], 0))
    levels = [Level(np.zeros(1, np.int64), np.array([from_root.max()]), np.zeros(1, np.int64), node)]
    for radius in RADII:
        above = levels[-1]
        order = np.argsort(above.node, kind="stable")
        edges = np.searchsorted(above.node[order], np.arange(len(above.centre) + 1))
        node = np.empty(n, np.int64)
        centres, radii, parents = [], [], []
        for p in range(len(above.centre)):
            members = order[edges[p] : edges[p + 1]]
            if above.radius[p] <= radius:  # one node of this level covers it
                node[members] = len(centres)
                centres.append(int(above.centre[p]))
                parents.append(p)
                radii.append(float(above.radius[p]))
                continue
            base = len(centres)
            gap = np.full(len(members), np.inf)
            mine = np.zeros(len(members), np.int64)
            centre = int(np.flatnonzero(members == above.centre[p])[0])
            while True:
                d = np.sqrt(np.maximum(2 - 2 * points[members] @ points[members[centre]], 0))
                d[centre] = 0
                closer = d < gap
                gap[closer], mine[closer] = d[closer], len(centres)
                centres.append(members[centre])
                parents.append(p)
                centre = int(np.argmax(gap))
                if gap[centre] <= radius:
                    break
            node[members] = mine
            own = np.zeros(len(centres) - base)
            np.maximum.at(own, mine - base, gap)
            radii += own.tolist()
        levels.append(Level(np.array(centres), np.array(radii), np.array(parents), node))
    return [*levels, Level(np.arange(n), np.zeros(n), levels[-1].node, np.arange(n))]


def _children(level: Level, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(level.parent, kind="stable")
    return order, np.searchsorted(level.parent[order], np.arange(nodes + 1))


def walk(a: np.ndarray, tree_a: list[Level], b: np.ndarray, tree_b: list[Level], reach: float):
    """Yield (points of a, points of b, sure) whose distances are at most `reach`; `sure` pairs of nodes need no check.

    Each yield is all points of one node against all of others. Together they cover every such pair once, both ways
    round where a and b are the same.
    """
    pairs = [(0, np.zeros(1, np.int64))]
    for depth in range(1, len(tree_a)):
        up_a, up_b, la, lb = tree_a[depth - 1], tree_b[depth - 1], tree_a[depth], tree_b[depth]
        order_a, edges_a = _children(la, len(up_a.centre))
        order_b, edges_b = _children(lb, len(up_b.centre))
        last = depth == len(tree_a) - 1
        following = []
        for node, mates in pairs:
            mine = order_a[edges_a[node] : edges_a[node + 1]]
            theirs = np.concatenate([order_b[edges_b[m] : edges_b[m + 1]] for m in mates])
            gap = np.sqrt(np.maximum(2 - 2 * a[la.centre[mine]] @ b[lb.centre[theirs]].T, 0))
            spread = la.radius[mine][:, None] + lb.radius[theirs][None, :]
            near = gap <= reach + spread + _EPS
            whole = gap + spread <= reach - _EPS
            for i, one in enumerate(mine):
                if last:
                    for found, sure in ((whole[i], True), (near[i] & ~whole[i], False)):
                        if found.any():
                            yield la.centre[one : one + 1], lb.centre[theirs[found]], sure
                    continue
                if whole[i].any():
                    yield np.flatnonzero(la.node == one), np.flatnonzero(np.isin(lb.node, theirs[whole[i]])), True
                rest = theirs[near[i] & ~whole[i]]
                if len(rest):
                    following.append((one, rest))
        pairs = following


def near_pairs(left: pd.DataFrame, right: pd.DataFrame, cosine: float, same: bool) -> pd.DataFrame:
    """(id, links, root) per vector of the two blocks that links with one of the other (or of its own) block.

    `links` adds the copies of the linked vectors; `root` is the smallest id that these links reach, so that the links
    themselves need not leave the task.
    """
    given = [np.array(f["v"].tolist(), float) for f in (left, right)]
    norms = [np.sqrt((g**2).sum(1)) for g in given]
    units = [g / n[:, None] for g, n in zip(given, norms, strict=True)]
    trees = [grow(units[0])]
    trees.append(trees[0] if same else grow(units[1]))
    ids = left["id"].to_numpy() if same else np.concatenate([left["id"].to_numpy(), right["id"].to_numpy()])
    shift = 0 if same else len(left)
    copies = [f["copies"].to_numpy() for f in (left, right)]
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(x: int, y: int) -> None:
        x, y = top(x), top(y)
        if x != y:
            low, high = (x, y) if ids[x] < ids[y] else (y, x)
            root[high] = low

    for xs, ys, sure in walk(units[0], trees[0], units[1], trees[1], float(np.sqrt(2 - 2 * cosine))):
        if not sure:
            exact = (given[0][xs] @ given[1][ys].T)[0] / (norms[0][xs[0]] * norms[1][ys])
            ys = ys[exact >= cosine]
        if not len(ys):
            continue
        links[xs] += copies[1][ys].sum()
        if not same:
            np.add.at(links, ys + shift, copies[0][xs].sum())
        # Only ends that are not yet known to be together are joined one by one.
        here = top(int(xs[0]))
        for y in (ys + shift)[root[ys + shift] != here]:
            join(int(xs[0]), int(y))
        for x in xs[1:]:
            join(int(x), int(ys[0]) + shift)
    if same:
        links -= copies[0]  # each met itself and its copies
    hit = np.flatnonzero(links > 0)
    return pd.DataFrame({"id": ids[hit], "links": links[hit], "root": [ids[top(int(i))] for i in hit]})


def near_vectors(df: DataFrame, cosine: float = 0.93, sample: int = 4_000, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of `df`: vec_id, n_links, component_id and kept.

    Two vectors link if their labels are equal and not null and their cosine, in double precision, is at least `cosine`
    (above 0). n_links counts the other rows linked directly, component_id is the smallest id reachable by links, kept
    marks the row that has it. Vectors that are null, zero, of another length than most, or hold null or non-finite
    components link with nothing, nor do rows without a label or an id; such a row is its own component. Rows that repeat
    an id are rows of their own, each with its own links, that share a component. An empty table gives no rows; other columns are not read.

    Equal vectors of a label meet first and count as copies. The rest of a label is split by the nearest of a few anchors
    (from a sample of at most `sample` vectors), and a crowded anchor by a hash, into blocks that hold a tree each. Blocks
    meet in pairs, but for those whose covering radii keep them apart, and a pair of blocks answers with counts and one
    root per vector, never with its links.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                     F.col(label_col).cast("string").alias("label"))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + 0.0))  # one zero, not two
    node = F.xxhash64("label", "v")
    good = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    dim = dimension(good, "v")
    good = saved(good.where(F.size("v") == dim), "vectors")
    # Trees and links know a vector by a hash of label and components, so that rows that repeat an id stay apart.
    heads = good.groupBy("label", "v").agg(F.min("id").alias("head"), F.count("*").alias("copies"))
    heads = saved(heads.withColumn("id", node), "heads")
    chosen = heads.orderBy(F.xxhash64("id"), "id").limit(sample).select("label", "v").toPandas()
    labels = chosen["label"].to_numpy()
    points = np.array(chosen["v"].tolist(), float).reshape(len(chosen), dim)
    points = points / np.maximum(np.sqrt((points**2).sum(1)), 1e-300)[:, None]
    # So many labels as the sample shows, so many anchors as a label's share of all asks for: both bounded.
    total = heads.count()
    anchors = {x: _anchors(points[labels == x], total / max(1, len(points))) for x in sorted(set(labels))}

    def place(frames):
        for frame in frames:
            v = np.array(frame["v"].tolist(), float).reshape(len(frame), dim)
            v = v / np.sqrt((v**2).sum(1))[:, None]
            cell, gap = np.zeros(len(frame), np.int64), np.full(len(frame), 2.0)
            for x in set(frame["label"]) & set(anchors):
                at = np.flatnonzero(frame["label"].to_numpy() == x)
                d = np.sqrt(np.maximum(2 - 2 * v[at] @ anchors[x].T, 0))
                cell[at], gap[at] = d.argmin(1), d.min(1)
            yield frame.assign(cell=cell, gap=gap)

    placed = saved(heads.select("label", "v", "id", "copies").mapInPandas(place, "label string, v array<double>, id long, copies long, cell long, gap double"), "cells")
    cells = placed.groupBy("label", "cell").agg(F.max("gap").alias("reach"), F.count("*").alias("n"))
    cells = cells.withColumn("shards", F.ceil(F.col("n") / BLOCK).cast("int"))
    blocks = saved(cells.select("label", "cell", "reach", "shards", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")), "blocks")
    reach = float(np.sqrt(2 - 2 * cosine))

    def apart(frames):
        for frame in frames:
            d = [0.0 if x not in anchors or i == j else float(np.linalg.norm(anchors[x][i] - anchors[x][j]))
                 for x, i, j in zip(frame["label"], frame["cell"], frame["cell2"], strict=True)]
            yield frame[np.array(d) <= frame["reach"].to_numpy() + frame["reach2"].to_numpy() + reach + _EPS]

    other = blocks.select("label", F.col("cell").alias("cell2"), F.col("reach").alias("reach2"), F.col("shard").alias("shard2"))
    met = blocks.drop("shards").join(other, "label").where("cell < cell2 or (cell = cell2 and shard <= shard2)")
    met = saved(met.mapInPandas(apart, met.schema), "block-pairs")
    dealt = placed.join(cells.select("label", "cell", "shards"), ["label", "cell"]).select(
        "label", "cell", (F.abs(F.xxhash64("id")) % F.col("shards")).cast("int").alias("shard"), "id", "v", "copies")
    keys = ["label", "cell", "shard", "cell2", "shard2"]
    left = met.select(*keys).join(dealt, ["label", "cell", "shard"])
    right = met.select(*keys).where("cell != cell2 or shard != shard2").join(
        dealt.toDF("label", "cell2", "shard2", "id", "v", "copies"), ["label", "cell2", "shard2"])
    right = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])  # the sides of a cogroup share no column

    def compare(key, one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        same = key[1] == key[3] and key[2] == key[4]
        two = two.rename(columns=lambda c: c.removeprefix("r_"))
        if not len(one) or not (same or len(two)):
            return pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
        return near_pairs(one.sort_values("id"), one.sort_values("id") if same else two.sort_values("id"), cosine, same)

    found = left.groupBy(*keys).cogroup(right.groupBy(*[f"r_{k}" for k in keys])).applyInPandas(compare, "id long, links long, root long")
    found = saved(found, "roots")
    name = heads.select(F.col("id").alias("node"), "head")
    between = found.select(F.col("id").alias("node"), "root").join(name, "node").select(F.col("head").alias("a"), F.col("root").alias("node"))
    between = between.join(name, "node").select("a", F.col("head").alias("b"))
    copies = good.select(F.col("id").alias("a"), node.alias("node")).distinct().join(name, "node").select("a", F.col("head").alias("b"))
    group = components(between.unionAll(copies))
    totals = found.groupBy("id").agg(F.sum("links").alias("links"))
    direct = heads.select("id", "copies").join(totals, "id", "left").select(
        F.col("id").alias("_node"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    counts = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")) & (F.size("v") == dim)
    marked = rows.select("id", F.when(counts, node).alias("node"))
    joined = marked.join(direct, F.col("node") == F.col("_node"), "left")
    return joined.join(group.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(False)).alias("kept"))


def _anchors(points: np.ndarray, weight: float, most: int = 256) -> np.ndarray:
    """Points far from each other, one per BLOCK vectors that the sample's points stand for, at most `most`."""
    n = min(len(points), most, max(1, int(np.ceil(len(points) * weight / BLOCK))))
    out = [0]
    gap = np.sqrt(np.maximum(2 - 2 * points @ points[0], 0))
    while len(out) < n:
        out.append(int(gap.argmax()))
        gap = np.minimum(gap, np.sqrt(np.maximum(2 - 2 * points @ points[out[-1]], 0)))
    return points[out]
