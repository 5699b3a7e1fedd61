"""Nearest neighbours by inverted lists and an adaptive scan of the dimensions.

Vectors are rotated at random, so that the first dimensions of a difference estimate its length. A list is scanned in blocks
of columns; after each block a test drops the candidates that are too far on the evidence so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from permitwright.llm.common import saved
from permitwright.llm.vectors import dimension, usable

# Columns in the first blocks of a scan; the last block takes the rest.
BLOCK = 8
# Vectors of the sample that every query is compared with, for a first radius.
RADIUS_SAMPLE = 1000
# Vectors, and queries, of one list that meet in one task.
SHARD = 4096


@dataclass(frozen=True)
class Index:
    """What a bounded sample tells: the lists' centres, a rotation, the sample itself, and how many lists to probe."""

    centres: np.ndarray
    rotation: np.ndarray
    sample: np.ndarray
    sample_ids: np.ndarray
    probes: int

    def lists(self, vectors: np.ndarray, n: int) -> np.ndarray:
        """The `n` nearest lists of each vector, nearest first."""
        gap = (self.centres**2).sum(1)[None, :] - 2 * vectors @ self.centres.T
        return np.argsort(gap, axis=1, kind="stable")[:, :n]

    def known(self, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The `k` nearest of the sample's first vectors to each query and their distances; -1 and infinity if fewer.

        The last distance is a radius within which all true neighbours lie.
        """
        some, names = self.sample[:RADIUS_SAMPLE], self.sample_ids[:RADIUS_SAMPLE]
        near, gaps = np.full((len(vectors), k), -1, np.int64), np.full((len(vectors), k), np.inf)
        for at in range(len(vectors)):
            others = np.flatnonzero(names != ids[at])
            gap = np.sqrt(((some[others] - vectors[at]) ** 2).sum(1))
            best = np.lexsort((names[others], gap))[:k]
            near[at, : len(best)], gaps[at, : len(best)] = names[others][best], gap[best]
        return near, gaps


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T


def _k_means(points: np.ndarray, n: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = points[rng.choice(len(points), n, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((centres**2).sum(1)[None, :] - 2 * points @ centres.T, axis=1)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=n)
        np.add.at(sums, near, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def fit_index(rows: DataFrame, total: int, dim: int, k: int = 10, sample: int = 6_000, lists: int | None = None,
              recall: float = 0.97, seed: int = 11) -> Index:
    """Fit on at most `sample` vectors, chosen by a hash of the id.

    The number of lists grows with the root of the number of vectors, up to one per 30 sample vectors. The number of
    lists to probe is the smallest with which 200 sample vectors find `recall` of their neighbours in the sample.
    """
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    points = np.array(chosen["v"].tolist(), float).reshape(len(chosen), dim)
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    n = lists or max(1, min(int(total**0.5), len(points) // 30))
    if not len(points):
        return Index(np.zeros((1, dim)), rotation, points, np.zeros(0, np.int64), 1)
    centres = _k_means(points, min(n, len(points)), rng)
    index = Index(centres, rotation, points, chosen["id"].to_numpy(np.int64), len(centres))
    tried = points[rng.choice(len(points), min(200, len(points)), replace=False)]
    near = np.argsort(_squares(tried, points), axis=1)[:, 1 : k + 1]
    own = index.lists(points, 1)[:, 0]
    order = index.lists(tried, len(centres))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centres))[None, :].repeat(len(tried), 0), axis=1)
    needed = np.sort(np.take_along_axis(place, own[near], axis=1).ravel()) + 1
    probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) if len(needed) else len(centres)
    return Index(centres, rotation, points, index.sample_ids, min(len(centres), probes))


def adaptive_scan(query: np.ndarray, blocks: list[np.ndarray], cuts: list[int], radius: float, significance: float) -> np.ndarray:
    """Positions of the candidates that no test abandons.

    `blocks` are the columns of the rotated candidates, `query` is rotated too. After `m` of `d` columns a candidate goes
    if its partial distance, scaled to all columns, exceeds the radius by more than `significance` standard errors.
    After the last column the partial distance is the distance, up to rounding.
    """
    dim = cuts[-1]
    alive, gap = np.arange(len(blocks[0])), np.zeros(len(blocks[0]))
    start = 0
    for block, end in zip(blocks, cuts, strict=True):
        gap = gap + ((block[alive] - query[start:end]) ** 2).sum(1)
        slack = significance / end**0.5 if end < dim else 1e-9
        stay = gap * (dim / end) <= (radius * (1 + slack) + 1e-9) ** 2
        alive, gap, start = alive[stay], gap[stay], end
        if not len(alive):
            break
    return alive


def nearest(df: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            significance: float = 2.1, **fit) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of each vector whose id is divisible by `every`.

    The score is the Euclidean distance in double precision on the vectors as given; nearest first, ties go to the
    smaller id; all candidates if they are fewer than `k`. Vectors that are null, zero, of another length than most, or hold
    null or non-finite components take no part, nor do rows without an id. Of rows that repeat an id the one with the
    smallest vector counts, and no row is a candidate of its own id. An empty table gives no rows; other columns are
    not read.

    Every vector is indexed. A list is dealt out in shards of about SHARD vectors and its queries likewise, so
    neither a crowded list nor one that many queries probe meets in one task. A query's nearest vectors
    in the sample give its first radius and stand in where the probed lists hold fewer than `k`. The sizes of lists, a bounded number of
    rows, decide the shards. A shard answers with at most `k` candidates per query.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    dim = dimension(rows, "v")
    rows = saved(rows.where(F.size("v") == dim).groupBy("id").agg(F.min("v").alias("v")), "vectors")
    index = fit_index(rows, rows.count(), dim, k, **fit)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = np.array(frame["v"].tolist(), float).reshape(len(frame), dim)
            for at in range(0, len(frame), 2000):
                part = frame.iloc[at : at + 2000]
                yield part.assign(list=index.lists(points[at : at + 2000], 1)[:, 0])

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = np.array(frame["v"].tolist(), float).reshape(len(frame), dim)
            for at in range(0, len(frame), 500):
                part, some = frame.iloc[at : at + 500], points[at : at + 500]
                probed = index.lists(some, index.probes)
                near, gaps = index.known(some, part["id"].to_numpy(), k)
                yield part.assign(radius=gaps[:, -1], lists=list(probed), near=list(near), gaps=list(gaps))

    indexed = saved(rows.mapInPandas(place, "id long, v array<double>, list int"), "lists")
    asked = rows.where(F.col("id") % every == 0).mapInPandas(
        probe, "id long, v array<double>, radius double, lists array<int>, near array<long>, gaps array<double>")
    probed = saved(asked, "queries")
    known = probed.select(F.col("id").alias("query_id"), F.inline(F.arrays_zip("near", "gaps")).alias("vec_id", "score"))
    asked = probed.select("id", "v", "radius", F.explode("lists").alias("list"))
    shards = _shards(indexed)
    turns = _shards(asked)
    deal = lambda d, own, other: d.select(
        "*", (F.abs(F.xxhash64("id")) % _of(own)).cast("int").alias("_own"),
        F.explode(F.sequence(F.lit(0), _of(other) - 1)).alias("_other"))
    left = deal(asked, turns, shards).select("*", F.col("_own").alias("turn"), F.col("_other").alias("shard"))
    right = deal(indexed, shards, turns).select("*", F.col("_own").alias("shard"), F.col("_other").alias("turn"))
    cuts = [c for c in range(BLOCK, min(dim, 4 * BLOCK), BLOCK) if c < dim] + [dim]

    def scan(_, queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(points):
            points = points.sort_values("id")
            ids, given = points["id"].to_numpy(), np.array(points["v"].tolist(), float)
            turned = given @ index.rotation
            blocks = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
            for query, v, radius in zip(queries["id"], queries["v"], queries["radius"], strict=True):
                v = np.asarray(v, float)
                alive = adaptive_scan(v @ index.rotation, blocks, cuts, radius, significance)
                alive = alive[ids[alive] != query]
                gap = np.sqrt(((given[alive] - v) ** 2).sum(1))
                best = np.argsort(gap, kind="stable")[:k]
                out += [(query, int(i), float(g)) for i, g in zip(ids[alive][best], gap[best], strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["list", "shard", "turn"]
    found = left.select("id", "v", "radius", *keys).groupBy(*keys).cogroup(
        right.select("id", "v", *keys).groupBy(*keys)).applyInPandas(scan, "query_id long, vec_id long, score double")
    found = found.unionAll(known.where("vec_id >= 0 or score < double('infinity')")).groupBy(
        "query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _shards(rows: DataFrame) -> dict[int, int]:
    return {r["list"]: -(-r["count"] // SHARD) for r in rows.groupBy("list").count().collect()}


def _of(sizes: dict[int, int]):
    """The number for the row's list, 1 for a list without any."""
    large = {k: n for k, n in sizes.items() if n > 1}
    if not large:
        return F.lit(1)
    return F.coalesce(F.create_map(*[F.lit(x) for pair in large.items() for x in pair])[F.col("list")], F.lit(1))
