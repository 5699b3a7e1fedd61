"""Helpers the operators of this subpackage share: written tables, splits, hashed words, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from permitwright.session import fresh_dir, tune

# An odd multiplier, so that it can be inverted modulo 2**64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


# Rows that reach a Python worker at once. Texts may be long, and several workers share an executor's memory.
ROWS_AT_ONCE = 1000


def prepared(spark: SparkSession) -> None:
    """The session settings these operators are made for; none changes a result."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder in the cluster's shared folder and read it back.

    It cuts the lineage: what was written survives lost executors and is computed once.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(id_col: Column, parts: int) -> Column:
    """crc32 of an id's decimal text modulo `parts`; null ids count as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % parts


def byte_groups(texts: list[str], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8, about `limit` bytes at a time, with the position of the first.

    Keeps a task's arrays small however many long documents follow each other; one longer text comes alone.
    """
    group: list[bytes] = []
    start = size = 0
    for place, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        if group and size + len(data) > limit:
            yield start, group
            group, start, size = [], place, 0
        group.append(data)
        size += len(data)
    if group:
        yield start, group


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def _powers(size: int, base: np.uint64) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    if size:
        steps[0] = 1
    return np.multiply.accumulate(steps)


def hashed_words(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of every maximal run of bytes for which `inside` is true.

    The hash is a polynomial in the run's bytes, taken from running sums, then scrambled together with the length.
    """
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), _BASE), out=sums[1:])
    value = (sums[ends] - sums[starts]) * _powers(len(data) + 1, inverse)[starts]
    return starts, ends, mixed(value + (ends - starts).astype(np.uint64) * _MIX[1])


# Edges that one task joins by itself.
_EDGES_AT_ONCE = 500_000


def _stars(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's edges as stars: every id with the smallest id its edges reach, ids that reach none smaller left out."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def told() -> pd.DataFrame:
        return pd.DataFrame([(x, top(x)) for x in list(up) if top(x) != x], columns=["hi", "lo"], dtype="int64")

    seen = 0
    for frame in frames:
        for x, y in zip(frame["hi"].tolist(), frame["lo"].tolist(), strict=True):
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        seen += len(frame)
        if seen >= 2 * _EDGES_AT_ONCE:  # more than was dealt to a task: start anew, the next round joins both
            yield told()
            up, seen = {}, 0
    yield told()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable from each id that occurs in the undirected edges.

    In each round tasks first turn a bounded number of edges into stars, which shortens paths and drops edges that close
    circles. If one task held all of them, that is the answer. Otherwise every neighbourhood is hooked on its smallest
    member, for larger and for smaller neighbours in turn, until only stars are left. Rows stay in proportion to the edges,
    minima combine in the map tasks, and a round's edges are written down. Null ends and loops are left out; no edges give no rows.
    Raises if `rounds` do not suffice, which are ample: the number needed grows with the logarithm of the longest path.
    """
    ordered = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    pairs = saved(ordered, "edges")
    before = None
    for _ in range(rounds):
        tasks = -(-pairs.count() // _EDGES_AT_ONCE)
        stars = pairs.coalesce(max(1, tasks)).mapInPandas(_stars, "hi long, lo long")
        state = None
        if tasks > 1:
            pairs = saved(_hooked(stars), "edges")
            state = pairs.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        else:
            pairs = saved(stars, "edges")
        if tasks <= 1 or state == before:
            hubs = pairs.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
            return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionAll(hubs)
        before = state
    raise RuntimeError("connected components did not settle")


def _hooked(pairs: DataFrame) -> DataFrame:
    """Every neighbourhood hooked on its smallest member: larger neighbours first, then smaller ones."""
    both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select((F.col("u") + 0).alias("u"), F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    small_least = large.groupBy("hi").agg(F.min("lo").alias("m")).select((F.col("hi") + 0).alias("hi"), "m")
    joined = large.join(small_least, "hi")
    small = joined.select("hi", F.col("m").alias("lo")).unionAll(
        joined.where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
    return small.distinct()


def passing(df: DataFrame, text_col: str, keeps: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose texts `keeps` marks. Rows travel as Arrow batches, so that no type or name is touched."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for start in range(0, frame.num_rows, 1000):
                part = frame.slice(start, 1000)
                yield part.filter(pa.array(keeps(part.column(text_col).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def batches(frames: Iterator[pd.DataFrame], rows: int = 2000) -> Iterator[pd.DataFrame]:
    """Cut batches into pieces of at most `rows` rows."""
    for frame in frames:
        for start in range(0, len(frame), rows):
            yield frame.iloc[start : start + rows]
