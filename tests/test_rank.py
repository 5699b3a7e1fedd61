"""Order-dependent operators against brute force, with one key holding a third of the rows and with many copies."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from permitwright.operators.rank import join_side, keep_first, key_set, numbered, page_slice


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = [("hot" if i % 3 == 0 else f"k{rng.randint(0, 400)}", rng.randint(0, 50), f"v{i % 700}") for i in range(6000)]
    return made + [("hot", 7, "copy")] * 3000


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, v string").repartition(8)


ORDER = [("n", False), ("k", True), ("v", True)]


def in_order(rows):
    return sorted(rows, key=lambda r: (-r[1], r[0], r[2]))


def test_numbered_equals_a_sort(table, rows):
    got = numbered(table, ORDER, "place").collect()
    assert sorted(r.place for r in got) == list(range(1, len(rows) + 1))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.place)] == in_order(rows)


def test_numbered_within_groups(table, rows):
    want = defaultdict(list)
    for row in in_order(rows):
        want[row[0]].append(row)
    got = defaultdict(list)
    for row in sorted(numbered(table, ORDER, "place", ["k"]).collect(), key=lambda r: (r.k, r.place)):
        got[row.k].append(row)
    for key, group in got.items():
        assert [r.place for r in group] == list(range(1, len(group) + 1))
        assert [tuple(r)[:3] for r in group] == want[key]


def test_numbered_spreads_copies_and_hot_groups(spark, table, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = numbered(table, [("k", True), ("v", True), ("n", True)], "place")
        # The offsets are broadcast, so the rows stay in the partitions they were numbered in.
        sizes = [r[0] for r in placed.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < len(rows) / 6


def test_numbered_by_an_expression(table, rows):
    got = numbered(table, [(F.col("n") % 7, True), ("k", True), ("n", True), ("v", True)], "place")
    want = sorted(rows, key=lambda r: (r[1] % 7, r[0], r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(got.collect(), key=lambda r: r.place)] == want


@pytest.mark.parametrize("start, size", [(0, 25), (100, 25), (8990, 25), (20_000, 5), (0, 9000)])
def test_page_slice(table, rows, start, size):
    got = page_slice(table, ORDER, start, size, "place", total="all").collect()
    want = in_order(rows)[start : start + size]
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(start + 1, start + 1 + len(want)))
    assert {r["all"] for r in got} <= {len(rows)}


def test_keep_first(table, rows):
    want = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        want.setdefault(row[0], row)
    got = keep_first(table, ["k"], [F.col("n")])
    assert got.columns == ["k", "n", "v"]
    assert {r.k: tuple(r) for r in got.collect()} == want


def test_key_set_keeps_every_key_and_few_repeats(table, rows):
    got = key_set(table, ["k"])
    assert {r.k for r in got.distinct().collect()} == {r[0] for r in rows}
    assert got.groupBy("k").count().agg(F.max("count")).first()[0] <= 16


def test_a_hot_key_is_split_in_the_join(spark, table):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        first = keep_first(table, ["k"], [F.col("n")]).select("k", F.col("n").alias("least"))
        joined = table.join(join_side(first, ["k"]), "k")
        semi = table.join(key_set(table, ["k"]), "k", "left_semi")
        for result in (joined, semi):
            assert result.count() == table.count()
            query = result.groupBy("v").count()
            query.collect()
            assert "skew=true" in query._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
