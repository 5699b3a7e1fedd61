"""Vectors that count: of one dimension, finite and not zero, one per id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component a finite number."""
    limit = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def dimension(rows: DataFrame, vector: str) -> int:
    """The most frequent length of the usable vectors, the smaller one on a tie; 0 without any."""
    sizes = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return sizes["d"] if sizes else 0
