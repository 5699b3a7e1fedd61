"""Choices and suggestions from a dictionary that is kept up to date, so that asking never scans the records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from permitwright.plans.browse import SUGGESTIONS, facet_choices
from permitwright.sources import store

_KEY = ["facet", "value"]


def offers(records: DataFrame, weight: int) -> DataFrame:
    """(facet, value, records): what records offer per facet, counted with a weight; a scan and one small aggregate."""
    tagged = F.array(*[F.struct(F.lit(facet).alias("facet"), value.alias("value")) for facet, value in facet_choices().items()])
    values = records.select(F.inline(tagged)).filter(F.col("value").isNotNull())
    return values.groupBy(*_KEY).agg((F.count("*") * weight).alias("records"))


class FacetDictionary:
    """(facet, value, records) of a record table, in folders by facet and sorted by value.

    Each state names the version of the table it belongs to. A change adds what the new rows offer and takes away what the old
    ones did, so keeping it costs the changed rows and the dictionary, never the table. A state that was not kept is made anew.
    """

    schema = "facet string, value string, records bigint"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, version: int) -> str:
        return f"{self.root}/table={version}"

    def versions(self) -> list[int]:
        """Table versions whose dictionary is there, oldest first."""
        found = store.numbered(self.spark, self.root, "table")
        return [version for version in found if store.is_complete(self.spark, self._folder(version))]

    def _write(self, counts: DataFrame, version: int) -> None:
        rows = counts.groupBy(*_KEY).agg(F.sum("records").alias("records")).filter("records > 0")
        rows.repartition("facet").sortWithinPartitions(*_KEY).write.mode("overwrite").partitionBy("facet").parquet(self._folder(version))
        for old in self.versions()[:-2]:
            store.remove(self.spark, self._folder(old))

    def rebuild(self, records: DataFrame, version: int) -> None:
        self._write(offers(records, 1), version)

    def change(self, base: int, version: int, added: DataFrame | None = None, removed: DataFrame | None = None) -> bool:
        """From a table version to the next by the rows that came and went; False if the first one's dictionary is not there."""
        if base not in self.versions():
            return False
        counts = self.read(base)
        if added is not None:
            counts = counts.unionByName(offers(added, 1))
        if removed is not None:
            counts = counts.unionByName(offers(removed, -1))
        self._write(counts, version)
        return True

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(version))

    def values(self, version: int) -> DataFrame:
        """Values to choose from, as `browse.facet_values` gives them."""
        number: Column = F.when(F.col("facet").isin("year", "gush"), F.col("value").try_cast("double"))
        return self.read(version).select(*_KEY, number.alias("number"))

    def suggest(self, version: int, facet: str, needle: str = "", count: int = SUGGESTIONS) -> DataFrame:
        """First values of a facet, in order, that contain the text as typed; reads that facet's folder alone."""
        values = self.read(version).filter(F.col("facet") == facet).select("value")
        if needle:
            values = values.filter(F.col("value").contains(needle))
        return values.orderBy("value").limit(count).withColumn("rank", F.row_number().over(Window.orderBy("value")))
