"""Pages of a table from a stored order: a narrow sorted table with counts per range, so that a page reads one range."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from permitwright.operators.rank import page_slice
from permitwright.plans.browse import PAGE_SIZE, Sort, ascending_key, group_key, grouped_heads, total_order
from permitwright.sources import store


class OrderIndex:
    """The order of a table's rows, or of its addresses, by one sort.

    An entry stands for all rows with one sort key and tie break, or for all addresses whose first row has these, with their
    number. Entries are sorted over range partitions and written one folder per range, with the number of rows per range beside
    them. A page, however deep, is found from these counts: one or two ranges are read, and of the table the rows of the
    page's own entries are fetched, by equality on the tie break, and put in their exact order.
    """

    def __init__(self, spark: SparkSession, root: str, sort: Sort | None = None, grouped: bool = False, ranges: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.sort = sort or Sort()
        self.grouped = grouped
        self.ranges = ranges

    def _keyed(self, records: DataFrame) -> DataFrame:
        return records.withColumn("_key", ascending_key(self.sort))

    def _entries(self, records: DataFrame) -> DataFrame:
        ties = self.sort.tie_break
        keyed = self._keyed(records)
        if self.grouped:
            first = F.min(F.struct("_key", *ties)).alias("f")
            keyed = keyed.groupBy(group_key().alias("group_key")).agg(first).select("f.*", "group_key")
        return keyed.groupBy("_key", *ties).agg(F.count("*").alias("n"))

    def build(self, records: DataFrame) -> None:
        """Sort and store the entries. Only key and tie break are sorted; no other column is read."""
        ties = self.sort.tie_break
        entries = self._entries(records)
        order = [F.col("_key").asc(), *[F.col(c).asc() for c in ties]]
        spread = entries.repartitionByRange(self.ranges, *order) if self.ranges else entries.repartitionByRange(*order)
        laid = spread.sortWithinPartitions(*order).select("*", F.monotonically_increasing_id().alias("place"))
        laid.withColumn("range", F.shiftright("place", 33)).write.mode("overwrite").partitionBy("range").parquet(f"{self.root}/entries")
        counts = self._stored().groupBy("range").agg(F.sum("n").alias("rows"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/counts")

    def is_built(self) -> bool:
        return store.is_complete(self.spark, f"{self.root}/counts")

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/entries")

    def _ranges(self) -> list[tuple[int, int]]:
        """(range, rows) in order: one row per range."""
        rows = self.spark.read.parquet(f"{self.root}/counts").collect()
        return sorted((row["range"], row["rows"]) for row in rows)

    def total(self) -> int:
        return sum(rows for _, rows in self._ranges())

    def entries_of(self, start: int, size: int) -> tuple[DataFrame, int]:
        """The entries that hold positions from `start` (from 0) on, and the position of the first of them within that."""
        before, wanted, offset = 0, [], None
        for number, rows in self._ranges():
            if before < start + size and before + rows > start:
                wanted.append(number)
                offset = before if offset is None else offset
            before += rows
        found = self._stored().filter(F.col("range").isin(wanted))
        running = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        # A window over one or two ranges, which are as large as a sort partition.
        placed = found.withColumn("end", F.sum("n").over(running) + F.lit(offset or 0)).withColumn("begin", F.col("end") - F.col("n"))
        return placed.filter((F.col("end") > start) & (F.col("begin") < start + size)), len(wanted)

    def page(self, records: DataFrame, page: int, size: int = PAGE_SIZE, name: str = "position") -> DataFrame:
        """One page of the records, or of the addresses' heads with `groups` and `pages`, each row with its 1-based position."""
        start, total, ties = page * size, self.total(), self.sort.tie_break
        entries, _ = self.entries_of(start, size)
        keys = entries.select("_key", *ties, "begin").collect()  # at most a page's entries
        first = min((row["begin"] for row in keys), default=start)
        candidates = self._candidates(records, entries)
        if self.grouped:
            heads = grouped_heads(candidates, self.sort)
            rows = page_slice(heads, [("_first", True)], start - first, size, name, copies=False).drop("_first")
        else:
            rows = page_slice(candidates, total_order(candidates, self.sort), start - first, size, name)
        moved = rows.withColumn(name, F.col(name) + F.lit(first))
        if not self.grouped:
            return moved
        return moved.withColumn("groups", F.lit(total).cast("bigint")).withColumn("pages", F.ceil(F.col("groups") / size))

    def _candidates(self, records: DataFrame, entries: DataFrame) -> DataFrame:
        """The rows of the entries: those with their tie break and key, or all rows of the addresses that begin with such a row."""
        ties = self.sort.tie_break
        wanted = entries.select("_key", *ties)
        cities = [row["city"] for row in wanted.select("city").distinct().collect()] if "city" in ties else None
        keyed = self._keyed(records)
        near = keyed if cities is None or self.grouped else keyed.filter(F.col("city").isin(cities))
        far = wanted.select(*[F.col(c).alias(f"w_{c}") for c in ["_key", *ties]])
        condition = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"w_{c}")) for c in ["_key", *ties]])
        rows = near.join(far, condition, "left_semi").drop("_key")
        if not self.grouped:
            return rows
        groups = rows.select(group_key().alias("_group")).distinct()
        # An address counts only if such a row is its first one.
        all_rows = records.withColumn("_group", group_key()).join(groups, "_group", "left_semi")
        firsts = self._keyed(all_rows).groupBy("_group").agg(F.min(F.struct("_key", *ties)).alias("f")).select("_group", "f.*")
        kept = firsts.join(far, condition, "left_semi").select("_group")
        return all_rows.join(kept, "_group", "left_semi").drop("_group")
