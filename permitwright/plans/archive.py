"""An archive's tables and the runs over them: what a command line offers, as methods.

The record table and the ledger lie below one folder. Each run reads tables, composes operators and appends to or
rewrites a table; what it returns is a DataFrame and costs nothing until it is used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from permitwright.operators import documents, extract, ledger, upkeep
from permitwright.operators.rank import key_set
from permitwright.schema import DOWNLOADED, ERROR, PENDING, as_records
from permitwright.session import fresh_dir
from permitwright.plans import browse
from permitwright.plans.facets import FacetDictionary
from permitwright.plans.order_index import OrderIndex
from permitwright.plans.search import SearchIndex
from permitwright.sources import store
from permitwright.sources.tables import LedgerTable, RecordTable, write_export, write_record_csv


def _cities(rows: DataFrame) -> list[str]:
    """The cities some rows are of: a list as short as the city list."""
    return sorted(row["city"] for row in rows.select("city").distinct().collect())


class Archive:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.records = RecordTable(spark, f"{self.root}/records")
        self.ledger = LedgerTable(spark, f"{self.root}/ledger")
        # What answers questions without a scan of the records; each knows the version of the table it belongs to.
        self.facets = FacetDictionary(spark, f"{self.root}/facets")
        self.search_index = SearchIndex(self.records, f"{self.root}/search")

    def status(self) -> DataFrame:
        """Files per status, and in total."""
        return ledger.progress(self.ledger.read())

    def cities(self, cities: DataFrame) -> DataFrame:
        """Every configured city with its progress."""
        return ledger.city_overview(cities, self.ledger.read())

    def update(self, listing: DataFrame) -> None:
        """Add files that the listing has and the ledger does not. Known entries are not written again."""
        self.ledger.append(ledger.new_entries(listing, self.ledger.read()))

    def record(self, marks: DataFrame) -> None:
        """Apply marks with their payload (see `ledger.mark_aggregates`); only the marks' cities are written again."""
        cities = _cities(marks.select(F.coalesce("city", F.lit("")).alias("city")))
        before = self.ledger.read(cities)
        changed = self._stored(ledger.marked_entries(before, marks), "marked")
        others = before.join(changed.select(*ledger.KEY), ledger.KEY, "left_anti")
        self._rewrite_ledger(others.unionByName(changed), _cities(changed))

    def retry_errors(self) -> int:
        """Put failed files back in line. Cities without any are left alone."""
        cities = _cities(ledger.with_status(self.ledger.read(), ERROR))
        return self._rewrite_ledger(ledger.retry_errors(self.ledger.read(cities)), cities)

    def _rewrite_ledger(self, entries: DataFrame, cities: list[str]) -> int:
        version = self.ledger.rewrite(entries, cities) if cities else self.ledger.version()
        self.ledger.clean()
        return version

    def wanted_documents(self, links: DataFrame, folder: Column) -> DataFrame:
        """Permit documents of pending files and where each is to be stored."""
        waiting = ledger.with_status(self.ledger.read(), PENDING).select("city", "file_id", "address")
        wanted = documents.permit_documents(links).join(waiting, ["city", "file_id"])
        return documents.document_targets(wanted, folder)

    def extract(
        self,
        texts: DataFrame,
        mode: str,
        geometry: DataFrame | None = None,
        responses: DataFrame | None = None,
        failures: DataFrame | None = None,
    ) -> None:
        """Write records of downloaded documents that have none, then mark the files that are done with.

        A file is done when each of its documents has a record, was read in this run without giving one, or is
        among the `failures` (pdf_path) that cannot be read.
        """
        entries = self.ledger.read()
        work = upkeep.first_records(ledger.pending_extraction(entries, self.records.read()), [F.col("file_id")])
        ready = texts.join(work.select("pdf_path"), "pdf_path", "left_semi").select(*texts.columns)
        found = self._stored(extract.stamp_records(extract.extract_records(ready, mode, geometry, responses), work), "extracted")
        self._append_records(found)
        settled = ready.select("pdf_path")
        if failures is not None:
            settled = settled.unionByName(failures.select("pdf_path"))
        # The ledger is computed from the table as it now is, so a run that stops in between is made good by the next.
        open_cities = _cities(ledger.with_status(entries, DOWNLOADED))
        before = self.ledger.read(open_cities)
        after = self._stored(ledger.mark_processed(before, self.records.read(open_cities), settled), "processed")
        waiting = ledger.with_status(before, DOWNLOADED).groupBy("city").agg(F.count("*").alias("b"))
        left = ledger.with_status(after, DOWNLOADED).groupBy("city").agg(F.count("*").alias("a"))
        done = _cities(waiting.join(left, "city", "left").filter("a is null or a < b"))
        self._rewrite_ledger(after.filter(F.col("city").isin(done)), done)

    def take_batch_results(self, responses: DataFrame, city: str) -> DataFrame:
        """Write records from batch responses, leaving out documents that have one.

        Returns one row: lines read, records written, lines set aside (kept below `quarantine`) and lines skipped.
        """
        marked = self._stored(extract.with_outcome(responses), "responses")
        fresh = self._stored(upkeep.batch_records(marked, self.records.read(), F.lit(city)), "batch-records")
        self._append_records(fresh)
        aside = marked.filter("outcome = 'quarantined'")
        aside.write.mode("append").parquet(f"{self.root}/quarantine")
        written = fresh.agg(F.count("*").alias("written"))
        counts = marked.agg(F.count("*").alias("lines"), F.count_if(F.col("outcome") == "quarantined").alias("quarantined"))
        row = counts.select("lines", written.scalar().alias("written"), "quarantined")
        return row.withColumn("skipped", F.col("lines") - F.col("written") - F.col("quarantined"))

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def reextract(
        self,
        texts: DataFrame,
        inventory: DataFrame,
        mode: str,
        geometry: DataFrame | None = None,
        responses: DataFrame | None = None,
    ) -> DataFrame:
        """Read documents of records without owner or architect again and fill empty fields; returns the counts."""
        again = upkeep.reextract_candidates(self.records.read(), inventory).select("pdf_path").distinct()
        ready = texts.join(again, "pdf_path", "left_semi").select(*texts.columns)
        found = self._stored(extract.extract_records(ready, mode, geometry, responses), "found")
        return self._change(found.select("pdf_path"), lambda table: upkeep.backfill(table, found))

    def correct(self, corrections: DataFrame) -> DataFrame:
        """Apply reviewed edits; returns the counts."""
        return self._change(corrections.select("pdf_path"), lambda table: upkeep.apply_corrections(table, corrections))

    def _change(self, documents: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Apply a change that concerns some documents; returns the counts over the whole table.

        Only the cities with such a document are computed, and only those in which a record changed are written again.
        """
        table = self.records.read()
        cities = _cities(table.join(key_set(documents, ["pdf_path"]), "pdf_path", "left_semi"))
        # Written once and read twice, for the new version and for the counts, instead of computed twice.
        result = self._stored(change(self.records.read(cities)), "changed")
        others = table.filter(~F.col("city").isin(cities)).withColumn("changed", F.lit(False))
        counts = self._stored(upkeep.review_summary(result.unionByName(others)), "summary")
        touched = _cities(result.filter("changed"))
        if touched:
            base, old, new = self.records.version(), self.records.read(touched), result.filter(F.col("city").isin(touched))
            self.facets.change(base, self.records.rewrite(new, touched), added=new, removed=old)
            self.records.clean()
        return counts

    def _append_records(self, rows: DataFrame) -> None:
        base = self.records.version()
        self.facets.change(base, self.records.append(rows), added=as_records(rows))

    def _facet_version(self) -> int:
        """The records' version, with its dictionary made if it was not kept."""
        version = self.records.version()
        if version not in self.facets.versions():
            self.facets.rebuild(self.records.read(), version)
        return version

    def choices(self) -> DataFrame:
        """Values to filter by, from the kept dictionary."""
        return self.facets.values(self._facet_version())

    def suggest(self, facet: str, needle: str = "", count: int = browse.SUGGESTIONS) -> DataFrame:
        """First values of a facet that contain the text as typed, from the kept dictionary."""
        return self.facets.suggest(self._facet_version(), facet, needle, count)

    def search(self, text: str, filters: browse.Filters | None = None) -> DataFrame:
        """Records in which any column holds the text; files that cannot hold it are not read. New files are indexed first."""
        self.search_index.refresh()
        return self.search_index.search(text, filters)

    def page(self, page: int, sort: browse.Sort | None = None, grouped: bool = False, size: int = browse.PAGE_SIZE) -> DataFrame:
        """One page of all records or addresses. The order is stored with the first page that is asked of a version and sort."""
        sort, version = sort or browse.Sort(), self.records.version()
        for old in store.numbered(self.spark, f"{self.root}/order", "table"):
            if old < version:
                store.remove(self.spark, f"{self.root}/order/table={old}")
        name = f"{sort.column}-{'up' if sort.ascending else 'down'}-{'-'.join(sort.tie_break)}{'-addresses' * grouped}"
        index = OrderIndex(self.spark, f"{self.root}/order/table={version}/{name}", sort, grouped)
        records = self.records.read()
        if not index.is_built():
            index.build(records)
        return index.page(records, page, size)

    def review(self) -> DataFrame:
        """Records that need a look."""
        return upkeep.review_queue(self.records.read())

    def cleanup(self, inventory: DataFrame) -> DataFrame:
        """Documents and folders no longer needed. Nothing is deleted."""
        return upkeep.cleanup_plan(self.records.read(), inventory)

    def redownload(self, inventory: DataFrame, links: DataFrame, folder: Column) -> DataFrame:
        """Documents to fetch again for records that need a look."""
        return upkeep.redownload_plan(self.records.read(), inventory, links, folder)

    def redownloaded(self, plan: DataFrame) -> DataFrame:
        """Point records to the documents that were fetched by a plan; returns the counts."""
        return self._change(plan.select("pdf_path"), lambda table: upkeep.redownloaded(table, plan))

    def merge(self, cities: DataFrame, path: str) -> DataFrame:
        """Write the configured cities' records, each with a city, as one table of CSV files; returns them."""
        rows = self.records.read()
        merged = upkeep.merge_cities(rows.withColumn("source", F.col("city")), cities)
        write_record_csv(merged, path)
        return merged

    def export(self, path: str, sort: browse.Sort | None = None, filters: browse.Filters | None = None) -> None:
        """Write what browsing shows as a CSV text in the order of the sort."""
        found = browse.filtered(self.records.read(), filters or browse.Filters())
        write_export(found, browse.total_order(found, sort or browse.Sort()), path)
