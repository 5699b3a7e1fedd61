"""Progress ledger: one entry per (city, file_id)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.operators.rank import join_side, keep_first, key_set
from permitwright.schema import DOC_META_TYPE, DOWNLOADED, ERROR, LEDGER_COLUMNS, PENDING, PROCESSED, SKIPPED

KEY = ["city", "file_id"]

# Events that change an entry, and the state each leaves.
LISTED = "listed"
MARK_STATES = [DOWNLOADED, PROCESSED, SKIPPED, ERROR]


def new_listing_entries(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files the ledger does not know, each once, the first listing counting."""
    once = keep_first(listing, KEY, [F.col("pos")])
    return once.join(ledger.select(*KEY), KEY, "left_anti").select(*listing.columns)


def new_entries(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """A pending entry for each listed file the ledger does not know."""
    return new_listing_entries(listing, ledger).select(
        *KEY,
        "url",
        "address",
        F.lit(PENDING).alias("status"),
        F.array().cast("array<string>").alias("pdfs"),
        F.array().cast(DOC_META_TYPE).alias("doc_meta"),
        F.lit(None).cast("string").alias("error"),
    )


def merge_listing(ledger: DataFrame, listing: DataFrame) -> DataFrame:
    """Ledger plus the new entries; existing entries stay as they are."""
    return ledger.select(*LEDGER_COLUMNS).unionByName(new_entries(listing, ledger))


def ledger_documents(ledger: DataFrame) -> DataFrame:
    """One row per document of an entry, with the date at the same place in its metadata, empty where that is shorter."""
    documents = ledger.select(*KEY, "address", "status", "doc_meta", F.posexplode("pdfs").alias("pos", "pdf_path"))
    meta = F.get("doc_meta", F.col("pos"))
    return documents.select(
        *KEY, "address", "status", "pos", "pdf_path", F.coalesce(meta.getField("date"), F.lit("")).alias("date")
    )


def pending_extraction(ledger: DataFrame, records: DataFrame) -> DataFrame:
    """Documents of downloaded entries that have no record yet."""
    documents = ledger_documents(ledger.filter(F.col("status") == DOWNLOADED)).drop("status")
    return documents.join(key_set(records, ["pdf_path"]), "pdf_path", "left_anti").select(*documents.columns)


def mark_processed(ledger: DataFrame, records: DataFrame, failures: DataFrame | None = None, literal: bool = False) -> DataFrame:
    """Downloaded entries become processed once every document has a record or a recorded failure.

    `literal` marks them all, whether their documents were read or not.
    """
    if literal:
        done = F.col("status") == DOWNLOADED
        return ledger.withColumn("status", F.when(done, PROCESSED).otherwise(F.col("status")))
    settled = records.select("pdf_path")
    if failures is not None:
        settled = settled.unionByName(failures.select("pdf_path"))
    documents = ledger_documents(ledger.filter(F.col("status") == DOWNLOADED))
    open_documents = documents.join(key_set(settled, ["pdf_path"]), "pdf_path", "left_anti")
    unfinished = open_documents.select(*KEY).distinct().withColumn("_open", F.lit(True))
    done = (F.col("status") == DOWNLOADED) & F.col("_open").isNull()
    return (
        ledger.join(unfinished, KEY, "left")
        .withColumn("status", F.when(done, PROCESSED).otherwise(F.col("status")))
        .select(*ledger.columns)
    )


def with_status(ledger: DataFrame, *states: str) -> DataFrame:
    return ledger.filter(F.col("status").isin(*states))


def retry_errors(ledger: DataFrame) -> DataFrame:
    """Failed entries become pending again and lose their error."""
    failed = F.col("status") == ERROR
    return ledger.withColumns(
        {
            "error": F.when(failed, F.lit(None).cast("string")).otherwise(F.col("error")),
            "status": F.when(failed, PENDING).otherwise(F.col("status")),
        }
    )


def progress(ledger: DataFrame) -> DataFrame:
    """Entries per status, and in total."""
    return with_total(ledger.groupBy("status").agg(F.count("*").alias("files")))


def with_total(counts: DataFrame) -> DataFrame:
    """Counts per status, and their sum: of the few counts, not counted again over the ledger."""
    total = F.explode(F.array(F.col("status"), F.lit("total")))
    return counts.select(total.alias("status"), "files").groupBy("status").agg(F.sum("files").alias("files"))


def status_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(city, status, files): what a change of entries adds to the counts; an entry leaves one status and enters another."""
    left = before.select("city", "status", F.lit(-1).cast("bigint").alias("files"))
    entered = after.select("city", "status", F.lit(1).cast("bigint").alias("files"))
    return summed(left.unionByName(entered))


def summed(counts: DataFrame) -> DataFrame:
    """Counts and changes of counts, added up; what nothing is left of goes."""
    added = counts.groupBy("city", "status").agg(F.sum("files").alias("files"))
    return added.filter("files != 0")


def city_overview(cities: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every configured city, with totals where a ledger exists and NULL where none does."""
    totals = ledger.groupBy("city").agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == PROCESSED).alias("processed")
    )
    return cities.join(totals, cities["subdomain"] == totals["city"], "left").drop("city")


def mark_aggregates() -> list[Column]:
    """Aggregates that stand for a file's whole history of marks; they combine in any order.

    Marks have city, file_id, ts, event_id, mark, url, address, pdfs, doc_meta and error. Each part of an entry has a last
    writer of its own: url and address the first listing, status any later mark, documents a download or a processing that
    names some, their metadata a download, the message an error.
    """
    at = [F.col("ts"), F.col("event_id")]
    mark = F.col("mark")

    def last(when: Column, *payload: str) -> Column:
        return F.max(F.when(when, F.struct(*at, *payload)))

    named = (mark == DOWNLOADED) | ((mark == PROCESSED) & (F.coalesce(F.size("pdfs"), F.lit(0)) > 0))
    return [
        F.min(F.when(mark == LISTED, F.struct(*at, "url", "address"))).alias("listed"),
        last(mark.isin(*MARK_STATES), "mark").alias("marked"),
        last(named, "pdfs").alias("named"),
        last(mark == DOWNLOADED, "doc_meta").alias("described"),
        last(mark == ERROR, "error").alias("failed"),
    ]


def _entry(base: dict[str, Column], counts: Callable[[str], Column]) -> list[Column]:
    """An entry's fields: of each the last writer's value if that mark counts, else the one it began with."""
    def field(writer: str, value: str, name: str) -> Column:
        return F.when(counts(writer), F.col(f"{writer}.{value}")).otherwise(base[name]).alias(name)

    return [
        base["url"].alias("url"),
        base["address"].alias("address"),
        field("marked", "mark", "status"),
        F.coalesce(field("named", "pdfs", "pdfs"), F.array().cast("array<string>")).alias("pdfs"),
        F.coalesce(field("described", "doc_meta", "doc_meta"), F.array().cast(DOC_META_TYPE)).alias("doc_meta"),
        field("failed", "error", "error"),
    ]


def _new_entry() -> tuple[dict[str, Column], Callable[[str], Column]]:
    """An entry begins pending with its first listing. Marks before that found no entry and are lost."""
    base = {
        "url": F.coalesce("listed.url", F.lit("")),
        "address": F.coalesce("listed.address", F.lit("")),
        "status": F.lit(PENDING),
        "pdfs": F.array().cast("array<string>"),
        "doc_meta": F.array().cast(DOC_META_TYPE),
        "error": F.lit(None).cast("string"),
    }

    def after(writer: str) -> Column:
        at = F.struct(F.col(f"{writer}.ts"), F.col(f"{writer}.event_id"))
        return F.col(writer).isNotNull() & (at > F.struct("listed.ts", "listed.event_id"))

    return base, after


def replayed_entries(aggregated: DataFrame) -> DataFrame:
    """The entry of every file that was ever listed."""
    listed = aggregated.filter(F.col("listed").isNotNull())
    return listed.select(*KEY, *_entry(*_new_entry()))


def histories(activity: DataFrame) -> DataFrame:
    """One row per marked file. Marks without a city are of the city without a name, as entries are."""
    return activity.withColumn("city", F.coalesce("city", F.lit(""))).groupBy(*KEY).agg(*mark_aggregates())


def replay(activity: DataFrame) -> DataFrame:
    """State of every file after all its marks, from nothing."""
    return replayed_entries(histories(activity))


def marked_entries(ledger: DataFrame, activity: DataFrame) -> DataFrame:
    """The entries that marks concern, after them. Marks are later than what the ledger says; files that it does not know
    begin with their first listing, and without one stay unknown."""
    marked = join_side(histories(activity), KEY)
    known = ledger.join(marked, KEY).select(
        *KEY, *_entry({name: F.col(name) for name in LEDGER_COLUMNS if name not in KEY}, lambda writer: F.col(writer).isNotNull()))
    unknown = marked.join(ledger.select(*KEY), KEY, "left_anti")
    return known.unionByName(replayed_entries(unknown))
