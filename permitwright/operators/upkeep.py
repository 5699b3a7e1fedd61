"""Keeping record tables complete, correct and merged. Every operator is a function from tables to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.functions.text import detail_path, is_blank, is_complete, is_valid_field, strip
from permitwright.operators.documents import document_targets, is_permit_type, with_permit_page
from permitwright.operators.extract import first_answers, with_outcome
from permitwright.operators.rank import join_side, keep_first
from permitwright.schema import as_records

# Fields a second extraction may fill, fields a reviewer may correct, and the price of a batch page.
BACKFILL_FIELDS = [
    "owner",
    "architect",
    "structural_planner",
    "gush",
    "helka",
    "migrash",
    "city_plan",
    "permit_number",
]
CORRECTED_FIELDS = ["owner", "architect"]
PRICE_PER_PAGE = 0.006


def complete() -> Column:
    return is_complete(F.col("owner"), F.col("architect"))


def has_document(records: DataFrame, inventory: DataFrame) -> DataFrame:
    return records.join(inventory.select(F.col("path").alias("pdf_path")), "pdf_path", "left_semi").select(*records.columns)


def without_document(records: DataFrame, inventory: DataFrame) -> DataFrame:
    return records.join(inventory.select(F.col("path").alias("pdf_path")), "pdf_path", "left_anti").select(*records.columns)


def first_records(records: DataFrame, order: list[Column]) -> DataFrame:
    """One record per document, the first written."""
    return keep_first(records, ["pdf_path"], order)


def new_records(candidates: DataFrame, existing: DataFrame, order: list[Column]) -> DataFrame:
    """Candidates whose document has no record, each document once.

    Both sides are reduced to one row per document before they are shuffled, and one shuffle serves reducing and
    joining.
    """
    known = existing.select("pdf_path").distinct()
    return first_records(candidates, order).join(known, "pdf_path", "left_anti").select(*candidates.columns)


def redownloaded(records: DataFrame, plan: DataFrame) -> DataFrame:
    """Records with the documents of a carried-out plan: pdf_path becomes the new target. `changed` marks them."""
    done = keep_first(plan.filter(F.col("target") != "").select("city", "pdf_path", "target"), ["city", "pdf_path"], [])
    joined = records.join(done, ["city", "pdf_path"], "left")
    path = F.coalesce("target", "pdf_path")
    return joined.select(
        *[path.alias(c) if c == "pdf_path" else F.col(c) for c in records.columns], F.col("target").isNotNull().alias("changed")
    )


def batch_records(responses: DataFrame, existing: DataFrame, city: Column) -> DataFrame:
    """Records of the documents that batch responses answer and that have none, one each (see `first_answers`).

    Responses that cannot be read as an answer, or name no document, give none.
    """
    usable = with_outcome(responses.drop("error", "outcome")).filter("outcome = 'ok'")
    found = as_records(first_answers(usable).withColumnRenamed("record_id", "pdf_path")).withColumn("city", city)
    return found.join(existing.select("pdf_path").distinct(), "pdf_path", "left_anti").select(*found.columns)


def review_queue(records: DataFrame) -> DataFrame:
    """Records that are not complete."""
    return records.filter(~complete())


def reextract_candidates(records: DataFrame, inventory: DataFrame) -> DataFrame:
    """Records with an empty owner or architect whose document is stored."""
    return has_document(records.filter(is_blank(F.col("owner")) | is_blank(F.col("architect"))), inventory)


def backfill(records: DataFrame, extracted: DataFrame) -> DataFrame:
    """Fill empty fields from a second extraction; of a document read twice the first by its values counts.

    `changed` marks records that gained something.
    """
    again = keep_first(extracted.select("pdf_path", *BACKFILL_FIELDS), ["pdf_path"], [])
    again = again.select("pdf_path", *[F.col(name).alias(f"_{name}") for name in BACKFILL_FIELDS])
    takes = {
        name: is_blank(F.col(name)) & (F.coalesce(F.col(f"_{name}"), F.lit("")) != "") for name in BACKFILL_FIELDS
    }
    changed = F.lit(False)
    for test in takes.values():
        changed = changed | test
    joined = records.join(again, "pdf_path", "left")
    return joined.select(
        *[
            (F.when(takes[name], F.col(f"_{name}")).otherwise(F.col(name)).alias(name) if name in takes else F.col(name))
            for name in records.columns
        ],
        changed.alias("changed"),
    )


def apply_corrections(records: DataFrame, corrections: DataFrame) -> DataFrame:
    """Reviewed values replace owner and architect where these are invalid and the record was not skipped.

    Edits are stripped, and an empty edit keeps the field. Of several reviews of a document the last counts, by `seq` if
    there is that column, then by its values. `changed` marks corrected records.
    """
    stripped = [strip(F.coalesce(name, F.lit(""))).alias(name) for name in CORRECTED_FIELDS]
    order = ["seq"] if "seq" in corrections.columns else []
    last = keep_first(corrections.select("pdf_path", *stripped, "action", *order), ["pdf_path"], [-F.col(c) for c in order])
    edits = last.select(
        "pdf_path", *[F.col(name).alias(f"_{name}") for name in CORRECTED_FIELDS], F.col("action").alias("_action")
    )
    takes = {
        name: (F.coalesce(F.col("_action"), F.lit("skip")) == "save")
        & ~is_valid_field(F.col(name))
        & (F.coalesce(F.col(f"_{name}"), F.lit("")) != "")
        for name in CORRECTED_FIELDS
    }
    joined = records.join(edits, "pdf_path", "left")
    return joined.select(
        *[
            (F.when(takes[name], F.col(f"_{name}")).otherwise(F.col(name)).alias(name) if name in takes else F.col(name))
            for name in records.columns
        ],
        (takes["owner"] | takes["architect"]).alias("changed"),
    )


def review_summary(corrected: DataFrame) -> DataFrame:
    """Counts over a corrected or backfilled table."""
    return corrected.agg(
        F.count("*").alias("records"),
        F.count_if(F.col("changed")).alias("changed"),
        F.count_if(complete()).alias("complete"),
        F.count_if(~complete()).alias("incomplete"),
    )


def cleanup_plan(records: DataFrame, inventory: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """What a cleanup would remove: `delete_document` for stored documents of complete records, and `remove_folder`
    for folders that lose a document and are empty then. Reports only.

    A document may have several records; the first complete one already removes it. `files` lists all files of the store (path,
    folder), whatever their kind; a folder stays if anything else than removed documents is in it. Without it the inventory
    counts as all there is.
    """
    finished = records.filter(complete()).select(F.col("pdf_path").alias("path")).distinct().withColumn("_done", F.lit(True))
    stays = F.col("_done").isNull()
    # One join for both: a stored document speaks for itself and for its folder, and what nothing keeps is removed.
    votes = F.array(
        F.struct(F.lit("delete_document").alias("action"), F.col("path").alias("path"), stays.alias("stays")),
        F.struct(F.lit("remove_folder").alias("action"), F.col("folder").alias("path"), stays.alias("stays")),
    )
    stored = inventory.join(finished, "path", "left").select(F.inline(votes))
    if files is not None:
        others = files.join(inventory.select("path"), "path", "left_anti")
        stored = stored.unionByName(others.select(F.lit("remove_folder").alias("action"), F.col("folder").alias("path"), F.lit(True).alias("stays")))
    kept = stored.groupBy("action", "path").agg(F.count_if(F.col("stays")).alias("kept"))
    return kept.filter(F.col("kept") == 0).select("action", "path")


def cleanup_summary(records: DataFrame, inventory: DataFrame) -> DataFrame:
    """deleted: stored documents of complete records. kept: incomplete records, stored or not."""
    kept = records.agg(F.count_if(~complete()).alias("kept"))
    finished = records.filter(complete()).select(F.col("pdf_path").alias("path"))
    deleted = inventory.join(finished, "path", "left_semi").agg(F.count("*").alias("deleted"))
    return kept.select(deleted.scalar().alias("deleted"), "kept")


def redownload_plan(records: DataFrame, inventory: DataFrame, links: DataFrame, root: Column) -> DataFrame:
    """For incomplete records without a stored document: the first permit document of their file and where it goes.

    A file is known by its city and number.
    """
    missing = without_document(records.filter(~complete() & ~is_blank(F.col("building_file_number"))), inventory)
    first = keep_first(
        links.filter(is_permit_type(F.col("doc_type"))).select("city", "file_id", "pos", "url", "entity_number", "date"),
        ["city", "file_id"],
        [F.col("pos"), F.col("url")],
    ).select("city", "file_id", "url", "entity_number")
    wanted = missing.select("city", "pdf_path", "address", F.col("building_file_number").alias("file_id"))
    found = wanted.join(join_side(first, ["city", "file_id"]), ["city", "file_id"])
    planned = document_targets(found, root, prefer_entity_number=False)
    return planned.select(
        "city", "pdf_path", "file_id", detail_path(F.col("file_id")).alias("page"), "url", "target", "error"
    )


def merge_cities(records: DataFrame, cities: DataFrame) -> DataFrame:
    """All configured cities' records, each with a city, and the city's place in the list.

    `records` carries `source`, the city folder it was read from. The city list is small, but it is joined without a
    hint: Spark broadcasts it as long as its measured size allows.
    """
    names = cities.select(F.col("subdomain").alias("source"), F.col("name").alias("_name"), "ord")
    city = F.when(is_blank(F.col("city")), F.col("_name")).otherwise(F.col("city"))
    return records.join(names, "source").withColumn("city", city).drop("_name")


def normalise_cities(records: DataFrame, cities: DataFrame) -> DataFrame:
    """Records whose city is a configured name or subdomain get the subdomain; other values stay."""
    either = F.explode(F.array_distinct(F.array("subdomain", "name")))
    known = keep_first(cities.select(either.alias("city"), "subdomain"), ["city"], [])
    city = F.coalesce(F.col("subdomain"), F.col("city"))
    joined = records.join(join_side(known, ["city"]), "city", "left").withColumn("city", city)
    return joined.select(*records.columns)


def records_per_city(records: DataFrame) -> DataFrame:
    return records.groupBy("city").agg(F.count("*").alias("records"))


def batch_summary(documents: DataFrame, geometry: DataFrame, responses: DataFrame, existing: DataFrame) -> DataFrame:
    """One row for a batch run: documents, those with a permit page, the price, and records written or skipped.

    Three one-row aggregates over different tables, put together as scalar subqueries.
    """
    found = documents.agg(F.count("*").alias("documents"))
    valid = with_permit_page(documents, geometry).agg(F.count("*").alias("with_permit_page"))
    answers = responses.select(F.col("record_id").alias("pdf_path"))
    answered = answers.agg(F.count("*").alias("responses"))
    known = existing.select("pdf_path").distinct()
    written = answers.distinct().join(known, "pdf_path", "left_anti").agg(F.count("*").alias("written"))
    row = found.select("documents", valid.scalar().alias("with_permit_page"), answered.scalar().alias("responses"),
                       written.scalar().alias("written"))
    return row.select(
        "documents",
        "with_permit_page",
        (F.col("with_permit_page") * PRICE_PER_PAGE).alias("price"),
        "written",
        (F.col("responses") - F.col("written")).alias("skipped"),
    )


