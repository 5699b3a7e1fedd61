"""From document texts and model responses to records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.functions.patterns import SET_A, SET_B, is_permit_text, label_matches, matched_values, pattern_values
from permitwright.functions.responses import RESPONSE_FIELDS, parse_responses, response_problem
from permitwright.functions.text import is_blank
from permitwright.operators.documents import with_permit_page
from permitwright.operators.rank import keep_first
from permitwright.schema import ALL_COLUMNS, CONFIDENCE_COLUMNS, CONFIDENCE_FIELDS, RECORD_COLUMNS, as_records

CLOUD = "cloud"
LOCAL = "local"
TEXT_ONLY = "tesseract"
SKIP = "skip"

# Where a record column is filled from a field of another name.
_FIELD_OF_COLUMN = {"building_file_number": "building_file"}
_FILLED_LATER = {"city", "pdf_path"}


def assemble_lines(lines: DataFrame) -> DataFrame:
    """A document's lines as one text, in line order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    grouped = lines.groupBy("pdf_path").agg(ordered.alias("_lines"))
    return grouped.select("pdf_path", F.array_join(F.col("_lines.line"), "\n").alias("ocr_text"))


def join_texts(page_text: Column, area_text: Column) -> Column:
    """Page text followed by the text of an area read again."""
    return F.concat_ws("\n", page_text, area_text)


def _record_values(values: dict[str, Column]) -> dict[str, Column]:
    return {
        name: values.get(_FIELD_OF_COLUMN.get(name, name), F.lit(""))
        for name in RECORD_COLUMNS
        if name not in _FILLED_LATER
    }


def _either(test: Column, yes: dict[str, Column], no: dict[str, Column]) -> dict[str, Column]:
    return {name: F.when(test, yes[name]).otherwise(no[name]) for name in yes}


def extract_records(
    texts: DataFrame,
    mode: str,
    geometry: DataFrame | None = None,
    responses: DataFrame | None = None,
    local_engine: bool = True,
) -> DataFrame:
    """Records (22 columns, city empty) from document texts.

    `texts` has pdf_path, ocr_text (first permit page) and, optionally, name_text (the name area).
    cloud      the document's response; where the call failed, so no response is there, the first pattern set
    local      the second pattern set, or the first when the local engine is not there
    tesseract  the first pattern set
    skip       nothing
    The first pattern set applies only to texts that look like a permit, and gives no confidences. cloud and local
    need a permit page.

    A document gets one record: of repeated texts the first by its values, of repeated responses the first that says
    something. Fields are searched where the text is scanned; what is shuffled is the fields, never a text.
    """
    if mode not in (CLOUD, LOCAL, TEXT_ONLY, SKIP):
        raise ValueError(f"unknown mode: {mode}")
    if mode == SKIP:
        return as_records(texts.select("pdf_path").filter(F.lit(False)))
    if mode in (CLOUD, LOCAL):
        if geometry is None:
            raise ValueError(f"mode {mode} needs page geometry")

    full = join_texts(F.col("ocr_text"), F.col("name_text")) if "name_text" in texts.columns else F.col("ocr_text")
    gate = is_permit_text(F.col("ocr_text"))
    from_patterns = _record_values(pattern_values(full, SET_A))
    nothing = {name: F.lit("") for name in CONFIDENCE_FIELDS}

    if mode == TEXT_ONLY or (mode == LOCAL and not local_engine):
        found = _one_per_document(_searched(texts.filter(gate), from_patterns, nothing))
        return as_records(found if mode == TEXT_ONLY else with_permit_page(found, geometry))
    if mode == LOCAL:
        rows = texts.withColumn("_match", label_matches(F.col("ocr_text"), SET_B))
        values, confidences = matched_values(F.col("_match"), SET_B)
        found = _searched(rows, _record_values(values), confidences)
        return as_records(with_permit_page(_one_per_document(found), geometry))

    if responses is None:
        raise ValueError("mode cloud needs responses")
    fallback = _one_per_document(texts.select("pdf_path", gate.alias("_permit"), *_aliased(from_patterns, "_p_")))
    answers = first_answers(responses).withColumnRenamed("record_id", "pdf_path").withColumn("_answered", F.lit(True))
    answered = F.col("_answered").isNotNull()
    # One pass: a document takes one of the two ways, so no join or scan is done twice.
    rows = with_permit_page(fallback, geometry).join(answers, "pdf_path", "left").filter(answered | F.col("_permit"))
    found = _record_values({name: F.col(name) for name in RESPONSE_FIELDS})
    certain = {name: F.col(f"{name}_confidence") for name in CONFIDENCE_FIELDS}
    values = _either(answered, found, {name: F.col(f"_p_{name}") for name in from_patterns})
    return as_records(_searched(rows, values, _either(answered, certain, nothing)))


def _aliased(values: dict[str, Column], prefix: str = "") -> list[Column]:
    return [column.alias(prefix + name) for name, column in values.items()]


def _searched(rows: DataFrame, values: dict[str, Column], confidences: dict[str, Column]) -> DataFrame:
    certain = [confidences[name].alias(f"{name}_confidence") for name in CONFIDENCE_FIELDS]
    return rows.select("pdf_path", *_aliased(values), *certain)


def _one_per_document(found: DataFrame) -> DataFrame:
    return keep_first(found, ["pdf_path"], [])


def says_something() -> Column:
    """Whether a parsed response has a value."""
    return reduce(Column.__or__, [F.col(f"{name}_confidence") == "high" for name in CONFIDENCE_FIELDS])


def first_answers(responses: DataFrame) -> DataFrame:
    """One parsed response per document: the first that says something, else the first.

    The order is that of `read_responses` (file, block, place) where these columns are there, then that of the values.
    """
    order = [c for c in ("file", "block", "place") if c in responses.columns]
    parsed = parse_responses(responses.filter(F.col("record_id").isNotNull()), "response_text", ["record_id", *order])
    first = keep_first(parsed, ["record_id"], [~says_something(), *[F.col(c) for c in order]])
    return first.drop(*order)


def response_records(responses: DataFrame) -> DataFrame:
    """Records from batch responses: city and file number stay empty. Lines without a document's name give none."""
    parsed = parse_responses(responses.filter(F.col("record_id").isNotNull()), "response_text", ["record_id"])
    return as_records(parsed.withColumnRenamed("record_id", "pdf_path"))


def stamp_records(records: DataFrame, work: DataFrame) -> DataFrame:
    """Crawl's rule: city, file number and date come from the work item, the address only where none was extracted.

    `work` has pdf_path, city, file_id, address and date. Records without a work item are not written.
    """
    item = work.select(
        "pdf_path", *[F.col(name).alias(f"_{name}") for name in ("city", "file_id", "address", "date")]
    )
    address = F.when(is_blank(F.col("address")), F.col("_address")).otherwise(F.col("address"))
    stamped = records.join(item, "pdf_path").withColumns(
        {
            "city": F.col("_city"),
            "building_file_number": F.col("_file_id"),
            "date": F.col("_date"),
            "address": address,
        }
    )
    return stamped.select(*[name for name in ALL_COLUMNS if name in records.columns])


def low_confidence_count(prefix: str = "") -> Column:
    """How many of a record's confidences are low or none."""
    total = F.lit(0)
    for name in CONFIDENCE_COLUMNS:
        total = total + F.col(prefix + name).isin("low", "none").cast("int")
    return total


def with_outcome(responses: DataFrame) -> DataFrame:
    """Responses with `error`, empty where the response is usable, and `outcome` ok or quarantined.

    Broken JSON counts as an empty answer, so it is kept; what could not be read as an answer at all, or names no
    document, is set aside.
    """
    problem = response_problem(F.col("response_text"))
    if "record_id" in responses.columns:
        problem = F.when(is_blank(F.coalesce("record_id", F.lit(""))), "no_document").otherwise(problem)
    marked = responses.withColumn("error", problem)
    bad = F.col("error").isin("no_document", "not_an_object", "fence_without_body")
    return marked.withColumn("outcome", F.when(bad, "quarantined").otherwise("ok"))
