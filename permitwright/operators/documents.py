"""Documents of a file and pages of a document: which count as permits, and where they are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.functions.text import folder_name, is_blank, year_strict
from permitwright.operators.rank import key_set

# The permit term in a document type, the first year wanted, and the page width in mm plans start at.
PERMIT_TERM = "היתר בניה"
FIRST_YEAR = 2000
MAX_WIDTH_MM = 300.0


def is_permit_type(doc_type: Column) -> Column:
    return doc_type.contains(PERMIT_TERM)


def permit_documents(links: DataFrame, first_year: int = FIRST_YEAR) -> DataFrame:
    """Permit documents, without those known to be older. A date that cannot be read does not exclude one."""
    year = year_strict(F.col("date"))
    return links.filter(is_permit_type(F.col("doc_type")) & (year.isNull() | (year >= first_year)))


def width_mm(width_pt: Column) -> Column:
    return width_pt * 25.4 / 72


def permit_pages(geometry: DataFrame, max_width_mm: float = MAX_WIDTH_MM) -> DataFrame:
    """Pages narrow enough to be a form rather than a plan."""
    width = width_mm(F.col("width_pt"))
    return geometry.withColumn("width_mm", width).filter(F.col("width_mm") < max_width_mm)


def first_permit_page(geometry: DataFrame) -> DataFrame:
    """Lowest permit page of each document that has one."""
    return permit_pages(geometry).groupBy("pdf_path").agg(F.min("page_idx").alias("page_idx"))


def with_permit_page(documents: DataFrame, geometry: DataFrame) -> DataFrame:
    """Documents that have a permit page."""
    pages = key_set(permit_pages(geometry), ["pdf_path"])
    return documents.join(pages, "pdf_path", "left_semi").select(*documents.columns)


def _name_file(url: Column) -> Column:
    """Document name in a viewer link, NULL when the link has none."""
    return F.when(url.contains("Name_File="), F.regexp_extract(url, r"Name_File=([^&]*)", 1))


def document_folder(root: Column, address: Column, file_id: Column) -> Column:
    name = folder_name(address)
    return F.concat_ws("/", root, F.when(is_blank(name), F.concat(F.lit("file_"), file_id)).otherwise(name))


def document_targets(links: DataFrame, root: Column, prefer_entity_number: bool = True) -> DataFrame:
    """Storage path of each document: folder by address, file by entity number or else by the link's document name.

    Without `prefer_entity_number` the document name is always used. A link without a document name cannot be
    fetched: `target` is empty and `error` says why.
    """
    name = _name_file(F.col("url"))
    stem = F.when(~is_blank(F.col("entity_number")), F.col("entity_number")).otherwise(name) if prefer_entity_number else name
    path = F.concat(
        document_folder(root, F.col("address"), F.col("file_id")), F.lit("/permit_"), stem, F.lit(".pdf")
    )
    return links.withColumns(
        {
            "target": F.when(name.isNotNull(), path).otherwise(""),
            "error": F.when(name.isNull(), "no document name in link").otherwise(""),
        }
    )
