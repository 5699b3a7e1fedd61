"""Table shapes. Every record value is a string and a missing one is the empty string, never NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The record table's columns in file order.
RECORD_COLUMNS = [
    "city",
    "building_file_number",
    "permit_number",
    "address",
    "gush",
    "helka",
    "migrash",
    "city_plan",
    "owner",
    "architect",
    "structural_planner",
    "pdf_path",
    "date",
]

# Fields that carry a confidence, in file order.
CONFIDENCE_FIELDS = [
    "permit_number",
    "address",
    "gush",
    "helka",
    "migrash",
    "city_plan",
    "owner",
    "architect",
    "date",
]

CONFIDENCE_COLUMNS = [f"{name}_confidence" for name in CONFIDENCE_FIELDS]
ALL_COLUMNS = RECORD_COLUMNS + CONFIDENCE_COLUMNS

RECORD_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RECORD_COLUMNS])
FULL_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ALL_COLUMNS])

DOC_META_TYPE = T.ArrayType(
    T.StructType([T.StructField("date", T.StringType()), T.StructField("entity_number", T.StringType())])
)
LEDGER_ENTRY_TYPE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("pdfs", T.ArrayType(T.StringType())),
        T.StructField("doc_meta", DOC_META_TYPE),
        T.StructField("error", T.StringType()),
    ]
)
LEDGER_SCHEMA = T.StructType(
    [T.StructField("city", T.StringType()), T.StructField("file_id", T.StringType()), *LEDGER_ENTRY_TYPE.fields]
)
LEDGER_COLUMNS = LEDGER_SCHEMA.fieldNames()

# The states of a ledger entry.
PENDING = "pending"
DOWNLOADED = "downloaded"
PROCESSED = "processed"
SKIPPED = "skipped"
ERROR = "error"


def as_records(df: DataFrame, columns: list[str] = ALL_COLUMNS) -> DataFrame:
    """Project to a fixed column list, absent columns and NULLs as empty strings."""
    present = set(df.columns)
    return df.select(
        *[
            (F.coalesce(F.col(name).cast("string"), F.lit("")) if name in present else F.lit("")).alias(name)
            for name in columns
        ]
    )
