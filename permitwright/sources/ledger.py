"""The progress ledger on storage: one JSON object per file and line, and the older one-document-per-city form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from permitwright.schema import DOC_META_TYPE, LEDGER_COLUMNS, LEDGER_ENTRY_TYPE, PENDING
from permitwright.sources.tables import source_folder


def _entry_columns(entry: Column) -> list[Column]:
    """Entry fields with their defaults; an absent error stays NULL."""
    text = {name: F.coalesce(entry.getField(name), F.lit("")) for name in ("url", "address")}
    return [
        text["url"].alias("url"),
        text["address"].alias("address"),
        F.coalesce(entry.getField("status"), F.lit(PENDING)).alias("status"),
        F.coalesce(entry.getField("pdfs"), F.array().cast("array<string>")).alias("pdfs"),
        F.coalesce(entry.getField("doc_meta"), F.array().cast(DOC_META_TYPE)).alias("doc_meta"),
        entry.getField("error").alias("error"),
    ]


def write_ledger(ledger: DataFrame, path: str) -> None:
    """One line per file, in one folder per city. No line holds more than one file, so no city is ever gathered."""
    entry = F.to_json(F.struct(*LEDGER_ENTRY_TYPE.fieldNames()), {"ignoreNullFields": "false"})
    lines = ledger.select("city", "file_id", entry.alias("entry")).hint("rebalance", "city")
    lines.write.partitionBy("city").json(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger that `write_ledger` wrote. Unknown entry fields are ignored, absent ones get their defaults."""
    lines = spark.read.schema("file_id string, entry string, city string").json(path)
    parsed = lines.select(
        F.coalesce("city", F.lit("")).alias("city"), "file_id", F.from_json("entry", LEDGER_ENTRY_TYPE).alias("_entry")
    )
    return parsed.select("city", "file_id", *_entry_columns(F.col("_entry")))


def read_state_documents(spark: SparkSession, root: str, name: str = "state.json") -> DataFrame:
    """Older ledgers: one JSON document per city with a map of all its files, the city being the folder's name.

    Such a document can only be parsed as a whole, so this is for taking over existing ledgers once.
    """
    document = T.StructType([T.StructField("building_files", T.MapType(T.StringType(), LEDGER_ENTRY_TYPE))])
    texts = spark.read.text(f"{root.rstrip('/')}/*/{name}", wholetext=True)
    maps = texts.select(source_folder(root).alias("city"), F.from_json("value", document).alias("_doc"))
    entries = maps.select("city", F.explode("_doc.building_files").alias("file_id", "_entry"))
    return entries.select("city", "file_id", *_entry_columns(F.col("_entry"))).select(*LEDGER_COLUMNS)
