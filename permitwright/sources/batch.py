"""Batch inference files: the requests to send and the responses that come back, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permitwright.functions.responses import RESPONSE_FIELDS

# The request envelope.
REQUEST_VERSION = "bedrock-2023-05-31"
MAX_TOKENS = 1024
MEDIA_TYPE = "image/png"

# Fixed value: ending of response files; other files below the folder are ignored.
RESPONSE_FILES = "*.jsonl.out"

DEFAULT_PROMPT = (
    "The image shows a building permit. Answer with one JSON object and nothing else, with the members "
    + ", ".join(RESPONSE_FIELDS)
    + ". Use null for anything that cannot be read."
)

_ENVELOPE = "recordId string, modelOutput struct<content: array<struct<text: string>>>"


def batch_requests(pages: DataFrame, prompt: str = DEFAULT_PROMPT) -> DataFrame:
    """Request lines (`value`) from pdf_path and the binary `payload` of its first permit page."""
    image = F.struct(
        F.lit("image").alias("type"),
        F.struct(
            F.lit("base64").alias("type"), F.lit(MEDIA_TYPE).alias("media_type"), F.base64("payload").alias("data")
        ).alias("source"),
    )
    text = F.struct(F.lit("text").alias("type"), F.lit(prompt).alias("text"))
    # The two content parts have different members, so each is rendered on its own and spliced into the message.
    content = F.concat(F.lit("["), F.to_json(image), F.lit(","), F.to_json(text), F.lit("]"))
    head = F.to_json(F.struct(F.col("pdf_path").alias("recordId")))
    line = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.lit(f',"modelInput":{{"anthropic_version":"{REQUEST_VERSION}","max_tokens":{MAX_TOKENS},'),
        F.lit('"messages":[{"role":"user","content":'),
        content,
        F.lit("}]}}"),
    )
    return pages.select(line.alias("value"))


def write_requests(requests: DataFrame, path: str) -> None:
    requests.write.text(path)


def read_responses(spark: SparkSession, path: str, files: str = RESPONSE_FILES) -> DataFrame:
    """record_id, response_text, the raw `line` and where it stands: file, block and place in it.

    record_id is NULL where a line is no envelope.

    A response without content reads as an empty object.
    """
    lines = spark.read.option("pathGlobFilter", files).option("recursiveFileLookup", "true").text(path)
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    parsed = placed.filter(F.length("value") > 0).withColumn("_e", F.from_json("value", _ENVELOPE))
    return parsed.select(
        F.col("_e.recordId").alias("record_id"),
        F.coalesce(F.get(F.col("_e.modelOutput.content"), F.lit(0)).getField("text"), F.lit("{}")).alias("response_text"),
        F.col("value").alias("line"),
        "file",
        "block",
        "place",
    )
