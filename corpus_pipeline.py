"""Documents to training sequences: stages that each call one operator and hand their rows on as Parquet."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permitwright.llm.best_fit import cut_documents, pack
from permitwright.llm.common import prepared, saved
from permitwright.llm.line_dedup import drop_boilerplate
from permitwright.llm.ngram_join import near_duplicates
from permitwright.llm.quality import learn_quality, with_quality
from permitwright.llm.queries import ACCEPTED, digests, held_out, table
from permitwright.llm.toxicity import learn_lexicon, without_toxic

# Tests a stage's SQL would have to express are in Python (fitted models, packing); each stage is tested by itself.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon does not call toxic."""
    prepared(spark)
    lexicon = learn_lexicon(docs, table(spark, sf_dir, "labels").where(~held_out(4, 2)))
    return without_toxic(docs, lexicon, ACCEPTED)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model does not reject."""
    prepared(spark)
    model = learn_quality(docs, table(spark, sf_dir, "labels").where(~held_out(5, 0)))
    return with_quality(docs, model, ACCEPTED)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their source's boilerplate lines; equal texts of a source count once, so copies keep their own lines."""
    prepared(spark)
    return drop_boilerplate(docs, "source", "text", once_per_text=True).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share most of their five-word shingles, directly or by way of others, the one with the smallest id.

    The ids to drop are written down, so that Spark knows their size before it joins them to the texts.
    """
    prepared(spark)
    groups = near_duplicates(docs, words=5, percent=80)
    dropped = saved(groups.where("component_id != doc_id").select(F.col("doc_id").alias("_copy")).distinct(), "copies")
    return docs.join(dropped, F.col("doc_id") == F.col("_copy"), "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document's ids lies in training sequences, with a checksum of the piece."""
    prepared(spark)
    pieces = cut_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pack(saved(digests(pieces), "pieces"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram jaccard join", one_of_each),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = saved(stage(spark, rows, sf_dir), f"stage-{name.replace(' ', '-')}")
    return rows
