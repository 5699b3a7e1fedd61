"""Documents and ledger marks as streams.

State that must outlive a run is in tables in the shared folder: the record table tells which documents are done, so
a restart goes on where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from permitwright.operators.ledger import KEY, histories, replayed_entries, status_changes, summed, with_total
from permitwright.operators.rank import key_set
from permitwright.schema import LEDGER_COLUMNS, LEDGER_SCHEMA
from permitwright.session import fresh_dir
from permitwright.sources import store
from permitwright.sources.tables import RecordTable

# How long a stream remembers which documents it has seen. Repeats that come later meet the record table instead.
RETENTION = "7 days"
# By how much the clocks of the machines that run one stream after another may differ.
CLOCKS = "1 hour"


def document_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """Text tables arriving as Parquet files in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def arrivals(texts: DataFrame, order: list[str], retention: str = RETENTION) -> DataFrame:
    """Every arriving row's place (pdf_path, order, file, row), and one more row, with `fresh` set, per document that has not
    arrived within `retention`.

    `texts` is a stream of Parquet files, read as one source. A document's time is that of its batch, so none comes late but by
    clocks that differ by more than CLOCKS. The state per document is its key and when it may go. Only keys and places go
    through the stream; texts stay in their files.
    """
    # A key stays for a delay after its time has left the watermark, which is as much behind: twice the delay.
    delay = max((pd.Timedelta(retention) + pd.Timedelta(CLOCKS)) / 2, pd.Timedelta(CLOCKS)) // pd.Timedelta(milliseconds=1)
    place = texts.select(
        "pdf_path", *order, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        F.current_timestamp().alias("arrived"))
    keys = place.select("pdf_path", "arrived").withWatermark("arrived", f"{delay} milliseconds").dropDuplicatesWithinWatermark(["pdf_path"])
    return place.drop("arrived").withColumn("fresh", F.lit(False)).unionByName(
        keys.select("pdf_path", F.lit(True).alias("fresh")), allowMissingColumns=True)


def first_places(batch: DataFrame, order: list[str]) -> DataFrame:
    """(pdf_path, file, row) of a batch's fresh documents, the first in `order`; missing values come last."""
    ranks = [c for i, name in enumerate(order) for c in (F.col(name).isNull().alias(f"_n{i}"), F.col(name).alias(f"_o{i}"))]
    first = F.min(F.when(~F.col("fresh"), F.struct(*ranks, "file", "row"))).alias("_first")
    found = batch.groupBy("pdf_path").agg(first, F.max("fresh").alias("fresh"))
    return found.filter("fresh").select("pdf_path", "_first.file", "_first.row")


def extract_stream(
    texts: DataFrame,
    table: RecordTable,
    checkpoint: str,
    extract: Callable[[DataFrame], DataFrame],
    order: list[str] | None = None,
    retention: str = RETENTION,
) -> StreamingQuery:
    """Write a record for each arriving document that has none. `texts` comes from `document_stream`.

    A document is written once. Repeats inside a batch keep the first in `order`; repeats of a later batch are known to the
    stream's state for `retention`, and a batch of nothing else ends there, without a look at the table. What passes is held
    against the table, which is exact at any age and for batches that run again after a failure. Texts are read last, of the
    documents that get a record, from the batch's own files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = fresh_dir(spark, "arrivals")
        batch.write.parquet(path)
        arrived = spark.read.schema(batch.schema).parquet(path)
        if arrived.filter("fresh").isEmpty():
            return
        first = first_places(arrived, order or [])
        known = table.read().select("pdf_path").join(first.select("pdf_path"), "pdf_path", "left_semi")
        fresh = first.join(key_set(known, ["pdf_path"]), "pdf_path", "left_anti")
        files = [unquote(row["file"]) for row in fresh.select("file").distinct().collect()]  # at most a batch's files
        if not files:
            return
        stored = spark.read.schema(texts.schema).parquet(*files)
        places = stored.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
        wanted = fresh.select(F.col("file").alias("_file"), F.col("row").alias("_row"))
        table.append(extract(places.join(wanted, ["_file", "_row"], "left_semi").select(*texts.columns)))

    return arrivals(texts, order or [], retention).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_STORED = T.StructType([*LEDGER_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])


class LedgerLog:
    """A ledger kept as one folder of changed entries per batch, on top of a compacted base.

    Entries lie in folders by a hash of their key, so that a batch's own entries are found without reading the others'. A batch that
    runs again overwrites its own folder. The newest batch holds an entry's state. Compacting puts the log into a new base and
    removes what the base before it already had, so that a reader or a batch that began before goes on.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def bucket(self) -> Column:
        """Which folder an entry is in: fixed by its key and the log's number of buckets."""
        return F.pmod(F.xxhash64(*KEY), F.lit(self.buckets)).cast("int")

    def _write(self, entries: DataFrame, path: str) -> None:
        rows = entries.select(*LEDGER_COLUMNS, self.bucket().alias("bucket"))
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def write(self, entries: DataFrame, batch_id: int) -> None:
        self._write(entries, f"{self.root}/log/batch={batch_id}")

    def bases(self) -> list[int]:
        """Batches up to which there is a finished base, oldest first."""
        found = store.numbered(self.spark, f"{self.root}/base", "upto")
        return [upto for upto in found if store.is_complete(self.spark, f"{self.root}/base/upto={upto}")]

    def read(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Current entries, or those before a batch; of some buckets only, if given."""
        limit = float("inf") if before is None else before
        upto = max((u for u in self.bases() if u < limit), default=-1)
        logs = [b for b in store.numbered(self.spark, f"{self.root}/log", "batch") if upto < b < limit]
        parts = [(f"{self.root}/base/upto={upto}", upto)] * (upto >= 0) + [(f"{self.root}/log/batch={b}", b) for b in logs]
        rows = None
        for path, batch in parts:
            part = self.spark.read.schema(_STORED).parquet(path)
            part = part if buckets is None else part.filter(F.col("bucket").isin(buckets))
            part = part.select(*LEDGER_COLUMNS, F.lit(batch).cast("bigint").alias("_batch"))
            rows = part if rows is None else rows.unionAll(part)
        if rows is None:
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        names = [name for name in LEDGER_COLUMNS if name not in KEY]
        newest = rows.groupBy(*KEY).agg(F.max_by(F.struct(*names), "_batch").alias("_e"))
        return newest.select(*KEY, "_e.*")

    def compact(self, batch_id: int) -> None:
        """Put all entries up to a finished batch into a new base."""
        self._write(self.read(before=batch_id + 1), f"{self.root}/base/upto={batch_id}")
        kept = self.bases()[-2:]
        for upto in store.numbered(self.spark, f"{self.root}/base", "upto"):
            if upto < kept[0]:
                store.remove(self.spark, f"{self.root}/base/upto={upto}")
        for batch in store.numbered(self.spark, f"{self.root}/log", "batch"):
            if len(kept) > 1 and batch <= kept[0]:
                store.remove(self.spark, f"{self.root}/log/batch={batch}")


class ProgressCounts:
    """Entries per city and status, kept by what each batch changes.

    A batch's counts are those before it plus its own changes; a batch that runs again writes the same ones.
    """

    schema = "city string, status string, files bigint"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, batch_id: int) -> str:
        return f"{self.root}/batch={batch_id}"

    def batches(self) -> list[int]:
        found = store.numbered(self.spark, self.root, "batch")
        return [batch for batch in found if store.is_complete(self.spark, self._folder(batch))]

    def read(self, before: int | None = None) -> DataFrame:
        """Counts after the last batch, or after the last one before some batch."""
        known = [batch for batch in self.batches() if before is None or batch < before]
        if not known:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(known[-1]))

    def add(self, changes: DataFrame, batch_id: int, keep: int = 3) -> None:
        counts = summed(self.read(before=batch_id).unionByName(changes))
        counts.coalesce(1).write.mode("overwrite").parquet(self._folder(batch_id))
        for batch in self.batches()[:-keep]:
            store.remove(self.spark, self._folder(batch))


def batch_changes(batch: DataFrame, log: LedgerLog, batch_id: int) -> DataFrame:
    """What a batch of entries changes in the counts per city and status.

    The entries' old states come from the batch's own buckets of the log; no other file is read.
    """
    keys = batch.select(*KEY, log.bucket().alias("_bucket"))
    touched = [row["_bucket"] for row in keys.select("_bucket").distinct().collect()]  # at most the number of buckets
    before = log.read(before=batch_id, buckets=touched).join(keys.select(*KEY), KEY, "left_semi")
    return status_changes(before, batch)


def ledger_stream(
    activity: DataFrame, log: LedgerLog, checkpoint: str, progress_path: str | None = None, compact_every: int = 50
) -> StreamingQuery:
    """Keep whole ledger entries up to date from a stream of marks; optionally keep the counts per city and status too.

    The state per file is five values, each with its last writer, that combine in any order, so marks may come late.
    """
    spark = log.spark
    changed = replayed_entries(histories(activity))

    def write(batch: DataFrame, batch_id: int) -> None:
        log.write(batch, batch_id)
        if progress_path:
            entries = spark.read.schema(batch.schema).parquet(f"{log.root}/log/batch={batch_id}")
            ProgressCounts(spark, progress_path).add(batch_changes(entries, log, batch_id), batch_id)
        if batch_id and batch_id % compact_every == 0:
            log.compact(batch_id)

    return (
        changed.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_progress(spark: SparkSession, progress_path: str) -> DataFrame:
    """Entries per status after the last batch, and in total."""
    counts = ProgressCounts(spark, progress_path).read()
    return with_total(counts.groupBy("status").agg(F.sum("files").alias("files")))
