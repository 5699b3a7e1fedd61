"""Streams run over all that has arrived, then their tables are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from permitwright.fixtures import VIEWS
from permitwright.operators import extract
from permitwright.session import fresh_dir
from permitwright.sources.tables import RecordTable
from permitwright.streaming import jobs
from permitwright.suite import rules as R
from permitwright.suite.extraction import _FROM_SET_A
from permitwright.suite.ledger import REPLAYED, flat_ledger, typed_marks
from permitwright.suite.registry import query


def _run_extraction(fx, visits, order=None):
    """Each visit's texts arrive while the stream is down; it is then started again on its checkpoint."""
    arrived, checkpoint = fresh_dir(fx.spark, "arrived"), fresh_dir(fx.spark, "checkpoint")
    table = RecordTable(fx.spark, fresh_dir(fx.spark, "records"))
    for texts in visits:
        texts.write.mode("append").parquet(arrived)
        stream = jobs.extract_stream(
            jobs.document_stream(fx.spark, arrived, texts.schema),
            table,
            checkpoint,
            lambda batch: extract.extract_records(batch, extract.TEXT_ONLY),
            order,
        )
        stream.awaitTermination()
    return table.read()


@query(
    "stream_extract",
    f"select {R.FULL_LIST} from (select {_FROM_SET_A} from fx_permit_text where {R.PERMIT_TEXT}) t",
)
def stream_extract(fx):
    return _run_extraction(fx, [fx["fx_permit_text"]])


@query(
    "stream_dedup",
    f"select {R.FULL_LIST} from (select {_FROM_SET_A} from fx_permit_text where {R.PERMIT_TEXT}) t",
)
def stream_dedup(fx):
    texts = fx["fx_permit_text"].withColumn("seq", F.lit(0))
    # Every document arrives again with another text, which must not be used.
    again = texts.withColumns({"seq": F.lit(1), "ocr_text": F.concat(F.lit("טופס 3\nבעל היתר: אחר\n"), "ocr_text")})
    # Once within the first batch, and once more in a batch of its own after a restart.
    return _run_extraction(fx, [texts.unionByName(again), again], ["seq"])


def _run_ledger(fx, progress_path=None):
    # The events table itself is the stream. As a pattern, the path may be one file or a folder of files.
    spark = fx.spark
    events = spark.readStream.schema(fx.base("events").schema).parquet(f"{fx.sf_dir}/events.parque[t]")
    marks = typed_marks(spark.sql(VIEWS["fx_activity"].replace("from events", "from {events}"), events=events))
    log = jobs.LedgerLog(spark, fresh_dir(spark, "ledger-log"), buckets=8)
    jobs.ledger_stream(marks, log, fresh_dir(spark, "checkpoint"), progress_path).awaitTermination()
    return log


@query("stream_ledger", f"with {REPLAYED} select * from replayed")
def stream_ledger(fx):
    return flat_ledger(_run_ledger(fx).read())


@query(
    "stream_progress",
    f"""with {REPLAYED} select status, count(*) as files from replayed group by status
    union all select 'total', count(*) from replayed""",
)
def stream_progress(fx):
    path = fresh_dir(fx.spark, "progress")
    _run_ledger(fx, path)
    return jobs.newest_progress(fx.spark, path)


@query(
    "stream_progress_by_city",
    f"with {REPLAYED} select city, status, count(*) as files from replayed group by city, status",
)
def stream_progress_by_city(fx):
    """Marks that arrive in three batches: each batch's changes are added to the counts before it."""
    spark = fx.spark
    arrived, path = fresh_dir(spark, "marks"), fresh_dir(spark, "progress")
    marks = typed_marks(fx["fx_activity"])
    log = jobs.LedgerLog(spark, fresh_dir(spark, "ledger-log"), buckets=8)
    checkpoint = fresh_dir(spark, "checkpoint")
    for part in range(3):
        marks.filter(F.col("event_id") % 4 % 3 == (part + 1) % 3).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(marks.schema).parquet(arrived)
        jobs.ledger_stream(stream, log, checkpoint, path, compact_every=2).awaitTermination()
    return jobs.ProgressCounts(spark, path).read()
