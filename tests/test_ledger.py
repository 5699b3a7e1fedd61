"""Ledger operators, the replay against a sequential fold, and streams over several batches."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from permitwright.operators import extract
from permitwright.operators import ledger as L
from permitwright.schema import LEDGER_ENTRY_TYPE
from permitwright.sources.tables import RecordTable
from permitwright.streaming import jobs

SCHEMA = "city string, file_id string, " + ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in LEDGER_ENTRY_TYPE.fields
)


def entry(city, file_id, status, pdfs=(), dates=(), error=None):
    return (city, file_id, "/u", "א", status, list(pdfs), [(d, "") for d in dates], error)


@pytest.fixture
def ledger(spark):
    return spark.createDataFrame(
        [
            entry("c", "1", "downloaded", ["a", "b"], ["1/1/2001"]),
            entry("c", "2", "downloaded", ["e"], ["2/2/2002", "3/3/2003"]),
            entry("c", "3", "error", error="timeout"),
            entry("d", "1", "pending"),
        ],
        SCHEMA,
    )


def test_documents_pair_by_position(ledger):
    got = sorted((r.pdf_path, r.pos, r.date) for r in L.ledger_documents(ledger).collect())
    assert got == [("a", 0, "1/1/2001"), ("b", 1, ""), ("e", 0, "2/2/2002")]


def test_pending_extraction_skips_known_documents(ledger, columns):
    assert {r.pdf_path for r in L.pending_extraction(ledger, columns(pdf_path=["a", "a", "x"])).collect()} == {"b", "e"}


def test_processed_only_when_every_document_is_settled(ledger, columns):
    def states(**options):
        return {(r.city, r.file_id): r.status for r in L.mark_processed(ledger, **options).collect()}

    one = states(records=columns(pdf_path=["a", "e"]))
    assert one[("c", "1")] == "downloaded" and one[("c", "2")] == "processed" and one[("c", "3")] == "error"
    both = states(records=columns(pdf_path=["a", "e"]), failures=columns(pdf_path=["b"]))
    assert both[("c", "1")] == "processed"
    assert states(records=columns(pdf_path=["x"]), literal=True)[("c", "1")] == "processed"


def test_retry_and_progress(ledger):
    again = L.retry_errors(ledger)
    assert [(r.status, r.error) for r in again.filter("file_id = '3'").collect()] == [("pending", None)]
    assert {r.status: r.files for r in L.progress(again).collect()} == {"downloaded": 2, "pending": 2, "total": 4}


def test_listing_adds_each_new_file_once(spark, ledger):
    listing = spark.createDataFrame(
        [("c", "1", "x", "", "/n", 0), ("c", "9", "late", "", "/n", 1), ("c", "9", "first", "", "/n", 0), ("d", "9", "y", "", "/n", 0)],
        "city string, file_id string, address string, parcel_info string, url string, pos int",
    )
    merged = L.merge_listing(ledger, listing).collect()
    assert len(merged) == 6
    assert {(r.city, r.file_id): (r.status, r.address, r.pdfs) for r in merged if r.file_id == "9"} == {
        ("c", "9"): ("pending", "first", []),
        ("d", "9"): ("pending", "y", []),
    }


MARKS = (
    "event_id bigint, t bigint, city string, file_id string, mark string, url string, address string, pdfs array<string>,"
    " doc_meta array<struct<date: string, entity_number: string>>, error string"
)


def activity_rows():
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        file_id = "hot" if i % 3 == 0 else str(rng.randint(0, 150))
        mark = rng.choice(["listed", "downloaded", "processed", "skipped", "error"])
        pdfs = [f"p{i}_{n}" for n in range(rng.randint(0, 2))] if mark in ("downloaded", "processed") else None
        meta = [(f"d{i}", "n")] if mark == "downloaded" else None
        told = (f"/u{i}", f"a{i}") if mark == "listed" else (None, None)
        rows.append((i, rng.randint(0, 500), rng.choice(["c", "d"]), file_id, mark, *told, pdfs, meta, f"e{i}" if mark == "error" else None))
    return rows


def fold(rows, state=None):
    """Marks applied one after the other to whole entries."""
    state = {key: dict(value) for key, value in (state or {}).items()}
    for _, _, city, file_id, mark, url, address, pdfs, meta, error in sorted(rows, key=lambda r: (r[1], r[0])):
        entry = state.get((city, file_id))
        if mark == "listed":
            if entry is None:
                state[city, file_id] = {"url": url, "address": address, "status": "pending", "pdfs": [], "doc_meta": [], "error": None}
            continue
        if entry is None:
            continue
        entry["status"] = mark
        if mark == "downloaded":
            entry["pdfs"], entry["doc_meta"] = pdfs, meta
        elif mark == "processed" and pdfs:
            entry["pdfs"] = pdfs
        elif mark == "error":
            entry["error"] = error
    return state


def activity_table(spark, rows):
    table = spark.createDataFrame(rows, MARKS)
    return table.withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz")).drop("t")


def entries_of(ledger):
    found = {}
    for r in ledger.collect():
        meta = [tuple(m) for m in r.doc_meta]
        assert (r.city, r.file_id) not in found
        found[r.city, r.file_id] = {"url": r.url, "address": r.address, "status": r.status, "pdfs": r.pdfs, "doc_meta": meta, "error": r.error}
    return found


def test_replay_equals_a_fold(spark):
    rows = activity_rows()
    assert entries_of(L.replay(activity_table(spark, rows))) == fold(rows)
    assert L.replay(activity_table(spark, rows[:1]).limit(0)).count() == 0


def test_histories_combine_in_any_order(spark):
    rows = activity_rows()
    shuffled = list(rows)
    random.Random(9).shuffle(shuffled)
    one = activity_table(spark, shuffled).repartition(7, "event_id")
    assert entries_of(L.replay(one)) == fold(rows)


def test_marks_change_a_ledger(spark, ledger):
    known = entries_of(ledger)
    marks = [
        (1, 5, "c", "1", "error", None, None, None, None, "late"),
        (2, 6, "c", "2", "processed", None, None, [], None, None),
        (3, 7, "c", "3", "downloaded", None, None, ["x"], [("d", "n")], None),
        (4, 8, "d", "1", "listed", "/other", "other", None, None, None),
        (5, 9, "c", "new", "skipped", None, None, None, None, None),
        (6, 10, "d", "new", "listed", "/n", "n", None, None, None),
        (7, 11, "d", "new", "processed", None, None, ["q"], None, None),
        (8, 12, None, "bare", "listed", "/b", "b", None, None, None),
    ]
    changed = entries_of(L.marked_entries(ledger, activity_table(spark, marks)))
    named = [(*m[:2], m[2] or "", *m[3:]) for m in marks]
    want = fold(named, known)
    assert {**known, **changed} == want
    assert set(changed) == {(m[2], m[3]) for m in named} - {("c", "new")}


def test_ledger_stream_over_batches_restart_and_compaction(spark, tmp_path):
    rows = activity_rows()
    arrived, checkpoint, counts = (str(tmp_path / n) for n in ("arrived", "checkpoint", "counts"))
    log = jobs.LedgerLog(spark, str(tmp_path / "log"), buckets=4)
    rng = random.Random(1)
    rng.shuffle(rows)

    def run():
        schema = activity_table(spark, rows[:1]).schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(arrived)
        jobs.ledger_stream(stream, log, checkpoint, counts, compact_every=2).awaitTermination()

    for part in (rows[:700], rows[700:1500]):
        activity_table(spark, part).coalesce(1).write.mode("append").parquet(arrived)
    run()
    for part in (rows[1500:1900], rows[1900:2000], rows[2000:]):
        activity_table(spark, part).coalesce(1).write.mode("append").parquet(arrived)
    run()
    want = fold(rows)
    assert entries_of(log.read()) == want
    counted = {r.status: r.files for r in jobs.newest_progress(spark, counts).collect()}
    assert counted == {**Counter(e["status"] for e in want.values()), "total": len(want)}
    by_city = {(r.city, r.status): r.files for r in jobs.ProgressCounts(spark, counts).read().collect()}
    assert by_city == Counter((city, e["status"]) for (city, _), e in want.items())
    # Bases and the logs they hold do not pile up.
    assert len(log.bases()) == 2 and min(int(p.name[6:]) for p in (tmp_path / "log" / "log").glob("batch=*")) > log.bases()[0]


def test_counting_reads_only_the_batchs_buckets(spark, tmp_path):
    log = jobs.LedgerLog(spark, str(tmp_path / "log"), buckets=16)
    many = spark.createDataFrame([entry("c", str(i), "pending") for i in range(200)], SCHEMA)
    log.write(many, 0)
    log.compact(0)
    batch = spark.createDataFrame([entry("c", "7", "processed"), entry("c", "new", "pending")], SCHEMA)
    log.write(batch, 1)
    changes = jobs.batch_changes(batch, log, 1)
    assert {(r.status, r.files) for r in changes.collect()} == {("processed", 1)}
    touched = [r.b for r in batch.select(log.bucket().alias("b")).collect()]
    read = log.read(before=1, buckets=touched)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < read.count() < 200 and {r.b for r in read.select(log.bucket().alias("b")).collect()} <= set(touched)


def test_a_repeated_batch_counts_once(spark, tmp_path):
    log, counts = jobs.LedgerLog(spark, str(tmp_path / "log")), jobs.ProgressCounts(spark, str(tmp_path / "counts"))
    for number, states in enumerate((["pending", "pending"], ["processed"], ["processed"])):
        batch = spark.createDataFrame([entry("c", str(i), s) for i, s in enumerate(states)], SCHEMA)
        number = min(number, 1)  # the last one is the second batch again
        log.write(batch, number)
        counts.add(jobs.batch_changes(batch, log, number), number)
    assert {(r.city, r.status): r.files for r in counts.read().collect()} == {("c", "pending"): 1, ("c", "processed"): 1}


def test_documents_are_extracted_once_over_restarts(spark, tmp_path):
    arrived, checkpoint = str(tmp_path / "arrived"), str(tmp_path / "checkpoint")
    table = RecordTable(spark, str(tmp_path / "records"))

    def texts(names, note):
        rows = [(n, f"טופס 3\nבעל היתר: {note} {n}", i) for i, n in enumerate(names)]
        return spark.createDataFrame(rows, "pdf_path string, ocr_text string, seq int")

    def run():
        stream = jobs.document_stream(spark, arrived, texts(["x"], "").schema, files_per_batch=1)
        jobs.extract_stream(
            stream, table, checkpoint, lambda b: extract.extract_records(b, "tesseract"), ["seq"]
        ).awaitTermination()

    texts(["a", "b", "a"], "one").coalesce(1).write.mode("append").parquet(arrived)
    texts(["c"], "two").coalesce(1).write.mode("append").parquet(arrived)
    run()
    first = {r.pdf_path: r.owner for r in table.read().collect()}
    texts(["a", "d"], "three").coalesce(1).write.mode("append").parquet(arrived)
    texts(["d", "e"], "four").coalesce(1).write.mode("append").parquet(arrived)
    run()
    rows = table.read().collect()
    assert sorted(r.pdf_path for r in rows) == ["a", "b", "c", "d", "e"]
    owners = {r.pdf_path: r.owner for r in rows}
    assert {n: owners[n] for n in first} == first
    assert owners["d"] == "three d"


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    log = jobs.LedgerLog(spark, str(tmp_path / "log"))
    one = spark.createDataFrame([entry("c", "1", "pending")], SCHEMA)
    two = one.withColumn("status", F.lit("processed"))
    log.write(one, 0)
    log.write(two, 1)
    log.write(two, 1)
    assert [(r.city, r.file_id, r.status) for r in log.read().collect()] == [("c", "1", "processed")]
    assert [r.status for r in log.read(before=1).collect()] == ["pending"]


def test_repeats_of_later_batches_never_meet_the_table(spark, tmp_path, monkeypatch):
    arrived, checkpoint = str(tmp_path / "arrived"), str(tmp_path / "checkpoint")
    table = RecordTable(spark, str(tmp_path / "records"))
    looks = []
    monkeypatch.setattr(table, "read", lambda *a, f=table.read: looks.append(1) or f(*a))

    def visit(names, note):
        rows = [(n, f"טופס 3\nבעל היתר: {note} {n}", i) for i, n in enumerate(names)]
        texts = spark.createDataFrame(rows, "pdf_path string, ocr_text string, seq int")
        texts.coalesce(1).write.mode("append").parquet(arrived)
        stream = jobs.document_stream(spark, arrived, texts.schema)
        jobs.extract_stream(stream, table, checkpoint, lambda b: extract.extract_records(b, "tesseract"), ["seq"]).awaitTermination()

    visit(["a", "b"], "one")
    assert len(looks) == 1
    visit(["b", "a"], "two")
    assert len(looks) == 1
    visit(["b", "c"], "three")
    assert len(looks) == 2
    monkeypatch.undo()
    assert {r.pdf_path: r.owner for r in table.read().collect()} == {"a": "one a", "b": "one b", "c": "three c"}
    # Another stream, whose state knows nothing: the table still decides.
    checkpoint = str(tmp_path / "other")
    visit(["a", "d"], "four")
    assert {r.pdf_path: r.owner for r in table.read().collect()}["a"] == "one a" and table.read().count() == 4


def test_arrivals_are_told_apart_by_spark_and_the_first_place_wins(spark, tmp_path):
    """No Python call per document: the state is Spark's own, and a batch's first row is found by an aggregate."""
    arrived = str(tmp_path / "arrived")
    rows = [("a", 2, "late"), ("a", None, "none"), ("a", 1, "first"), (None, 5, "nameless"), ("b", None, "only"), (None, 4, "nameless")]
    texts = spark.createDataFrame(rows, "pdf_path string, seq int, ocr_text string").coalesce(1)
    texts.write.parquet(arrived)
    found = []

    def visit():
        def write(batch, batch_id):
            found.append(sorted(map(tuple, jobs.first_places(batch, ["seq"]).select("pdf_path", "row").collect()), key=str))

        stream = jobs.arrivals(jobs.document_stream(spark, arrived, texts.schema), ["seq"]).writeStream.foreachBatch(write)
        query = stream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
        return query.recentProgress

    progress = visit()
    assert len(progress[0]["sources"]) == 1
    assert [s["operatorName"] for s in progress[0]["stateOperators"]] == ["dedupeWithinWatermark"]
    assert found[0] == [("a", 2), ("b", 4), (None, 5)] and not any(found[1:])
    found.clear()
    texts.filter("pdf_path = 'a'").union(spark.createDataFrame([("c", 1, "new")], texts.schema)).coalesce(1).write.mode("append").parquet(arrived)
    visit()
    assert [[name for name, _ in batch] for batch in found if batch] == [["c"]]
