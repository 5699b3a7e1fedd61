"""Runs over an archive's tables, end to end."""

import pytest
from pyspark.sql import functions as F

from permitwright.plans.archive import Archive
from permitwright.plans.browse import Filters, browse, facet_values, filtered, grouped_by_address, sorted_records, suggest_values

LINKS = (
    "city string, file_id string, pos int, doc_type string, description string, date string, entity_type string,"
    " entity_number string, url string"
)


@pytest.fixture
def archive(spark, tmp_path):
    return Archive(spark, str(tmp_path / "archive"))


def listing(spark, ids):
    return spark.createDataFrame(
        [("akko", i, f"הרצל {i}", "", f"/f{i}", 0) for i in ids],
        "city string, file_id string, address string, parcel_info string, url string, pos int",
    )


def states(archive):
    return {r.status: r.files for r in archive.status().collect()}


def test_a_run_from_listing_to_browsing(spark, archive, columns):
    archive.update(listing(spark, ["1", "2"]))
    archive.update(listing(spark, ["2", "3"]))
    assert states(archive) == {"pending": 3, "total": 3}

    links = spark.createDataFrame(
        [("akko", "1", 0, "היתר בניה", "", "1/1/2005", "", "11", "/v?Name_File=a"),
         ("akko", "1", 1, "היתר בניה", "", "1/1/1995", "", "12", "/v?Name_File=b"),
         ("akko", "2", 0, "תכנית", "", "", "", "", "/v?Name_File=c")], LINKS)
    wanted = archive.wanted_documents(links, F.lit("data")).collect()
    assert [r.target for r in wanted] == ["data/הרצל_1/permit_11.pdf"]

    # What a download run would note.
    fetched = archive.ledger.read().withColumns({
        "status": F.when(F.col("file_id") == "1", "downloaded").when(F.col("file_id") == "2", "error").otherwise("skipped"),
        "pdfs": F.when(F.col("file_id") == "1", F.array(F.lit("p1"), F.lit("p2"))).otherwise(F.col("pdfs")),
        "doc_meta": F.when(F.col("file_id") == "1", F.array(F.struct(F.lit("1/1/2005").alias("date"), F.lit("11").alias("entity_number"))))
        .otherwise(F.col("doc_meta")),
    })
    archive.ledger.rewrite(fetched)

    archive.extract(columns(pdf_path=["p1", "zz"], ocr_text=["טופס 3\nבעל היתר: משפחת כהן", "טופס 3"]), "tesseract")
    assert states(archive) == {"downloaded": 1, "error": 1, "skipped": 1, "total": 3}
    archive.extract(columns(pdf_path=["p1", "p2"], ocr_text=["טופס 3\nבעל היתר: אחר", "טופס 3\nגוש: 7"]), "tesseract")
    assert states(archive) == {"processed": 1, "error": 1, "skipped": 1, "total": 3}
    rows = {r.pdf_path: (r.city, r.building_file_number, r.owner, r.address, r.date) for r in archive.records.read().collect()}
    assert rows == {"p1": ("akko", "1", "משפחת כהן", "הרצל 1", "1/1/2005"), "p2": ("akko", "1", "", "הרצל 1", "")}

    archive.retry_errors()
    assert states(archive)["pending"] == 1
    page = browse(archive.records.read(), Filters(city="akko"), grouped=True, page=0).collect()
    assert [(r.group_key, r.group_size, r.pdf_path) for r in page] == [("הרצל 1", 2, "p1")]


def test_batch_results_corrections_and_second_extraction(spark, archive, columns):
    answers = spark.createDataFrame(
        [("p1", "bad", 0), ("p1", '{"owner": "דן"}', 1), ("p1", '{"owner": "אב"}', 2), ("p2", "bad", 3), (None, "{}", 4), ("p3", "[1]", 5)],
        "record_id string, response_text string, place int")
    assert tuple(archive.take_batch_results(answers, "akko").first()) == (6, 2, 2, 2)
    assert tuple(archive.take_batch_results(answers, "akko").first()) == (6, 0, 2, 4)
    rows = archive.records.read().collect()
    assert sorted((r.city, r.pdf_path, r.owner, r.owner_confidence) for r in rows) == [
        ("akko", "p1", "דן", "high"), ("akko", "p2", "", "none"),
    ]

    store = columns(path=["p2"])
    texts = columns(pdf_path=["p1", "p2"], ocr_text=["טופס 3\nבעל היתר: אחר", "טופס 3\nבעל היתר: משפחת לוי"])
    assert archive.reextract(texts, store, "tesseract").first().changed == 1
    edits = columns(pdf_path=["p2"], owner=["x"], architect=["אדריכל דן"], action=["save"])
    assert archive.correct(edits).first().changed == 1
    fixed = archive.records.read().filter("pdf_path = 'p2'").first()
    assert (fixed.owner, fixed.architect, fixed.owner_confidence) == ("משפחת לוי", "אדריכל דן", "none")
    assert [r.pdf_path for r in archive.review().collect()] == ["p1"]
    assert [tuple(r) for r in archive.cleanup(columns(path=["p2"], folder=["f"])).collect()] == [
        ("delete_document", "p2"), ("remove_folder", "f"),
    ]


def test_cities(spark, archive):
    archive.update(listing(spark, ["1"]))
    cities = spark.createDataFrame([("akko", "עכו"), ("arad", "ערד")], "subdomain string, name string")
    got = sorted((r.subdomain, r.total, r.processed) for r in archive.cities(cities).collect())
    assert got == [("akko", 1, 0), ("arad", None, None)]


def files(table, cities):
    return sorted(f.split("/data/")[1] for f in table.read(cities).inputFiles())


def test_runs_leave_untouched_cities_alone(spark, archive, columns):
    names = "city string, file_id string, url string, address string, status string, pdfs array<string>, doc_meta array<struct<date: string, entity_number: string>>, error string"
    entry = lambda city, i, status, pdfs=(): (city, i, "/u", "א", status, list(pdfs), [], "e" if status == "error" else None)
    archive.ledger.append(spark.createDataFrame(
        [entry("akko", "1", "error"), entry("arad", "1", "downloaded", ["p1"]), entry("lod", "1", "processed"), entry("lod", "2", "pending")], names))
    archive.records.append(columns(city=["akko", "arad", "lod"], pdf_path=["a", "b", "c"], owner=["", "x", "y"], architect=["", "", ""]))

    before = files(archive.ledger, ["arad", "lod"])
    archive.retry_errors()
    assert files(archive.ledger, ["arad", "lod"]) == before
    before = files(archive.ledger, ["akko", "lod"])
    archive.extract(columns(pdf_path=["p1"], ocr_text=["טופס 3\nבעל היתר: משפחת כהן"]), "tesseract")
    assert files(archive.ledger, ["akko", "lod"]) == before
    assert states(archive) == {"pending": 2, "processed": 2, "total": 4}

    before = files(archive.records, ["arad", "lod"])
    counts = archive.correct(columns(pdf_path=["a", "b"], owner=["משפחת לוי", ""], architect=["", ""], action=["save", "save"])).first()
    assert (counts.records, counts.changed) == (4, 1)
    assert files(archive.records, ["arad", "lod"]) == before
    version = archive.records.version()
    assert archive.correct(columns(pdf_path=["zz"], owner=["x"], architect=["y"], action=["save"])).first().changed == 0
    assert archive.records.version() == version


def test_marks_are_recorded_by_city(spark, archive):
    archive.update(listing(spark, ["1", "2"]))
    archive.ledger.append(archive.ledger.read().withColumn("city", F.lit("lod")))
    before = files(archive.ledger, ["lod"])
    marks = spark.createDataFrame(
        [(1, "akko", "1", "downloaded", None, None, ["p"], [("d", "n")], None), (2, "akko", "2", "error", None, None, None, None, "timeout"),
         (3, "akko", "9", "listed", "/n", "new", None, None, None)],
        "event_id bigint, city string, file_id string, mark string, url string, address string, pdfs array<string>,"
        " doc_meta array<struct<date: string, entity_number: string>>, error string").withColumn("ts", F.timestamp_seconds("event_id"))
    archive.record(marks)
    got = {(r.city, r.file_id): (r.status, r.pdfs, r.error, r.url) for r in archive.ledger.read().collect()}
    assert got == {
        ("akko", "1"): ("downloaded", ["p"], None, "/f1"), ("akko", "2"): ("error", [], "timeout", "/f2"), ("akko", "9"): ("pending", [], None, "/n"),
        ("lod", "1"): ("pending", [], None, "/f1"), ("lod", "2"): ("pending", [], None, "/f2"),
    }
    assert files(archive.ledger, ["lod"]) == before


def test_stored_answers_follow_the_records(spark, archive, columns):
    """Choices, search and pages stay equal to the full computation through appends and corrections."""
    def told(df):
        return sorted(map(tuple, df.collect()), key=str)

    def check():
        rows = archive.records.read()
        assert told(archive.choices()) == told(facet_values(rows))
        assert [tuple(r) for r in archive.suggest("architect", "אדר").collect()] == [tuple(r) for r in suggest_values(rows, "architect", "אדר").collect()]
        assert told(archive.search("לוי")) == told(filtered(rows, Filters(text="לוי")))
        assert told(archive.page(0, size=3)) == told(sorted_records(rows).filter("position <= 3"))
        assert told(archive.page(0, grouped=True, size=2).drop("groups", "pages")) == told(grouped_by_address(rows).filter("position <= 2"))

    archive.records.append(columns(
        city=["akko", "akko", "arad", ""], pdf_path=["a", "b", "c", "d"], owner=["", "משפחת לוי", "x", "משפחת כהן"], architect=["אדריכל דן", "", "אדריכל רון", "אדריכל דן"],
        date=["1/1/2005", "1/1/2010", "", "2/2/2002"], address=["הרצל 1", "הרצל 1", "ויצמן 5", ""], gush=["3600", "3601", "x", ""]))
    check()
    version = archive.records.version()
    archive.correct(columns(pdf_path=["a", "b"], owner=["משפחת לוי", ""], architect=["", "אדריכל גל"], action=["save", "save"]))
    # Kept by the change itself, not made anew when asked.
    assert archive.records.version() > version and archive.records.version() in archive.facets.versions()
    check()
    answers = spark.createDataFrame([("e", '{"owner": "משפחת לוי", "architect": "אדריכל טל"}')], "record_id string, response_text string")
    archive.take_batch_results(answers, "lod")
    assert archive.records.version() in archive.facets.versions()
    check()
