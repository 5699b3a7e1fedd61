"""Upkeep operators on literal tables."""

from pyspark.sql import functions as F

from permitwright.operators import upkeep as U
from permitwright.schema import RECORD_COLUMNS, as_records

GOOD = ("משפחת כהן", "אדריכל לוי")


def records(spark, rows):
    names = "pdf_path string, owner string, architect string, gush string, address string, building_file_number string, city string"
    padded = [tuple(r) + ("",) * (7 - len(r)) for r in rows]
    return as_records(spark.createDataFrame(padded, names), RECORD_COLUMNS)


def test_backfill_takes_only_new_values_for_empty_fields(spark, columns):
    table = records(spark, [("a", "", "x", ""), ("b", "o", "", "1"), ("c", "", "", "")])
    again = columns(
        pdf_path=["a", "b"], owner=["new", "other"], architect=["", ""], structural_planner=["", ""], gush=["5", "6"],
        helka=["", ""], migrash=["", ""], city_plan=["", ""], permit_number=["", ""],
    )
    out = {r.pdf_path: (r.owner, r.architect, r.gush, r.changed) for r in U.backfill(table, again).collect()}
    assert out == {"a": ("new", "x", "5", True), "b": ("o", "", "1", False), "c": ("", "", "", False)}


def test_corrections_touch_invalid_fields_only(spark, columns):
    table = records(spark, [("a", "12", GOOD[1]), ("b", "", ""), ("c", "", ""), ("d", *GOOD), ("e", "", "")])
    edits = columns(
        pdf_path=["a", "b", "c", "d"], owner=["דן", "דן", "דן", "דן"], architect=["רן", "", "רן", "רן"],
        action=["save", "save", "skip", "save"],
    )
    out = {r.pdf_path: (r.owner, r.architect, r.changed) for r in U.apply_corrections(table, edits).collect()}
    assert out == {
        "a": ("דן", GOOD[1], True), "b": ("דן", "", True), "c": ("", "", False), "d": (*GOOD, False), "e": ("", "", False),
    }
    summary = U.review_summary(U.apply_corrections(table, edits)).first()
    assert tuple(summary) == (5, 2, 2, 3)


def test_cleanup_reports_documents_and_emptied_folders(spark, columns):
    table = records(spark, [("f/a", *GOOD), ("f/b", *GOOD), ("g/a", *GOOD), ("g/b", "", ""), ("h/a", *GOOD), ("f/a", "", "")])
    store = columns(path=["f/a", "f/b", "g/a", "g/b"], folder=["f", "f", "g", "g"])
    plan = sorted(map(tuple, U.cleanup_plan(table, store).collect()))
    assert plan == [
        ("delete_document", "f/a"), ("delete_document", "f/b"), ("delete_document", "g/a"), ("remove_folder", "f"),
    ]
    assert tuple(U.cleanup_summary(table, store).first()) == (3, 2)


def test_new_records_are_written_once(spark, columns):
    known = columns(pdf_path=["a", "a"])
    more = columns(pdf_path=["a", "b", "b"], owner=["1", "2", "3"])
    out = U.new_records(more, known, [F.col("owner")])
    assert [tuple(r) for r in out.collect()] == [("b", "2")]


def test_redownload_takes_the_first_permit_document(spark, columns):
    table = records(
        spark,
        [("a", "", "", "", "הרצל 1", "7"), ("b", *GOOD, "", "", "7"), ("c", "", "", "", "", ""), ("d", "", "", "", "", "7"),
         ("e", "", "", "", "", "8")],
    )
    store = columns(path=["d"])
    table = table.withColumn("city", F.lit("akko"))
    links = spark.createDataFrame(
        [("akko", "7", 0, "תכנית", "/v?Name_File=0", "1", ""), ("akko", "7", 2, "היתר בניה", "/v?Name_File=2", "1", "1/1/1990"),
         ("akko", "7", 1, "היתר בניה", "/v?Name_File=1", "1", ""), ("arad", "7", 0, "היתר בניה", "/v?Name_File=9", "1", "")],
        "city string, file_id string, pos int, doc_type string, url string, entity_number string, date string",
    )
    out = U.redownload_plan(table, store, links, F.lit("data")).collect()
    assert [(r.pdf_path, r.target, r.error) for r in out] == [("a", "data/הרצל_1/permit_1.pdf", "")]
    moved = U.redownloaded(table, U.redownload_plan(table, store, links, F.lit("data")))
    assert {r.pdf_path: r.changed for r in moved.collect()} == {
        "data/הרצל_1/permit_1.pdf": True, "b": False, "c": False, "d": False, "e": False}


def test_of_several_reviews_the_last_counts_and_blanks_are_none(spark, columns):
    table = records(spark, [("a", "x", "y", "", "", ""), ("b", "x", "y", "", "", "")])
    edits = spark.createDataFrame(
        [("a", " דן כהן ", "", "save", 2), ("a", "אחר", "אחר", "save", 1), ("b", " ", "רן לוי", "save", 1)],
        "pdf_path string, owner string, architect string, action string, seq int")
    got = {r.pdf_path: (r.owner, r.architect, r.changed) for r in U.apply_corrections(table, edits).collect()}
    assert got == {"a": ("דן כהן", "y", True), "b": ("x", "רן לוי", True)}


def test_merge_fills_the_city_and_leaves_out_unknown_folders(spark, columns):
    table = columns(source=["akko", "akko", "zzz"], city=["", "x", ""])
    cities = spark.createDataFrame([("akko", "עכו", 0)], "subdomain string, name string, ord int")
    assert sorted((r.city, r.ord) for r in U.merge_cities(table, cities).collect()) == [("x", 0), ("עכו", 0)]


def test_batch_summary(spark, columns):
    pages = spark.createDataFrame([("a", 0, 500.0), ("a", 1, 500.0), ("b", 0, 2000.0)], "pdf_path string, page_idx int, width_pt double")
    answers = columns(record_id=["a", "a", "c"])
    row = U.batch_summary(columns(pdf_path=["a", "b"]), pages, answers, columns(pdf_path=["c"])).first()
    assert tuple(row) == (2, 1, 0.006, 1, 2)
