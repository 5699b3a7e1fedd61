"""Sources and sinks on literal files."""

import json
import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from permitwright.schema import ALL_COLUMNS, RECORD_COLUMNS, as_records
from permitwright.sources import ledger, pages, tables, text_files
from permitwright.sources.inventory import InventoryLog
from permitwright.sources.text_files import write_text_files
from permitwright.suite import storage


def record(**values):
    return {name: values.get(name, "") for name in RECORD_COLUMNS}


def test_city_list(spark, tmp_path):
    path = tmp_path / "cities.csv"
    path.write_text("# comment\n# subdomain, name\nakko,עכו\n\narad,ערד,more\n", encoding="utf-8")
    assert sorted(map(tuple, tables.read_cities(spark, str(path)).collect())) == [("akko", "עכו"), ("arad", "ערד")]


def test_csv_with_mark_quotes_newlines_and_ragged_rows(spark, tmp_path):
    path = tmp_path / "output.csv"
    heading = ",".join(RECORD_COLUMNS)
    first = 'c,1,2,"הרצל 5, ""א""\nקומה 2",,,,,,,,p1,01/02/2003'
    longer = "c,2,,,,,,,,,,p2,," + ",".join(["high"] * 9)
    shorter = "c,3"
    path.write_text("﻿" + "\r\n".join([heading, first, longer, shorter]) + "\r\n", encoding="utf-8", newline="")
    rows = {r.building_file_number: r for r in tables.read_record_csv(spark, str(path)).collect()}
    assert rows["1"].address == 'הרצל 5, "א"\nקומה 2'
    assert (rows["1"].pdf_path, rows["1"].date, rows["1"].gush) == ("p1", "01/02/2003", "")
    assert rows["2"].owner_confidence == "high"
    assert (rows["3"].city, rows["3"].pdf_path, rows["3"].owner_confidence) == ("c", "", "")


def test_csv_round_trip_of_awkward_values(spark, tmp_path):
    values = ['a"b', "a,b", "a\nb", "", " x ", "א'ב", "\\", '"']
    rows = as_records(spark.createDataFrame([(v, str(i)) for i, v in enumerate(values)], "owner string, pdf_path string"))
    tables.write_record_csv(rows, str(tmp_path / "out"))
    back = tables.read_record_csv(spark, str(tmp_path / "out"))
    assert back.columns == ALL_COLUMNS
    assert [r.owner for r in back.orderBy(F.col("pdf_path").cast("int")).collect()] == values


def test_every_citys_file_is_read_with_its_folder(spark, tmp_path):
    for city, lines in {"akko": [" c ,1", "c,"], "arad": ['c,,,"  x "']}.items():
        (tmp_path / city).mkdir()
        (tmp_path / city / "output.csv").write_text(
            ",".join(RECORD_COLUMNS) + "\n" + "\n".join(lines) + "\n", encoding="utf-8"
        )
    rows = tables.read_city_tables(spark, str(tmp_path)).select("source", "city", "building_file_number", "address")
    assert sorted(map(tuple, rows.collect())) == [("akko", "c", "1", ""), ("arad", "c", "", "x")]


def files_of(table, cities=None):
    return {f.split("/data/")[1] for f in table.read(cities).inputFiles()}


def test_table_versions(spark, tmp_path):
    table = tables.RecordTable(spark, str(tmp_path / "t"))
    assert (table.version(), table.read().count(), table.cities()) == (0, 0, [])
    table.append(spark.createDataFrame([("", "a"), ("x", "b"), ("7", "c")], "city string, pdf_path string"))
    table.append(spark.createDataFrame([("x", "d")], "city string, pdf_path string"))
    before = table.read()
    assert sorted((r.city, r.pdf_path) for r in before.collect()) == [("", "a"), ("7", "c"), ("x", "b"), ("x", "d")]
    assert table.rewrite(before.filter("pdf_path <> 'b'").withColumn("owner", F.upper("pdf_path"))) == 3
    assert sorted((r.city, r.pdf_path, r.owner) for r in table.read().collect()) == [
        ("", "a", "A"), ("7", "c", "C"), ("x", "d", "D"),
    ]
    # The old version is still whole, for a reader that began before the rewrite.
    assert before.count() == 4


def test_a_rewrite_leaves_other_cities_files_alone(spark, tmp_path):
    table = tables.RecordTable(spark, str(tmp_path / "t"))
    rows = [(city, f"{city}{i}") for city in ("", "x", "y/z", "עכו") for i in range(3)]
    table.append(spark.createDataFrame(rows, "city string, pdf_path string"))
    assert table.cities() == ["", "x", "y/z", "עכו"]
    others = files_of(table, ["x", "y/z"])
    table.rewrite(table.read(["", "עכו"]).withColumn("owner", F.lit("n")), ["", "עכו"])
    assert files_of(table, ["x", "y/z"]) == others and not files_of(table, ["", "עכו"]) & others
    assert {(r.city, r.owner) for r in table.read().collect()} == {("", "n"), ("x", ""), ("y/z", ""), ("עכו", "n")}
    # A city that loses all its rows is gone, and no other.
    table.rewrite(table.read(["x"]).limit(0), ["x"])
    assert table.cities() == ["", "y/z", "עכו"] and table.read().count() == 9


def test_clean_removes_what_no_recent_version_names(spark, tmp_path):
    table = tables.RecordTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([("x", "a"), ("y", "b")], "city string, pdf_path string"))
    for owner in "123":
        table.rewrite(table.read(["x"]).withColumn("owner", F.lit(owner)), ["x"])
    before = table.read()
    assert sorted(table.clean()) == ["write=1/city=x", "write=2/city=x"]
    assert table.versions() == [3, 4] and not (tmp_path / "t" / "data" / "write=2").exists()
    assert before.count() == 2 and {(r.city, r.owner) for r in table.read().collect()} == {("x", "3"), ("y", "")}
    assert table.clean() == []


def test_a_write_that_failed_changes_nothing(spark, tmp_path):
    table = tables.RecordTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([("x", "a")], "city string, pdf_path string"))
    broken = spark.createDataFrame([("x", "b")], "city string, pdf_path string").withColumn("owner", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        table.append(broken)
    assert table.version() == 1 and [r.pdf_path for r in table.read().collect()] == ["a"]
    table.append(spark.createDataFrame([("x", "c")], "city string, pdf_path string"))
    assert sorted(r.pdf_path for r in table.read().collect()) == ["a", "c"]


def test_table_scan_is_pruned_by_city(spark, tmp_path):
    table = tables.RecordTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([("x", "a"), ("y", "b")], "city string, pdf_path string"))
    plan = table.read().filter(F.col("city") == "x").select("pdf_path")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "city#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_export_is_the_text_a_spreadsheet_reads(spark, tmp_path):
    rows = as_records(
        spark.createDataFrame([("b", 'x "y"', "1"), ("a", "z", "2")], "address string, owner string, permit_number string"),
        RECORD_COLUMNS,
    )
    tables.write_export(rows, [("address", True)], str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*"))
    text = "".join(p.read_text(encoding="utf-8") for p in parts)
    assert text.splitlines() == [
        "﻿כתובת,בעל היתר,אדריכל,גוש,חלקה,תאריך,היתר",
        '"a","z","","","","","2"',
        '"b","x ""y""","","","","","1"',
    ]


def test_inventory_takes_only_documents(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.pdf").write_bytes(b"123")
    (tmp_path / "a" / "y.txt").write_bytes(b"1")
    rows = tables.document_inventory(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[1], r.folder.endswith("/a/b"), r.length) for r in rows] == [("x.pdf", True, 3)]


def test_older_ledger_documents(spark, tmp_path):
    (tmp_path / "akko").mkdir()
    document = {
        "phase": "done",
        "last_results_page": 0,
        "building_files": {
            "1": {"url": "/u", "address": "א", "status": "error", "pdfs": ["p"], "error": "e", "new": 1,
                  "doc_meta": [{"date": "d", "entity_number": "n", "more": 1}]},
            "2": {},
        },
        "stats": {"total": 2},
    }
    (tmp_path / "akko" / "state.json").write_text(json.dumps(document, ensure_ascii=False, indent=2), encoding="utf-8")
    rows = {r.file_id: r for r in ledger.read_state_documents(spark, str(tmp_path)).collect()}
    assert (rows["1"].city, rows["1"].status, rows["1"].pdfs, rows["1"].error) == ("akko", "error", ["p"], "e")
    assert rows["1"].doc_meta[0].date == "d"
    assert (rows["2"].status, rows["2"].pdfs, rows["2"].doc_meta, rows["2"].error) == ("pending", [], [], None)


LISTING = """<table><thead><tr><th>x</th></tr></thead><tbody>
<tr class="r"><td> 123 <b>x</b></td><td>
 הרצל &amp; בניו </td><td>גוש 5</td><td><a class="l" href="/BuildingArchiveDetails?id=1">פרטים</a></td></tr>
<tr><td>124</td><td><a href="/BuildingArchiveDetails?id=2">x</a></td></tr>
<tr><td>125</td><td>b</td><td>c</td><td><a href="/Other">x</a></td></tr></tbody></table>"""


def test_listing_rows(columns):
    rows = pages.listing_rows(columns(html=[LISTING]), "html", []).drop("row_pos").collect()
    assert [tuple(r) for r in rows] == [("123", "הרצל & בניו", "גוש 5", "/BuildingArchiveDetails?id=1")]


def test_page_verdicts(columns):
    rows = columns(html=["Cloudflare blocked", "Cloudflare", "blocked", "חלה שגיאה", "Cloudflare Ray ID חלה שגיאה"])
    out = [r[0] for r in rows.select(pages.page_verdict(F.col("html"))).collect()]
    assert out == ["blocked", "ok", "ok", "error", "blocked"]


def test_record_files_are_read_by_header(spark, tmp_path):
    for city, text in (("akko", "address,city,pdf_path\nהרצל 1,akko,p1\n"), ("arad", "pdf_path,unknown,owner,building_file_number\np2,x,דן,7\n")):
        (tmp_path / city).mkdir()
        (tmp_path / city / "output.csv").write_text(text, encoding="utf-8-sig" if city == "arad" else "utf-8")
    got = {r.pdf_path: r for r in tables.read_city_tables(spark, str(tmp_path)).collect()}
    assert (got["p1"].city, got["p1"].address, got["p1"].source, got["p1"].owner) == ("akko", "הרצל 1", "akko", "")
    assert (got["p2"].owner, got["p2"].building_file_number, got["p2"].source, got["p2"].city) == ("דן", "7", "arad", "")
    assert tables.read_record_csv(spark, str(tmp_path / "none")).count() == 0
    assert tables.read_city_tables(spark, str(tmp_path / "none")).columns[0] == "source"


NESTED = """<table><tbody>
<tr><td>1 <table><tr><td>in</td><td>n</td><td>m</td><td><a href='/BuildingArchiveDetails?id=9'>i</a></td></tr></table></td>
<td>b</td><td>c</td><td><a href="/BuildingArchiveDetails?id=1">x</a></td></tr>
<tr><td>2<td>open<td>row<td><a href="/BuildingArchiveDetails?id=2">x</a>
<tr><td>3</td><td>d</td><td>e</td><td><a href="/BuildingArchiveDetails?id=3">x</a></td></tr>
</tbody></table><table><tr><td>4</td><td>f</td><td>g</td><td><a href="/BuildingArchiveDetails?id=4">x</a></td></tr></table>"""


def test_tables_in_tables_and_open_rows(columns):
    rows = pages.listing_rows(columns(html=[NESTED]), "html", []).orderBy("row_pos").drop("row_pos").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "in", "n", "/BuildingArchiveDetails?id=9"),
        ("in", "n", "m", "/BuildingArchiveDetails?id=9"),
        ("2", "open", "row", "/BuildingArchiveDetails?id=2"),
        ("3", "d", "e", "/BuildingArchiveDetails?id=3"),
        ("4", "f", "g", "/BuildingArchiveDetails?id=4"),
    ]


def test_both_ways_agree_on_regular_pages(columns, monkeypatch):
    page = columns(html=[LISTING, "", "<table></table>", "no table"])
    plain = sorted(map(tuple, pages.listing_rows(page, "html", []).collect()))
    monkeypatch.setattr(pages, "_is_irregular", lambda body, shape: F.lit(True))
    assert sorted(map(tuple, pages.listing_rows(page, "html", []).collect())) == plain != []


def test_a_long_irregular_page_is_read_row_by_row(columns):
    """Time goes with a page's tags: before, each tag copied all earlier ones, and each row looked at all cells of the page."""
    row = "<tr><td>{0}<table><tr><td>in{0}</table><td>b<td>c<td><a href='/BuildingArchiveDetails?id={0}'>x</a>"
    page = columns(html=["<table>" + "".join(row.format(i) for i in range(6000)) + "</table>"])
    began = time.monotonic()
    rows = pages.listing_rows(page, "html", []).orderBy("row_pos").drop("row_pos").collect()
    assert [tuple(r) for r in rows] == [(f"{i}in{i}", f"in{i}", "b", f"/BuildingArchiveDetails?id={i}") for i in range(6000)]
    assert time.monotonic() - began < 30


def test_a_pages_own_control_characters_stay(columns):
    """Depths are marked in the page's text; what looks like a mark in the page itself is text."""
    cells = ["\x011<td", "\x02a", "\x02b\x011<b>", "&#1;2", "\x01\x02"]
    html = "<table><tr><td>" + "<td>".join([*cells, "<a title='<tr>' href='/DocumentViewer?\x012\x02a'>x</a>"]) + "<table></table>"
    rows = [tuple(r) for r in pages.document_rows(columns(html=[html]), "html", []).drop("row_pos").collect()]
    assert rows == []  # the row ends at the tag in the title
    rows = pages.document_rows(columns(html=[html.replace(" title='<tr>'", "")]), "html", []).drop("row_pos").collect()
    assert [tuple(r) for r in rows] == [("\x011", "<td", "\x02a", "\x02b\x011", "\x012", "/DocumentViewer?\x012\x02a")]


def test_inventory_changes_between_visits(spark, tmp_path):
    store = tmp_path / "store"
    (store / "a").mkdir(parents=True)
    for name, text in (("same", "1"), ("longer", "1"), ("touched", "1"), ("gone", "1")):
        (store / "a" / f"{name}.pdf").write_text(text)
    log = InventoryLog(spark, str(tmp_path / "log"), str(store))
    assert log.visit() == 1
    (store / "a" / "longer.pdf").write_text("123")
    os.utime(store / "a" / "touched.pdf", (1, 1))
    (store / "a" / "gone.pdf").unlink()
    (store / "a" / "new.pdf").write_text("12")
    assert log.visit() == 2
    got = {r.path.rsplit("/", 1)[1]: (r.change, r.length, r.old_length) for r in log.changes(1, 2).collect()}
    assert got == {
        "longer.pdf": ("changed", 3, 1), "touched.pdf": ("changed", 1, 1), "gone.pdf": ("removed", None, 1), "new.pdf": ("added", 2, None),
    }
    assert log.changes(0, 2).count() == 4 and {r.change for r in log.changes(0, 2).collect()} == {"added"}
    log.visit()
    assert log.visits() == [2, 3] and log.changes(2, 3).count() == 0


def test_a_citys_files_are_written_by_many_tasks(spark, tmp_path):
    per_folder = storage._PER_FILE * storage._PER_FOLDER
    count = 2 * per_folder + 50
    rows = spark.range(count).select(F.lit("data/akko/pdfs/a").alias("folder"), F.format_string("p%07d", "id").alias("path"))
    storage._store_documents(SimpleNamespace(spark=spark), rows, str(tmp_path / "s"))
    found = tables.document_inventory(spark, str(tmp_path / "s"), "*.txt").collect()
    assert len(found) == -(-count // storage._PER_FILE) and len({r.folder for r in found}) == 3
    lines = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path / "s"))
    assert lines.distinct().count() == lines.count() == count
    storage._store_documents(SimpleNamespace(spark=spark), rows.limit(30), str(tmp_path / "s"), visit=2)
    cities = tables.document_inventory(spark, str(tmp_path / "s"), "*.txt").groupBy(storage._city_of("folder").alias("city"))
    assert [tuple(r) for r in cities.count().collect()] == [("akko", len(found) + 2)]


def test_markup_goes_before_references_are_decoded(columns):
    """Texts in two passes: what a reference stands for is text, never markup, and markup is taken out once per cell."""
    cells = columns(a=["<b>&lt;i&gt;</b> "], b=["&#x5D0;<br>&amp;lt;"]).select(pages._texts(F.array("a", "b")).alias("cells"))
    assert cells.first()[0] == ["<i>", "א&lt;"]
    assert cells._jdf.queryExecution().analyzed().toString().count("regexp_replace(") == 1


def _stored(root):
    """The lines of each file by its folder, files in the order of their names."""
    files = sorted(p for p in root.rglob("*.txt") if not any(part[0] in "._" for part in p.relative_to(root).parts))
    return [(str(p.parent.relative_to(root)), p.read_text(encoding="utf-8")) for p in files]


def test_text_files_are_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    cities = ["akko", "", "a/b=c %[x]{y}", "בת ים'\"#?*:\\^", "\x01\x7f"]
    lines = [(city, f"r{i // 9}", i % 9, None if i == 4 else f"{city} שורה {i}") for city in cities for i in range(14)]
    rows = spark.createDataFrame(lines, "city string, run string, line bigint, value string")
    write_text_files(rows, str(tmp_path / "here"), ["city", "run"], "line", 4)
    # Spark wrote a checksum beside each file, and started a process for each of them.
    assert not list((tmp_path / "here").rglob("*.crc")) and not list((tmp_path / "here").rglob("_*"))
    monkeypatch.setattr(text_files.store, "local_path", lambda spark, path: None)
    write_text_files(rows, str(tmp_path / "there"), ["city", "run"], "line", 4)
    assert _stored(tmp_path / "here") == _stored(tmp_path / "there") and len(_stored(tmp_path / "here")) == 5 * 5


def test_text_files_are_added_to_a_folder(spark, tmp_path):
    rows = spark.createDataFrame([("akko", i, f"a{i}") for i in range(5)], "city string, line bigint, value string")
    for _ in range(2):
        write_text_files(rows, (tmp_path / "s").as_uri(), ["city"], "line", 3)
    write_text_files(rows.limit(0), str(tmp_path / "s"), ["city"], "line", 3)
    assert sorted(_stored(tmp_path / "s")) == [("city=akko", "a0\na1\na2\n")] * 2 + [("city=akko", "a3\na4\n")] * 2
    assert len(list((tmp_path / "s").iterdir())) == 1 and len(list((tmp_path / "s" / "city=akko").iterdir())) == 4


def test_many_short_files_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"{i}.txt").write_text("x")
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1b")  # a task per file
    try:
        found = tables.document_inventory(spark, str(tmp_path), "*.txt")
        assert found.rdd.getNumPartitions() <= most < 60 and found.count() == 60
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()
