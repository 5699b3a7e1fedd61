"""Pages from a stored order, choices from a kept dictionary, search with file filters: each against the full computation."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from permitwright.operators import upkeep
from permitwright.plans import browse, search
from permitwright.plans.browse import Filters, Sort
from permitwright.plans.facets import FacetDictionary
from permitwright.plans.order_index import OrderIndex
from permitwright.plans.search import SearchIndex
from permitwright.schema import ALL_COLUMNS, as_records
from permitwright.sources.tables import RecordTable


@pytest.fixture(scope="module")
def records(spark):
    """Rows with many ties: repeated rows, rows that differ only beyond the tie break, addresses in several cities."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        city, number = rng.choice(["akko", "arad", ""]), str(rng.randint(0, 9))
        rows.append((city, number, f"p{rng.randint(0, 60)}", rng.choice(["הרצל 1", "הרצל 2", "", "ויצמן 3"]), rng.choice(["1/1/1999", "1/1/2005", ""]),
                     rng.choice(["משפחת כהן", "משפחת לוי", ""]), rng.choice(["אדריכל דן", "אדריכל רון 2", "xx ABCDEF gh"]), rng.choice(["3600", "3601", "x"])))
    rows += rows[:30]
    table = spark.createDataFrame(rows, "city string, building_file_number string, pdf_path string, address string, date string, owner string, architect string, gush string")
    return as_records(table).checkpoint()


def tuples(df, names):
    return [tuple(r) for r in df.select(*names).orderBy("position").collect()]


@pytest.mark.parametrize("sort", [Sort(), Sort("owner", True), Sort("gush", False)])
def test_pages_of_a_stored_order(spark, records, tmp_path, sort):
    names = [*ALL_COLUMNS, "position"]
    index = OrderIndex(spark, str(tmp_path / "i"), sort, ranges=5)
    assert not index.is_built()
    index.build(records)
    assert index.is_built() and index.total() == 430
    want = tuples(browse.sorted_records(records, sort), names)
    for page in (0, 3, 10):
        assert tuples(index.page(records, page, 40), names) == want[page * 40 : page * 40 + 40]
    assert index.page(records, 11, 40).count() == 0


@pytest.mark.parametrize("sort", [Sort(), Sort("architect", False)])
def test_pages_of_addresses_from_a_stored_order(spark, records, tmp_path, sort):
    names = [*ALL_COLUMNS, "group_key", "group_size", "position"]
    index = OrderIndex(spark, str(tmp_path / "i"), sort, grouped=True, ranges=3)
    index.build(records)
    every = browse.grouped_by_address(records, sort)
    want = tuples(every, names)
    assert index.total() == len(want)
    for page in (0, 1, 2):
        got = index.page(records, page, 4)
        assert tuples(got, names) == want[page * 4 : page * 4 + 4]
        assert {(r.groups, r.pages) for r in got.collect()} <= {(len(want), -(-len(want) // 4))}


def test_a_deep_page_reads_one_range(spark, tmp_path):
    rows = spark.range(5000).select(F.lit("c").alias("city"), F.col("id").cast("string").alias("building_file_number"), F.concat(F.lit("p"), "id").alias("pdf_path"))
    index = OrderIndex(spark, str(tmp_path / "i"), ranges=10)
    index.build(as_records(rows))
    entries, ranges = index.entries_of(2300, 40)
    assert ranges == 1 and entries.count() == 40
    plan = entries._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "range#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_dictionary_kept_by_changes(spark, records, tmp_path):
    dictionary = FacetDictionary(spark, str(tmp_path / "f"))
    first, second = records.filter("city = 'akko'"), records.filter("city <> 'akko'")
    dictionary.rebuild(first, 1)
    assert dictionary.change(1, 2, added=second)
    want = lambda rows: sorted(map(tuple, browse.facet_values(rows).collect()), key=str)
    assert sorted(map(tuple, dictionary.values(2).collect()), key=str) == want(records)
    edits = records.filter("architect = 'xx ABCDEF gh'").select("pdf_path", F.lit("").alias("owner"), F.lit("אדריכל חדש").alias("architect"), F.lit("save").alias("action"))
    corrected = upkeep.apply_corrections(records, edits.distinct())
    old, new = records.exceptAll(corrected.drop("changed")), corrected.drop("changed").exceptAll(records)
    assert dictionary.change(2, 3, added=new, removed=old)
    assert sorted(map(tuple, dictionary.values(3).collect()), key=str) == want(corrected.drop("changed"))
    for needle in ("", "חדש", "אדר"):
        got = [tuple(r) for r in dictionary.suggest(3, "architect", needle, 3).collect()]
        assert got == [tuple(r) for r in browse.suggest_values(corrected, "architect", needle, 3).collect()]
    assert not dictionary.change(7, 8, added=second) and dictionary.versions() == [2, 3]


def test_suggestions_read_one_facet(spark, records, tmp_path):
    dictionary = FacetDictionary(spark, str(tmp_path / "f"))
    dictionary.rebuild(records, 1)
    plan = dictionary.suggest(1, "gush", "36")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "facet#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_search_leaves_out_files_and_no_row(spark, records, tmp_path):
    table = RecordTable(spark, str(tmp_path / "t"))
    table.append(records)
    index = SearchIndex(table, str(tmp_path / "s"))
    assert index.refresh() == len(table.read().inputFiles()) and index.refresh() == 0
    needles = ["א", "ab", "p1", "akk", "AKKO", "הרצל 1", "משפחת", "xx abcdef", "nowhere at all", "", " arad ", "p10\0", "כהן\0", "1/1/1999"]
    for needle in needles:
        want = sorted(map(tuple, browse.filtered(table.read(), Filters(text=needle)).collect()))
        assert sorted(map(tuple, index.search(needle).collect())) == want, needle
    every = len(index.files("א"))
    assert len(index.files("akko")) < every and index.files("nowhere at all") == [] and len(index.files("ab")) == every
    # A file that the index does not know yet is read.
    table.append(as_records(spark.createDataFrame([("lod", "zebra")], "city string, pdf_path string")))
    assert [r.city for r in index.search("ZEBRA").collect()] == ["lod"]
    assert index.refresh() == 1 and len(index.files("zebra")) == 1
    found = index.search("akko", Filters(year_from=2000))
    assert found.count() == browse.filtered(table.read(), Filters(text="akko", year_from=2000)).count()


def test_bitmaps_hold_every_run_of_three_characters():
    """One pass over a task's rows: a row per file, no row per trigram."""
    texts = ["abc", "", "x", "בעל היתר", "a\0b\U0001f600c"]
    batch = pa.RecordBatch.from_pydict({"file": ["f", "f", "f", "f", "g"], "text": texts})
    (out,) = search._bitmaps(iter([batch]))
    assert out.column(0).to_pylist() == ["f", "g"]
    bitmaps = [np.unpackbits(np.array(bits, "<i8").view(np.uint8), bitorder="little") for bits in out.column(1).to_pylist()]
    for text, bitmap in zip(texts, [bitmaps[0]] * 4 + [bitmaps[1]], strict=True):
        assert all(bitmap[search._grams(search._points(text[i : i + 3]))].all() for i in range(len(text) - 2))
    assert bitmaps[1].sum() <= 3 and not bitmaps[1][search._grams(search._points("abc"))].any()


def test_an_index_of_other_bits_is_not_believed(spark, records, tmp_path):
    table = RecordTable(spark, str(tmp_path / "t"))
    table.append(records)
    index = SearchIndex(table, str(tmp_path / "s"))
    empty = [(file, [0] * (search.BITS >> 6)) for file in index._current()]
    spark.createDataFrame(empty, "file string, bits array<bigint>").write.parquet(str(tmp_path / "s" / "part-1"))
    assert index.refresh() == len(empty) and index.search("akko").count() > 0
