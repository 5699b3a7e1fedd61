"""Filters on literal records; order, groups and pages on many, with one address holding a third of them."""

import random

import pytest
from pyspark.sql import functions as F

from permitwright.plans import browse
from permitwright.plans.browse import Filters, Sort
from permitwright.schema import RECORD_COLUMNS


# What the text rules make of the values below.
CLEAN = {"": "", "משפחת כהן": "משפחת כהן", "xx ABC": "", "א": "א", "12": "12", "אדריכל לוי": "אדריכל לוי", "אדריכל דן": "אדריכל דן",
         "Arch": "", "אד": "אד"}
NUMBER = {"": 0, "36": 36, "5": 5, "100": 100, "5-6": 5, "x": 0, "7": 7, "10": 10, "215 216": 215, "1,2": 1}
YEAR = {"": 0, "1/1/2001": 2001, "1/1/1999": 1999, "2/2/2010": 2010, "לא ידוע": 0}
STREET = {"": "", "הרצל 1": "הרצל", "הרצל 2, חיפה": "הרצל חיפה", "בן גוריון 7": "בן גוריון", "אב 3": "אב"}


def make():
    rng = random.Random(9)
    rows = []
    for i in range(1200):
        row = dict.fromkeys(RECORD_COLUMNS, "")
        row["city"] = rng.choice(["", "חיפה", "אילת"])
        row["building_file_number"] = rng.choice(["", "1", "2", str(i)])
        row["address"] = "הרצל 1" if i % 3 == 0 else rng.choice(["", "", "הרצל 2, חיפה", "בן גוריון 7", "אב 3"])
        row["owner"] = rng.choice(["", "משפחת כהן", "xx ABC", "א", "12"])
        row["architect"] = rng.choice(["", "אדריכל לוי", "אדריכל דן", "Arch", "אד"])
        row["gush"] = rng.choice(["", "36", "5", "100", "5-6", "x"])
        row["helka"] = rng.choice(["", "7", "10", "215 216", "1,2"])
        row["date"] = rng.choice(list(YEAR))
        row["pdf_path"] = f"p{i:05d}"
        rows.append(row)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in RECORD_COLUMNS) for r in rows],
                                 ", ".join(f"{c} string" for c in RECORD_COLUMNS))


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def table(spark, rows):
    return frame(spark, rows).repartition(6).cache()


FEW = [
    {"pdf_path": "p1", "city": "חיפה", "address": "הרצל 1", "owner": "משפחת כהן", "architect": "אדריכל לוי", "gush": "5",
     "helka": "7", "date": "1/1/2001"},
    {"pdf_path": "p2", "city": "חיפה", "address": "הרצל 2, חיפה", "owner": "xx ABC", "architect": "Arch", "gush": "5-6",
     "helka": "7", "date": "2/2/2010"},
    {"pdf_path": "p3", "city": "אילת", "address": "בן גוריון 7", "owner": "משפחת כהן", "architect": "", "gush": "36",
     "helka": "215 216", "date": "1/1/1999"},
    {"pdf_path": "p4", "city": "", "address": "", "owner": "", "architect": "אדריכל לוי", "gush": "5", "helka": "1,2",
     "date": "לא ידוע"},
    {"pdf_path": "p5", "city": "אילת", "address": "אב 3", "owner": "א", "architect": "אד", "gush": "", "helka": "",
     "date": "1/1/1000000000000000000000"},
]
FILTERS = [
    (Filters(), "p1 p2 p3 p4 p5"),
    (Filters(text="  abc "), "p2"),
    (Filters(text="P3"), "p3"),
    (Filters(year_from=2000), "p1 p2 p5"),
    (Filters(year_to=2000), "p3 p4"),
    (Filters(year_from=2005, year_to=2015), "p2"),
    (Filters(gush="5"), "p1 p4"),
    (Filters(city="חיפה"), "p1 p2"),
    (Filters(street="הרצל"), "p1 p2"),
    (Filters(architect="אדריכל לוי"), "p1 p4"),
    (Filters(architect="Arch"), ""),
    (Filters(missing_only=True), "p2 p3 p4"),
    (Filters(private_only=True), "p1 p5"),
    (Filters(text="כהן", year_from=1999, year_to=2005, city="חיפה", street="הרצל", private_only=True), "p1"),
]


@pytest.mark.parametrize("wanted, found", FILTERS)
def test_filters(spark, wanted, found):
    table = frame(spark, [dict.fromkeys(RECORD_COLUMNS, "") | row for row in FEW])
    assert sorted(r.pdf_path for r in browse.filtered(table, wanted).collect()) == found.split()


def test_a_value_is_not_found_across_two_columns(columns):
    rows = columns(a=["xy"], b=["z"])
    assert rows.filter(browse.contains_anywhere(["a", "b"], "yz")).count() == 0
    assert rows.filter(browse.contains_anywhere(["a", "b"], "XY")).count() == 1


def sort_rows(rows, sort):
    def key(row):
        value = row[sort.column]
        if sort.column == "date":
            return YEAR[row["date"]]
        return NUMBER[value] if sort.column in ("gush", "helka") else value

    ordered = sorted(rows, key=lambda r: (r["city"], r["building_file_number"], r["pdf_path"]))
    return sorted(ordered, key=key, reverse=not sort.ascending)


SORTS = [Sort(), Sort("gush", True), Sort("helka", False), Sort("owner", True), Sort("owner", False), Sort("date", True)]


@pytest.mark.parametrize("sort", SORTS, ids=lambda s: f"{s.column}-{s.ascending}")
def test_sorting_grouping_and_paging(table, rows, sort):
    ordered = sort_rows(rows, sort)
    placed = sorted(browse.sorted_records(table, sort).collect(), key=lambda r: r.position)
    assert [r.pdf_path for r in placed] == [r["pdf_path"] for r in ordered]

    groups = {}
    for row in ordered:
        groups.setdefault(row["address"] or row["building_file_number"] or row["pdf_path"], []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: YEAR[r["date"]], reverse=True)
    want = [(key, len(group), group[0]["pdf_path"]) for key, group in groups.items()]
    heads = sorted(browse.grouped_by_address(table, sort).collect(), key=lambda r: r.position)
    assert [(r.group_key, r.group_size, r.pdf_path) for r in heads] == want
    assert [r.position for r in heads] == list(range(1, len(want) + 1))

    page = sorted(browse.page_of_groups(table, 1, sort, 15).collect(), key=lambda r: r.position)
    assert [(r.group_key, r.group_size, r.pdf_path) for r in page] == want[15:30]
    assert {(r.groups, r.pages) for r in page} == {(len(want), -(-len(want) // 15))}

    inside = {}
    for row in sorted(browse.group_rows(table, sort).collect(), key=lambda r: r.place_in_group):
        inside.setdefault(row.group_key, []).append(row.pdf_path)
    assert inside == {key: [r["pdf_path"] for r in group] for key, group in groups.items()}

    flat = sorted(browse.page_of_records(table, 2, sort, 30).collect(), key=lambda r: r.position)
    assert [r.pdf_path for r in flat] == [r["pdf_path"] for r in ordered[60:90]]


def test_heading_clicks():
    assert Sort().click("date") == Sort("date", True)
    assert Sort().click("owner") == Sort("owner", True)
    assert Sort("owner", True).click("owner") == Sort("owner", False)


def test_metrics(table, rows):
    card = browse.metric_cards(table).first()
    assert tuple(card) == (
        len(rows),
        len({r["address"] for r in rows} - {""}),
        len({CLEAN[r["architect"]] for r in rows} - {""}),
        len({STREET[r["address"]] for r in rows} - {""}),
        len({r["gush"] for r in rows if r["gush"].isdigit()}),
        sum(not CLEAN[r["owner"]] or not CLEAN[r["architect"]] for r in rows),
    )


def test_facets_and_suggestions(table, rows):
    got = {}
    for row in browse.facet_values(table).collect():
        got.setdefault(row.facet, set()).add(row.value)
    assert got == {
        "year": {str(YEAR[r["date"]]) for r in rows if 2000 <= YEAR[r["date"]] <= 2030},
        "gush": {r["gush"] for r in rows if r["gush"].isdigit()},
        "street": {STREET[r["address"]] for r in rows if len(STREET[r["address"]]) > 2},
        "architect": {CLEAN[r["architect"]] for r in rows} - {""},
        "city": {r["city"] for r in rows} - {""},
    }
    hits = browse.suggest_values(table, "architect", "אדריכל", 1).collect()
    assert [(r.value, r["rank"]) for r in hits] == [("אדריכל דן", 1)]


def test_top_architects(table, rows):
    counts = {}
    for r in rows:
        if CLEAN[r["architect"]]:
            counts[CLEAN[r["architect"]]] = counts.get(CLEAN[r["architect"]], 0) + 1
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    got = sorted(browse.top_architects(table).collect(), key=lambda r: r["rank"])
    assert [(r.architect, r.records) for r in got] == want
    assert [r.bar for r in got] == [pytest.approx(max(n / want[0][1] * 100, 4)) for _, n in want]


def test_no_records_give_empty_results(table):
    none = table.filter(F.lit(False))
    assert browse.page_of_groups(none, 0).count() == 0
    assert browse.sorted_records(none).count() == 0
    assert browse.top_architects(none).count() == 0
    assert tuple(browse.metric_cards(none).first()) == (0, 0, 0, 0, 0, 0)
