"""Text rules on literal values."""

import pytest
from pyspark.sql import functions as F

from permitwright.functions import text as T

WIDE = "\xa0אב　"
MARKED = "﻿אבג﻿"

VALUES = {
    "strip": (T.strip, {
        "": "", " ": "", "  12 34 ": "12 34", "\xa0\xa0": "", "א\xa0": "א", WIDE: "אב", "\x1fאב": "אב", "\t7\t": "7",
        "  ": "", "  שלום   עולם ": "שלום   עולם", "א b": "א b", MARKED: MARKED,
    }),
    "clean": (T.clean, {
        "": "", "א": "א", "אב": "אב", "ab": "ab", "12": "12", "1-2/3.4": "1-2/3.4", "abc": "", "אב cdefgh": "אב cdefgh",
        "אב cdefghi": "", "אabc": "אabc", "אabcd": "", "א b c d e": "", "😀": "😀", "😀😀": "", "xx ABCDEF gh": "", "12א": "12א",
        "12,13": "", "1/1/٣٤": "", "...": "...", "20_04": "", "3636-3637": "3636-3637", "é": "é",
    }),
    "leading": (T.leading_integer, {
        "": 0.0, "א12": 0.0, "12א": 12.0, "  12 34 ": 12.0, "\t7\t": 7.0, "-5": -5.0, "+7": 7.0, "20_04": 20.0, "_2": 0.0, "٣٤": 0.0,
        "0012": 12.0, "999999999999999999": 999999999999999999.0, "1000000000000000000000": 1e21, "7" * 40: float("7" * 40),
    }),
    "year": (T.year_lenient, {
        "": 0.0, "/": 0.0, "1/2/": 0.0, "1/2/2004": 2004.0, "1/2/ 2004 ": 2004.0, "01/01/2004a": 2004.0, "x/y/-5": -5.0, "x/+7": 7.0,
        "2004": 2004.0, "לא ידוע": 0.0,
    }),
    "street": (T.street_name, {
        "": "", "12": "", "הרצל 12, נחל. (דרום)": "הרצל נחל דרום", "1/2/2004": "//", "א\tב\nג": "א ב ג", WIDE: "אב", MARKED: "אבג",
        "3636-3637": "-", "1/1/٣٤": "//٣٤", "...": "", "  שלום   עולם ": "שלום עולם",
    }),
    "folder": (T.folder_name, {
        "": "", " ": "", "א\xa0": "א", "  12 34 ": "12_34", "1/2/ 2004 ": "1_2__2004", 'a/b\\c:d*e?f"g<h>i|j': "a_b_c_d_e_f_g_h_i_j",
        "א\tב\nג": "א_ב_ג", "הרצל 12, נחל. (דרום)": "הרצל_12,_נחל._(דרום)", "/ /": "___",
    }),
}

# Rule, values for which it holds, values for which it does not.
TESTS = {
    "valid": (
        T.is_valid_field,
        ["אב", WIDE, "\x1fאב", "אב cdefgh", "אabc", "😀א", "12א", MARKED, "הרצל 12, נחל. (דרום)", "א\tב\nג", "א.", "12 א"],
        ["", " ", "א", "א\xa0", "abc", "12", "1-2/3.4", "\xa0\xa0", "אב cdefghi", "אabcd", "א b c d e", "😀😀", "1/1/٣٤", "/ /"],
    ),
    "garbage": (
        T.is_garbage,
        ["abc", "אב cdefghi", "אabcd", "א b c d e", "😀😀", "01/01/2004a", "x/+7", "2__0", "12,13", "a b", "1/1/٣٤"],
        ["", "א", "ab", "12", "1-2/3.4", "  12 34 ", "\xa0\xa0", "אבג", "אabc", "😀", "12א", "...", "/ /", "\t7\t", "é"],
    ),
    "parcel": (
        lambda c: T.is_single_parcel(c, c),
        ["", " ", "12", "\xa0\xa0", WIDE, "1/2/2004", "20_04", "...", "\t7\t", MARKED],
        ["1-2", "12,13", "215 216", "א b", "3636-3637", "12　13", "-"],
    ),
}


@pytest.mark.parametrize("name", sorted(VALUES))
def test_values(name, columns):
    rule, cases = VALUES[name]
    got = columns(v=list(cases)).select("v", rule(F.col("v")).alias("r")).collect()
    assert {r.v: r.r for r in got} == cases


@pytest.mark.parametrize("name", sorted(TESTS))
def test_tests(name, columns):
    rule, holds, fails = TESTS[name]
    got = columns(v=holds + fails).select("v", rule(F.col("v")).alias("r")).collect()
    assert {r.v for r in got if r.r} == set(holds)


def test_numbers_of_any_length_keep_their_order(columns):
    rows = columns(v=["1000000000000000000000", "999999999999999999", "12", "", "-3", "9" * 40])
    got = [r.v for r in rows.orderBy(T.leading_integer(F.col("v"))).collect()]
    assert got == ["-3", "", "12", "999999999999999999", "1000000000000000000000", "9" * 40]


def test_strict_year(columns):
    cases = {"1/2/2004": 2004, " 2004 ": 2004, "20_04": 2004, "-5": -5, "2004a": None, "2_": None, "_2": None, "2__0": None,
             "": None, "1/2/": None, "x/+7": 7}
    got = columns(v=list(cases)).select("v", T.year_strict(F.col("v")).alias("y")).collect()
    assert {r.v: None if r.y is None else int(r.y) for r in got} == cases


def test_links(columns):
    rows = columns(href=["/a", "http://x/b", "https://y"], number=["", "5", "7"])
    out = rows.select(T.absolute_link(F.col("href"), F.lit("https://h")).alias("a"), T.detail_path(F.col("number")).alias("d"))
    assert [tuple(r) for r in out.collect()] == [
        ("https://h/a", ""),
        ("http://x/b", "/BuildingArchiveDetails?OrgEntityNumber=5&pageId=8575&DefinementEntityType=10&BuildingNum=5"),
        ("https://y", "/BuildingArchiveDetails?OrgEntityNumber=7&pageId=8575&DefinementEntityType=10&BuildingNum=7"),
    ]
