"""Pattern sets, responses and the extraction modes on literal texts."""

import json

import pytest
from pyspark.sql import functions as F

from permitwright.functions.patterns import (
    DIGITS,
    SET_A,
    SET_B,
    FieldPattern,
    extract_values,
    extract_with_confidence,
    is_permit_text,
)
from permitwright.functions.responses import RESPONSE_FIELDS, parse_responses
from permitwright.operators import documents, extract
from permitwright.schema import ALL_COLUMNS
from permitwright.sources import batch


# Text, what the first set finds, what the second finds; absent fields are empty.
TEXTS = [
    (
        "כתובת הבניה 12/03/2004\nחלקה:\xa012/03/2004\nבתאריך:\n\nx\x85y",
        {"helka": "12", "address": "הבניה 12/03/2004"},
        {"helka": "12", "address": "12/03/2004", "date": "x"},
    ),
    (
        "מתכנן שלד: 12/03/2004\nבעל_התר::\t<>{}\nכתובת הבניה:\n\nx\x85y",
        {"structural_planner": "12/03/2004", "owner": "", "address": "הבניה:"},
        {"owner": "", "address": "x\x85y"},
    ),
    (
        "גוש::\tמשה כהן\nבעל_התר:\xa04/5\nבעל היתר הרצל 5,  חיפה\r\nכתובת הבניה::\t4/5",
        {"owner": "4/5", "address": "הבניה::\t4/5"},
        {"owner": "4/5", "address": "4/5"},
    ),
    (
        "בעל היתר:\n\n| דנה  לוי []\nהיתר בניה מספר:\n4/5",
        {"owner": "דנה לוי", "permit_number": "4/5"},
        {"owner": "דנה  לוי", "permit_number": "4"},
    ),
    ("ורך_הבקשה: 123\nעורך הבקשה: 4/5\nמגרש::\t4/5", {"architect": "123", "migrash": "4"}, {"architect": "123", "migrash": "4"}),
    ("תוכנית 4/5\nתיק בנין: 17\nמספר בקשה: 8", {"city_plan": "4/5", "building_file": "17"}, {"city_plan": "4/5", "permit_number": "8"}),
    ("היתר בניה מספר::\t", {"permit_number": ":"}, {}),
    ("חלקה:\xa0<>{}", {}, {}),
    ("", {}, {}),
]


@pytest.mark.parametrize("text, first, second", TEXTS)
def test_pattern_sets(columns, text, first, second):
    rows = columns(t=[text])
    got = extract_values(rows, "t", SET_A, []).first().asDict()
    assert got == dict.fromkeys(got, "") | first
    got = extract_with_confidence(rows, "t", SET_B, []).first().asDict()
    names = [n for n in got if not n.endswith("_confidence")]
    assert {n: got[n] for n in names} == dict.fromkeys(names, "") | second
    assert {n: got[n + "_confidence"] for n in names} == {n: "high" if n in second else "none" for n in names}


def test_both_sets_keep_their_own_address_rule(columns):
    rows = columns(t=["כתובת הבניה: הרצל 5"])
    assert extract_values(rows, "t", SET_A, []).first().address == "הבניה: הרצל 5"
    assert extract_with_confidence(rows, "t", SET_B, []).first().address == "הרצל 5"


def test_empty_label_takes_the_next_line(columns):
    rows = columns(t=["בעל היתר:\nגוש: 5"])
    assert extract_values(rows, "t", SET_A, []).first().owner == "גוש: 5"


def test_a_third_set_is_just_data(columns):
    mine = [FieldPattern("engineer", r"מהנדס[:\s]*(.+)"), FieldPattern("floors", r"קומות[:\s]*(\d+)", DIGITS)]
    row = extract_with_confidence(columns(t=["קומות: 4\nקומה"]), "t", mine, []).first()
    assert row.asDict() == {"engineer": "", "engineer_confidence": "none", "floors": "4", "floors_confidence": "high"}


def test_permit_phrases(columns):
    rows = columns(t=["טופס 3", "היתר זה", "תקנה 18", "x היתר בניה", "תוכנית"])
    assert [r[0] for r in rows.select(is_permit_text(F.col("t"))).collect()] == [True, True, True, True, False]


FENCE = "```"
# Response and the values it gives; every other field is empty with confidence none.
RESPONSES = {
    '{"owner": " א ", "gush": 12, "helka": null, "migrash": "null", "x": {"y": 1}}': {"owner": "א", "gush": "12"},
    FENCE + 'json\n{"owner": "ב"}\n' + FENCE: {"owner": "ב"},
    FENCE + '\n{"owner": "ב"}\n' + FENCE + "\nand more": {"owner": "ב"},
    FENCE + '\n{"owner": "a' + FENCE + 'b"}\n' + FENCE: {"owner": "a" + FENCE + "b"},
    '  \n{"owner": "ג"}\n ': {"owner": "ג"},
    '{"owner": ""}': {"owner": ""},
    '{"owner": "ד"} trailing': {},
    '{"owner": "ד"}}': {},
    '{"owner": "ד"}]': {},
    '{"owner": "ד"': {},
    '{"owner":"a"},"z":{"b":1}': {},
    '{"owner":"a"},"closed":1,"z":{"b":1}': {},
    "{'owner': 'ד'}": {},
    "": {},
    "nope": {},
}


def test_responses(columns):
    for row in parse_responses(columns(t=list(RESPONSES)), "t", ["t"]).collect():
        given = RESPONSES[row.t]
        for name in RESPONSE_FIELDS:
            want = (given[name], "high") if name in given else ("", "none")
            assert (row[name], row[name + "_confidence"]) == want, (name, row.t)


def test_unusable_responses_are_set_aside(columns):
    rows = columns(response_text=["[1]", "3", FENCE + "x" + FENCE, "{", "{}"])
    out = [(r.error, r.outcome) for r in extract.with_outcome(rows).collect()]
    assert out == [
        ("not_an_object", "quarantined"),
        ("not_an_object", "quarantined"),
        ("fence_without_body", "quarantined"),
        ("invalid_json", "ok"),
        ("", "ok"),
    ]


@pytest.fixture
def documents_and_pages(spark):
    rows = spark.createDataFrame(
        [("a", "טופס 3\nגוש: 1"), ("b", "טופס 3\nגוש: 2"), ("c", "לא\nגוש: 3"), ("d", "טופס 3\nגוש: 4")],
        "pdf_path string, ocr_text string",
    )
    pages = spark.createDataFrame(
        [("a", 0, 595.0), ("b", 0, 595.0), ("c", 1, 595.0), ("d", 0, 2384.0)], "pdf_path string, page_idx int, width_pt double"
    )
    return rows, pages


def gush(df):
    return {r.pdf_path: (r.gush, r.gush_confidence) for r in df.collect()}


def test_modes(spark, documents_and_pages):
    rows, pages = documents_and_pages
    answers = spark.createDataFrame([("a", '{"gush": 9}'), ("d", '{"gush": 8}')], "record_id string, response_text string")
    cloud = extract.extract_records(rows, "cloud", pages, answers)
    assert cloud.columns == ALL_COLUMNS
    assert gush(cloud) == {"a": ("9", "high"), "b": ("2", "")}
    assert gush(extract.extract_records(rows, "local", pages)) == {"a": ("1", "high"), "b": ("2", "high"), "c": ("3", "high")}
    assert gush(extract.extract_records(rows, "local", pages, local_engine=False)) == {"a": ("1", ""), "b": ("2", "")}
    assert gush(extract.extract_records(rows, "tesseract")) == {"a": ("1", ""), "b": ("2", ""), "d": ("4", "")}
    assert gush(extract.extract_records(rows, "skip")) == {}
    with pytest.raises(ValueError):
        extract.extract_records(rows, "other")


def test_repeats_give_one_record(spark, documents_and_pages):
    rows, pages = documents_and_pages
    answers = spark.createDataFrame(
        [("a", "broken", 0), ("a", '{"gush": 9}', 1), ("a", '{"gush": 8}', 2), (None, '{"gush": 7}', 0)],
        "record_id string, response_text string, place int")
    twice = rows.unionAll(rows)
    for mode, given in (("cloud", answers), ("local", None), ("tesseract", None)):
        found = extract.extract_records(twice, mode, pages, given)
        assert sorted(r.pdf_path for r in found.collect()) == {"cloud": ["a", "b"], "local": ["a", "b", "c"], "tesseract": ["a", "b", "d"]}[mode]
    assert gush(extract.extract_records(twice, "cloud", pages, answers))["a"] == ("9", "high")


def test_the_gate_looks_at_the_page_only_but_patterns_at_both_texts(columns):
    rows = columns(pdf_path=["a", "b"], ocr_text=["טופס 3", "אין"], name_text=["בעל היתר: דן", "טופס 3\nבעל היתר: רן"])
    assert {r.pdf_path: r.owner for r in extract.extract_records(rows, "tesseract").collect()} == {"a": "דן"}


def test_stamping(columns):
    records = columns(pdf_path=["a", "b"], address=["", "x"], date=["1", "2"], city=["", ""], building_file_number=["8", "9"])
    work = columns(pdf_path=["a", "b"], city=["c", "c"], file_id=["1", "2"], address=["w", "w"], date=["d", ""])
    out = extract.stamp_records(records, work).select("pdf_path", "city", "building_file_number", "address", "date")
    assert sorted(map(tuple, out.collect())) == [("a", "c", "1", "w", "d"), ("b", "c", "2", "x", "")]


def test_page_width_limit_is_strict(spark):
    exactly = 300 * 72 / 25.4
    rows = spark.createDataFrame([("a", 0, exactly), ("a", 1, exactly - 0.01), ("a", 2, 500.0), ("b", 0, 900.0)],
                                 "pdf_path string, page_idx int, width_pt double")
    assert [tuple(r) for r in documents.first_permit_page(rows).collect()] == [("a", 1)]


def test_document_targets(columns):
    links = columns(
        file_id=["1", "2", "3"], address=[" הרצל 5/6 ", "", "x"], entity_number=["7", "", "8"],
        url=["/v?Name_File=n1&a=b", "/v?Name_File=n2", "/v?other=1"],
    )
    out = documents.document_targets(links, F.lit("data"))
    assert [(r.target, r.error) for r in out.collect()] == [
        ("data/הרצל_5_6/permit_7.pdf", ""),
        ("data/file_2/permit_n2.pdf", ""),
        ("", "no document name in link"),
    ]
    by_name = documents.document_targets(links, F.lit("data"), prefer_entity_number=False)
    assert by_name.first().target == "data/הרצל_5_6/permit_n1.pdf"


def test_request_lines_are_the_expected_objects(spark):
    pages = spark.createDataFrame([('a"b}.pdf', bytearray(b"\x89PNG"))], "pdf_path string, payload binary")
    line = json.loads(batch.batch_requests(pages, 'say "hi"\n').first().value)
    assert line == {
        "recordId": 'a"b}.pdf',
        "modelInput": {
            "anthropic_version": "bedrock-2023-05-31",
            "max_tokens": 1024,
            "messages": [
                {
                    "role": "user",
                    "content": [
                        {"type": "image", "source": {"type": "base64", "media_type": "image/png", "data": "iVBORw=="}},
                        {"type": "text", "text": 'say "hi"\n'},
                    ],
                }
            ],
        },
    }


def test_response_files(spark, tmp_path):
    (tmp_path / "job").mkdir()
    good = json.dumps({"recordId": "a", "modelOutput": {"content": [{"text": '{"owner":"x"}'}]}})
    (tmp_path / "job" / "in.jsonl.out").write_text(
        good + "\n\n" + json.dumps({"recordId": "b", "modelOutput": {}}) + "\nbroken\n", encoding="utf-8"
    )
    (tmp_path / "job" / "manifest.json.out").write_text(good + "\n", encoding="utf-8")
    rows = batch.read_responses(spark, str(tmp_path)).collect()
    assert sorted((r.record_id or "", r.response_text) for r in rows) == [("", "{}"), ("a", '{"owner":"x"}'), ("b", "{}")]
