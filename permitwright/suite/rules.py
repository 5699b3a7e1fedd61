"""The text rules once more, as DuckDB SQL snippets for the checks."""

from __future__ import annotations

from permitwright.functions.responses import RESPONSE_FIELDS
from permitwright.schema import CONFIDENCE_FIELDS, RECORD_COLUMNS

HEBREW = r"[^\x{0590}-\x{05FF}]"


def strip(value: str) -> str:
    return rf"regexp_replace({value}, '^\s+|\s+$', '', 'g')"


def hebrew(value: str) -> str:
    return f"length(regexp_replace({value}, '{HEBREW}', '', 'g'))"


def valid(value: str) -> str:
    text = strip(value)
    return (
        rf"(length({text}) >= 2 and not regexp_full_match({text}, '[\d\s./\-]+')"
        rf" and {hebrew(text)} / greatest(length(replace({text}, ' ', '')), 1) >= 0.25)"
    )


def complete() -> str:
    return f"({valid('owner')} and {valid('architect')})"


def clean(value: str) -> str:
    noise = (
        rf"(length({value}) >= 3 and not regexp_full_match({value}, '[\d\s./\-]+') and ({hebrew(value)} = 0"
        rf" or {hebrew(value)} / length(regexp_replace({value}, '\s', '', 'g')) < 0.25))"
    )
    return f"(case when {noise} then '' else {value} end)"


def missing() -> str:
    return f"({clean('owner')} = '' or {clean('architect')} = '')"


def integer(value: str) -> str:
    return rf"coalesce(try_cast(regexp_extract({value}, '^\s*([+-]?\d+)', 1) as double), 0)"


def year(value: str = "date") -> str:
    return integer(f"list_extract(string_split({value}, '/'), -1)")


def street(value: str = "address") -> str:
    return (
        rf"trim(regexp_replace(regexp_replace(regexp_replace({value}, '\d+', '', 'g'),"
        rf" '[,،.()]', ' ', 'g'), '\s+', ' ', 'g'))"
    )


def single_parcel() -> str:
    one = [
        rf"not regexp_matches({c}, '[,\-]') and len(string_split_regex(trim({c}), '\s+')) <= 1" for c in ("helka", "gush")
    ]
    return "(" + " and ".join(one) + ")"


def folder(value: str) -> str:
    return rf"""regexp_replace(regexp_replace({strip(value)}, '[/\\:*?"<>|]', '_', 'g'), '\s+', '_', 'g')"""


def cleaned(value: str, collapse: bool) -> str:
    text = strip(rf"regexp_replace({strip(value)}, '[|\[\]{{}}><]+', '', 'g')")
    return rf"regexp_replace({text}, '\s{{2,}}', ' ', 'g')" if collapse else text


# The two pattern sets, stated again.
PATTERNS_A = {
    "owner": r"בעל[_ ]הי?תר[:\s]*(.+)",
    "architect": r"ע?ורך[_ ]הבקשה[:\s]*(.+)",
    "structural_planner": r"מתכנן[_ ]שלד[:\s]*(.+)",
    "gush": r"גוש[:\s]*(\d+)",
    "helka": r"חלקה[:\s]*(\d+)",
    "migrash": r"מגרש[:\s]*(\d+)",
    "permit_number": r"היתר בני[הי] מספר[:\s]*(\S+)",
    "building_file": r"תיק בני[ין][:\s]*(\d+)",
    "city_plan": r"תוכנית[:\s]*([^\n]+)",
    "address": r"כתובת[:\s]*([^\n]+)",
}
PATTERNS_B = {
    **{name: PATTERNS_A[name] for name in ("owner", "architect", "gush", "helka", "migrash", "city_plan")},
    "permit_number": r"(?:היתר בני[הי] מספר|מספר בקשה)[:\s]*(\d+)",
    "address": r"כתובת(?:\s*הבניה)?[:\s]*([^\n]+)",
    "date": r"בתאריך[:\s]*(\S+)",
}
# Phrases that mark a permit, stated again.
PERMIT_TEXT = (
    "(contains(ocr_text, 'היתר בני') or contains(ocr_text, 'טופס 3') or contains(ocr_text, 'תקנה 18')"
    " or contains(ocr_text, 'היתר זה'))"
)


def field_a(name: str, text: str = "ocr_text") -> str:
    return cleaned(f"regexp_extract({text}, '{PATTERNS_A[name]}', 1)", collapse=True)


def field_b(name: str, text: str = "ocr_text") -> str:
    return cleaned(f"regexp_extract({text}, '{PATTERNS_B[name]}', 1)", collapse=False)


def confidence_b(name: str, text: str = "ocr_text") -> str:
    return f"case when regexp_matches({text}, '{PATTERNS_B[name]}') then 'high' else 'none' end"


# Responses with their parsed object `j`, NULL where there is none.
PARSED = rf"""parsed as (select *, case when json_type(doc) = 'OBJECT' then doc end as j from (
  select *, try_cast(case when starts_with(t, '```') then
      case when not contains(t, chr(10)) then null
        else regexp_extract(regexp_replace(t, '^[^\n]*\n', ''), '^((?s:.*))```', 1) end
    else t end as json) as doc
  from (select *, {strip('response_text')} as t from fx_responses) s) d)"""


def response_field(name: str) -> str:
    raw = f"json_extract_string(j, '$.{name}')"
    return f"case when {raw} is null or {raw} = 'null' then '' else {strip(raw)} end"


def response_confidence(name: str) -> str:
    raw = f"json_extract_string(j, '$.{name}')"
    return f"case when {raw} is null or {raw} = 'null' then 'none' else 'high' end"


RECORD = RECORD_COLUMNS
CONFIDENT = CONFIDENCE_FIELDS
RECORD_LIST = ", ".join(RECORD)
FULL_LIST = RECORD_LIST + ", " + ", ".join(f"{c}_confidence" for c in CONFIDENT)
BLANK_CONFIDENCES = ", ".join(f"'' as {c}_confidence" for c in CONFIDENT)
# Default order of the table: newest first, then the tie break.
NEWEST = f"{year()} desc, city, building_file_number, pdf_path, {RECORD_LIST}"
