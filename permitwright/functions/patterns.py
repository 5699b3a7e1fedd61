"""Field patterns over document text.

A pattern set is data: an ordered list of fields, each with a pattern whose first group is the value and a shape
that says which cleaning can change it. Adding an extractor means adding a list, not code. Patterns must not match
the empty string.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.functions.text import strip

# U: classes such as \s and \d cover Unicode. d: only \n ends a line, so a dot matches \r.
REGEX_FLAGS = "(?Ud)"

DIGITS = "digits"  # no cleaning can change it
TOKEN = "token"  # no white space inside, borders may cling to it
PHRASE = "phrase"  # free text up to the end of the line


@dataclass(frozen=True)
class FieldPattern:
    name: str
    pattern: str
    shape: str = PHRASE


# Patterns of the first set.
SET_A = [
    FieldPattern("owner", r"בעל[_ ]הי?תר[:\s]*(.+)"),
    FieldPattern("architect", r"ע?ורך[_ ]הבקשה[:\s]*(.+)"),
    FieldPattern("structural_planner", r"מתכנן[_ ]שלד[:\s]*(.+)"),
    FieldPattern("gush", r"גוש[:\s]*(\d+)", DIGITS),
    FieldPattern("helka", r"חלקה[:\s]*(\d+)", DIGITS),
    FieldPattern("migrash", r"מגרש[:\s]*(\d+)", DIGITS),
    FieldPattern("permit_number", r"היתר בני[הי] מספר[:\s]*(\S+)", TOKEN),
    FieldPattern("building_file", r"תיק בני[ין][:\s]*(\d+)", DIGITS),
    FieldPattern("city_plan", r"תוכנית[:\s]*([^\n]+)"),
    FieldPattern("address", r"כתובת[:\s]*([^\n]+)"),
]

# Patterns of the second set.
SET_B = [
    FieldPattern("owner", r"בעל[_ ]הי?תר[:\s]*(.+)"),
    FieldPattern("architect", r"ע?ורך[_ ]הבקשה[:\s]*(.+)"),
    FieldPattern("address", r"כתובת(?:\s*הבניה)?[:\s]*([^\n]+)"),
    FieldPattern("gush", r"גוש[:\s]*(\d+)", DIGITS),
    FieldPattern("helka", r"חלקה[:\s]*(\d+)", DIGITS),
    FieldPattern("migrash", r"מגרש[:\s]*(\d+)", DIGITS),
    FieldPattern("permit_number", r"(?:היתר בני[הי] מספר|מספר בקשה)[:\s]*(\d+)", DIGITS),
    FieldPattern("date", r"בתאריך[:\s]*(\S+)", TOKEN),
    FieldPattern("city_plan", r"תוכנית[:\s]*([^\n]+)"),
]

# Phrases that mark a text as a permit.
PERMIT_PHRASES = ["היתר בני", "טופס 3", "תקנה 18", "היתר זה"]

# Fixed value: characters that table borders leave in a reading.
BORDER_CHARACTERS = "|[]{}><"


def is_permit_text(text: Column) -> Column:
    test = F.lit(False)
    for phrase in PERMIT_PHRASES:
        test = test | text.contains(phrase)
    return test


def _cleaned(value: Column, shape: str, collapse: bool) -> Column:
    if shape == DIGITS:
        return value
    value = F.translate(strip(value), BORDER_CHARACTERS, "")
    if shape == TOKEN:
        return value
    value = strip(value)
    return F.regexp_replace(value, r"(?U)\s{2,}", " ") if collapse else value


def pattern_values(text: Column, patterns: list[FieldPattern]) -> dict[str, Column]:
    """Cleaned value per field, empty where the pattern is absent; inner runs of white space become one space."""
    return {
        p.name: _cleaned(F.regexp_extract(text, REGEX_FLAGS + p.pattern, 1), p.shape, collapse=True) for p in patterns
    }


def label_matches(text: Column, patterns: list[FieldPattern]) -> Column:
    """Struct of each field's whole match, label included; empty where the label is absent."""
    return F.struct(*[F.regexp_extract(text, REGEX_FLAGS + p.pattern, 0).alias(p.name) for p in patterns])


def matched_values(matches: Column, patterns: list[FieldPattern]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Values and confidences from `label_matches`: high where the label was found, even with nothing in it.

    The long text is searched once per field; value and confidence both come from the short match.
    """
    values, confidences = {}, {}
    for p in patterns:
        match = matches.getField(p.name)
        values[p.name] = _cleaned(F.regexp_extract(match, REGEX_FLAGS + p.pattern, 1), p.shape, collapse=False)
        confidences[p.name] = F.when(match != "", "high").otherwise("none")
    return values, confidences


def aliased(values: dict[str, Column], suffix: str = "") -> list[Column]:
    return [column.alias(name + suffix) for name, column in values.items()]


def extract_values(df: DataFrame, text: str, patterns: list[FieldPattern], keep: list[str]) -> DataFrame:
    """`keep` columns plus one value per field."""
    return df.select(*keep, *aliased(pattern_values(F.col(text), patterns)))


def extract_with_confidence(df: DataFrame, text: str, patterns: list[FieldPattern], keep: list[str]) -> DataFrame:
    """`keep` columns plus value and confidence per field."""
    matched = df.select(*keep, label_matches(F.col(text), patterns).alias("_match"))
    values, confidences = matched_values(F.col("_match"), patterns)
    return matched.select(*keep, *aliased(values), *aliased(confidences, "_confidence"))
