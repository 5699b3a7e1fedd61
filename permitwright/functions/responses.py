"""Model responses: text that should hold one JSON object, possibly inside a code fence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.functions.patterns import aliased
from permitwright.functions.text import strip

# Fields asked for in a response.
RESPONSE_FIELDS = [
    "owner",
    "architect",
    "address",
    "gush",
    "helka",
    "migrash",
    "permit_number",
    "date",
    "city_plan",
]

# Fixed value: the fence a response may be wrapped in.
FENCE = "```"

_JSON_OPTIONS = {"allowSingleQuotes": "false", "mode": "PERMISSIVE"}
_OBJECT_TYPE = ", ".join(f"{name}: string" for name in RESPONSE_FIELDS)
_WRAPPED_TYPE = f"body struct<{_OBJECT_TYPE}>, closed int"


def fenced_without_body(text: Column) -> Column:
    """A fence that never reaches a second line has no content at all."""
    stripped = strip(text)
    return stripped.startswith(FENCE) & ~stripped.contains("\n")


def response_body(text: Column) -> Column:
    """Response without its code fence: the first line goes, and everything from the last fence on."""
    stripped = strip(text)
    rest = F.regexp_replace(stripped, r"(?s)\A[^\n]*\n?", "")
    inner = F.when(rest.contains(FENCE), F.regexp_extract(rest, r"(?s)\A(.*)```", 1)).otherwise(rest)
    return F.when(stripped.startswith(FENCE), inner).otherwise(stripped)


def _wrapped(body: Column) -> Column:
    # Spark's reader ignores text after the object. With a member behind it, such text makes the whole invalid.
    return F.concat(F.lit('{"body":'), body, F.lit(',"closed":1}'))


def _breaks_out(body: Column) -> Column:
    """Whether a body closes its object and goes on with members of the object around it."""
    return body.rlike(r"\}\s*,") & (F.coalesce(F.size(F.json_object_keys(_wrapped(body))), F.lit(0)) != 2)


def body_json(body: Column) -> Column:
    """Parsed response body, for `response_values`. The body is named several times, so it should be a column by itself."""
    return F.when(~_breaks_out(body), F.from_json(_wrapped(body), _WRAPPED_TYPE, _JSON_OPTIONS))


def response_values(parsed: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """Values and confidences: absent, null, "null" and all of an invalid response are empty with confidence none."""
    values, confidences = {}, {}
    closed = parsed.getField("closed") == 1
    for name in RESPONSE_FIELDS:
        raw = F.when(closed, parsed.getField("body").getField(name))
        given = raw.isNotNull() & (raw != "null")
        values[name] = F.when(given, strip(raw)).otherwise("")
        confidences[name] = F.when(given, "high").otherwise("none")
    return values, confidences


def parse_responses(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """`keep` columns plus value and confidence per field."""
    bodies = df.select(*keep, response_body(F.col(text)).alias("_body"))
    parsed = bodies.select(*keep, body_json(F.col("_body")).alias("_json"))
    values, confidences = response_values(F.col("_json"))
    return parsed.select(*keep, *aliased(values), *aliased(confidences, "_confidence"))


def response_problem(text: Column) -> Column:
    """What is wrong with a response, empty when nothing is."""
    body = strip(response_body(text))
    # An object, array or plain value all parse in this place; only broken JSON does not.
    closed = F.from_json(_wrapped(body), "body string, closed int", _JSON_OPTIONS).getField("closed")
    return (
        F.when(fenced_without_body(text), "fence_without_body")
        .when((F.coalesce(closed, F.lit(0)) != 1) | _breaks_out(body), "invalid_json")
        .when(~body.startswith("{"), "not_an_object")
        .otherwise("")
    )
