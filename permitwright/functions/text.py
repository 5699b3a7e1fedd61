"""Column functions for cleaning and judging text values.

Two families of rules exist side by side on purpose. The pipeline rules treat every Unicode space as a space and
count code points; the browsing rules follow the page's script, whose digits are ASCII and whose lengths are UTF-16
units. Values are expected to be non-NULL strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters the pipeline strips from both ends.
PIPELINE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Characters the page's script treats as white space.
PAGE_SPACE = (
    "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
PAGE_SPACE_CLASS = r"\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"

# The Hebrew block, and the share of Hebrew letters below which a value is noise.
NOT_HEBREW = r"[^\u0590-\u05FF]+"
HEBREW_SHARE = 0.25


def strip(value: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.btrim(value, F.lit(PIPELINE_SPACE))


def page_strip(value: Column) -> Column:
    """Drop white space at both ends as the page does."""
    return F.btrim(value, F.lit(PAGE_SPACE))


def is_blank(value: Column) -> Column:
    """True for the model's missing value."""
    return value == ""


def _hebrew_count(value: Column) -> Column:
    # Cheaper than counting matches, which lists them all first.
    return F.length(F.regexp_replace(value, NOT_HEBREW, ""))


def is_valid_field(value: Column) -> Column:
    """Real data: two characters or more, not just a number, and at least a quarter Hebrew.

    Only U+0020 is left out of the length the share is taken of.
    """
    text = strip(value)
    size = F.greatest(F.length(F.replace(text, F.lit(" "), F.lit(""))), F.lit(1))
    return (
        (F.length(text) >= 2)
        & ~text.rlike(r"(?U)\A[\d\s./\-]+\z")
        & (_hebrew_count(text) / size >= F.lit(HEBREW_SHARE))
    )


def is_complete(owner: Column, architect: Column) -> Column:
    return is_valid_field(owner) & is_valid_field(architect)


def utf16_length(value: Column) -> Column:
    """Length in UTF-16 units."""
    return (F.octet_length(F.encode(value, "UTF-16BE")) / 2).cast("int")


def is_garbage(value: Column) -> Column:
    """Reading noise as the page sees it: no Hebrew, or too little, in a value that is not short and not a number.

    Shares are compared by multiplying. Code points bound UTF-16 units from both sides, so that lengths which decide
    already by code points, as nearly all do, are not encoded.
    """
    hebrew = _hebrew_count(value)
    wanted = hebrew * int(1 / HEBREW_SHARE)
    dense = F.regexp_replace(value, f"[{PAGE_SPACE_CLASS}]", "")
    return (
        ((F.length(value) >= 3) | (utf16_length(value) >= 3))
        & ~value.rlike(rf"\A[0-9{PAGE_SPACE_CLASS}./\-]+\z")
        & ((hebrew == 0) | ((wanted < F.length(value) * 2) & (wanted < utf16_length(dense))))
    )


def clean(value: Column) -> Column:
    """The value, or empty where it is noise."""
    return F.when(is_garbage(value), F.lit("")).otherwise(value)


def leading_integer(value: Column) -> Column:
    """Integer at the start of the text, else 0, as a double: numbers of any length compare as the page compares them."""
    digits = F.regexp_extract(value, rf"\A[{PAGE_SPACE_CLASS}]*([+-]?[0-9]+)", 1)
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))


def last_date_part(date: Column) -> Column:
    return F.substring_index(date, "/", -1)


def year_lenient(date: Column) -> Column:
    """Year of a dd/mm/yyyy text for browsing: leading integer of the last part, 0 when there is none."""
    return leading_integer(last_date_part(date))


def year_strict(date: Column) -> Column:
    """Year of a dd/mm/yyyy text for selecting documents: the whole last part as an integer, else NULL.

    Single underscores between digits are allowed, as in integer literals.
    """
    text = strip(last_date_part(date))
    return F.when(
        text.rlike(r"(?U)\A[+-]?\d+(_\d+)*\z"), F.replace(text, F.lit("_"), F.lit("")).try_cast("decimal(38,0)")
    )


def street_name(address: Column) -> Column:
    """Address without digits and separators."""
    text = F.regexp_replace(address, "[0-9]+", "")
    text = F.translate(text, ",\u060c.()", "     ")
    return page_strip(F.regexp_replace(text, f"[{PAGE_SPACE_CLASS}]+", " "))


def is_single_parcel(helka: Column, gush: Column) -> Column:
    """Private house: neither number holds a separator or more than one value."""

    def single(value: Column) -> Column:
        return ~value.rlike("[,-]") & ~page_strip(value).rlike(f"[{PAGE_SPACE_CLASS}]")

    return single(helka) & single(gush)


def folder_name(address: Column) -> Column:
    """Address as a folder name."""
    text = F.regexp_replace(strip(address), r'[/\\:*?"<>|]', "_")
    return F.regexp_replace(text, r"(?U)\s+", "_")


def absolute_link(href: Column, base: Column) -> Column:
    """Relative links get the portal's base in front."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, href))


def detail_path(file_number: Column) -> Column:
    """Path of a file's detail page, empty when there is no file number."""
    # Fixed value: the portal's query string.
    return F.when(is_blank(file_number), F.lit("")).otherwise(
        F.concat(
            F.lit("/BuildingArchiveDetails?OrgEntityNumber="),
            file_number,
            F.lit("&pageId=8575&DefinementEntityType=10&BuildingNum="),
            file_number,
        )
    )
