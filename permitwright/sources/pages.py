"""Stored HTML pages of the archive: table rows as records, and pages that are no answer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.functions.text import page_strip

# Markers of a blocked page (the first plus any of the others) and of the portal's error page.
BLOCK_VENDOR = "Cloudflare"
BLOCK_SIGNS = ["blocked", "Why have I been blocked", "Ray ID"]
ERROR_SIGN = "חלה שגיאה"


@dataclass(frozen=True)
class RowShape:
    """How one record looks in a page: its element, its cells, and the link that tells it from other rows."""

    row: str = "tr"
    cell: str = "td"
    link_part: str = ""
    min_cells: int = 1


# Link parts and cell counts of the two tables.
LISTING_ROW = RowShape(link_part="BuildingArchiveDetails", min_cells=3)
DOCUMENT_ROW = RowShape(link_part="DocumentViewer", min_cells=5)

# Named character references; the ampersand goes last so that nothing is decoded twice.
_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\xa0", "&amp;": "&"}


def _character(reference: Column) -> Column:
    """The character of a numeric reference's body, such as 1488 or x5D0; the replacement character for no such one."""
    code = F.when(reference.rlike("^[xX]"), F.conv(F.substring(reference, 2, 8), 16, 10)).otherwise(reference).try_cast("bigint")
    text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    usable = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(usable, text).otherwise(F.lit("\ufffd"))


def decoded(value: Column) -> Column:
    """A text of markup with its character references replaced."""
    # The text is cut in front of each numeric reference, and each piece but the first starts with one.
    pieces = F.split(value, r"&#(?=[0-9]{1,7};|[xX][0-9a-fA-F]{1,6};)")
    rest = F.transform(
        F.slice(pieces, 2, F.size(pieces)),
        lambda p: F.concat(_character(F.substring_index(p, ";", 1)), F.substr(p, F.instr(p, ";") + 1)),
    )
    numeric = F.when(value.contains("&#"), F.array_join(F.concat(F.slice(pieces, 1, 1), rest), "")).otherwise(value)
    for reference, character in _REFERENCES.items():
        numeric = F.replace(numeric, F.lit(reference), F.lit(character))
    return numeric


def _texts(cells: Column, marked: bool = False) -> Column:
    """The cells' texts. Markup goes in a pass of its own: `decoded` names its value several times, and each evaluates it."""
    markup = rf"<[^>]*>|{_MARK}\d+" if marked else r"<[^>]*>"
    bare = F.transform(cells, lambda html: F.regexp_replace(html, markup, ""))
    bare = F.transform(bare, _unescaped) if marked else bare
    return F.transform(bare, lambda text: page_strip(F.when(text.contains("&"), decoded(text)).otherwise(text)))


# Marks in a page's text. A page's own \x01 and \x02 are written as \x02a and \x02b while the marks are in it.
_MARK, _ESCAPE = "\x01", "\x02"
# Tags that end a cell of their depth, but for a table's end; and those that end a row. A new row or cell ends the one before it.
_CELL_END = r"<(?=/?(?i:thead|tbody|tfoot|tr|td|th)\b)"
_ROW_END = r"</?(?i:thead|tbody|tfoot|tr|table)\b"
# Rows and cells in a marked page: each reaches to the next tag of its depth that ends it, and they may stand in one another.
# The possessive repeat goes from mark to mark, by a loop and not by calls, so that a page may be as long as it likes.
_MARKED_ROW = rf"{_MARK}(\d+)(?=(<(?i:tr)\b(?:[^{_MARK}]++|{_MARK}(?!\1{_ROW_END}))*+))"
_MARKED_CELL = rf"{_MARK}(\d+)(?=(<(?i:td)\b(?:[^{_MARK}]++|{_MARK}(?!\1<))*+))"


def _is_irregular(body: Column, shape: RowShape) -> Column:
    """Whether a table stands in a table, or a row or cell is not closed: then patterns cannot find where rows end."""
    def times(tag: str) -> Column:
        return F.regexp_count(body, F.lit(rf"<(?i){tag}\b"))

    nested = F.exists(F.split(body, "</(?i)table"), lambda part: F.regexp_count(part, F.lit(r"<(?i)table\b")) > 1)
    # The dearest test goes last: where another has told already, it is not made.
    return (times(shape.row) != times(f"/{shape.row}")) | (times(shape.cell) != times(f"/{shape.cell}")) | nested


def _marked(body: Column) -> Column:
    """A page with `_MARK` and the depth of tables in front of each tag that ends a cell.

    Between two tags of tables all others stand at one depth, so that there is a step per such tag, and one pattern marks all
    tags of a step.
    """
    def tags_at(part: Column, depth: Column) -> Column:
        return F.regexp_replace(part, F.lit(_CELL_END), F.concat(F.lit(_MARK), depth, F.lit("<")))

    def walked(state: Column, part: Column) -> Column:
        # A table's own tags stand at the depth of what is in it.
        closes = part.startswith("</")
        depth = F.when(closes, F.greatest(state["depth"] - 1, F.lit(0))).otherwise(state["depth"] + 1)
        own = F.when(closes, F.concat(F.lit(_MARK), state["depth"])).otherwise("")
        return F.struct(depth.alias("depth"), F.concat(state["text"], own, tags_at(part, depth)).alias("text"))

    plain = F.replace(F.replace(body, F.lit(_ESCAPE), F.lit(f"{_ESCAPE}b")), F.lit(_MARK), F.lit(f"{_ESCAPE}a"))
    parts = F.split(F.regexp_replace(plain, r"<(?=/?(?i:table)\b)", f"{_MARK}<"), _MARK)
    start = F.struct(F.lit(0).alias("depth"), tags_at(F.get(parts, F.lit(0)), F.lit(0)).alias("text"))
    return F.aggregate(F.slice(parts, 2, F.size(parts)), start, walked, lambda state: state["text"])


def _unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(f"{_ESCAPE}a"), F.lit(_MARK)), F.lit(f"{_ESCAPE}b"), F.lit(_ESCAPE))


def _balanced_rows(marked: Column, link: str) -> Column:
    """(link, cells) of every row of a marked page, in page order, with the marks that are in them.

    A row that holds a table holds its rows and cells too, and these rows come once more as rows of their own.
    """
    return _with_cells(F.regexp_extract_all(marked, F.lit(_MARKED_ROW), F.lit(2)), F.lit(_MARKED_CELL), 2, link)


def _with_cells(rows: Column, cell: Column, group: int, link: str) -> Column:
    return F.transform(
        rows, lambda r: F.struct(F.regexp_extract(r, link, 1).alias("link"), F.regexp_extract_all(r, cell, F.lit(group)).alias("cells")))


def _plain_rows(body: Column, shape: RowShape, link: str) -> Column:
    """(link, cells) of every row of a page without tables in tables, whose rows and cells are all closed."""
    rows = F.regexp_extract_all(body, F.lit(rf"<(?is){shape.row}\b[^>]*>(.*?)</{shape.row}>"), F.lit(1))
    return _with_cells(rows, F.lit(rf"<(?is){shape.cell}\b[^>]*>(.*?)</{shape.cell}>"), 1, link)


def html_rows(pages: DataFrame, html: str, shape: RowShape, keep: list[str], texts: int | None = None) -> DataFrame:
    """`keep` columns, row_pos, href and the first `texts` cell texts (`cells`, all by default) of every row that has the link and enough cells.

    Rows of a table's head do not count. Links and texts come decoded; links may stand in either kind of quotes. Tables in
    tables, and rows and cells without an end, are told apart by the depth of the tags.
    """
    body = F.regexp_replace(F.col(html), r"<(?is)thead\b.*?</thead>", "")
    bodies = pages.select(*keep, body.alias("_body"))
    part = shape.link_part
    link = rf"""<(?is)a\b[^>]*?href\s*=\s*("[^"]*{part}[^"]*"|'[^']*{part}[^']*')"""
    rows, odd = _plain_rows(F.col("_body"), shape, link), F.lit(False)
    if (shape.row, shape.cell) == ("tr", "td"):
        odd = _is_irregular(F.col("_body"), shape)
        rows = F.when(F.col("_odd"), _balanced_rows(_marked(F.col("_body")), link)).otherwise(rows)
    found = bodies.withColumn("_odd", odd).select(*keep, "_odd", F.posexplode(rows).alias("row_pos", "_row"))
    # The link still has its quotes: one of two characters is empty.
    kept = found.filter((F.length("_row.link") > 2) & (F.size("_row.cells") >= shape.min_cells))
    href = F.substr("_row.link", F.lit(2), F.length("_row.link") - 2)
    # Marks stand in front of tags only, and a link's pattern passes over them.
    href = F.when(F.col("_odd"), _unescaped(F.regexp_replace(href, rf"{_MARK}\d+", ""))).otherwise(href)
    few = F.slice("_row.cells", 1, texts) if texts else F.col("_row.cells")
    cells = F.when(F.col("_odd"), _texts(few, marked=True)).otherwise(_texts(few))
    return kept.select(*keep, "row_pos", decoded(href).alias("href"), cells.alias("cells"))


def _cell(index: int) -> Column:
    return F.coalesce(F.get(F.col("cells"), F.lit(index)), F.lit(""))


def listing_rows(pages: DataFrame, html: str, keep: list[str], shape: RowShape = LISTING_ROW) -> DataFrame:
    """Files of the archive: number, address, parcel and link."""
    rows = html_rows(pages, html, shape, keep, 3)
    return rows.select(
        *keep,
        "row_pos",
        F.regexp_extract(_cell(0), r"(?U)\A(\S*)", 1).alias("file_id"),
        _cell(1).alias("address"),
        _cell(2).alias("parcel_info"),
        F.col("href").alias("url"),
    )


def document_rows(pages: DataFrame, html: str, keep: list[str], shape: RowShape = DOCUMENT_ROW) -> DataFrame:
    """Documents of a file, in page order."""
    names = ["doc_type", "description", "date", "entity_type", "entity_number"]
    rows = html_rows(pages, html, shape, keep, len(names))
    return rows.select(
        *keep,
        "row_pos",
        *[_cell(i).alias(name) for i, name in enumerate(names)],
        F.col("href").alias("url"),
    )


def is_blocked(html: Column) -> Column:
    sign = F.lit(False)
    for text in BLOCK_SIGNS:
        sign = sign | html.contains(text)
    return html.contains(BLOCK_VENDOR) & sign


def page_verdict(html: Column) -> Column:
    """blocked, error or ok."""
    return F.when(is_blocked(html), "blocked").when(html.contains(ERROR_SIGN), "error").otherwise("ok")
