"""Browsing the records of all cities: filters, facets, metrics, grouping, sorting, paging and top lists.

Filters, facets, metrics and group heads are composed lazily, so Spark sees one plan from scan to result. What gives exact
positions sorts when it is called and checkpoints that. Where several results are wanted of one filter, cache that.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from permitwright.functions.text import (
    PAGE_SPACE,
    clean,
    is_blank,
    is_garbage,
    is_single_parcel,
    leading_integer,
    street_name,
    utf16_length,
    year_lenient,
)
from permitwright.operators.rank import Order, numbered, page_slice
from permitwright.sources.tables import EXPORT_LABELS

# Fixed values of the page.
PAGE_SIZE = 40
TOP_ARCHITECTS = 10
SUGGESTIONS = 20
FIRST_FACET_YEAR = 2000
LAST_FACET_YEAR = 2030
OPEN_END = 9999
MIN_BAR = 4.0
NUMERIC_SORTS = ("date", "gush", "helka")

# Records have no stored input order, so these columns decide between equal sort values.
TIE_BREAK = ["city", "building_file_number", "pdf_path"]


@dataclass(frozen=True)
class Filters:
    """What is asked for; empty values ask for nothing."""

    text: str = ""
    year_from: int = 0
    year_to: int = OPEN_END
    gush: str = ""
    city: str = ""
    street: str = ""
    architect: str = ""
    missing_only: bool = False
    private_only: bool = False


@dataclass(frozen=True)
class Sort:
    """Sort column and direction; years and parcel numbers sort as numbers."""

    column: str = "date"
    ascending: bool = False
    tie_break: list[str] = field(default_factory=lambda: list(TIE_BREAK))

    def click(self, column: str) -> Sort:
        """The sort after a click on a heading: the same column turns around, another starts ascending."""
        return Sort(column, not self.ascending if column == self.column else True, self.tie_break)

    def key(self) -> Column:
        value = F.col(self.column)
        if self.column == "date":
            return year_lenient(value)
        if self.column in NUMERIC_SORTS:
            return leading_integer(value)
        return value


def contains_anywhere(columns: list[str], text: str) -> Column:
    """Case-insensitive search in all columns: joined by a character no needle holds, lowered and searched once."""
    needle = text.strip(PAGE_SPACE).lower()
    if "\0" in needle:
        return reduce(lambda a, b: a | b, [F.lower(c).contains(needle) for c in columns])
    return F.lower(F.concat_ws("\0", *columns)).contains(needle)


def lacks(value: Column) -> Column:
    """True where nothing is left of the value once it is cleaned."""
    return is_blank(value) | is_garbage(value)


def is_missing_data() -> Column:
    return lacks(F.col("owner")) | lacks(F.col("architect"))


def predicate(filters: Filters, columns: list[str]) -> Column | None:
    """All active filters AND-ed, cheap ones first; None when nothing is asked for."""
    year = year_lenient(F.col("date"))
    tests: list[Column] = []
    if filters.city:
        tests.append(F.col("city") == filters.city)
    if filters.gush:
        tests.append(F.col("gush") == filters.gush)
    if filters.year_from:
        tests.append(year >= filters.year_from)
    if filters.year_to and filters.year_to < OPEN_END:
        tests.append(year <= filters.year_to)
    if filters.architect:
        # A plain comparison first: it can be pushed to the scan, and only equal values need the noise test.
        tests.append((F.col("architect") == filters.architect) & (clean(F.col("architect")) == filters.architect))
    if filters.street:
        tests.append(street_name(F.col("address")).contains(filters.street))
    if filters.private_only:
        tests.append(is_single_parcel(F.col("helka"), F.col("gush")))
    if filters.missing_only:
        tests.append(is_missing_data())
    if filters.text.strip(PAGE_SPACE):
        tests.append(contains_anywhere(columns, filters.text))
    return reduce(lambda a, b: a & b, tests) if tests else None


def filtered(records: DataFrame, filters: Filters) -> DataFrame:
    test = predicate(filters, records.columns)
    return records if test is None else records.filter(test)


def total_order(records: DataFrame, sort: Sort) -> Order:
    """Sort key, tie break, then every other column, so that the order has no ties but between equal rows."""
    plain = sort.column not in NUMERIC_SORTS
    rest = [name for name in records.columns if name not in sort.tie_break]
    return [
        (sort.column if plain else sort.key(), sort.ascending),
        *[(name, True) for name in [*sort.tie_break, *rest]],
    ]


def sorted_records(records: DataFrame, sort: Sort | None = None) -> DataFrame:
    """Records with their 1-based `position` in the sort order."""
    return numbered(records, total_order(records, sort or Sort()), "position")


def page_of_records(records: DataFrame, page: int, sort: Sort | None = None, size: int = PAGE_SIZE) -> DataFrame:
    """One page of the ungrouped table."""
    return page_slice(records, total_order(records, sort or Sort()), page * size, size, "position")


def group_key() -> Column:
    """Address, else file number, else the document itself, so that a record without either stands alone."""
    return (
        F.when(~is_blank(F.col("address")), F.col("address"))
        .when(~is_blank(F.col("building_file_number")), F.col("building_file_number"))
        .otherwise(F.col("pdf_path"))
    )


def _descending_text(value: Column) -> Column:
    """Text whose ascending order is the value's descending order: its bytes, inverted, with an end mark above them."""
    return F.concat(F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def ascending_key(sort: Sort) -> Column:
    """Sort key turned so that ascending order is the wanted order, as a min aggregate needs it."""
    key = sort.key()
    if sort.ascending:
        return key
    return -key if sort.column in NUMERIC_SORTS else _descending_text(key)


def grouped_heads(records: DataFrame, sort: Sort | None = None) -> DataFrame:
    """One row per address: its newest record, the group's size, and `_first`, the sort place of its first row.

    All of it is aggregates, so every task sends on one row per address even if a third of all records share one.
    """
    sort = sort or Sort()
    rest = [name for name in records.columns if name not in sort.tie_break]
    place = F.struct(ascending_key(sort).alias("_key"), *[F.col(name) for name in [*sort.tie_break, *rest]])
    newest_first = sort.column == "date" and not sort.ascending
    if newest_first:
        # The first row of a group is its newest, so one aggregate gives both.
        head, first = F.min(place), F.col("_head")
        aggregates = [head.alias("_head")]
    else:
        head = F.min(F.struct((-year_lenient(F.col("date"))).alias("_year"), place.alias("_place"))).getField("_place")
        first = F.col("_first")
        aggregates = [head.alias("_head"), F.min(place).alias("_first")]
    groups = records.groupBy(group_key().alias("group_key")).agg(F.count("*").alias("group_size"), *aggregates)
    return groups.select(
        "group_key", "group_size", first.alias("_first"), *[F.col(f"_head.{name}").alias(name) for name in records.columns]
    )


def grouped_by_address(records: DataFrame, sort: Sort | None = None) -> DataFrame:
    """All group heads with the group's 1-based `position`."""
    heads = grouped_heads(records, sort)
    return numbered(heads, [("_first", True)], "position", copies=False).drop("_first")


def page_of_groups(records: DataFrame, page: int, sort: Sort | None = None, size: int = PAGE_SIZE) -> DataFrame:
    """One page of group heads, with the number of groups and pages: one scan and one aggregate give all of it."""
    heads = grouped_heads(records, sort)
    rows = page_slice(heads, [("_first", True)], page * size, size, "position", copies=False, total="groups")
    return rows.drop("_first").withColumn("pages", F.ceil(F.col("groups") / size))


def group_rows(records: DataFrame, sort: Sort | None = None) -> DataFrame:
    """Every record with its 1-based place in its group, newest first, and its group's size.

    The place is counted over range-partitioned rows, so a hot address spreads over many tasks.
    """
    sort = sort or Sort()
    keyed = records.withColumn("group_key", group_key())
    order = [(year_lenient(F.col("date")), False), *total_order(records, sort)]
    return numbered(keyed, order, "place_in_group", ["group_key"])


def browse(
    records: DataFrame,
    filters: Filters | None = None,
    sort: Sort | None = None,
    grouped: bool = False,
    page: int | None = None,
) -> DataFrame:
    """What the page shows: filtered, sorted, perhaps grouped by address, and one page of it or, without a page, all."""
    found = filtered(records, filters or Filters())
    if grouped:
        return grouped_by_address(found, sort) if page is None else page_of_groups(found, page, sort)
    return sorted_records(found, sort) if page is None else page_of_records(found, page, sort)


def metric_cards(records: DataFrame) -> DataFrame:
    """One row: records, distinct addresses, architects, streets and numeric gush values, and records missing data."""
    # Each rule is applied once; the aggregates use the results.
    rules = records.select(
        "address",
        "gush",
        clean(F.col("architect")).alias("architect"),
        street_name(F.col("address")).alias("street"),
        lacks(F.col("owner")).alias("no_owner"),
    )

    def given(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    return rules.agg(
        F.count("*").alias("records"),
        F.count_distinct(given("address")).alias("addresses"),
        F.count_distinct(given("architect")).alias("architects"),
        F.count_distinct(given("street")).alias("streets"),
        F.count_distinct(F.when(F.col("gush").rlike(r"\A[0-9]+\z"), F.col("gush"))).alias("gushes"),
        F.count_if(F.col("no_owner") | is_blank(F.col("architect"))).alias("missing"),
    )


def top_architects(records: DataFrame, count: int = TOP_ARCHITECTS) -> DataFrame:
    """Architects with most records, their rank and bar length in percent of the longest."""
    names = records.select(clean(F.col("architect")).alias("architect"))
    # Blank names count as zero and go by that: a filter on the name would be evaluated before the cleaned value is.
    counts = names.groupBy("architect").agg(F.count(F.nullif(F.col("architect"), F.lit(""))).alias("records"))
    top = counts.filter(F.col("records") > 0).orderBy(F.desc("records"), "architect").limit(count)
    # The windows run over the top rows only.
    order = Window.orderBy(F.desc("records"), "architect")
    longest = F.max("records").over(Window.partitionBy())
    share = F.greatest(F.col("records") / longest * 100, F.lit(MIN_BAR))
    return top.select("architect", "records", share.alias("bar"), F.row_number().over(order).alias("rank"))


def facet_choices() -> dict[str, Column]:
    """What a record offers per facet, NULL for nothing."""
    year = year_lenient(F.col("date"))
    street = street_name(F.col("address"))
    return {
        "year": F.when(year.between(FIRST_FACET_YEAR, LAST_FACET_YEAR), year.cast("bigint").cast("string")),
        "gush": F.when(F.col("gush").rlike(r"\A[0-9]+\z"), F.col("gush")),
        "street": F.when(utf16_length(street) > 2, street),
        "architect": F.nullif(clean(F.col("architect")), F.lit("")),
        "city": F.nullif(F.col("city"), F.lit("")),
    }


def facet_values(records: DataFrame) -> DataFrame:
    """Values to choose from: facet, value, and number for facets that sort as numbers.

    One scan: each record gives its values as tagged rows, and repeats are dropped before the shuffle.
    """
    tagged = F.array(
        *[F.struct(F.lit(facet).alias("facet"), value.alias("value")) for facet, value in facet_choices().items()]
    )
    values = records.select(F.inline(tagged)).filter(F.col("value").isNotNull()).distinct()
    number = F.when(F.col("facet").isin("year", "gush"), F.col("value").try_cast("double"))
    return values.withColumn("number", number)


def suggest_values(records: DataFrame, facet: str, needle: str = "", count: int = SUGGESTIONS) -> DataFrame:
    """First values of a facet, in order, that contain the text as typed."""
    values = records.select(facet_choices()[facet].alias("value")).filter(F.col("value").isNotNull())
    if needle:
        values = values.filter(F.col("value").contains(needle))
    top = values.distinct().orderBy("value").limit(count)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("value")))


def labelled(records: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """The exported columns under their headings."""
    return records.select(*[F.col(name).alias(label) for name, label in EXPORT_LABELS.items()], *(extra or []))


def detail_link(base: Column, path: Column) -> Column:
    """Link to a file's page on its city's portal, empty when there is no file number."""
    return F.when(is_blank(path), F.lit("")).otherwise(F.concat(base, path))


def portal_base(template: str, subdomain: Column) -> Column:
    """Base address of a city's portal; `template` holds {subdomain}."""
    before, after = template.split("{subdomain}")
    return F.concat(F.lit(before), subdomain, F.lit(after))

