"""What the browsing page asks."""

from __future__ import annotations

from pyspark.sql import functions as F

from permitwright.plans import browse
from permitwright.plans.browse import Filters, Sort
from permitwright.plans.facets import FacetDictionary
from permitwright.plans.order_index import OrderIndex
from permitwright.plans.search import SearchIndex
from permitwright.session import fresh_dir
from permitwright.sources.tables import EXPORT_LABELS, RecordTable
from permitwright.suite import rules as R
from permitwright.suite.registry import query

_KEY = "case when address <> '' then address when building_file_number <> '' then building_file_number else pdf_path end"


@query(
    "search_any_column",
    "select pdf_path from fx_permits where "
    + " or ".join(f"contains(lower({c}), 'arch ltd')" for c in R.RECORD),
)
def search_any_column(fx):
    return browse.filtered(fx["fx_permits"], Filters(text=" Arch LTD ")).select("pdf_path")


@query(
    "filter_year_range",
    f"select pdf_path, date from fx_permits where {R.year()} >= 1999 and {R.year()} <= 2001",
)
def filter_year_range(fx):
    return browse.filtered(fx["fx_permits"], Filters(year_from=1999, year_to=2001)).select("pdf_path", "date")


@query(
    "filter_facets",
    f"""select 'gush' as facet, pdf_path from fx_permits where gush = '3610'
    union all select 'city', pdf_path from fx_permits where city = 'FRANCE'
    union all select 'street', pdf_path from fx_permits where contains({R.street()}, 'הרצל')
    union all select 'architect', pdf_path from fx_permits where {R.clean('architect')} = 'אדריכל לוי 3'""",
)
def filter_facets(fx):
    asked = {
        "gush": Filters(gush="3610"),
        "city": Filters(city="FRANCE"),
        "street": Filters(street="הרצל"),
        "architect": Filters(architect="אדריכל לוי 3"),
    }
    parts = [
        browse.filtered(fx["fx_permits"], wanted).select(F.lit(name).alias("facet"), "pdf_path")
        for name, wanted in asked.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query("filter_missing", f"select pdf_path, owner, architect from fx_permits where {R.missing()}")
def filter_missing(fx):
    return browse.filtered(fx["fx_permits"], Filters(missing_only=True)).select("pdf_path", "owner", "architect")


_BROWSE = Filters(text="משפחת", year_from=1998, year_to=2002, street="הרצל", private_only=True)
_BROWSE_SQL = (
    "("
    + " or ".join(f"contains(lower({c}), 'משפחת')" for c in R.RECORD)
    + f") and {R.year()} between 1998 and 2002 and contains({R.street()}, 'הרצל') and {R.single_parcel()}"
)


@query("browse_filtered", f"select {R.RECORD_LIST} from fx_permits where {_BROWSE_SQL}")
def browse_filtered(fx):
    return browse.filtered(fx["fx_permits"], _BROWSE)


@query(
    "metric_cards",
    f"""select count(*) as records, count(distinct nullif(address, '')) as addresses,
      count(distinct nullif({R.clean('architect')}, '')) as architects, count(distinct nullif({R.street()}, '')) as streets,
      count(distinct case when regexp_full_match(gush, '[0-9]+') then gush end) as gushes,
      count(*) filter ({R.missing()}) as missing from fx_permits""",
)
def metric_cards(fx):
    return browse.metric_cards(fx["fx_permits"])


@query(
    "top_architects",
    f"""with counts as (select {R.clean('architect')} as architect, count(*) as records from fx_permits group by 1),
    top as (select * from counts where architect <> '' order by records desc, architect limit 10)
    select architect, records, greatest(records / max(records) over () * 100, 4.0e0) as bar,
      cast(row_number() over (order by records desc, architect) as int) as rank from top""",
)
def top_architects(fx):
    return browse.top_architects(fx["fx_permits"])


_FACETS = f"""facets as (select distinct facet, value from (
    select 'year' as facet, case when {R.year()} between 2000 and 2030 then cast(cast({R.year()} as bigint) as varchar) end as value
      from fx_permits
    union all select 'gush', case when regexp_full_match(gush, '[0-9]+') then gush end from fx_permits
    union all select 'street', case when length({R.street()}) > 2 then {R.street()} end from fx_permits
    union all select 'architect', nullif({R.clean('architect')}, '') from fx_permits
    union all select 'city', nullif(city, '') from fx_permits) v where value is not null)"""


@query(
    "facet_values",
    f"""with {_FACETS} select facet, value, case when facet in ('year', 'gush') then cast(value as double) end as number
    from facets""",
)
def facet_values(fx):
    return browse.facet_values(fx["fx_permits"])


@query(
    "suggest_values",
    f"""with {_FACETS}, top as (select value from facets where facet = 'architect' and contains(value, 'לוי')
      order by value limit 20)
    select value, cast(row_number() over (order by value) as int) as rank from top""",
)
def suggest_values(fx):
    return browse.suggest_values(fx["fx_permits"], "architect", "לוי")


@query(
    "sort_records",
    f"select *, row_number() over (order by {R.NEWEST}) as position from fx_permits",
)
def sort_records(fx):
    return browse.sorted_records(fx["fx_permits"])


@query(
    "sort_by_parcel",
    f"""select *, row_number() over (order by {R.integer('helka')}, city, building_file_number, pdf_path,
      {R.RECORD_LIST}) as position from fx_permits""",
)
def sort_by_parcel(fx):
    return browse.sorted_records(fx["fx_permits"], Sort().click("helka"))


_PLACED = f"placed as (select *, {_KEY} as group_key, row_number() over (order by {R.NEWEST}) as place from fx_permits)"
_GROUPS = f"""{_PLACED}, heads as (select *, row_number() over (order by first_place) as position from (
    select *, count(*) over (partition by group_key) as group_size, min(place) over (partition by group_key) as first_place,
      row_number() over (partition by group_key order by {R.year()} desc, place) as rn from placed) h where rn = 1)"""


@query(
    "grouped_by_address",
    f"with {_GROUPS} select group_key, group_size, {R.RECORD_LIST}, position from heads",
)
def grouped_by_address(fx):
    return browse.grouped_by_address(fx["fx_permits"])


@query(
    "grouped_by_owner_order",
    f"""with placed as (select *, {_KEY} as group_key, row_number() over (order by owner desc, city, building_file_number,
      pdf_path, {R.RECORD_LIST}) as place from fx_permits), heads as (
    select *, row_number() over (order by first_place) as position from (
    select *, count(*) over (partition by group_key) as group_size, min(place) over (partition by group_key) as first_place,
      row_number() over (partition by group_key order by {R.year()} desc, place) as rn from placed) h where rn = 1)
    select group_key, group_size, {R.RECORD_LIST}, position from heads""",
)
def grouped_by_owner_order(fx):
    return browse.grouped_by_address(fx["fx_permits"], Sort("owner", ascending=False))


@query(
    "group_subrows",
    f"""with {_PLACED} select * from (select group_key, {R.RECORD_LIST}, row_number() over (partition by group_key
      order by {R.year()} desc, place) as place_in_group from placed) r where place_in_group > 1""",
)
def group_subrows(fx):
    return browse.group_rows(fx["fx_permits"]).filter("place_in_group > 1")


_PAGE = 2


@query(
    "page_of_groups",
    f"""with {_GROUPS} select group_key, group_size, {R.RECORD_LIST}, position, "groups",
      cast(ceil("groups" / 40.0) as bigint) as pages
    from (select *, count(*) over () as "groups" from heads) h where position > {_PAGE * 40} and position <= {_PAGE * 40 + 40}""",
)
def page_of_groups(fx):
    return browse.page_of_groups(fx["fx_permits"], _PAGE)


@query(
    "export_rows",
    "select "
    + ", ".join(f'{name} as "{label}"' for name, label in EXPORT_LABELS.items())
    + f", position from (select *, row_number() over (order by {R.NEWEST}) as position from fx_permits"
    f" where {R.missing()}) p",
)
def export_rows(fx):
    wanted = browse.filtered(fx["fx_permits"], Filters(missing_only=True))
    return browse.labelled(browse.sorted_records(wanted), ["position"])


_DEEP = 7


@query(
    "page_by_stored_order",
    f"""select *, cast(row_number() over (order by {R.NEWEST}) as bigint) as position from fx_permits
    qualify position > {_DEEP * 40} and position <= {_DEEP * 40 + 40}""",
)
def page_by_stored_order(fx):
    """A deep page from an order that is stored once for all pages."""
    index = OrderIndex(fx.spark, fresh_dir(fx.spark, "order"), ranges=8)
    index.build(fx["fx_permits"])
    return index.page(fx["fx_permits"], _DEEP)


@query(
    "page_of_groups_by_stored_order",
    f"""with {_GROUPS} select group_key, group_size, {R.RECORD_LIST}, position, "groups",
      cast(ceil("groups" / 40.0) as bigint) as pages
    from (select *, count(*) over () as "groups" from heads) h where position > {_PAGE * 40} and position <= {_PAGE * 40 + 40}""",
)
def page_of_groups_by_stored_order(fx):
    index = OrderIndex(fx.spark, fresh_dir(fx.spark, "order"), grouped=True, ranges=8)
    index.build(fx["fx_permits"])
    return index.page(fx["fx_permits"], _PAGE)


def _kept_dictionary(fx):
    """A dictionary of the records known before, kept through an append and a change of the owners' architects."""
    known, every = fx["fx_known_records"], fx["fx_permits"]
    dictionary = FacetDictionary(fx.spark, fresh_dir(fx.spark, "facets"))
    dictionary.rebuild(known.withColumn("architect", F.concat("architect", F.lit(" ישן"))), 1)
    fresh = every.join(known.select("pdf_path"), "pdf_path", "left_anti").select(*every.columns)
    dictionary.change(1, 2, added=fresh)
    dictionary.change(2, 3, added=known, removed=known.withColumn("architect", F.concat("architect", F.lit(" ישן"))))
    return dictionary


@query(
    "facet_dictionary",
    f"""with {_FACETS} select facet, value, case when facet in ('year', 'gush') then cast(value as double) end as number
    from facets""",
)
def facet_dictionary(fx):
    return _kept_dictionary(fx).values(3)


@query(
    "suggest_from_dictionary",
    f"""with {_FACETS}, top as (select value from facets where facet = 'architect' and contains(value, 'לוי')
      order by value limit 20)
    select value, cast(row_number() over (order by value) as int) as rank from top""",
)
def suggest_from_dictionary(fx):
    return _kept_dictionary(fx).suggest(3, "architect", "לוי")


@query(
    "search_with_file_filters",
    "select pdf_path from fx_permits where "
    + " or ".join(f"contains(lower({c}), 'arch ltd')" for c in R.RECORD)
    + " union all select concat('rare ', pdf_path) from fx_permits where "
    + " or ".join(f"contains(lower({c}), '/france/pdfs/')" for c in R.RECORD),
)
def search_with_file_filters(fx):
    """A needle that is in most files, and one that is in a city's files alone."""
    table = RecordTable(fx.spark, fresh_dir(fx.spark, "records"))
    table.append(fx["fx_permits"])
    index = SearchIndex(table, fresh_dir(fx.spark, "search"))
    index.refresh()
    rare = index.search("/FRANCE/pdfs/").select(F.concat(F.lit("rare "), "pdf_path").alias("pdf_path"))
    return index.search(" Arch LTD ").select("pdf_path").unionAll(rare)
