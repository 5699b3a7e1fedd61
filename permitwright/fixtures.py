"""Test inputs in this domain's shapes, as SQL views over the driver's tables.

Each view is SQL that Spark and DuckDB both accept unchanged, so a query and its check start from the same
rows. Views are used as common table expressions: `with_views` puts the ones a statement needs in front of it.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from permitwright.session import fresh_dir

BASE_TABLES = ["orders", "customer", "nation", "lineitem", "events", "pages"]

VIEWS: dict[str, str] = {}

VIEWS["fx_cities"] = """
select lower(n_name) as subdomain, n_name as name, n_nationkey as ord from nation
"""

# One row per order: the identity, status and place every other view is built from.
VIEWS["fx_base"] = """
select b.*, concat('data/', lower(city), '/pdfs/', replace(street, ' ', '_'), '_', house) as folder,
  concat('data/', lower(city), '/pdfs/', replace(street, ' ', '_'), '_', house, '/permit_', cast(k as string), '.pdf')
    as doc_path
from (
  select o_orderkey as k, o_custkey as ck, n_name as city, o_orderstatus as ost, o_orderpriority as prio,
    year(o_orderdate) as oy, cast(year(o_orderdate) + 2 as string) as yy,
    lpad(cast(month(o_orderdate) as string), 2, '0') as mm,
    lpad(cast(day(o_orderdate) as string), 2, '0') as dd,
    cast(o_custkey % 40 + 1 as string) as house,
    case o_custkey % 6 when 0 then 'הרצל' when 1 then 'ויצמן' when 2 then 'בן גוריון'
      when 3 then 'רוטשילד' when 4 then 'העצמאות' else 'סוקולוב' end as street,
    case o_orderkey % 7 when 0 then 'כהן' when 1 then 'לוי' when 2 then 'מזרחי' when 3 then 'פרץ'
      when 4 then 'ביטון' when 5 then 'דהן' else 'אברהם' end as sur
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
) b
"""

VIEWS["fx_permits_all"] = """
select case when k % 53 = 0 then '' else city end as city,
  cast(ck as string) as building_file_number, cast(k as string) as permit_number,
  case when k % 43 = 0 then '' else concat(street, ' ', house,
    case when k % 5 = 0 then ', חיפה' else '' end) end as address,
  case when k % 17 = 0 then '' when k % 19 = 0 then '3636-3637' else cast(3600 + ck % 50 as string) end as gush,
  case when k % 13 = 0 then '215 216' when k % 29 = 0 then '12,13' else cast(k % 300 as string) end as helka,
  cast(k % 90 as string) as migrash,
  concat('חפ/', cast(k % 25 as string)) as city_plan,
  case when k % 11 = 0 then '' when k % 23 = 0 then 'xx ABCDEF gh' when k % 31 = 0 then '12-34'
    when k % 47 = 0 then 'א' else concat('משפחת ', sur) end as owner,
  case when k % 14 = 0 then '' when k % 26 = 0 then 'Arch Ltd א' when k % 33 = 0 then '77'
    else concat('אדריכל ', sur, ' ', cast(ck % 12 as string)) end as architect,
  case when k % 6 = 0 then '' else concat('מהנדס ', sur) end as structural_planner,
  doc_path as pdf_path,
  case when k % 37 = 0 then '' when k % 41 = 0 then 'לא ידוע' else concat(dd, '/', mm, '/', yy) end as date,
  k, ost, prio
from fx_base
"""

VIEWS["fx_permits"] = """
select city, building_file_number, permit_number, address, gush, helka, migrash, city_plan, owner, architect,
  structural_planner, pdf_path, date
from fx_permits_all
"""

# Records already in the table when a run starts: those of finished orders.
VIEWS["fx_known_records"] = """
select city, building_file_number, permit_number, address, gush, helka, migrash, city_plan, owner, architect,
  structural_planner, pdf_path, date
from fx_permits_all where ost = 'F'
"""

# The record table plus a second record for every urgent document, in writing order.
VIEWS["fx_repeated"] = """
select city, building_file_number, permit_number, address, gush, helka, migrash, city_plan, owner, architect,
  structural_planner, pdf_path, date, 0 as seq
from fx_permits_all
union all
select city, building_file_number, permit_number, address, gush, helka, migrash, city_plan, 'רישום שני', architect,
  structural_planner, pdf_path, date, 1
from fx_permits_all where prio = '1-URGENT'
"""

VIEWS["fx_permit_text"] = """
select pdf_path, concat(
  case when k % 9 = 0 then 'תוכנית הגשה' else 'טופס 3' end, chr(10),
  case when k % 9 = 0 then 'מספר בקשה: ' else 'היתר בניה מספר: ' end, permit_number, chr(10),
  case when k % 8 = 0 then 'בעל התר: ' when k % 8 = 1 then concat('בעל היתר:', chr(10)) else 'בעל היתר: ' end,
  '| ', owner, '  []', chr(10),
  case when k % 10 = 0 then 'ורך_הבקשה ' else 'עורך הבקשה: ' end, architect, chr(10),
  'גוש: ', gush, ' חלקה: ', helka, ' מגרש: ', migrash, chr(10),
  'תוכנית: ', city_plan, chr(10), 'תיק בניו תיק בנין: ', building_file_number, chr(10),
  'מתכנן שלד: ', 'מהנדס   ', migrash, chr(10),
  case when k % 2 = 0 then 'כתובת הבניה: ' else 'כתובת: ' end, address, chr(10),
  'בתאריך: ', date) as ocr_text
from fx_permits_all
"""

VIEWS["fx_permit_lines"] = """
select pdf_path, 0 as pos, 'טופס 3' as line from fx_permits
union all select pdf_path, 1, concat('בעל היתר: ', owner) from fx_permits
union all select pdf_path, 2, concat('גוש: ', gush) from fx_permits
"""

# Text of the name area, read a second time at a higher resolution.
VIEWS["fx_name_text"] = """
select pdf_path, concat('עורך הבקשה: ', architect) as name_text from fx_permits
"""

VIEWS["fx_responses"] = """
select pdf_path as record_id,
  case when k % 50 = 0 then 'not json {'
  when k % 59 = 0 then '["owner"]'
  when k % 61 = 0 then '```json {"owner":"א"}'
  else concat(case when k % 4 = 0 then concat('```json', chr(10)) else '' end,
    '{"owner":', case when k % 11 = 0 then 'null' when k % 13 = 0 then '"null"' else concat('" ', owner, ' "') end,
    ',"architect":"', architect, '","address":"', address,
    '","gush":', case when k % 3 = 0 then cast(3600 + k % 50 as string) else concat('"', gush, '"') end,
    ',"helka":"', helka, '","migrash":"', migrash, '"',
    case when k % 5 = 0 then '' else concat(',"permit_number":"', permit_number, '"') end,
    ',"date":"', date, '","city_plan":"', city_plan, '"}',
    case when k % 4 = 0 then concat(chr(10), '```') else '' end) end as response_text
from fx_permits_all
"""

# Lines of response files in reading order: answers, second answers that are broken, and lines that are none.
VIEWS["fx_response_lines"] = """
select record_id, response_text, 'job1' as file, 0 as block, 0 as place from fx_responses
union all
select doc_path, 'not json {', 'job2', 0, 1 from fx_base where prio = '1-URGENT'
union all
select doc_path, '{"owner":"תשובה מאוחרת"}', 'job2', 0, 2 from fx_base where prio = '2-HIGH'
union all
select cast(null as string), '{}', 'job3', 0, k from fx_base where prio = '5-LOW'
"""

# Calls that came back: those of open orders; the others count as failed calls.
VIEWS["fx_answered"] = """
select record_id, response_text from fx_responses join fx_permits_all on record_id = pdf_path where ost = 'O'
"""

VIEWS["fx_geometry"] = """
select doc_path as pdf_path, l_linenumber - 1 as page_idx,
  case when l_quantity < 25 then 595.28e0 when l_quantity < 33 then 841.89e0 else 2383.94e0 end as width_pt
from lineitem join fx_base on l_orderkey = k
"""

# File numbers are a city's own: other cities use the same ones.
VIEWS["fx_doc_links"] = """
select city, cast(ck % 1000 as string) as file_id, cast(k as string) as listing_id, l_linenumber - 1 as pos,
  case l_returnflag when 'A' then 'היתר בניה' when 'N' then 'היתר בניה - שינויים' else 'תכנית הגשה' end as doc_type,
  concat('doc ', cast(l_partkey as string)) as description,
  case when l_partkey % 31 = 0 then '' when l_partkey % 37 = 0 then 'לא ידוע'
    else concat(lpad(cast(day(l_shipdate) as string), 2, '0'), '/', lpad(cast(month(l_shipdate) as string), 2, '0'),
      '/', cast(year(l_shipdate) as string)) end as date,
  'תיק' as entity_type,
  case when l_partkey % 6 = 0 then '' else cast(l_suppkey as string) end as entity_number,
  case when l_partkey % 97 = 0 then '/DocumentViewer?Other=1'
    else concat('/DocumentViewer?Name_File=', cast(l_partkey as string), '&Type=', l_linestatus) end as url,
  k, l_linenumber as line
from lineitem join fx_base on l_orderkey = k
"""

VIEWS["fx_doc_pages"] = """
select k, line, concat('<table><thead><tr><td>a</td><td>b</td><td>c</td><td>d</td><td>e</td><td><a href="/DocumentViewer?Name_File=0">',
  '</a></td></tr></thead><tbody><tr><td>', replace(doc_type, 'ה', '&#1492;'), '</td><td> ', description, ' </td><td>', date,
  '</td><td>', entity_type, '</td><td>&#x', '30;', entity_number, '</td><td><a class=x href=',
  case when k % 2 = 0 then '"' else '''' end, replace(url, '&', '&amp;'), case when k % 2 = 0 then '"' else '''' end,
  '>צפייה</a></td></tr>',
  '<tr><td>a</td><td>b</td><td>c</td><td>d</td><td>e</td></tr>',
  '<tr><td>x</td><td><a href="/DocumentViewer?Name_File=1">y</a></td></tr></tbody></table>') as html
from fx_doc_links
"""

# A page per link with a table in a cell, and a row none of whose elements has an end.
VIEWS["fx_nested_pages"] = """
select k, line, doc_type, description, date, url, concat('<table><tbody><tr><td>', doc_type,
  '<table><tr><td>in1</td><td>in2</td><td>in3</td><td>in4</td><td>in5</td><td><a href="/DocumentViewer?Name_File=in">x</a></td></tr></table>',
  '</td><td>', description, '</td><td>', date, '</td><td>p</td><td>q</td><td><a href="', replace(url, '&', '&amp;'), '">y</a></td></tr>',
  '<tr><td>', description, '<td>', date, '<td>', doc_type, '<td>', case when k % 3 = 0 then '<b>r</b>' else '' end, '<td>s<td><a href="',
  replace(url, '&', '&amp;'), '">z</a></table>') as html
from fx_doc_links
"""

VIEWS["fx_listing_pages"] = """
select page_id, url, case page_id % 10
  when 0 then concat('<h1>Cloudflare</h1><p>Ray ID</p>', html)
  when 1 then concat('<p>Cloudflare</p>', html)
  when 2 then concat('<p>חלה שגיאה</p>', html)
  else html end as html
from pages
"""

# All files as listed. Urgent files are listed twice, the second time with another address.
VIEWS["fx_listing_all"] = """
select prio, city, cast(k as string) as file_id, concat(street, ' ', house) as address,
  concat('גוש ', cast(3600 + ck % 50 as string)) as parcel_info,
  concat('/BuildingArchiveDetails?OrgEntityNumber=', cast(k as string)) as url, 0 as pos
from fx_base
union all
select prio, city, cast(k as string), 'כתובת כפולה', '', concat('/BuildingArchiveDetails?OrgEntityNumber=', cast(k as string)), 1
from fx_base where prio = '1-URGENT'
"""

# A ledger of all files. Lists are joined with ';'.
VIEWS["fx_ledger_all"] = """
select city, cast(k as string) as file_id, concat('/BuildingArchiveDetails?OrgEntityNumber=', cast(k as string)) as url,
  concat(street, ' ', house) as address,
  case when k % 20 = 1 then 'error' when k % 20 = 2 then 'skipped' when ost = 'F' then 'processed'
    when ost = 'P' then 'downloaded' else 'pending' end as status,
  case when k % 20 in (1, 2) or ost = 'O' then ''
    else concat(doc_path, ';data/', lower(city), '/pdfs/', cast(k as string), '/permit_b.pdf') end as pdfs_joined,
  case when k % 20 in (1, 2) or ost = 'O' then '' else concat(dd, '/', mm, '/', yy,
    case when k % 4 = 0 then '' else ';01/01/2001' end) end as dates_joined,
  case when k % 20 = 1 then 'timeout' else '' end as error, oy
from fx_base
"""

# The listing of a later visit, on which some files are no longer.
VIEWS["fx_listing"] = """
select city, file_id, address, parcel_info, url, pos from fx_listing_all where prio <> '5-LOW'
"""

# The ledger of an earlier run: files from before 2000.
VIEWS["fx_ledger"] = """
select city, file_id, url, address, status, pdfs_joined, dates_joined, error from fx_ledger_all where oy < 2000
"""

# All documents, and those in the store: of orders no longer open.
VIEWS["fx_documents"] = """
select doc_path as path, folder from fx_base
"""
VIEWS["fx_inventory"] = """
select doc_path as path, folder, k % 1000 + 1 as length from fx_base where ost <> 'O'
"""

# Reviews in the order they were made. Of several of one document the last counts; blanks are no edit.
VIEWS["fx_corrections"] = """
select pdf_path, 'ערך קודם' as owner, 'ערך קודם' as architect, 'save' as action, 0 as seq
from fx_permits_all where prio = '1-URGENT'
union all
select pdf_path, case when k % 2 = 0 then ' משפחת תיקון ' else ' ' end as owner,
  case when k % 3 = 0 then 'אדריכל תיקון' else '' end as architect,
  case when k % 25 = 0 then 'skip' else 'save' end as action, 1 as seq
from fx_permits_all where prio in ('1-URGENT', '2-HIGH')
"""

# Marks with what they say. File numbers are a city's own; lists are joined with ';'.
VIEWS["fx_activity"] = """
select event_id, ts, concat('city', cast(event_id % 3 as string)) as city, cast(user_id as string) as file_id,
  case event_type when 'view' then 'listed' when 'click' then 'downloaded' when 'purchase' then 'processed'
    when 'signup' then 'skipped' else 'error' end as mark,
  case event_type when 'view' then concat('/BuildingArchiveDetails?OrgEntityNumber=', cast(user_id as string), '&v=',
    cast(event_id % 5 as string)) else '' end as url,
  case event_type when 'view' then concat('הרצל ', cast(event_id % 40 as string)) else '' end as address,
  case when event_type = 'click' and event_id % 4 <> 0 or event_type = 'purchase' and event_id % 2 = 0
    then concat('p', cast(event_id as string), '_a.pdf;p', cast(event_id as string), '_b.pdf') else '' end as pdfs_joined,
  case when event_type = 'click' and event_id % 4 <> 0 then concat('01/02/', cast(1950 + event_id % 70 as string)) else '' end
    as dates_joined,
  case event_type when 'error' then concat('timeout ', cast(event_id % 9 as string)) else '' end as error
from events
"""

_NAME = re.compile(r"\bfx_[a-z_]+\b")


def needed_views(sql: str) -> list[str]:
    """Views a statement reads, directly or through other views, in definition order."""
    wanted: set[str] = set()
    todo = _NAME.findall(sql)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo.extend(_NAME.findall(VIEWS[name]))
    return [name for name in VIEWS if name in wanted]


def with_views(sql: str, first: list[str] | None = None) -> str:
    """The statement with the views it needs in front, after any given common table expressions."""
    parts = list(first or []) + [f"{name} as ({VIEWS[name].strip()})" for name in needed_views(sql)]
    body = sql.strip()
    if not parts:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return "with " + ",\n".join(parts) + "\n" + body


# Views already written, by application, folder and name.
_STORED: dict[tuple[str, str, str], str] = {}


class Fixtures:
    """The views over one folder of driver tables.

    A view is written as a Parquet table to the shared folder when it is first asked for, so that queries start from
    stored tables, as they do in use, and their filters and column lists reach the scan. Its files have a fixed number of rows,
    so that they are read by as many tasks as their rows ask for, on every master.
    """

    ROWS_PER_FILE = 20_000

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def base(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def _scan(self, table: str) -> str:
        return f"{table} as (select * from parquet.`{self.sf_dir}/{table}.parquet`)"

    def derived(self, view: str) -> DataFrame:
        """The view as a plan over the driver's tables."""
        text = view + " " + " ".join(VIEWS[name] for name in needed_views(view))
        scans = [self._scan(table) for table in BASE_TABLES if re.search(rf"\b{table}\b", text)]
        return self.spark.sql(with_views(f"select * from {view}", scans))

    def __getitem__(self, view: str) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, view)
        if key in _STORED:
            try:
                return self.spark.read.parquet(_STORED[key])
            except AnalysisException as problem:
                # The shared folder may have been cleared; then the view is written again.
                if problem.getCondition() != "PATH_NOT_FOUND":
                    raise
        path = fresh_dir(self.spark, view)
        self.derived(view).write.option("maxRecordsPerFile", self.ROWS_PER_FILE).parquet(path)
        _STORED[key] = path
        return self.spark.read.parquet(path)
