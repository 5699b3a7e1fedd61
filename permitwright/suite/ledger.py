"""Listing, ledger and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permitwright.fixtures import Fixtures
from permitwright.operators import ledger as L
from permitwright.plans.archive import Archive
from permitwright.session import fresh_dir
from permitwright.suite.registry import query


def typed_ledger(fx: Fixtures, view: str = "fx_ledger_all") -> DataFrame:
    """A ledger view with its lists as arrays and an absent error as NULL."""

    def listed(name: str):
        return F.filter(F.split(name, ";"), lambda item: item != "")

    meta = F.transform(
        listed("dates_joined"), lambda d: F.struct(d.alias("date"), F.lit("").alias("entity_number"))
    )
    return fx[view].select(
        "city",
        "file_id",
        "url",
        "address",
        "status",
        listed("pdfs_joined").alias("pdfs"),
        meta.alias("doc_meta"),
        F.nullif(F.col("error"), F.lit("")).alias("error"),
    )


def flat_ledger(ledger: DataFrame) -> DataFrame:
    """Lists joined again, to compare with the view."""
    return ledger.select(
        "city",
        "file_id",
        "url",
        "address",
        "status",
        F.array_join("pdfs", ";").alias("pdfs_joined"),
        F.array_join(F.col("doc_meta.date"), ";").alias("dates_joined"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


_FRESH = """select city, file_id, address, parcel_info, url from (
      select *, row_number() over (partition by city, file_id order by pos) as rn from fx_listing l
      where not exists (select 1 from fx_ledger g where g.city = l.city and g.file_id = l.file_id)) f where rn = 1"""
_LEDGER = "select city, file_id, url, address, status, pdfs_joined, dates_joined, error from fx_ledger"


@query("incremental_update", _FRESH)
def incremental_update(fx):
    return L.new_listing_entries(fx["fx_listing"], typed_ledger(fx, "fx_ledger")).drop("pos")


@query(
    "ledger_merge",
    f"""{_LEDGER} union all select city, file_id, url, address, 'pending', '', '', '' from ({_FRESH}) n""",
)
def ledger_merge(fx):
    return flat_ledger(L.merge_listing(typed_ledger(fx, "fx_ledger"), fx["fx_listing"]))


_DOCUMENTS = """documents as (select city, file_id, address, status, cast(p as int) - 1 as pos, pdfs[p] as pdf_path,
      coalesce(dates[p], '') as date
    from (select *, unnest(generate_series(1, len(pdfs))) as p from (select *, string_split(pdfs_joined, ';') as pdfs,
      string_split(dates_joined, ';') as dates from fx_ledger_all where pdfs_joined <> '') s) e)"""


@query("ledger_documents", f"with {_DOCUMENTS} select * from documents")
def ledger_documents(fx):
    return L.ledger_documents(typed_ledger(fx))


@query(
    "pending_extraction",
    f"""with {_DOCUMENTS} select city, file_id, address, pos, pdf_path, date from documents
    where status = 'downloaded' and pdf_path not in (select pdf_path from fx_known_records)""",
)
def pending_extraction(fx):
    return L.pending_extraction(typed_ledger(fx), fx["fx_known_records"])


@query(
    "mark_processed",
    f"""with {_DOCUMENTS}, unfinished as (select distinct city, file_id from documents
      where pdf_path not in (select pdf_path from fx_permits) and pdf_path not in (
        select pdf_path from documents where contains(pdf_path, 'permit_b') and city < 'J'))
    select city, file_id, case when status = 'downloaded' and not exists (select 1 from unfinished u
      where u.city = g.city and u.file_id = g.file_id) then 'processed' else status end as status from fx_ledger_all g""",
)
def mark_processed(fx):
    ledger = typed_ledger(fx)
    # Second documents of the first half of the cities failed; elsewhere they are still open.
    failed = L.ledger_documents(ledger).filter(F.col("pdf_path").contains("permit_b") & (F.col("city") < "J"))
    return L.mark_processed(ledger, fx["fx_permits"], failed.select("pdf_path")).select("city", "file_id", "status")


@query(
    "ledger_by_status",
    "select status, city, file_id, url from fx_ledger_all where status in ('pending', 'downloaded', 'error')",
)
def ledger_by_status(fx):
    return L.with_status(typed_ledger(fx), "pending", "downloaded", "error").select("status", "city", "file_id", "url")


@query(
    "ledger_progress",
    """select status, count(*) as files from fx_ledger_all group by status
    union all select 'total', count(*) from fx_ledger_all""",
)
def ledger_progress(fx):
    return L.progress(typed_ledger(fx))


@query(
    "retry_errors",
    """select city, file_id, case when status = 'error' then 'pending' else status end as status,
      case when status = 'error' then '' else error end as error from fx_ledger_all""",
)
def retry_errors(fx):
    return flat_ledger(L.retry_errors(typed_ledger(fx))).select("city", "file_id", "status", "error")


@query(
    "city_overview",
    """select subdomain, name, ord, total, processed from fx_cities left join (select lower(city) as c, count(*) as total,
      count(*) filter (status = 'processed') as processed from fx_ledger_all group by 1) l on subdomain = c""",
)
def city_overview(fx):
    ledger = typed_ledger(fx).withColumn("city", F.lower("city"))
    return L.city_overview(fx["fx_cities"], ledger)


def typed_marks(rows: DataFrame) -> DataFrame:
    """Marks with their lists as arrays."""
    def listed(name: str):
        return F.filter(F.split(name, ";"), lambda item: item != "")

    meta = F.transform(listed("dates_joined"), lambda d: F.struct(d.alias("date"), F.lit("").alias("entity_number")))
    return rows.select(
        "event_id", "ts", "city", "file_id", "mark", "url", "address", listed("pdfs_joined").alias("pdfs"), meta.alias("doc_meta"),
        F.nullif("error", F.lit("")).alias("error"))


def _last(value: str, when: str, name: str) -> str:
    at = "struct_pack(ts := ts, event_id := event_id)"
    return f"max({at}) filter ({when}) as {name}_at, arg_max({value}, {at}) filter ({when}) as {name}_value"


# Marks replayed: of each part of an entry the last writer after the first listing.
REPLAYED = f"""replayed as (select city, file_id, url, address,
      case when status_at > listed_at then status_value else 'pending' end as status,
      case when pdfs_at > listed_at then pdfs_value else '' end as pdfs_joined,
      case when dates_at > listed_at then dates_value else '' end as dates_joined,
      case when error_at > listed_at then error_value else '' end as error
    from (select city, file_id, min(struct_pack(ts := ts, event_id := event_id)) filter (mark = 'listed') as listed_at,
        arg_min(url, struct_pack(ts := ts, event_id := event_id)) filter (mark = 'listed') as url,
        arg_min(address, struct_pack(ts := ts, event_id := event_id)) filter (mark = 'listed') as address,
        {_last("mark", "mark <> 'listed'", "status")},
        {_last("pdfs_joined", "mark = 'downloaded' or mark = 'processed' and pdfs_joined <> ''", "pdfs")},
        {_last("dates_joined", "mark = 'downloaded'", "dates")},
        {_last("error", "mark = 'error'", "error")}
      from fx_activity group by city, file_id) a where listed_at is not null)"""


@query("ledger_replay", f"with {REPLAYED} select * from replayed")
def ledger_replay(fx):
    return flat_ledger(L.replay(typed_marks(fx["fx_activity"])))


@query(
    "ledger_marks",
    f"""with {REPLAYED}, named as (select concat('city', cast(cast(file_id as bigint) % 3 as varchar)) as city, file_id, url, address, status,
      pdfs_joined, dates_joined, error from fx_ledger_all where oy < 1995),
    marked as (select city, file_id, {_last("mark", "mark <> 'listed'", "status")},
        {_last("pdfs_joined", "mark = 'downloaded' or mark = 'processed' and pdfs_joined <> ''", "pdfs")},
        {_last("dates_joined", "mark = 'downloaded'", "dates")}, {_last("error", "mark = 'error'", "error")}
      from fx_activity group by city, file_id)
    select n.city, n.file_id, n.url, n.address, coalesce(status_value, n.status) as status,
      coalesce(pdfs_value, n.pdfs_joined) as pdfs_joined, coalesce(dates_value, n.dates_joined) as dates_joined,
      coalesce(error_value, n.error) as error
    from named n left join marked m on n.city = m.city and n.file_id = m.file_id
    union all select r.* from replayed r where not exists (select 1 from named n where n.city = r.city and n.file_id = r.file_id)""",
)
def ledger_marks(fx):
    """An archive's ledger before and after a run of marks; files it knows and files it does not."""
    archive = Archive(fx.spark, fresh_dir(fx.spark, "archive"))
    before = typed_ledger(fx, "fx_ledger_all").join(fx["fx_ledger_all"].filter("oy < 1995").select("city", "file_id"), L.KEY, "left_semi")
    named = F.concat(F.lit("city"), (F.col("file_id").cast("bigint") % 3).cast("string"))
    archive.ledger.append(before.withColumn("city", named))
    archive.record(typed_marks(fx["fx_activity"]))
    return flat_ledger(archive.ledger.read())
