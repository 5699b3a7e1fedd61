"""Completing, correcting, cleaning up and merging record tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from permitwright.functions.patterns import SET_A, extract_values
from permitwright.operators import upkeep as U
from permitwright.operators.extract import with_outcome
from permitwright.plans.archive import Archive
from permitwright.session import fresh_dir
from permitwright.suite import rules as R
from permitwright.suite.registry import query

_IN_STORE = "pdf_path in (select path from fx_inventory)"


@query("review_queue", f"select pdf_path, owner, architect from fx_permits where not {R.complete()}")
def review_queue(fx):
    return U.review_queue(fx["fx_permits"]).select("pdf_path", "owner", "architect")


@query("missing_documents", f"select {R.RECORD_LIST} from fx_permits where not {_IN_STORE}")
def missing_documents(fx):
    return U.without_document(fx["fx_permits"], fx["fx_inventory"])


@query(
    "reextract_candidates",
    f"select pdf_path, owner, architect from fx_permits where (owner = '' or architect = '') and {_IN_STORE}",
)
def reextract_candidates(fx):
    return U.reextract_candidates(fx["fx_permits"], fx["fx_inventory"]).select("pdf_path", "owner", "architect")


_BACKFILLED = """backfilled as (select p.*, """ + ", ".join(
    f"case when p.{n} = '' and coalesce(a.{n}, '') <> '' then a.{n} else p.{n} end as new_{n}"
    for n in U.BACKFILL_FIELDS
) + """ from fx_permits p left join again a using (pdf_path))"""
_AGAIN = (
    "again as (select pdf_path, "
    + ", ".join(f"{R.field_a(n)} as {n}" for n in U.BACKFILL_FIELDS)
    + f" from fx_permit_text where pdf_path in (select pdf_path from fx_permits where (owner = '' or architect = '') and {_IN_STORE}))"
)


@query(
    "backfill_fields",
    f"with {_AGAIN}, {_BACKFILLED} select city, building_file_number, address, pdf_path, date, "
    + ", ".join(f"new_{n} as {n}" for n in U.BACKFILL_FIELDS)
    + ", ("
    + " or ".join(f"new_{n} <> {n}" for n in U.BACKFILL_FIELDS)
    + ") as changed from backfilled",
)
def backfill_fields(fx):
    wanted = U.reextract_candidates(fx["fx_permits"], fx["fx_inventory"]).select("pdf_path").distinct()
    texts = fx["fx_permit_text"].join(wanted, "pdf_path", "left_semi")
    return U.backfill(fx["fx_permits"], extract_values(texts, "ocr_text", SET_A, ["pdf_path"]))


_CORRECTED = f"""corrected as (select p.* exclude (owner, architect),
      case when takes_owner then new_owner else owner end as owner,
      case when takes_architect then new_architect else architect end as architect, takes_owner or takes_architect as changed
    from (select p.*, c.owner as new_owner, c.architect as new_architect,
      coalesce(c.action = 'save' and c.owner <> '' and not {R.valid('p.owner')}, false) as takes_owner,
      coalesce(c.action = 'save' and c.architect <> '' and not {R.valid('p.architect')}, false) as takes_architect
    from fx_permits p left join (select pdf_path, action, trim(owner) as owner, trim(architect) as architect from fx_corrections
      qualify row_number() over (partition by pdf_path order by seq desc) = 1) c using (pdf_path)) p)"""


@query("apply_corrections", f"with {_CORRECTED} select {R.RECORD_LIST}, changed from corrected")
def apply_corrections(fx):
    return U.apply_corrections(fx["fx_permits"], fx["fx_corrections"])


@query(
    "corrected_archive",
    f"""with {_CORRECTED} select {R.RECORD_LIST}, {R.BLANK_CONFIDENCES} from corrected""",
)
def corrected_archive(fx):
    """The corrections as a run over an archive, which writes the cities again in which a record changed."""
    archive = Archive(fx.spark, fresh_dir(fx.spark, "archive"))
    archive.records.append(fx["fx_permits"])
    archive.correct(fx["fx_corrections"])
    return archive.records.read()


@query(
    "review_summary",
    f"""with {_CORRECTED} select count(*) as records, count(*) filter (changed) as changed,
      count(*) filter ({R.complete()}) as complete, count(*) filter (not {R.complete()}) as incomplete from corrected""",
)
def review_summary(fx):
    return U.review_summary(U.apply_corrections(fx["fx_permits"], fx["fx_corrections"]))


_DONE = f"done as (select distinct pdf_path from fx_permits where {R.complete()})"


@query(
    "cleanup_plan",
    f"""with {_DONE} select 'delete_document' as action, path from fx_inventory where path in (select pdf_path from done)
    union all select 'remove_folder', folder from fx_inventory group by folder
      having count(*) filter (path not in (select pdf_path from done)) = 0""",
)
def cleanup_plan(fx):
    return U.cleanup_plan(fx["fx_permits"], fx["fx_inventory"])


@query(
    "cleanup_plan_of_store",
    f"""with {_DONE} select 'delete_document' as action, path from fx_inventory where path in (select pdf_path from done)
    union all select 'remove_folder', folder from fx_inventory where folder not in (
        select folder from fx_base where k % 8 = 1) group by folder
      having count(*) filter (path not in (select pdf_path from done)) = 0""",
)
def cleanup_plan_of_store(fx):
    """Beside its documents a folder may hold other files, which keep it."""
    notes = fx.derived("fx_base").filter("k % 8 = 1").select(F.concat("folder", F.lit("/notes.txt")).alias("path"), "folder").distinct()
    files = fx["fx_inventory"].select("path", "folder").unionByName(notes)
    return U.cleanup_plan(fx["fx_permits"], fx["fx_inventory"], files)


@query(
    "cleanup_summary",
    f"""with {_DONE} select (select count(*) from fx_inventory where path in (select pdf_path from done)) as deleted,
      (select count(*) from fx_permits where not {R.complete()}) as kept""",
)
def cleanup_summary(fx):
    return U.cleanup_summary(fx["fx_permits"], fx["fx_inventory"])


@query(
    "redownload_plan",
    rf"""select p.city, pdf_path, file_id, concat('/BuildingArchiveDetails?OrgEntityNumber=', file_id,
        '&pageId=8575&DefinementEntityType=10&BuildingNum=', file_id) as page, url,
      case when contains(url, 'Name_File=') then concat('data/', case when {R.folder('address')} = ''
        then concat('file_', file_id) else {R.folder('address')} end, '/permit_', regexp_extract(url, 'Name_File=([^&]*)', 1),
        '.pdf') else '' end as target,
      case when contains(url, 'Name_File=') then '' else 'no document name in link' end as error
    from fx_permits p join (select city, file_id, url, row_number() over (partition by city, file_id
        order by pos, url, date, entity_number) as rn from fx_doc_links where contains(doc_type, 'היתר בניה')) d
      on d.city = p.city and file_id = building_file_number and rn = 1
    where not {R.complete()} and building_file_number <> '' and not {_IN_STORE}""",
)
def redownload_plan(fx):
    return U.redownload_plan(fx["fx_permits"], fx["fx_inventory"], fx["fx_doc_links"], F.lit("data"))


@query(
    "merge_cities",
    f"""select case when city = '' then name else city end as city, {", ".join(R.RECORD[1:])}, subdomain as source, ord
    from fx_permits join fx_cities on subdomain = string_split(pdf_path, '/')[2]""",
)
def merge_cities(fx):
    source = F.split_part("pdf_path", F.lit("/"), F.lit(2))
    return U.merge_cities(fx["fx_permits"].withColumn("source", source), fx["fx_cities"])


@query(
    "normalise_cities",
    f"""select coalesce(subdomain, city) as city, {", ".join(R.RECORD[1:])}
    from fx_permits left join fx_cities on name = city or subdomain = city""",
)
def normalise_cities(fx):
    return U.normalise_cities(fx["fx_permits"], fx["fx_cities"])


@query("records_per_city", "select city, count(*) as records from fx_permits group by city")
def records_per_city(fx):
    return U.records_per_city(fx["fx_permits"])


@query(
    "batch_summary",
    """select documents, with_permit_page, with_permit_page * 0.006e0 as price, written, responses - written as skipped
    from (select (select count(*) from fx_documents) as documents,
      (select count(*) from fx_documents where path in (select pdf_path from fx_geometry
        where width_pt * 25.4e0 / 72 < 300)) as with_permit_page,
      (select count(*) from fx_responses) as responses,
      (select count(distinct record_id) from fx_responses
        where record_id not in (select pdf_path from fx_known_records)) as written) s""",
)
def batch_summary(fx):
    stored = fx["fx_documents"].select(F.col("path").alias("pdf_path"))
    return U.batch_summary(stored, fx["fx_geometry"], fx["fx_responses"], fx["fx_known_records"])


@query(
    "first_record_per_document",
    f"""select {R.RECORD_LIST} from (select *, row_number() over (partition by pdf_path order by seq, {R.RECORD_LIST}) as rn
      from fx_repeated) r where rn = 1""",
)
def first_record_per_document(fx):
    return U.first_records(fx["fx_repeated"], [F.col("seq")]).drop("seq")


_USABLE = f"""{R.PARSED.replace("fx_responses", "fx_response_lines")}, usable as (select *,
      {" or ".join(f"{R.response_confidence(n)} = 'high'" for n in R.RESPONSE_FIELDS)} as says
    from parsed where record_id is not null and not (starts_with(t, '```') and not contains(t, chr(10)))
      and (doc is null or j is not null))"""


@query(
    "batch_results",
    f"""with {_USABLE} select 'akko' as city, '' as building_file_number,
      {", ".join(f"{R.response_field(n)} as {n}" for n in R.RESPONSE_FIELDS)}, '' as structural_planner, record_id as pdf_path,
      {", ".join(f"{R.response_confidence(n)} as {n}_confidence" for n in R.RESPONSE_FIELDS)}
    from (select * from usable qualify row_number() over (partition by record_id order by says desc, file, block, place) = 1) u
    where record_id not in (select pdf_path from fx_known_records)""",
)
def batch_results(fx):
    return U.batch_records(fx["fx_response_lines"], fx["fx_known_records"], F.lit("akko"))


@query(
    "batch_quarantine",
    f"""with {R.PARSED.replace("fx_responses", "fx_response_lines")} select record_id, file, place, error from (
      select *, case when record_id is null then 'no_document'
        when starts_with(t, '```') and not contains(t, chr(10)) then 'fence_without_body'
        when doc is not null and j is null then 'not_an_object' end as error from parsed) q where error is not null""",
)
def batch_quarantine(fx):
    marked = with_outcome(fx["fx_response_lines"])
    return marked.filter("outcome = 'quarantined'").select("record_id", "file", "place", "error")


@query(
    "redownloaded_records",
    f"""select p.city, {", ".join(n for n in R.RECORD if n not in ("city", "pdf_path"))},
      case when k % 3 = 0 then concat(pdf_path, '.new') else pdf_path end as pdf_path, k % 3 = 0 as changed from fx_permits_all p""",
)
def redownloaded_records(fx):
    plan = fx["fx_permits_all"].filter("k % 3 = 0").select("city", "pdf_path", F.concat("pdf_path", F.lit(".new")).alias("target"))
    return U.redownloaded(fx["fx_permits"], plan.unionAll(plan))
