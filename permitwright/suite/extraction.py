"""Field rules, pattern extraction and responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from permitwright.functions import text as T
from permitwright.functions.patterns import SET_A, SET_B, extract_values, extract_with_confidence, is_permit_text
from permitwright.functions.responses import parse_responses
from permitwright.operators import documents, extract
from permitwright.plans import browse
from permitwright.sources import batch, pages
from permitwright.suite import rules as R
from permitwright.suite.registry import query

DATA_ROOT = "data"
# Each city's portal; a real host is passed by the user.
PORTAL = "https://{subdomain}.archive.example"


@query(
    "extract_fields_a",
    "select pdf_path, " + ", ".join(f"{R.field_a(n)} as {n}" for n in R.PATTERNS_A) + " from fx_permit_text",
)
def extract_fields_a(fx):
    return extract_values(fx["fx_permit_text"], "ocr_text", SET_A, ["pdf_path"])


@query(
    "extract_fields_b",
    "select pdf_path, "
    + ", ".join(f"{R.field_b(n)} as {n}, {R.confidence_b(n)} as {n}_confidence" for n in R.PATTERNS_B)
    + " from fx_permit_text",
)
def extract_fields_b(fx):
    return extract_with_confidence(fx["fx_permit_text"], "ocr_text", SET_B, ["pdf_path"])


@query("permit_text_filter", f"select pdf_path from fx_permit_text where {R.PERMIT_TEXT}")
def permit_text_filter(fx):
    return fx["fx_permit_text"].filter(is_permit_text(F.col("ocr_text"))).select("pdf_path")


@query(
    "assemble_text",
    """select l.pdf_path, concat(l.ocr_text, chr(10), n.name_text) as full_text from (
      select pdf_path, string_agg(line, chr(10) order by pos) as ocr_text from fx_permit_lines group by pdf_path) l
    join fx_name_text n on l.pdf_path = n.pdf_path""",
)
def assemble_text(fx):
    whole = extract.assemble_lines(fx["fx_permit_lines"]).join(fx["fx_name_text"], "pdf_path")
    return whole.select("pdf_path", extract.join_texts(F.col("ocr_text"), F.col("name_text")).alias("full_text"))


@query(
    "parse_responses",
    f"with {R.PARSED} select record_id, "
    + ", ".join(
        f"{R.response_field(n)} as {n}, {R.response_confidence(n)} as {n}_confidence" for n in R.RESPONSE_FIELDS
    )
    + " from parsed",
)
def parse_all_responses(fx):
    return parse_responses(fx["fx_responses"], "response_text", ["record_id"])


_RESPONSE_RECORD = (
    "'' as city, '' as building_file_number, "
    + ", ".join(f"{R.response_field(n)} as {n}" for n in R.RESPONSE_FIELDS)
    + ", '' as structural_planner, record_id as pdf_path, "
    + ", ".join(f"{R.response_confidence(n)} as {n}_confidence" for n in R.RESPONSE_FIELDS)
)


@query("response_records", f"with {R.PARSED} select {_RESPONSE_RECORD} from parsed")
def response_records(fx):
    return extract.response_records(fx["fx_responses"])


@query(
    "low_confidence_count",
    f"with {R.PARSED} select record_id, cast("
    + " + ".join(f"cast({R.response_confidence(n)} = 'none' as int)" for n in R.RESPONSE_FIELDS)
    + " as int) as low_fields from parsed",
)
def low_confidence_count(fx):
    parsed = parse_responses(fx["fx_responses"], "response_text", ["record_id"])
    return parsed.select("record_id", extract.low_confidence_count().alias("low_fields"))


@query(
    "extraction_quarantine",
    f"""with {R.PARSED} select record_id, error,
      case when error in ('not_an_object', 'fence_without_body') then 'quarantined' else 'ok' end as outcome
    from (select record_id, case when starts_with(t, '```') and not contains(t, chr(10)) then 'fence_without_body'
      when doc is null then 'invalid_json' when j is null then 'not_an_object' else '' end as error from parsed) p""",
)
def extraction_quarantine(fx):
    return extract.with_outcome(fx["fx_responses"]).select("record_id", "error", "outcome")


_FROM_SET_A = (
    "'' as city, "
    + ", ".join(
        f"{R.field_a('building_file' if n == 'building_file_number' else n)} as {n}"
        if n in R.PATTERNS_A or n == "building_file_number"
        else f"'' as {n}"
        for n in R.RECORD
        if n not in ("city", "pdf_path")
    )
    + f", pdf_path, {R.BLANK_CONFIDENCES}"
)
_ON_PERMIT_PAGE = "pdf_path in (select pdf_path from fx_geometry where width_pt * 25.4 / 72 < 300)"


@query(
    "extract_with_fallback",
    f"with {R.PARSED} select {R.FULL_LIST} from (select {_RESPONSE_RECORD} from parsed"
    f" where record_id in (select record_id from fx_answered)) p where {_ON_PERMIT_PAGE}"
    f" union all select {R.FULL_LIST} from (select {_FROM_SET_A} from fx_permit_text"
    f" where {R.PERMIT_TEXT} and {_ON_PERMIT_PAGE} and pdf_path not in (select record_id from fx_answered)) t",
)
def extract_with_fallback(fx):
    return extract.extract_records(fx["fx_permit_text"], extract.CLOUD, fx["fx_geometry"], fx["fx_answered"])


@query(
    "extract_text_only",
    f"select {R.FULL_LIST} from (select {_FROM_SET_A} from (select pdf_path, ocr_text as page,"
    " concat(ocr_text, chr(10), name_text) as ocr_text from fx_permit_text join fx_name_text using (pdf_path)) w"
    f" where {R.PERMIT_TEXT.replace('ocr_text', 'page')}) t",
)
def extract_text_only(fx):
    texts = fx["fx_permit_text"].join(fx["fx_name_text"], "pdf_path")
    return extract.extract_records(texts, extract.TEXT_ONLY)


@query(
    "extract_local",
    f"select {R.FULL_LIST} from (select pdf_path, '' as city, '' as building_file_number, '' as structural_planner, "
    + ", ".join(f"{R.field_b(n)} as {n}, {R.confidence_b(n)} as {n}_confidence" for n in R.PATTERNS_B)
    + f" from fx_permit_text where {_ON_PERMIT_PAGE}) t",
)
def extract_local(fx):
    return extract.extract_records(fx["fx_permit_text"], extract.LOCAL, fx["fx_geometry"])


@query(
    "stamp_records",
    f"""with found as (select {_FROM_SET_A} from fx_permit_text where {R.PERMIT_TEXT}),
    work as (select city, file_id, address, unnest(string_split(pdfs_joined, ';')) as pdf_path,
      unnest(string_split(dates_joined, ';')) as date from fx_ledger_all where pdfs_joined <> '')
    select w.city, w.file_id as building_file_number, permit_number,
      case when f.address = '' then w.address else f.address end as address, gush, helka, migrash, city_plan, owner,
      architect, structural_planner, pdf_path, coalesce(w.date, '') as date,
      {", ".join(f"{c}_confidence" for c in R.CONFIDENT)}
    from found f join work w using (pdf_path)""",
)
def stamp_records(fx):
    from permitwright.operators.ledger import ledger_documents
    from permitwright.suite.ledger import typed_ledger

    records = extract.extract_records(fx["fx_permit_text"], extract.TEXT_ONLY)
    return extract.stamp_records(records, ledger_documents(typed_ledger(fx, "fx_ledger_all")))


@query("folder_names", f"select pdf_path, {R.folder('address')} as folder from fx_permits")
def folder_names(fx):
    return fx["fx_permits"].select("pdf_path", T.folder_name(F.col("address")).alias("folder"))


@query(
    "document_targets",
    rf"""select city, listing_id as file_id, pos, line, d.url, case when contains(d.url, 'Name_File=') then concat('data/',
        case when {R.folder('address')} = '' then concat('file_', listing_id) else {R.folder('address')} end, '/permit_',
        case when entity_number <> '' then entity_number else regexp_extract(d.url, 'Name_File=([^&]*)', 1) end, '.pdf')
      else '' end as target,
      case when contains(d.url, 'Name_File=') then '' else 'no document name in link' end as error
    from fx_doc_links d join (select city, file_id as listing_id, address from fx_listing_all where pos = 0) l
      using (city, listing_id)""",
)
def document_targets(fx):
    listing = fx["fx_listing_all"].filter("pos = 0").select("city", "file_id", "address")
    links = fx["fx_doc_links"].drop("file_id").withColumnRenamed("listing_id", "file_id").join(listing, ["city", "file_id"])
    targets = documents.document_targets(links, F.lit(DATA_ROOT))
    return targets.select("city", "file_id", "pos", "line", "url", "target", "error")


@query("year_parse", f"select pdf_path, date, {R.year()} as year from fx_permits")
def year_parse(fx):
    return fx["fx_permits"].select("pdf_path", "date", T.year_lenient(F.col("date")).alias("year"))


@query("street_names", f"select pdf_path, {R.street()} as street from fx_permits")
def street_names(fx):
    return fx["fx_permits"].select("pdf_path", T.street_name(F.col("address")).alias("street"))


@query(
    "clean_fields",
    f"select pdf_path, {R.clean('owner')} as owner, {R.clean('architect')} as architect from fx_permits",
)
def clean_fields(fx):
    return fx["fx_permits"].select("pdf_path", *[T.clean(F.col(n)).alias(n) for n in ("owner", "architect")])


@query(
    "record_completeness",
    f"""select pdf_path, {R.valid('owner')} as owner_valid, {R.valid('architect')} as architect_valid,
      {R.complete()} as complete from fx_permits""",
)
def record_completeness(fx):
    owner, architect = F.col("owner"), F.col("architect")
    return fx["fx_permits"].select(
        "pdf_path",
        T.is_valid_field(owner).alias("owner_valid"),
        T.is_valid_field(architect).alias("architect_valid"),
        T.is_complete(owner, architect).alias("complete"),
    )


@query("private_houses", f"select pdf_path, gush, helka from fx_permits where {R.single_parcel()}")
def private_houses(fx):
    return browse.filtered(fx["fx_permits"], browse.Filters(private_only=True)).select("pdf_path", "gush", "helka")


@query(
    "detail_links",
    """select pdf_path, case when building_file_number = '' then '' else concat('https://',
      string_split(pdf_path, '/')[2], '.archive.example/BuildingArchiveDetails?OrgEntityNumber=', building_file_number,
      '&pageId=8575&DefinementEntityType=10&BuildingNum=', building_file_number) end as link from fx_permits""",
)
def detail_links(fx):
    base = browse.portal_base(PORTAL, F.split_part("pdf_path", F.lit("/"), F.lit(2)))
    link = browse.detail_link(base, T.detail_path(F.col("building_file_number")))
    return fx["fx_permits"].select("pdf_path", link.alias("link"))


@query(
    "absolute_links",
    """select city, file_id, pos, case when starts_with(url, 'http') then url
      else concat('https://', lower(city), '.archive.example', url) end as link from fx_listing_all""",
)
def absolute_links(fx):
    base = browse.portal_base(PORTAL, F.lower("city"))
    return fx["fx_listing_all"].select("city", "file_id", "pos", T.absolute_link(F.col("url"), base).alias("link"))


@query(
    "permit_documents",
    """select file_id, pos, doc_type, date, url from fx_doc_links where contains(doc_type, 'היתר בניה')
      and coalesce(try_cast(trim(list_extract(string_split(date, '/'), -1)) as int), 2000) >= 2000""",
)
def permit_documents(fx):
    return documents.permit_documents(fx["fx_doc_links"]).select("file_id", "pos", "doc_type", "date", "url")


@query(
    "permit_pages",
    """select pdf_path, page_idx, width_pt * 25.4e0 / 72 as width_mm from fx_geometry
      where width_pt * 25.4e0 / 72 < 300""",
)
def permit_pages(fx):
    return documents.permit_pages(fx["fx_geometry"]).select("pdf_path", "page_idx", "width_mm")


@query(
    "first_permit_page",
    """select pdf_path, min(page_idx) as page_idx from fx_geometry where width_pt * 25.4e0 / 72 < 300
      group by pdf_path""",
)
def first_permit_page(fx):
    return documents.first_permit_page(fx["fx_geometry"])


@query("permit_pdfs", f"select path from fx_documents where {_ON_PERMIT_PAGE.replace('pdf_path in', 'path in')}")
def permit_pdfs(fx):
    stored = fx["fx_documents"].withColumnRenamed("path", "pdf_path")
    return documents.with_permit_page(stored, fx["fx_geometry"]).select(F.col("pdf_path").alias("path"))


@query(
    "batch_requests",
    """select pdf_path as record_id, 'bedrock-2023-05-31' as version, 1024 as max_tokens, 'user' as role,
      'image' as first_type, 'image/png' as media_type, concat(pdf_path, '#', cast(min(page_idx) as varchar)) as payload,
      'text' as second_type, 'P' as prompt
    from fx_geometry where width_pt * 25.4e0 / 72 < 300 group by pdf_path""",
)
def batch_requests(fx):
    first = documents.first_permit_page(fx["fx_geometry"])
    # A rendered page is an input; here its bytes are the page's name.
    pages_with_bytes = first.select(
        "pdf_path", F.concat_ws("#", "pdf_path", F.col("page_idx").cast("string")).cast("binary").alias("payload")
    )
    lines = batch.batch_requests(pages_with_bytes, "P")

    def at(path: str):
        return F.get_json_object("value", f"$.{path}")

    message = "modelInput.messages[0]"
    return lines.select(
        at("recordId").alias("record_id"),
        at("modelInput.anthropic_version").alias("version"),
        at("modelInput.max_tokens").cast("int").alias("max_tokens"),
        at(f"{message}.role").alias("role"),
        at(f"{message}.content[0].type").alias("first_type"),
        at(f"{message}.content[0].source.media_type").alias("media_type"),
        F.unbase64(at(f"{message}.content[0].source.data")).cast("string").alias("payload"),
        at(f"{message}.content[1].type").alias("second_type"),
        at(f"{message}.content[1].text").alias("prompt"),
    )


@query(
    "html_listing_rows",
    r"""select page_id, cast(pos - 1 as int) as row_pos, regexp_extract(label, '^\s*(\S*)', 1) as file_id, url from (
      select page_id, pos, regexp_extract(item, '<a\b[^>]*?href="([^"]*)"', 1) as url,
        replace(regexp_replace(regexp_extract(item, '(?s)<a\b[^>]*>(.*?)</a>', 1), '<[^>]*>', '', 'g'), '&amp;', '&') as label
      from (select page_id, unnest(items) as item, generate_subscripts(items, 1) as pos
        from (select page_id, regexp_extract_all(html, '(?s)<li\b[^>]*>(.*?)</li>', 1) as items from pages) p) i) r
    where url <> ''""",
)
def html_listing_rows(fx):
    shape = pages.RowShape(row="li", cell="a")
    return pages.listing_rows(fx.base("pages"), "html", ["page_id"], shape).select("page_id", "row_pos", "file_id", "url")


@query(
    "html_document_links",
    """select k, line, 0 as row_pos, doc_type, description, date, entity_type, concat('0', entity_number) as entity_number, url
    from fx_doc_links""",
)
def html_document_links(fx):
    return pages.document_rows(fx["fx_doc_pages"], "html", ["k", "line"])


@query(
    "html_nested_rows",
    """select k, line, 0 as row_pos, concat(doc_type, 'in1in2in3in4in5x') as doc_type, 'in1' as description, 'in2' as date,
      'in3' as entity_type, 'in4' as entity_number, '/DocumentViewer?Name_File=in' as url from fx_nested_pages
    union all select k, line, 1, 'in1', 'in2', 'in3', 'in4', 'in5', '/DocumentViewer?Name_File=in' from fx_nested_pages
    union all select k, line, 2, description, date, doc_type, case when k % 3 = 0 then 'r' else '' end, 's', url
      from fx_nested_pages""",
)
def html_nested_rows(fx):
    return pages.document_rows(fx["fx_nested_pages"], "html", ["k", "line"])


@query(
    "page_quarantine",
    """select page_id, case when contains(html, 'Cloudflare') and (contains(html, 'blocked') or contains(html, 'Ray ID'))
      then 'blocked' when contains(html, 'חלה שגיאה') then 'error' else 'ok' end as verdict from fx_listing_pages""",
)
def page_quarantine(fx):
    return fx["fx_listing_pages"].select("page_id", pages.page_verdict(F.col("html")).alias("verdict"))
