"""The registered queries over these operators: each derives the columns of its contract from an operator's output."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from permitwright.llm.ann import nearest
from permitwright.llm.best_fit import cut_documents, pack
from permitwright.llm.common import id_remainder, prepared, saved
from permitwright.llm.conversation_repair import damaged, repair_conversations
from permitwright.llm.cover_tree import near_vectors
from permitwright.llm.license_scan import BASE, SIMILARITY, SLACK, WORDINGS, license_report
from permitwright.llm.line_dedup import RATIO, REPEATED, drop_boilerplate
from permitwright.llm.ngram_join import near_duplicates
from permitwright.llm.piece_encoding import encode_documents
from permitwright.llm.quality import learn_quality, score_quality
from permitwright.llm.recompression import WINDOW, without_repeats
from permitwright.llm.token_alignment import align_documents
from permitwright.llm.toxicity import learn_lexicon, score_toxicity
from permitwright.llm.warc import REVISIT_BYTES, read_archives, with_revisits, write_archives

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

ACCEPTED = 0.3


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(parts: int, part: int) -> Column:
    return id_remainder(F.col("doc_id"), parts) == part


def predicted(scores: DataFrame, parts: int, part: int) -> DataFrame:
    return scores.select(
        "doc_id", held_out(parts, part).alias("held_out"), "score",
        F.when(F.col("score") >= ACCEPTED, 1).otherwise(0).alias("predicted"),
    )


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = learn_lexicon(docs, labels.where(~held_out(4, 2)))
    return predicted(score_toxicity(docs, lexicon), 4, 2)


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn_quality(docs, labels.where(~held_out(5, 0)))
    return predicted(score_quality(docs, model), 5, 0)


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source: a source is the host, a document the page."""
    kept = drop_boilerplate(table(spark, sf_dir, "documents"), "source", "text", RATIO, REPEATED)
    return kept.select("doc_id", "source", "text", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"))


SQL["op5_line_dedup"] = f"""
with pages as (select doc_id, source, text, string_split(coalesce(text, ''), chr(10)) as lines from documents),
placed as (
  select doc_id, source, unnest(lines) as line, generate_subscripts(lines, 1) as place from pages
),
totals as (select source, count(*) as pages from documents group by source),
frequent as (
  select p.source, trim(p.line) as line from placed p join totals t on p.source is not distinct from t.source
  where trim(p.line) <> '' group by p.source, trim(p.line), t.pages
  having count(distinct p.doc_id) >= {REPEATED} and count(distinct p.doc_id) > {RATIO} * t.pages
),
kept as (
  select p.doc_id, string_agg(p.line, chr(10) order by p.place) as text, count(*) as n
  from placed p left join frequent f on p.source is not distinct from f.source and trim(p.line) = f.line
  where f.line is null group by p.doc_id
)
select d.doc_id, d.source, case when d.text is null then null else coalesce(k.text, '') end as text,
  case when d.text is null then 0 else len(d.lines) end as n_lines,
  case when d.text is null then 0 else len(d.lines) - coalesce(k.n, 0) end as n_dropped
from pages d left join kept k on d.doc_id = k.doc_id
"""


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=90)


SQL["op8_ngram_join"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) end) as s
  from words
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as common
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
),
links as (
  select x, y from shared join sizes p on x = p.doc_id join sizes q on y = q.doc_id
  where 100 * common >= 90 * (p.n + q.n - common)
),
reach as (
  select doc_id as x, doc_id as y from documents
  union
  select reach.x, links.y from reach join links on reach.y = links.x
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, r.component_id
from documents d left join sizes s on d.doc_id = s.doc_id
join (select x, min(y) as component_id from reach group by x) r on d.doc_id = r.x
"""


@F.pandas_udf(LongType())
def ids_crc32(ids: pd.Series) -> pd.Series:
    return pd.Series([zlib.crc32(np.asarray(part, "<u4").tobytes()) for part in ids], dtype="int64")


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum of their ids in place of the ids."""
    return pieces.select(*[ids_crc32(c).alias("ids_crc32") if c == "ids" else c for c in pieces.columns])


@query
def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pack(saved(digests(pieces), "pieces"))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = with_revisits(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return read_archives(spark, write_archives(pages), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "error")


SQL["op1_warc"] = f"""
with payloads as (
  select page_id, url, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
),
newest as (
  select payload_digest, payload_bytes, max(page_id) as page from payloads where payload_bytes >= {REVISIT_BYTES}
  group by payload_digest, payload_bytes
)
select p.page_id, p.payload_bytes, p.payload_digest,
  case when n.page <> p.page_id then 'revisit' else 'response' end as record_type,
  case when n.page <> p.page_id then n.page end as refers_to, p.url, cast(null as varchar) as error
from payloads p left join newest n on p.payload_digest = n.payload_digest and p.payload_bytes = n.payload_bytes
"""


@query
def op2_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


_PHRASES = ", ".join(
    f"({number}, '{phrase}', '{label}', {str(number < len(BASE)).lower()})"
    for number, (phrase, label) in enumerate((*BASE, *WORDINGS))
)
SQL["op4_license_scan"] = rf"""
with phrases(template, phrase, label, base) as (values {_PHRASES}),
split as (select *, string_split(phrase, ' ') as t from phrases),
pairs as (select template, label, base, len(t) - 1 as n, t, unnest(range(1, len(t))) as tplace from split),
words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
),
grams as (select doc_id, w, unnest(range(1, len(w))) as place from words),
hits as (
  select doc_id, template, label, base, n, tplace, place, place - tplace as diagonal
  from (select doc_id, place, w[place] as w1, w[place + 1] as w2 from grams) g
  join pairs p on g.w1 = p.t[p.tplace] and g.w2 = p.t[p.tplace + 1]
),
votes as (
  select doc_id, template, label, base, n, diagonal, count(distinct tplace) as v from hits
  group by doc_id, template, label, base, n, diagonal
),
opened as (
  select *, case when diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) <= {SLACK}
    then 0 else 1 end as fresh
  from votes where not base
),
merged as (
  select doc_id, template, diagonal, sum(fresh) over (partition by doc_id, template order by diagonal) as part from opened
),
spans as (
  select doc_id, label, base, diagonal, cast(1 as double) as score from votes where base and v = n
  union all
  select h.doc_id, h.label, h.base, min(h.diagonal), cast(count(distinct h.tplace) as double) / h.n
  from hits h join merged m on h.doc_id = m.doc_id and h.template = m.template and h.diagonal = m.diagonal
  group by h.doc_id, h.template, h.label, h.base, h.n, m.part
  having cast(count(distinct h.tplace) as double) / h.n >= {SIMILARITY} and max(h.place) - min(h.place) + 1 <= h.n + {SLACK}
),
found as (
  select doc_id, count(*) filter (base) as n_base, min(diagonal) filter (base) as first_word,
    max(diagonal) filter (base) as last_word, string_agg(distinct label, ',' order by label) filter (base) as base_labels,
    string_agg(distinct label, ',' order by label) as labels, max(score) as score
  from spans group by doc_id
)
select d.doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0) as score
from words d left join found f on d.doc_id = f.doc_id
"""


@query
def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


@query
def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


SQL["op7_near_vectors"] = """
with recursive vectors as (
  select vec_id, label, cast(embedding as double[]) as v from embeddings
),
links as (
  select a.vec_id as x, b.vec_id as y from vectors a join vectors b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.93
),
reach as (
  select vec_id as x, vec_id as y from vectors
  union
  select reach.x, links.y from reach join links on reach.y = links.x
)
select r.x as vec_id, coalesce(n.n, 0) as n_links, min(r.y) as component_id, r.x = min(r.y) as kept
from reach r left join (select x, count(*) as n from links group by x) n on r.x = n.x
group by r.x, n.n
"""


@query
def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), WINDOW, texts=False)


SQL["op11_recompression"] = rf"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, place, sha1(array_to_string(w[place:place + {WINDOW - 1}], ' ')) as s
  from (select doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) as place from words)
),
again as (select s from windows group by s having count(*) > 1),
gone as (select distinct doc_id, unnest(range(place, place + {WINDOW})) as place from windows semi join again using (s)),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by place) as text
  from (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as place from words) anti join gone using (doc_id, place)
  group by doc_id
)
select w.doc_id, len(w.w) as n_words, len(w.w) - coalesce(k.n, 0) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from words w left join kept k on w.doc_id = k.doc_id
"""


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair_conversations(damaged(rows), rows)


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_documents(table(spark, sf_dir, "documents"), *paths, texts=False)
