"""Registered queries against their SQL over the whole smallest tables; those without SQL against plain computations."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from compare import connect, differences
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from permitwright.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_all_are_registered():
    names = entry_point.queries()
    assert [n for n in range(1, 14) if not any(name.startswith(f"op{n}_") for name in names)] == []
    assert "pipeline" in names and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", ["op4_license_scan", "op5_line_dedup"])
def test_native_queries_run_no_python(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [step for step in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if step in plan]


def test_piece_encoding_equals_the_library(spark, sf_dir, con):
    import hashlib

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = {}
    for doc_id, text in con.execute("select doc_id, coalesce(text, '') from documents").fetchall():
        ids = library.encode(text)
        want[doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op2_piece_encoding"](spark, sf_dir).collect()}
    assert got == want


def test_neighbours_against_brute_force(spark, sf_dir, con):
    rows = con.execute("select vec_id, embedding from embeddings order by vec_id").fetchall()
    ids, points = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = {}
    for r in QUERIES["op3_neighbours"](spark, sf_dir).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = wanted = 0
    for q in np.flatnonzero(ids % 100 == 0):
        gap = np.sqrt(((points - points[q]) ** 2).sum(1))
        gap[q] = np.inf
        near = set(ids[np.lexsort((ids, gap))[:10]].tolist())
        mine = found.pop(ids[q])
        assert sorted(mine) == list(range(1, 11))
        assert [mine[k] for k in sorted(mine)] == sorted(mine.values(), key=lambda v: (v[1], v[0]))
        assert all(s == pytest.approx(gap[ids == v][0], rel=1e-12) for v, s in mine.values())
        hits, wanted = hits + len(near & {v for v, _ in mine.values()}), wanted + 10
    assert not found and hits >= 0.9 * wanted


def test_packing_is_gapless_and_near_the_bound(spark, sf_dir, con):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = QUERIES["op9_best_fit"](spark, sf_dir).collect()
    pieces, used = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, {})[r.piece] = r
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = 0
    for doc_id, text in con.execute("select doc_id, coalesce(text, '') from documents").fetchall():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        mine, start = pieces.pop(doc_id), 0
        for number in range(len(mine)):
            r = mine[number]
            assert r.start == start and (r.length == 2048 or number == 0)
            assert r.ids_crc32 == zlib.crc32(ids[start : start + r.length].tobytes())
            start += r.length
        assert start == len(ids)
        total += len(ids)
    assert not pieces
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(used) <= -(-total // 2048) + 1


@pytest.mark.parametrize("name, label, part", [("op6_quality", "quality", (5, 0)), ("op10_toxicity", "toxic", (4, 2))])
def test_classifiers_on_held_out_documents(name, label, part, spark):
    """Recall and precision of what is to be caught: low quality, and toxic documents."""
    sf_dir = "/root/testdata/sf0.1"
    labels = dict(connect(sf_dir).execute(f"select doc_id, {label} from labels").fetchall())
    rows = QUERIES[name](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % part[0] == part[1]) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    wanted = 0 if label == "quality" else 1
    pairs = [(r.predicted == wanted, labels[r.doc_id] == wanted) for r in rows if r.held_out and r.doc_id in labels]
    caught = sum(p and y for p, y in pairs)
    assert caught >= 0.9 * sum(y for _, y in pairs) > 50 and caught >= 0.9 * sum(p for p, _ in pairs)


def test_pipeline_stages(spark, sf_dir, con):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = rows.columns
    counts = [rows.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.saved(stage(spark, rows, sf_dir), "stage")
        assert rows.columns == names
        counts.append(rows.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    kept = {r.doc_id for r in rows.select("doc_id").collect()}
    toxic = {d for d, in con.execute("select doc_id from labels where toxic = 1 and quality = 1").fetchall()}
    clean = {d for d, in con.execute("select doc_id from labels where toxic = 0 and quality = 1").fetchall()}
    assert len(kept & toxic) <= 0.2 * len(toxic) and len(kept & clean) >= 0.8 * len(clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept
