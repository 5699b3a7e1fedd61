"""Operators on small literal tables: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import functools
import gzip
import hashlib
import io
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from permitwright.llm import (
    best_fit, common, conversation_repair, cover_tree, license_scan, line_dedup, ngram_join, quality, recompression, token_alignment, toxicity, warc,
)
from permitwright.llm.ann import nearest
from permitwright.llm.piece_encoding import encode_documents, piece_model

DOCS = "doc_id long, text string, key long, n long, score double, ids string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    """Columns that clash with the operators' own, a null id, null, empty and blank texts, a repeated row, a long text."""
    texts = [(1, "one two three"), (2, None), (3, ""), (4, " \n\t "), (None, "no id here"), (5, "same"), (5, "same"), (6, "w " * 40_000)]
    return spark.createDataFrame([(i, t, None, 1, 0.5, "x", None) for i, t in texts], DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Components


def test_components(spark, monkeypatch):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(900 + i, 901 + i) for i in range(90)] + [(7, 7)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    table = spark.createDataFrame([*edges, (None, 3)], "a long, b long").repartition(4)
    for limit in (500_000, 50):
        monkeypatch.setattr(common, "_EDGES_AT_ONCE", limit)
        assert sorted(map(tuple, common.components(table).collect())) == sorted((x, top(x)) for x in up)
    assert common.components(table.limit(0)).count() == 0


# WARC


def test_archives_round_trip(spark):
    same, other = "ä" * 600, "b" * 999
    pages = [(1, "http://a", same), (2, "u\r\nv", same), (3, None, same), (4, "u", other), (5, "u", other), (6, "u", None), (7, "u", ""),
             (None, "u", same), (8, "u", "long" * 500_000), (3, None, same)]
    table = spark.createDataFrame([(i, u, h, "x") for i, u, h in pages], "page_id long, url string, html string, digest string").repartition(3)
    listed = warc.write_archives(warc.with_revisits(table, "page_id", "url", "html"), limit=2000)
    rows = warc.read_archives(spark, listed).collect()
    assert len(rows) == len(pages) and all(r.error is None for r in rows)
    assert sum(r.records for r in listed.collect()) == len(pages)
    kinds = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in rows), key=str)
    assert kinds == sorted([(1, "revisit", 3, 1200), (2, "revisit", 3, 1200), (3, "response", None, 1200), (3, "response", None, 1200),
                            (4, "response", None, 999), (5, "response", None, 999), (6, "response", None, 0), (7, "response", None, 0),
                            (None, "revisit", 3, 1200), (8, "response", None, 2_000_000)], key=str)
    payloads = {r.page_id: r.payload for r in rows}
    assert bytes(payloads[3]).decode() == same and payloads[1] is None and len(payloads[8]) == 2_000_000
    empty = warc.write_archives(warc.with_revisits(table.limit(0), "page_id", "url", "html"))
    assert warc.read_archives(spark, empty).count() == 0


def test_broken_records_are_told(tmp_path):
    good = warc.page_record("urn:page:1", "u", b"hello", None, "2000-01-01T00:00:00Z")
    text = gzip.decompress(good)
    for data, message in (
        (gzip.compress(text.replace(b"hello", b"jello")), "digest differs"),
        (gzip.compress(text.replace(b"\r\n\r\n\r\n", b"")[:-20]), "shorter than"),
        (gzip.compress(text + b"more"), "does not end"),
        (gzip.compress(b"HTTP/1.1 200\r\n\r\n"), "not a WARC record"),
        (good[:-30], "ends inside"),
    ):
        found = list(warc.records(io.BytesIO(good + data)))
        assert found[0]["error"] is None and message in found[1]["error"], message


def test_records_after_a_long_head_or_a_broken_one():
    url = "http://a/" + "".join(random.Random(1).choices("abcdefghij", k=5_000_000))
    last = warc.page_record("urn:page:2", "u", b"last", None, "2000-01-01T00:00:00Z")
    found = list(warc.records(io.BytesIO(warc.page_record("urn:page:1", url, b"first", None, "2000-01-01T00:00:00Z") + last)))
    assert [f["error"] for f in found] == [None, None] and found[0]["fields"]["warc-target-uri"] == url
    for head in (b"HTTP/1.1 200\r\n\r\n", b"WARC/1.1\r\nContent-Length: many\r\n\r\n", b"no head"):
        found = list(warc.records(io.BytesIO(gzip.compress(head + b"x" * 5_000_000) + last)))
        assert found[0]["error"] and found[1]["error"] is None and found[1]["block"].endswith(b"last"), head


def foreign_record(kind, name, block, *fields):
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), ("WARC-Record-ID", name), *fields, ("Content-Length", len(block))])
    return gzip.compress(b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n")


def test_foreign_and_corrupt_archives_are_read_to_their_end(spark, tmp_path):
    http = lambda body, *more: "\r\n".join(["HTTP/1.1 200 OK", *more, "", body]).encode()
    own = lambda i: warc.page_record(f"urn:page:{i}", None, b"own", None, "2000-01-01T00:00:00Z")
    corrupt = bytearray(foreign_record("response", "<urn:uuid:7>", http("x" * 5000)))
    corrupt[60:80] = b"\xff" * 20
    late = bytearray(own(3))
    late[-8:] = b"\0" * 8  # the member's own checksum
    parts = [
        foreign_record("warcinfo", "<urn:uuid:1>", b"software: x"),
        foreign_record("request", "<urn:uuid:2>", b"GET / HTTP/1.1\r\n\r\n"),
        foreign_record("response", "<urn:uuid:3>", http("hello", "Content-Length: 5")),
        foreign_record("response", "<urn:uuid:4>", http("hello"), ("WARC-Payload-Digest", "sha1:not base32")),
        foreign_record("response", "<urn:uuid:5>", http("hello", "Content-Length: many")),
        foreign_record("response", "<urn:uuid:6>", http("5\r\nhello\r\n0\r\n\r\n", "Transfer-Encoding: chunked", "Content-Length: 5"),
                       ("WARC-Payload-Digest", "sha256:00"), ("WARC-Block-Digest", "md5:00")),
        bytes(corrupt), own(1), b"\x1f\x8b\x08 noise between members", own(2), bytes(late), own(4), own(5)[:-20],
    ]
    path = tmp_path / "foreign.warc.gz"
    path.write_bytes(b"".join(parts))
    rows = warc.read_archives(spark, spark.createDataFrame([(f"file://{path}",)], "path string")).collect()
    told = [(r.record_id, r.record_type, r.error) for r in rows]
    assert told[:3] == [("<urn:uuid:1>", "warcinfo", None), ("<urn:uuid:2>", "request", None), ("<urn:uuid:3>", "response", None)]
    assert [t[0] for t in told[3:6]] == ["<urn:uuid:4>", "<urn:uuid:5>", "<urn:uuid:6>"]
    assert ["digest cannot" in told[3][2], "no number" in told[4][2], told[5][2]] == [True, True, None]
    assert bytes(rows[0].payload) == b"software: x" and bytes(rows[2].payload) == b"hello" and rows[2].payload_bytes == 5
    own_rows = [(r.page_id, r.url) for r in rows if r.page_id is not None and r.error is None]
    assert own_rows == [(1, None), (2, None), (4, None)]
    assert sum(t[2] is not None for t in told) == 2 + 4


# Pieces


def test_pieces(docs, none):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = encode_documents(docs, path)
    assert rows.columns == ["doc_id", "ids", "decoded"] and rows.count() == 8
    assert all(len(r.ids) == 0 and r.decoded == "" for r in rows.where("doc_id in (2, 3)").collect())
    assert rows.where("doc_id = 6").first().decoded == "w " * 40_000
    assert encode_documents(none, path).count() == 0
    import sentencepiece

    library, model, rng = sentencepiece.SentencePieceProcessor(model_file=path), piece_model(path), random.Random(2)
    alphabet = "abcdefghij  \n.,:-_()0123ABÉßΩж中😀▁"
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert model.encode(text) == library.encode(text) and model.decode(model.encode(text)) == library.decode(library.encode(text))


# Neighbours and near vectors

VECTORS = "vec_id long, embedding array<float>, label int, id string, v int"


def vectors(spark, points, labels=None):
    rows = [(i, None if p is None else [None if x is None else float(x) for x in p], labels[i] if labels else 1, "x", 1)
            for i, p in enumerate(points)]
    return spark.createDataFrame(rows, VECTORS).repartition(3)


def test_neighbours_without_bad_vectors(spark):
    rng = np.random.default_rng(1)
    points = [*rng.normal(size=(60, 8)), None, [0] * 8, [float("nan")] * 8, [None] * 8, [1, 2, 3], [float("inf")] * 8]
    points[20] = points[40] = points[10]
    found = {}
    for r in nearest(vectors(spark, points), every=10, k=3).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    assert sorted(found) == [0, 10, 20, 30, 40, 50]
    assert sorted(found[10])[:2] == [(1, 20, 0.0), (2, 40, 0.0)] and sorted(found[20])[:2] == [(1, 10, 0.0), (2, 40, 0.0)]
    few = nearest(vectors(spark, points[:3]), every=10, k=5).collect()
    assert sorted(r["rank"] for r in few) == [1, 2]
    assert nearest(vectors(spark, points).limit(0), every=10).count() == 0


def test_near_vectors_against_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(cover_tree, "BLOCK", 40)
    base = rng.normal(size=(30, 6))
    points = [b + rng.normal(size=6) * s for b in base for s in (0, 0, 0.05, 0.2, 0.3)] + [base[0] + rng.normal(size=6) * 0.02 for _ in range(80)]
    labels = [int(rng.integers(0, 2)) if i % 11 else None for i in range(len(points))]
    points += [None, [0] * 6, [float("nan")] * 6, [1, 2]]
    labels += [0, 0, 0, 0]
    n, up = len(points), list(range(len(points)))
    given = np.array([p if p is not None and len(p) == 6 else [0] * 6 for p in points], np.float32).astype(float)
    size = np.sqrt((given**2).sum(1))
    links = np.zeros(n, int)
    for i, j in itertools.combinations(range(n - 4), 2):
        if labels[i] is not None and labels[i] == labels[j] and given[i] @ given[j] / (size[i] * size[j]) >= 0.93:
            links[[i, j]] += 1
            a, b = i, j
            while up[a] != a:
                a = up[a]
            while up[b] != b:
                b = up[b]
            up[max(a, b)] = min(a, b)

    def top(x):
        return x if up[x] == x else top(up[x])

    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_vectors(vectors(spark, points, labels)).collect()}
    assert got == {i: (links[i], top(i), top(i) == i) for i in range(n)}
    assert cover_tree.near_vectors(vectors(spark, points).limit(0)).count() == 0


# Licenses


def test_licenses(docs, none, spark):
    rows = [(1, "GNU General Public License; MIT-License, cc by"), (2, "mit license mit license"), (3, "gnu general license"),
            (4, "licensed under the apache license version two 0"), (5, None), (5, None), (6, "ſmit license"), (None, "CC BY")]
    got = by_id(license_scan.license_report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == sorted([
        (1, 8, 3, 0, 6, "cc-by,gpl,mit", "cc-by,gpl,mit", 1.0), (2, 4, 2, 0, 2, "mit", "mit", 1.0), (3, 3, 0, None, None, "", "", 0.0),
        (4, 8, 1, 3, 3, "apache", "apache", 1.0), (5, 0, 0, None, None, "", "", 0.0), (5, 0, 0, None, None, "", "", 0.0),
        (6, 2, 0, None, None, "", "", 0.0), (None, 2, 1, 0, 0, "cc-by", "cc-by", 1.0)], key=str)
    near = license_scan.license_report(spark.createDataFrame(
        [(1, "permission is hereby granted free of any charge to any person obtaining a copy of this software")], "doc_id long, text string"))
    assert near.first().labels == "mit" and 0.75 <= near.first().score < 1
    assert license_scan.license_report(docs).count() == 8 and license_scan.license_report(none).count() == 0


# Lines


def test_lines(spark, docs, none):
    pages = [(i, "a", f"menu \nbody {i}\n\nfoot") for i in range(12)] + [(20, "b", "menu\nx"), (21, None, "menu"), (22, "a", None), (23, "a", "menu")]
    table = spark.createDataFrame(pages, "doc_id long, host string, text string").withColumn("_keys", F.lit(1))
    got = {r.doc_id: (r.text, r._lines, r._dropped) for r in line_dedup.drop_boilerplate(table, "host", "text").collect()}
    assert got[3] == ("body 3\n", 4, 2) and got[20] == ("menu\nx", 2, 0) and got[21] == ("menu", 1, 0)
    assert got[22] == (None, 0, 0) and got[23] == ("", 1, 1)
    kept = {r.doc_id: r.text for r in line_dedup.drop_boilerplate(table, "host", "text", max_share=0.5).collect()}
    assert kept[23] == "menu"
    assert line_dedup.drop_boilerplate(docs, "lang", "text").count() == 8
    assert line_dedup.drop_boilerplate(none, "lang", "text").count() == 0


def test_lines_of_small_hosts(spark):
    pages = [(i, "abcd"[i // 2], f"own words {i}\nfoot") for i in range(8)] + [(10, "e", "own\nfoot")]
    pages += [(20 + i, "f", f"body {i}" + "\nfoot" * (i < 9)) for i in range(60)]
    table = spark.createDataFrame(pages, "doc_id long, host string, text string")
    got = {r.doc_id: (r.text, r._dropped) for r in line_dedup.drop_boilerplate(table, "host", "text").collect()}
    assert all(got[i] == (f"own words {i}", 1) for i in range(8)) and got[10] == ("own\nfoot", 0)
    assert all(got[20 + i] == (f"body {i}", int(i < 9)) for i in range(60))


def test_lines_of_pages_that_are_mostly_boilerplate(spark):
    foot = "a footer longer than what stands above it"
    pages = [(i, f"body {i}\n{foot}") for i in range(12)] + [(20 + i, "a copied text\nof two lines") for i in range(12)]
    pages += [(40, None), (41, None), (42, foot)]
    table = spark.createDataFrame([(i, "a", t) for i, t in pages], "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, table, "").collect()}
    assert all(got[i] == f"body {i}" for i in range(12)) and got[40] is None and got[42] == ""
    assert all(got[20 + i] == "a copied text\nof two lines" for i in range(12)) and len(got) == len(pages)


def test_a_line_near_a_tenth_goes_from_all_sources(spark):
    # Of 100 pages per source 7 to 13 have the line, 4 to 5 another.
    pages = [(100 * k + i, f"s{k}", f"body {k} {i}" + "\nmenu" * (i < 7 + k) + "\nyes." * (i >= 96 - k % 2)) for k in range(7) for i in range(100)]
    table = spark.createDataFrame(pages, "doc_id long, source string, text string")
    texts = [r.text for r in corpus_pipeline.drop_lines(spark, table, "").collect()]
    assert len(texts) == 700 and not any("menu" in t for t in texts)
    assert sum("yes." in t for t in texts) == sum(4 + k % 2 for k in range(7))


# Quality


def test_attention_learns_from_single_passages():
    rng = np.random.default_rng(5)
    counts = rng.integers(1, 6, 400)
    rows = rng.normal(size=(counts.sum(), quality.N_FEATURES)).astype(np.float32)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    labels = rng.integers(0, 2, 400).astype(float)
    rows[first + rng.integers(0, counts), 3] += np.where(labels == 1, 6, 0)  # one passage of the document tells
    model = quality.fit(rows[: first[300]], counts[:300], labels[:300])
    scores = model.forward(rows[first[300] :], counts[300:])["p"]
    assert ((scores >= 0.5) == labels[300:]).mean() > 0.9
    small = quality.fit(rows[: first[20]], counts[:20], labels[:20], epochs=0)
    step = 1e-5
    grads = quality._gradients(small, rows[: first[20]], counts[:20], labels[:20])

    def loss():
        p = small.forward(rows[: first[20]], counts[:20])["p"]
        return -np.mean(labels[:20] * np.log(p) + (1 - labels[:20]) * np.log(1 - p))

    for name in ("W", "V", "U", "a", "c"):
        flat = small.weights[name].reshape(-1)
        before = flat[1]
        flat[1] = before + step
        up = loss()
        flat[1] = before - step
        down = loss()
        flat[1] = before
        assert grads[name].reshape(-1)[1] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-8)


def test_quality_of_odd_rows(docs, none, spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (6, None), (5, 0)], "doc_id long, quality int")
    model = quality.learn_quality(docs, labels)
    rows = quality.score_quality(docs, model).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id == 2} == {r.score for r in rows if r.doc_id == 3}
    assert quality.with_quality(docs, model, 0.0).columns == docs.columns
    assert quality.with_quality(docs, model, 0.0).count() == 8 and quality.with_quality(docs, model, 1.1).count() == 0
    assert quality.score_quality(none, quality.learn_quality(none, labels)).count() == 0


# Near duplicates


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(2000)]
    rows, number = [], 0
    for _ in range(14):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 4, 30, 90, 200]))]
        for _ in range(rng.choice([1, 3, 40])):
            text = list(base)
            for _ in range(int(len(text) * rng.choice([0, 0.01, 0.03, 0.05]))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((number, " ".join(text)))
            number += 1
    rows += [(number, None), (number + 1, ""), (number + 2, " \n"), (number + 3, "A b C"), (number + 4, "a\tB  c")]
    for size, percent in ((3, 90), (5, 80)):
        sets = {}
        for i, text in rows:
            parts = (text or "").lower().split()
            sets[i] = {tuple(parts[j : j + size]) for j in range(max(1, len(parts) - size + 1))} if parts else set()
        up = {i: i for i in sets}

        def top(x, up=up):
            return x if up[x] == x else top(up[x])

        for a, b in itertools.combinations(sets, 2):
            if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table, size, percent).collect()}
        assert got == {i: (len(s), top(i)) for i, s in sets.items()}


def test_near_duplicates_of_odd_rows(docs, none):
    got = by_id(ngram_join.near_duplicates(docs, 3, 90))
    assert got == sorted([(1, 1, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (None, 1, None), (5, 1, 5), (5, 1, 5), (6, 1, 6)], key=str)
    assert ngram_join.near_duplicates(none).count() == 0


# Packing


def fewest(items, capacity):
    best = [len(items)]

    def place(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(items):
            best[0] = len(bins)
            return
        for room in set(bins):
            if room >= items[at]:
                rest = list(bins)
                rest.remove(room)
                place(at + 1, [*rest, room - items[at]])
        place(at + 1, [*bins, capacity - items[at]])

    place(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(8)
    for _ in range(150):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = {s: items.count(s) for s in items}
        plan = best_fit.bin_completion(counts, 20)
        assert all(sum(pattern) <= 20 for pattern, _ in plan)
        used = [s for pattern, times in plan for s in pattern * times]
        assert sorted(used, reverse=True) == items
        assert sum(times for _, times in plan) == fewest(items, 20) >= best_fit.lower_bound(counts, 20)


def test_pieces_and_sequences(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = common.saved(best_fit.cut_documents(docs, path, capacity=1000), "pieces")
    packed = common.saved(best_fit.pack(pieces, 1000), "packed")
    rows = packed.collect()
    assert sum(r.length for r in rows if r.doc_id == 3) == 1 and sum(r.doc_id == 5 for r in rows) == 2
    assert {r.ids[-1] for r in rows if r.doc_id in (2, 3)} == {0}
    long = sorted((r.piece, r.start, r.length) for r in rows if r.doc_id == 6)
    assert all(n == 1000 for p, _, n in long if p) and [s for _, s, _ in long] == list(itertools.accumulate([0, *[n for *_, n in long[:-1]]]))
    made = best_fit.sequences(packed).collect()
    assert sum(len(r.ids) for r in made) == sum(r.length for r in rows) and all(len(r.ids) <= 1000 for r in made)
    assert best_fit.pack(common.saved(best_fit.cut_documents(none, path), "pieces")).count() == 0


def test_byte_encoder_equals_the_library():
    encoder = best_fit.byte_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["", " ", "a  b\n\n c", "\ta b", "x <|endoftext|> y", "naïve don't १२ 中文", "tab\t\tend \n"]:
        assert encoder.encode(text).tolist() == encoder.library.encode(text, add_special_tokens=False).ids


# Toxicity


def test_folding_and_matching():
    assert toxicity.folded("İD1ОT p4thetic $cum mo­ron") == toxicity.folded("İD1ОT p4thetic $cum mo­ron").lower()
    lexicon = toxicity.Lexicon({"idiot": 2.0, "clown": 1.0, "vequ*": 3.0}, ("clown fish",))
    find = lambda text: [t for t, _ in toxicity.matches(lexicon.automaton(), toxicity.folded(text))]
    assert find("You 1d10t, IDIОT! idiots vidiot") == ["idiot", "idiot"]
    assert find("a clown fish and a clown") == ["clown"]
    assert find("vequance vequ revequ") == ["vequ*", "vequ*"]
    assert find("") == [] and find(None) == []
    assert toxicity.matches(toxicity.Lexicon({}, ()).automaton(), "x") == []


def test_toxicity_of_odd_rows(docs, none, spark):
    labels = spark.createDataFrame([(1, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs, labels)
    assert lexicon.weights == {}
    rows = toxicity.score_toxicity(docs, lexicon).collect()
    assert len(rows) == 8 and {r.score < 0.3 for r in rows} == {True}
    lexicon = toxicity.Lexicon({"same": 9.0})
    assert {r.doc_id for r in toxicity.score_toxicity(docs, lexicon).where("score >= 0.3").collect()} == {5}
    assert by_id(toxicity.without_toxic(docs, lexicon).select("doc_id")) == sorted([(1,), (2,), (3,), (4,), (6,), (None,)], key=str)
    assert toxicity.without_toxic(docs, lexicon).columns == docs.columns
    assert toxicity.score_toxicity(none, lexicon).count() == 0 and toxicity.without_toxic(none, lexicon).count() == 0


# Substring dedup


def without_repeats_plain(rows, window):
    seen, words = Counter(), [(t or "").encode().split() for _, t in rows]
    for w in words:
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = {k for at in range(len(w) - window + 1) if seen[tuple(w[at : at + window])] > 1 for k in range(at, at + window)}
        left = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(left)).hexdigest(), b" ".join(left).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, seed", [(35, 1), (8, 2), (3, 3), (1, 4)])
def test_repeats_against_a_plain_search(spark, window, seed):
    """Copied, overlapping, periodic and near-equal passages over a small vocabulary, which chance repeats as well."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "c", "Ä", "w w"][:4] + [f"x{rng.randrange(400)}"] * 3)
    shared = [[word() for _ in range(window + rng.randrange(20))] for _ in range(4)] + [["r"] * (2 * window), ["p", "q"] * window]
    rows = []
    for i in range(60):
        text = [word() for _ in range(rng.randrange(30))]
        for _ in range(rng.randrange(4)):
            part = list(rng.choice(shared))
            if rng.random() < 0.4:
                part[rng.randrange(len(part))] = "edited"
            if rng.random() < 0.3:
                part = part[rng.randrange(len(part)) :]
            text += part + [word() for _ in range(rng.randrange(3))]
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(text)))
    rows += [(3, rows[3][1]), (None, "only " * 5), (None, None), (90, ""), (91, " \n"), (92, "r " * 30_000), (93, "n\u00a0o\u2003blank " * 3)]
    table = spark.createDataFrame([(t, i, "x", 1) for i, t in rows], "text string, doc_id long, kept string, start int").repartition(5)
    got = sorted((tuple(r) for r in recompression.without_repeats(table, window).collect()), key=str)
    assert got == without_repeats_plain(rows, window)


def test_repeats_of_odd_rows(docs, none):
    assert recompression.without_repeats(none).count() == 0
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept) for r in recompression.without_repeats(docs).collect()}
    assert got == {(1, 3, 0, "one two three"), (2, 0, 0, ""), (3, 0, 0, ""), (4, 0, 0, ""), (None, 3, 0, "no id here"), (5, 1, 0, "same"),
                   (6, 40_000, 40_000, "")}


def test_equal_stretches_have_equal_inner_symbols():
    rng = np.random.default_rng(2)
    common_part = rng.integers(1, 30, 200, np.uint64)
    def found(left, right):
        row = np.concatenate((rng.integers(1, 30, left, np.uint64), common_part, rng.integers(1, 30, right, np.uint64)))
        border = np.zeros(len(row) + 2, bool)
        border[[0, -1]] = True
        last = recompression.levels(np.concatenate(([0], row, [0])).astype(np.uint64), border, 4)[-1]
        inside = (last.low >= left + 1) & (last.high <= left + 201)
        return list(zip(last.name[inside].tolist(), (last.low[inside] - left).tolist(), strict=True))
    one = found(17, 40)
    assert len(one) > 20 and one == found(90, 3) == found(1, 1)


# Conversations


def solved(rows):
    """Least cost, ASCII-least edits and lines of rows of (role, text), by trying everything."""
    faults, seen = [], set()
    for role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @functools.cache
    def best(place, state, inserted):
        ways = [(0, "", ())] if place == len(rows) and state in ("", "a") else []
        if place < len(rows):
            role, text = rows[place]
            cost, edits, lines = best(place + 1, state, 0)
            ways.append((cost + 2, "D" + edits, lines))
            if faults[place] not in ("blank", "duplicate"):
                extra = 5 * (faults[place] == "truncated")
                for edit, name, price in [("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)]:
                    if name[:1] in after[state]:
                        cost, edits, lines = best(place + 1, after[state][name[:1]], 0)
                        ways.append((cost + extra + price, edit + edits, (f"{name}:{text}", *lines)))
        if inserted < 3:
            for name in ("user", "assistant"):
                if name[0] in after[state]:
                    cost, edits, lines = best(place, after[state][name[0]], inserted + 1)
                    ways.append((cost + 5, "I" + edits, (f"{name}:", *lines)))
        return min(ways) if ways else (10**6, "~", ())

    return faults, best(0, "", 0)


@pytest.mark.parametrize("least_block", [64, 2])
def test_repairs_against_all_ways(spark, monkeypatch, least_block):
    """Also with blocks of few rows, so that walks go on from one block to the next."""
    monkeypatch.setattr(conversation_repair, "LEAST_BLOCK", least_block)
    rng = random.Random(8)
    conversations = {}
    for i in range(60):
        turns = sorted(rng.sample(range(40), rng.randrange(0, 14)))
        conversations[i] = [(t, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b!", "c?", "cut", " ", "", "d. ", f"n{t}."])) for t in turns]
        conversations[i] += [r for r in conversations[i] if rng.random() < 0.1]
    conversations[99] = [(None, "user", "no turn."), (None, "user", "no turn."), (5, "assistant", "x.")]
    conversations[None] = [(1, None, None), (2, "user", "y.")]
    rows = [(c, t, r, x, "clash", 7) for c, part in conversations.items() for t, r, x in part]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cid string, part int").repartition(6)
    ids = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    got = {r.conv_id: tuple(r)[1:] for r in conversation_repair.repair_conversations(table, ids).collect()}
    assert set(got) == set(conversations)
    for c, part in conversations.items():
        part = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in part), key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, _, _ in part if t is not None]
        faults, (cost, edits, lines) = solved([(r, x) for _, r, x in part])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(part))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert got[c] == (gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, edits, sha), c


def test_a_long_conversation_spreads_over_blocks(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(3000) if i % 97]
    rows += [(1, 0, "system", "one.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    found = conversation_repair.blocks(table, 64).collect()
    assert len(found) >= 3000 // 64 and max(len(r.codes) for r in found) == 64
    r = {r.conv_id: r for r in conversation_repair.repair_conversations(table).collect()}
    assert (r[1].audit, r[1].cost) == ("D", 2)
    faults, (cost, edits, lines) = None, (0, "", ())
    assert len(r[7].audit.replace("I", "")) == len(rows) - 1 and r[7].gaps == 30
    # Every missing row costs one insert, or one deleted neighbour.
    assert r[7].cost <= 31 * 5 and set(r[7].audit) <= set("DIKR")


def test_damage(spark):
    rows = [(i, t, r, x) for i in range(40) for t, r, x in [(0, "system", "One. Two!"), (None, None, None), (2, "assistant", "Three?")]]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = Counter(tuple(r) for r in conversation_repair.damaged(table).collect())
    want = Counter()
    for i, t, r, x in rows:
        kind = zlib.crc32(f"{i}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else x.translate(str.maketrans("", "", ".!?")) if kind == 2 else x
        want[i, t, "user" if kind == 4 else r, x] += {0: 0, 3: 2}.get(kind, 1)
    assert got == +want


# Alignment


def aligned_plain(docs_, paths):
    """Every text's numbers from the two libraries' ids of the whole text, by going through all pairs of tokens."""
    library, pieces = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    library.encode_special_tokens = True
    byte_of = token_alignment.byte_table()
    links, out = Counter(), []
    for i, text in docs_:
        a, b = (library.encode(f" {text}", add_special_tokens=False).ids, pieces.encode(text)) if text else ([], [])
        a_bytes = [bytes(byte_of[c] for c in library.id_to_token(x)) for x in a]
        b_bytes = [bytes([int(pieces.id_to_piece(x)[3:5], 16)]) if pieces.is_byte(x) else pieces.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if text and not b"".join(a_bytes) == b"".join(b_bytes) == f" {text}".encode():
            a, b = [], []
        spans = []
        for ids, entries in ((a, a_bytes), (b, b_bytes)):
            ends = list(itertools.accumulate(map(len, entries)))[: len(ids)]
            spans.append(list(zip([0, *ends[:-1]], ends, ids, strict=True)) if ids else [])
        pairs = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups = [
            "|".join(",".join(str(x[2]) for x in side if lo < x[1] <= hi) for side in spans) for lo, hi in itertools.pairwise([0, *cuts])
        ]
        links.update(pairs)
        out.append((i, len(a), len(b), len(groups), pairs, ";".join(groups)))
    top = {}
    for (_, y), n in links.items():
        top[y] = max(top.get(y, 0), n)
    return sorted([(i, x, y, g, len(p), sum(links[q] == top[q[1]] for q in p), sum(links[q] for q in p),
                    hashlib.sha256(t.encode()).hexdigest() if t else "", t) for i, x, y, g, p, t in out], key=str)


def test_alignment_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 200)
    rng = random.Random(6)
    texts = ["the cat sat on the mat", "", None, " ", "  two  blanks", "tab\tline\n\nend ", "<s> and <|endoftext|> </s> <unk> <0x41>", "▁lower ▁", "é ü ñ 漢字 😀 \u00a0x",
             "naïve café" * 3, "a" * 300, "the cat sat on the mat", "it's 'tis don't \'s", "x\u2028y \u2003 z", "a \x1c b \x85 c", "1 2  3 4", "привет мир", "a\u00adb c\u200bd e"]
    texts += [" ".join(rng.choice(["the", "tion", "Über", "x1", "…", "internationalisation"]) for _ in range(20)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "no id")]
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, pair long, block int").repartition(4)
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    got = sorted((tuple(r) for r in token_alignment.align_documents(table, *paths).collect()), key=str)
    want = aligned_plain(rows, paths)
    assert got == want and sum(r[1] > 0 for r in got) > 25 and any(r[1] == 0 and r[0] == 7 for r in got)


def test_alignment_of_odd_rows(docs, none):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    assert token_alignment.align_documents(none, *paths).count() == 0
    rows = token_alignment.align_documents(docs, *paths).collect()
    assert len(rows) == docs.count()
    assert {tuple(r)[1:] for r in rows if r.doc_id in (2, 3)} == {(0, 0, 0, 0, 0, 0, "", "")}
    assert all(r.n_a and r.n_links >= max(r.n_a, r.n_b) and r.groups.count(";") == r.n_groups - 1 for r in rows if r.doc_id in (1, 5, 6))


def test_intervals_coalesce():
    starts = lambda ends: np.array([0, *ends[:-1]])
    a, b = np.array([2, 5, 7, 9]), np.array([3, 7, 8, 9])
    found = token_alignment.align(starts(a), a, starts(b), b)
    assert found.a_group.tolist() == [0, 0, 0, 1] and found.b_group.tolist() == [0, 0, 1, 1] and found.groups == 2
    assert sorted(zip(found.a.tolist(), found.b.tolist(), strict=True)) == [(0, 0), (1, 0), (1, 1), (2, 1), (3, 2), (3, 3)]


def test_near_vectors_that_repeat_an_id(spark):
    rows = [(1, [1.0, 0.0], "a"), (1, [0.0, 1.0], "a"), (0, [1.0, 0.01], "a"), (2, [0.01, 1.0], "a"), (3, [0.0, -1.0], "a"), (3, [0.0, -1.0], "a"),
            (None, [1.0, 0.0], "a"), (4, [-0.0, 1.0], "b"), (5, [0.0, 2.0], "b")]
    table = spark.createDataFrame([(*r, 9, 1) for r in rows], "vec_id long, embedding array<double>, label string, id long, copies int")
    got = sorted((tuple(r) for r in cover_tree.near_vectors(table).collect()), key=str)
    assert got == sorted([(1, 1, 0, False), (1, 1, 0, False), (0, 1, 0, True), (2, 1, 0, False), (3, 1, 3, True), (3, 1, 3, True),
                          (None, 0, None, False), (4, 1, 4, True), (5, 1, 4, False)], key=str)


def test_hot_tokens_are_settled_in_bounded_memory(spark, monkeypatch):
    """Buckets that fill up several times give the same classes."""
    rng = random.Random(12)
    rows = [(i, " ".join(["hot words here"] + [rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9))])) for i in range(300)]
    rows += [(i + 1000, t) for i, t in rows[:40]]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = by_id(ngram_join.near_duplicates(table, 3, 80))
    for name, value in (("_HELD", 40), ("BUCKET_TOKENS", 300), ("_TOKENS_AT_ONCE", 200)):
        monkeypatch.setattr(ngram_join, name, value)
    assert by_id(ngram_join.near_duplicates(table, 3, 80)) == want


def test_sets_still_apart_are_not_all_compared(spark, monkeypatch):
    """What all sets of a signature are first compared with is similar to none, so all of them are still apart."""
    frequent = ngram_join.FREQUENT << 56
    shared, first, second, rest = (list(range(frequent + lo, frequent + hi)) for lo, hi in ((0, 40), (100, 160), (200, 260), (300, 360)))
    group = lambda base, i: sorted(shared + base[: i % 60] + base[i % 60 + 1 :])
    sets = [(0, 100, sorted(shared + rest))] + [(i, 101, group(first if i % 3 else second, i)) for i in range(1, 401)]
    frame = spark.createDataFrame(sets, "key long, n int, tokens array<long>").repartition(4)
    compared, verified = [], ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, *more: compared.append(pairs.count()) or verified(pairs, *more))
    links = ngram_join._links(frame, 80)
    assert dict(tuple(r) for r in common.components(links).collect()) == {i: 1 if i % 3 else 3 for i in range(1, 401)}
    assert sum(compared) < 10 * len(sets), compared


def test_rows_of_sets_still_apart_are_taken_a_few_times(spark, monkeypatch):
    """Sets that lack five tokens in a row are similar if their gaps lie one apart at most, so most stay apart for long."""
    frequent = ngram_join.FREQUENT << 56
    rng = random.Random(8)
    gaps = [*range(52), *(rng.randrange(52) for _ in range(350))]
    sets = [(i, 56, [frequent + j for j in range(56) if not gap <= j < gap + 5]) for i, gap in enumerate(gaps, 1)]
    sets += [(i + 1000, 56, [frequent + j for j in range(56) if j % 11 != i % 11]) for i in range(40)]
    frame = spark.createDataFrame(sets, "key long, n int, tokens array<long>").repartition(4)
    taken, saved = [], ngram_join.saved

    def counted(df, name):
        out = saved(df, name)
        taken.append((name, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "saved", counted)
    got = dict(tuple(r) for r in common.components(ngram_join._links(frame, 80)).collect())
    assert got == {i: 1 if i <= len(gaps) else (i - 1000) % 11 + 1000 for i, *_ in sets if i <= len(gaps) or i < 1040}
    posted = dict(taken)["postings"]
    assert sum(n for name, n in taken if name in ("placed", "open")) <= 5 * posted, taken


def test_turns_of_signatures_give_the_same_classes(spark, monkeypatch):
    rng = random.Random(21)
    base = [[f"w{rng.randrange(900)}" for _ in range(60)] for _ in range(3)]
    texts = []
    for i in range(240):
        text = list(base[i % 3])
        for _ in range(1 + i % 2):
            text[rng.randrange(60)] = f"x{i}"
        texts.append((i, " ".join(text)))
    table = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(ngram_join, "PAIRS_PER_ROW", 1 << 40)
    want = by_id(ngram_join.near_duplicates(table, 5, 80))
    monkeypatch.setattr(ngram_join, "PAIRS_PER_ROW", 0)
    assert by_id(ngram_join.near_duplicates(table, 5, 80)) == want and 3 < len({r[2] for r in want}) < 240


def test_the_exchange_of_tokens_does_not_grow_with_the_buckets(spark, monkeypatch):
    """What a task tells of its texts is as long for many buckets as for few, but for a row's own bytes."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(5000)) for _ in range(400))) for i in range(60)]
    table = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    told = []
    monkeypatch.setattr(type(table), "repartition", lambda self, *_: told.append(self) or self.coalesce(1))
    for tokens in (3000, 100):
        monkeypatch.setattr(ngram_join, "BUCKET_TOKENS", tokens)
        ngram_join.shared_tokens(table, 3, 60 * 398).count()
    few, many = (sum(len(bytes(x)) if isinstance(x, (bytes, bytearray)) else 8 * len(x) if isinstance(x, list) else 0
                     for r in told[at].collect() for x in r) for at in (0, 2))
    assert few > 60 * 398 * 8 - 1000 and many < 1.1 * few


def test_keys_that_agree_in_the_bits_told():
    keys = np.array([5, 7, (1 << 32) + 5, (2 << 32) + 5, (1 << 40) + 7, 9], np.uint64)
    layer = ngram_join._layers(keys)
    assert layer.tolist() == [0, 0, 1, 2, 1, 0] and ngram_join._layers(keys[:2]).tolist() == [0, 0]
    values = np.array([0, 0, 3, 70000, 0xFFFFFFFF])
    assert ngram_join._heard(ngram_join._told(values)).tolist() == values.tolist() and len(ngram_join._told(values)) == 20


def test_the_lexicon_knows_what_it_was_shown(spark):
    """A hundred documents, ten toxic in two languages: most toxic words are learned, and their other forms by a common start."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("aeiounrst", k=rng.randrange(3, 8)))
    vocabulary = [word() for _ in range(300)]
    bad = {0: ["blorg", "vexil", "dratz"], 1: ["quompa", "quombo", "quomti", "quomle"]}
    rows = []
    for i in range(240):
        text = [rng.choice(vocabulary) for _ in range(60)]
        if i % 10 == 0:
            for at in range(6):
                text[at * 7] = rng.choice(bad[i // 10 % 2])
        rows.append((i, " ".join(text), int(i % 10 == 0)))
    docs_ = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(0, 1)], "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs_, labels)
    known = lambda w: any(w.startswith(t.rstrip("*")) for t in lexicon.weights)
    assert known("quompa") and sum(map(known, bad[0])) >= 2, lexicon.weights
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(docs_, lexicon).collect()}
    assert all((scores[i] >= 0.3) == bool(y) for i, _, y in rows)
    other = spark.createDataFrame([(1, "a Bl0rg and quomzz here"), (2, "nothing of the kind")], "doc_id long, text string")
    told = {r.doc_id: r.hits for r in toxicity.score_toxicity(other, lexicon).collect()}
    assert told == {1: 2, 2: 0}
    # The same again without toxic examples, and with repeated rows of documents.
    assert toxicity.learn_lexicon(docs_, labels.where("toxic = 0")).weights == {}
    assert toxicity.learn_lexicon(docs_.unionAll(docs_), labels).weights == lexicon.weights


def test_byte_ids_come_as_one_array_and_as_the_library_gives_them(monkeypatch):
    """Ordinary texts go to the merger that answers with an array, never by way of a list; others to the library."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library = best_fit.ByteEncoder(path), Tokenizer.from_file(path)

    def listed(self, text):
        raise AssertionError("ids by way of a list")

    monkeypatch.setattr(type(encoder.fast), "encode_ordinary", listed)
    for text in ["", "a", "one  two\n\n three's ", "x" * 3000, "naïve 12345", "שלום 中文", "end <|endoftext|> of"]:
        got = encoder.encode(text)
        assert got.dtype == np.uint32 and got.tolist() == library.encode(text, add_special_tokens=False).ids, text
