"""Toxicity by a weighted lexicon: folded text, Aho-Corasick matches, exception phrases, length normalisation."""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.llm.common import batches, passing, saved

# Letters that look like Latin ones (Cyrillic, Greek), and the digits and signs that stand for letters.
LOOKALIKES = dict(
    pair for pair in (
        "аa вb еe іi кk мm нh оo рp сc тt уy хx ѕs јj ԁd һh ɡg ӏl αa βb εe ιi κk νv οo ρp τt υu χx".split()
    )
)
DIGITS = dict(zip("013457", "oieast", strict=True))
SIGNS = {"@": "a", "$": "s"}
_TABLE = str.maketrans(LOOKALIKES | DIGITS | dict.fromkeys("­​‌‍⁠﻿", ""))
_SIGN = re.compile(r"(?<=[^\W_])[@$](?=[^\W_])")
_WORD = re.compile(r"[^\W_]+")

# Harmless uses of words that are otherwise insults.
EXCEPTIONS = ("clown fish", "circus clown", "trash can", "trash bag", "sore loser board game", "pond scum")


def folded(text: str | None) -> str:
    """Lower case, compatibility forms composed, look-alikes and digits as letters, invisible characters gone."""
    text = (text or "").lower()
    if not text.isascii() and not unicodedata.is_normalized("NFKC", text):
        text = unicodedata.normalize("NFKC", text).lower()
    text = text.translate(_TABLE)
    if "$" in text or "@" in text:
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return text


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights. A term that ends in `*` matches the start of a word, any other one whole words."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    # Logistic curve over log(1 + total weight) and log(1 + total weight per 1000 words).
    curve: tuple[float, float, float] = (-4.0, 1.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            stem = term.rstrip("*")
            entry = found.get(stem, {})
            found.add_word(stem, entry | {term.endswith("*"): (term, weight)})
        for phrase in self.exceptions:
            found.add_word(phrase, found.get(phrase, {}) | {"exception": phrase})
        if len(found):
            found.make_automaton()
        return found


def matches(automaton: ahocorasick.Automaton, text: str) -> list[tuple[str, float]]:
    """Terms in a folded text that stand at word edges and in no exception phrase, one per word start.

    Where a whole word and the starts of it match at one place, the heaviest term counts.
    """
    if not len(automaton):
        return []
    best: dict[int, tuple[str, float]] = {}
    spared: list[tuple[int, int]] = []
    for end, entry in automaton.iter(text):
        after = end + 1 < len(text) and text[end + 1].isalnum()
        for kind, value in entry.items():
            size = len(value) if kind == "exception" else len(value[0].rstrip("*"))
            start = end + 1 - size
            if start and text[start - 1].isalnum():
                continue
            if kind == "exception":
                if not after:
                    spared.append((start, end))
            elif (kind or not after) and (start not in best or best[start][1] < value[1]):
                best[start] = value
    return [v for at, v in sorted(best.items()) if not any(a <= at <= b for a, b in spared)]


def _terms(words: set[str], stems: tuple[int, ...]) -> set[str]:
    return words | {f"{w[:n]}*" for w in words for n in stems if len(w) > n}


def _times(words: Counter[str], stems: tuple[int, ...]) -> Counter[str]:
    """How often each term stands in a text, from its words' counts."""
    found = Counter(words)
    for word, times in words.items():
        for n in stems:
            if len(word) > n:
                found[f"{word[:n]}*"] += times
    return found


def _curve_points(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(total)), np.log1p(total), np.log1p(1000 * total / np.maximum(words, 1))])


def learn_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = 20_000,
    support: float = 0.01,
    contrast: float = 4.0,
    cover: int = 6,
    stems: tuple[int, ...] = (3, 4, 5, 6),
    exceptions: tuple[str, ...] = EXCEPTIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Lexicon:
    """Learn terms, weights and the curve from at most `sample` labelled documents, chosen by a hash of the id.

    Candidates are words and word starts in at least `support` of the toxic sample documents (two, if that is more) and in
    `contrast` times as large a share of them as of the clean ones. Fewer than 1 / `support` times a toxic document's terms can
    be in so many of them, so the candidates' number has a bound that does not grow with the sample, and the driver gets, of
    each sample document, at most these. Terms are then picked one by one, the one that says most about toxic documents with
    fewer than `cover` terms so far first, until none adds more than chance would: so words that merely accompany toxic ones stay out,
    and each toxic document is known by several words. A term's weight is its smoothed log-odds. Rows that repeat an id are one document.
    Null labels, ids and texts are left out of the sample; without toxic examples the lexicon is empty and every score is low.
    """
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id is not null and label is not null")
        .groupBy("id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(sample)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    # At most `sample` rows of two numbers are told to all tasks. Documents are written once: at most `sample` of them.
    rows = saved(rows.join(F.broadcast(chosen), "id").dropDuplicates(["id"]), "examples")
    number = {r["label"]: r["count"] for r in rows.groupBy(F.least("label", F.lit(1)).alias("label")).count().collect()}
    n_toxic, n_clean = number.get(1, 0), number.get(0, 0)
    least = max(2, math.ceil(support * n_toxic))

    def terms_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            toxic, clean, times = Counter(), Counter(), Counter()
            for text, label in zip(frame["text"], frame["label"], strict=True):
                words = Counter(_WORD.findall(folded(text)))
                (toxic if label else clean).update(_terms(set(words), stems))
                if label:
                    times.update(_times(words, stems))
            every = list(toxic | clean)
            yield pd.DataFrame({"term": every, "toxic": [toxic[t] for t in every], "clean": [clean[t] for t in every], "times": [times[t] for t in every]})

    counts = rows.mapInPandas(terms_of, "term string, toxic long, clean long, times long").groupBy("term").agg(
        *[F.sum(c).alias(c) for c in ("toxic", "clean", "times")])
    share, other = F.col("toxic") / (n_toxic + 1), (F.col("clean") + 0.5) / (n_clean + 1)
    expected = F.col("clean") * (n_toxic / max(n_clean, 1))
    known = counts.where((F.col("toxic") >= least) & (share >= contrast * other) & (F.col("toxic") >= contrast * expected))
    candidates = {r["term"]: r for r in known.collect()}
    wanted = set(candidates)

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"terms": [sorted(_terms(set(_WORD.findall(folded(t))), stems) & wanted) for t in frame["text"]]})

    holders: dict[str, list[int]] = {}
    for place, row in enumerate(rows.where("label > 0").select("text").mapInPandas(held, "terms array<string>").collect()):
        for term in row["terms"]:
            holders.setdefault(term, []).append(place)
    expected_hits = {t: candidates[t]["clean"] * n_toxic / max(n_clean, 1) for t in holders}
    covered, weights = Counter(), {}

    def gain(term: str) -> float:
        return sum(covered[d] < cover for d in holders[term]) - 3 * expected_hits[term]

    # A gain only falls as others are picked, so a term whose gain is up to date and still ahead of all others comes next.
    queue = [(-gain(t), -candidates[t]["times"], t) for t in holders]
    heapq.heapify(queue)
    while queue:
        _, times, term = heapq.heappop(queue)
        now = gain(term)
        if now < least:
            continue
        if queue and -now > queue[0][0]:
            heapq.heappush(queue, (-now, times, term))
            continue
        hit, miss = candidates[term]["toxic"], candidates[term]["clean"]
        weights[term] = round(math.log((hit + 0.5) / (n_toxic + 1)) - math.log((miss + 0.5) / (n_clean + 1)), 4)
        covered.update(holders[term])
    lexicon = Lexicon(weights, exceptions)
    return Lexicon(weights, exceptions, _fit_curve(rows, lexicon))


def _fit_curve(rows: DataFrame, lexicon: Lexicon, steps: int = 40) -> tuple[float, float, float]:
    """Logistic regression by Newton steps on the sample's totals, with a small ridge."""
    points = measured(rows, lexicon, keep=["label"]).select("total", "words", "label").toPandas()
    y = points["label"].to_numpy(float)
    if not len(y) or y.min() == y.max() or not lexicon.weights:
        return Lexicon.curve
    x, b = _curve_points(points["total"].to_numpy(float), points["words"].to_numpy(float)), np.zeros(3)
    ridge = np.diag([1e-3, 0.1, 0.1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + ridge
        b = b + np.linalg.solve(hessian, x.T @ (y - p) - ridge @ b)
    return tuple(float(v) for v in b)


def measured(df: DataFrame, lexicon: Lexicon, keep: list[str], text_col: str = "text") -> DataFrame:
    """The `keep` columns plus words, hits, total (weight of all hits) and terms (distinct, sorted) per text."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = lexicon.automaton()
        for frame in batches(frames):
            texts = [folded(t) for t in frame["_text"]]
            found = [matches(automaton, t) for t in texts]
            yield frame[keep].assign(
                words=[len(t.split()) for t in texts],
                hits=[len(f) for f in found],
                total=[math.fsum(w for _, w in f) for f in found],
                terms=[sorted({t for t, _ in f}) for f in found],
            )

    rows = df.select(*keep, F.col(text_col).alias("_text"))
    return rows.mapInPandas(run, f"{schema}, words long, hits long, total double, terms array<string>")


def score_of(lexicon: Lexicon, total: Column, words: Column) -> Column:
    """0 to 1. The total weight counts both as such and per 1000 words, each on a logarithmic scale."""
    a, b, c = lexicon.curve
    dense = total * 1000 / F.greatest(words, F.lit(1))
    return 1 / (1 + F.exp(-(F.lit(a) + b * F.log1p(total) + c * F.log1p(dense))))


def score_toxicity(df: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: doc_id, score, words, hits and terms.

    Null and empty texts have no hits and get the score of a text without any. Null ids and repeated rows are kept as
    they are; other columns of `df` are not read, so their names cannot clash. An empty table gives no rows. A text
    is one value: its folded copy has to fit in a task's memory.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = measured(rows, lexicon, ["doc_id"])
    return found.select("doc_id", score_of(lexicon, F.col("total"), F.col("words")).alias("score"), "words", "hits", "terms")


def without_toxic(df: DataFrame, lexicon: Lexicon, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `df`, all columns untouched, whose text scores below `threshold`. Null texts count as empty."""
    a, b, c = lexicon.curve

    def clean(texts: list[str | None]) -> list[bool]:
        automaton = lexicon.automaton()
        marks = []
        for text in map(folded, texts):
            total = math.fsum(w for _, w in matches(automaton, text))
            dense = 1000 * total / max(len(text.split()), 1)
            marks.append(1 / (1 + math.exp(-(a + b * math.log1p(total) + c * math.log1p(dense)))) < threshold)
        return marks

    return passing(df, text_col, clean)
