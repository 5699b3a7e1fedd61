"""Alignment of two tokenizers' tokens over one text, by coalescing their byte intervals.

Both tokenizers cut the same bytes. All intervals of both are sorted by start, and their ends' running maximum is taken: a group
begins where a start reaches that maximum. Within groups overlapping intervals are the links between the two vocabularies.
How often two ids are linked is counted over the whole corpus.

Neither tokenizer joins a word with a blank behind it, so both cut in front of a blank between two words. A block of texts is
therefore encoded and aligned as its distinct words, and a text's groups and links are those of its words, one after the other.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permitwright.llm.common import ROWS_AT_ONCE, saved

# Bytes of text whose linked ids are listed together: the longer, the fewer times a frequent pair of ids is told.
BLOCK_BYTES = 8 << 20
# Bytes of words that are encoded and aligned at once.
_AT_ONCE = 1 << 15
_B = np.int64(1) << np.int64(32)
# How a byte-level BPE tokenizer of this kind cuts a text before merging (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters on which every Unicode version agrees; words with others are encoded by the tokenizer's own library.
_PLAIN = re.compile(r"[\t\n !-~¡-ɏ‐-‧]*")
# A blank between two words: both its neighbours are of kinds that no Unicode version takes for blanks.
_CUT = re.compile(r"(?<=[!-~¡-ɏ‐-‧\w]) (?=[!-~¡-ɏ‐-‧\w])")


def byte_table() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: shown bytes as they are, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """A byte-level tokenizer file (A) and a sentence piece model (B), with the bytes of every entry."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = SentencePieceProcessor(model_file=b_path)
        byte_of = byte_table()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        # The file's vocabulary is in merge order, so it also serves as ranks for a faster merger.
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        ranks = {self.a_bytes[i]: i for entry, i in self.a.get_vocab(with_added_tokens=False).items() if entry not in special}
        self.fast = Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        pieces = (self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.cuts_at_blanks = not any("▁" in piece for piece in pieces)
        self.a_size = np.array([len(e) for e in self.a_bytes])
        self.b_size = np.array([len(e) for e in self.b_bytes])
        # What each id looks like in a list of groups: followed by another of its side, or the last of it.
        self.shown = [f"{i}{end}" for size, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for end in ends for i in range(size)]

    def words(self, text: str) -> list[str]:
        """A text's parts, each standing for a blank and itself; both tokenizers cut between them."""
        return _CUT.split(text) if self.cuts_at_blanks else [text]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and number of them per word, the same of B, and whether both have the bytes of a blank and the word.

        The words are encoded in one go, as a text of their own, and told apart by their bytes. If some have other bytes on a
        side, they are encoded one by one; such words have no ids.
        """
        text = " " + " ".join(words)
        data = text.encode()
        size = np.fromiter((len(w) + 1 if w.isascii() else len(w.encode()) + 1 for w in words), np.int64, len(words))
        if self.cuts_at_blanks and len(_CUT.findall(text)) == len(words) - 1:
            a = self.fast.encode_ordinary(text) if _PLAIN.fullmatch(text) else self.a.encode(text, add_special_tokens=False).ids
            b = self.b.encode(text[1:])
            if b"".join(map(self.a_bytes.__getitem__, a)) == data == b"".join(map(self.b_bytes.__getitem__, b)):
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                ends = np.cumsum(size)
                counts = []
                for side, sizes in ((a, self.a_size), (b, self.b_size)):
                    upto = np.searchsorted(np.cumsum(sizes[side]), ends, side="right")
                    counts.append(np.diff(upto, prepend=0))
                return a, counts[0], b, counts[1], np.ones(len(words), bool)
        a_ids = [self.fast.encode_ordinary(w) if _PLAIN.fullmatch(w) else self.a.encode(w, add_special_tokens=False).ids for w in map(" ".__add__, words)]
        b_ids = self.b.encode(words, num_threads=1)
        fine = np.ones(len(words), bool)
        for place, word in enumerate(words):
            data = b" " + word.encode()
            if b"".join(map(self.a_bytes.__getitem__, a_ids[place])) != data or b"".join(map(self.b_bytes.__getitem__, b_ids[place])) != data:
                a_ids[place], b_ids[place], fine[place] = [], [], False
        flat = [np.array(list(chain.from_iterable(ids)), np.int64) for ids in (a_ids, b_ids)]
        return flat[0], np.array([len(i) for i in a_ids]), flat[1], np.array([len(i) for i in b_ids]), fine


@lru_cache(maxsize=1)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """One pair per worker process."""
    return Tokenizers(a_path, b_path)


@dataclass
class Alignment:
    """Groups and links of two rows of intervals over the same bytes."""

    a_group: np.ndarray
    b_group: np.ndarray
    groups: int
    # Positions of linked intervals.
    a: np.ndarray
    b: np.ndarray


def align(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> Alignment:
    """Coalesce two rows of intervals, each in order and without overlaps. Intervals are not empty."""
    start, end = np.concatenate((a_start, b_start)), np.concatenate((a_end, b_end))
    side = np.concatenate((np.zeros(len(a_start), np.int8), np.ones(len(b_start), np.int8)))
    order = np.lexsort((side, start))
    reached = np.maximum.accumulate(end[order]) if len(order) else end
    opens = np.ones(len(order), bool)
    opens[1:] = start[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    # An interval overlaps those of the other side from the first that ends behind its start to the last that starts before its end.
    first = np.searchsorted(b_end, a_start, side="right")
    many = np.searchsorted(b_start, a_end, side="left") - first
    a = np.repeat(np.arange(len(a_start)), many)
    b = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return Alignment(group[: len(a_start)], group[len(a_start) :], int(opens.sum()), a, b)


def _group_texts(known: Tokenizers, found: Alignment, a_id: np.ndarray, b_id: np.ndarray, a_word: np.ndarray, b_word: np.ndarray, words: int) -> list[str]:
    """Each word's groups as `a1,a2|b1;a3|b2;`."""
    a_n, b_n = len(known.a_bytes), len(known.b_bytes)
    a_last, b_last = np.ones(len(a_id), bool), np.ones(len(b_id), bool)
    a_last[:-1] = found.a_group[1:] != found.a_group[:-1]
    b_last[:-1] = found.b_group[1:] != found.b_group[:-1]
    place = np.concatenate((a_id + a_n * a_last, 2 * a_n + b_id + b_n * b_last))
    order = np.lexsort((np.concatenate((np.zeros(len(a_id), np.int8), np.ones(len(b_id), np.int8))), np.concatenate((found.a_group, found.b_group))))
    shown = list(map(known.shown.__getitem__, place[order].tolist()))
    cuts = np.cumsum(np.bincount(a_word, minlength=words) + np.bincount(b_word, minlength=words)).tolist()
    return ["".join(shown[lo:hi]) for lo, hi in zip([0, *cuts[:-1]], cuts, strict=True)]


@dataclass
class Words:
    """Numbers per word: [n_a, n_b, n_groups, n_links], whether both tokenizers give it back, its groups, and its links in order."""

    numbers: np.ndarray
    fine: np.ndarray
    groups: list[str]
    word: np.ndarray
    pair: np.ndarray


def aligned(known: Tokenizers, words: list[str]) -> Words:
    """Encode words, each with a blank before it, and align the two sides."""
    n = len(words)
    a_id, a_len, b_id, b_len, fine = known.encode(words)
    a_word, b_word = np.repeat(np.arange(n), a_len), np.repeat(np.arange(n), b_len)
    # Words lie end to end, and both sides have the same bytes, so no interval crosses from one to the next.
    a_end, b_end = np.cumsum(known.a_size[a_id]), np.cumsum(known.b_size[b_id])
    found = align(a_end - known.a_size[a_id], a_end, b_end - known.b_size[b_id], b_end)
    group_word = np.zeros(found.groups, np.int64)
    group_word[found.a_group] = a_word
    word = a_word[found.a]
    numbers = np.column_stack([a_len, b_len, np.bincount(group_word, minlength=n), np.bincount(word, minlength=n)])
    return Words(numbers, fine, _group_texts(known, found, a_id, b_id, a_word, b_word, n), word, a_id[found.a] * _B + b_id[found.b])


def _chunks(words: list[str]) -> Iterator[list[str]]:
    """Some words at a time; one longer word comes alone."""
    start = size = 0
    for place, word in enumerate(words):
        if place > start and size + len(word) > _AT_ONCE:
            yield words[start:place]
            start, size = place, 0
        size += len(word)
    if start < len(words):
        yield words[start:]


def aligned_texts(known: Tokenizers, texts: list[str]) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text n_a, n_b, n_groups, n_links and groups; the linked pairs of ids; then, in order, (text, place of a pair, how many links)."""
    place_of: dict[str, int] = {}
    codes = [np.fromiter((place_of.setdefault(w, len(place_of)) for w in known.words(t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
    names = list(place_of)
    # Only a text's first and last word may begin or end with a blank. They come last, so that the others can stand beside each other.
    edges = np.zeros(len(names), bool)
    edges[[c[i] for c in codes if len(c) for i in (0, -1)]] = True
    turn = np.argsort(edges, kind="stable")
    back = np.argsort(turn, kind="stable")
    codes = [back[c] for c in codes]
    parts, first, link_word = [aligned(known, chunk) for chunk in _chunks([names[i] for i in turn.tolist()])], 0, []
    for part in parts:
        link_word.append(part.word + first)
        first += len(part.groups)
    numbers = np.concatenate([p.numbers for p in parts] or [np.zeros((0, 4), np.int64)])
    fine = np.concatenate([p.fine for p in parts] or [np.zeros(0, bool)])
    groups = list(chain.from_iterable(p.groups for p in parts))
    word = np.concatenate([*link_word, np.zeros(0, np.int64)])
    listed, place = np.unique(np.concatenate([*[p.pair for p in parts], np.zeros(0, np.int64)]), return_inverse=True)
    # A text with a word that one side does not give back has no tokens.
    codes = [c if fine[c].all() else c[:0] for c in codes]
    size = np.array([len(c) for c in codes], np.int64)
    text_of, code = np.repeat(np.arange(len(texts)), size), np.concatenate([*codes, np.zeros(0, np.int64)])
    sums = np.column_stack([np.bincount(text_of, weights=numbers[code, k], minlength=len(texts)).astype(np.int64) for k in range(4)])
    rows = pd.DataFrame(sums, columns=["n_a", "n_b", "n_groups", "n_links"])
    rows["groups"] = ["".join(map(groups.__getitem__, c.tolist()))[:-1] for c in codes]
    # A text's words by how often they stand in it, and these words' pairs.
    key, times = np.unique(text_of * len(names) + code, return_counts=True)
    text_of, code = key // max(len(names), 1), key % max(len(names), 1)
    links, begin = np.bincount(word, minlength=len(groups)), np.searchsorted(word, np.arange(len(groups)))
    many = links[code]
    each = np.repeat(begin[code] - np.cumsum(many) + many, many) + np.arange(many.sum())
    key, times = np.repeat(text_of, many) * max(len(listed), 1) + place[each], np.repeat(times, many)
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    at = np.flatnonzero(np.diff(key, prepend=-1))
    key, times = key[at], np.add.reduceat(times, at) if len(at) else times
    return rows, listed, key // max(len(listed), 1), key % max(len(listed), 1), times


def _packed(values: np.ndarray) -> bytes:
    return values.astype("<i4").tobytes()


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of some rows at a time."""
    ids, held, size = [], [], 0
    for frame in frames:
        for i, text in frame[["doc_id", "text"]].itertuples(index=False):
            ids.append(i)
            held.append(text or "")
            size += len(held[-1])
            if size >= BLOCK_BYTES:
                yield ids, held
                ids, held, size = [], [], 0
    if held:
        yield ids, held


def _aligned_rows(rows: DataFrame, id_type: str, a_path: str, b_path: str, texts: bool) -> DataFrame:
    """One row per text with its numbers, its linked pairs as places in its block's list of pairs, and how often each is linked;
    the block's list and how often each pair is linked in it come with the first of the block's rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, part = tokenizers(a_path, b_path), TaskContext.get().partitionId()
        for number, (ids, held) in enumerate(_blocks(frames)):
            found, listed, text_of, place, many = aligned_texts(known, held)
            counts = np.bincount(place, weights=many, minlength=len(listed)).astype(np.int64)
            cuts = np.searchsorted(text_of, np.arange(len(found) + 1))
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            groups = found.pop("groups")
            found.insert(0, "doc_id", ids)
            found["groups_sha256"] = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            if texts:
                found["groups"] = groups
            for at in range(0, len(found), ROWS_AT_ONCE):
                some = found.iloc[at : at + ROWS_AT_ONCE]
                bare = [None] * (len(some) - 1)
                yield some.assign(
                    block=(part << 32) + number, places=[_packed(place[lo:hi]) for lo, hi in spans[at : at + ROWS_AT_ONCE]],
                    many=[_packed(many[lo:hi]) for lo, hi in spans[at : at + ROWS_AT_ONCE]],
                    pairs=[None if at else listed, *bare], counts=[None if at else counts, *bare])

    names = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string" + ", groups string" * texts
    return rows.mapInPandas(run, f"{names}, block long, places binary, many binary, pairs array<long>, counts array<long>")


def align_documents(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """One row per row of `df`: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if `texts`, groups.

    A encodes a space and the text, B, which adds the space itself, the text; strings of special tokens are plain text. `groups` lists the ids
    of both sides between the bytes at which both have an end. n_best counts links whose pair of ids is linked as often in the corpus
    as any pair with that id of B, count_sum adds their pairs' numbers of links. Null and empty texts, and texts that one of the two
    does not give back byte by byte, have no tokens: zeros and an empty string. Repeated rows count as rows of their own, null
    ids are kept, an empty table gives no rows, and other columns are not read, so their names cannot clash. A text is one value:
    its tokens have to fit in a task's memory.

    Pairs are told per block of texts, not per text, so that frequent ones are not told for every text that has them. Blocks get
    the corpus's numbers of their own pairs back, by a join on the pair and one on the block.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = df.schema[id_col].dataType.simpleString()
    found = saved(_aligned_rows(rows, id_type, a_path, b_path, texts), "aligned")
    told = found.where("pairs is not null").select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    told = told.select("block", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = saved(told.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    best = totals.groupBy(b_id.alias("b")).agg(F.max("n").alias("top"))
    marked = totals.join(best, b_id == F.col("b")).select((F.col("pair") + 0).alias("pair"), "n", (F.col("n") == F.col("top")).alias("best"))
    mine = told.select("block", "pair").join(marked, "pair")
    listed = mine.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pair", "n", "best"))).alias("l"))
    listed = listed.select((F.col("block") + 0).alias("block"), F.col("l.n").alias("n"), F.col("l.best").alias("best"))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *["groups"] * texts]
    kinds = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in names)

    def counted(mine: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        n, best = (np.asarray(told[c].iloc[0]) if len(told) else np.zeros(0, np.int64) for c in ("n", "best"))
        sums, tops = [], []
        for places, many in zip(mine["places"], mine["many"], strict=True):
            at, times = np.frombuffer(places, "<i4"), np.frombuffer(many, "<i4").astype(np.int64)
            sums.append(int((n[at] * times).sum()))
            tops.append(int(times[best[at].astype(bool)].sum()))
        return mine[names].assign(n_best=tops, count_sum=sums)

    blocks = found.select(*names, "block", "places", "many").groupBy("block")
    done = blocks.cogroup(listed.groupBy("block")).applyInPandas(counted, f"{kinds}, n_best long, count_sum long")
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", *names[5:])
