"""Packing of token sequences by bin completion, planned on the histogram of lengths."""

from __future__ import annotations

import bisect
import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPACITY = 2048
# How a byte-level BPE tokenizer of this kind cuts a text before merging (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters on which every Unicode version agrees; texts with others are encoded by the tokenizer's own library.
_PLAIN = re.compile(r"[\t\n !-~¡-ɏ‐-‧]*")


class ByteEncoder:
    """Ids of a byte-level BPE tokenizer file, as its library gives them without added special tokens.

    The file's vocabulary is in merge order, so it also serves as ranks for a faster merger, which encodes ordinary
    texts. Strings of special tokens in a text become those tokens, as the library does by default.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = list(special)
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        self.fast = Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        if not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        # No string of a special token is in the text; the ids come as an array, with no list between.
        return self.fast.encode_to_numpy(text, disallowed_special=())


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """One encoder per worker process."""
    return ByteEncoder(path)


def cut_documents(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids, block, place) per piece of a document's ids and the end id after them.

    A document of at most `capacity` ids is one piece. A longer one is cut into pieces of that size, of which the first
    may be shorter. Null texts count as empty and are the end id alone; repeated rows and null ids are documents of
    their own. `block` and `place` number the pieces of one length within a task; write the result down before `pack`.
    Other columns are not read. An empty table has no pieces.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = byte_encoder(path)
        block, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for frame in frames:
            for begin in range(0, len(frame), 200):
                out = []
                part = frame.iloc[begin : begin + 200]
                for doc, text in zip(part["doc_id"], part["text"], strict=True):
                    ids = np.append(encoder.encode(text or ""), np.uint32(end_id))
                    start, piece = 0, 0
                    while start < len(ids):
                        size = (len(ids) - start - 1) % capacity + 1
                        out.append((doc, piece, start, size, ids[start : start + size].astype(np.int32), block, seen[size]))
                        seen[size] += 1
                        start, piece = start + size, piece + 1
                rows = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids", "block", "place"])
                yield rows.astype({"doc_id": part["doc_id"].dtype})

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(
        run, f"doc_id {kind}, piece int, start long, length long, ids array<int>, block int, place long")


# Planning: patterns over lengths. Nothing here grows with the number of pieces.

Pattern = tuple[int, ...]
Plan = list[tuple[Pattern, int]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by the sum, and by pieces too long to share with each other."""
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for small in [0, *(s for s in counts if 2 * s <= capacity)]:
        alone = sum(n for s, n in counts.items() if s > capacity - small)
        half = [(s, n) for s, n in counts.items() if capacity - small >= s and 2 * s > capacity]
        room = sum((capacity - s) * n for s, n in half)
        rest = sum(s * n for s, n in counts.items() if small <= s and 2 * s <= capacity)
        best = max(best, alone + sum(n for _, n in half) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing, bins of equal content handled together."""
    open_bins: dict[int, list[list]] = {}
    rooms: list[int] = []
    done: Plan = []

    def put(pattern: Pattern, times: int) -> None:
        room = capacity - sum(pattern)
        if not room:
            done.append((pattern, times))
            return
        if room not in open_bins:
            open_bins[room] = []
            bisect.insort(rooms, room)
        open_bins[room].append([pattern, times])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                each = min(capacity // size, left)
                put((size,) * each, left // each)
                left -= left // each * each
                continue
            room = rooms[at]
            pattern, times = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
            each = room // size
            # What best fit does: it fills one bin as far as pieces of this size go, then the next.
            if left >= each:
                take = min(times, left // each)
                put(pattern + (size,) * each, take)
                left -= take * each
            else:
                take = 1
                put(pattern + (size,) * left, 1)
                left = 0
            if times > take:
                put(pattern, times - take)
    return done + [(p, t) for group in open_bins.values() for p, t in group]


def fillings(avail: np.ndarray, room: int, width: int) -> list[Pattern]:
    """Undominated ways to fill `room`, least waste first: at most `width` of them.

    One, two or three pieces, then the longest that still fit. A filling is dominated if one longer piece could stand for
    several of its own at no more waste: so two pieces count only if they fill more than the longest single one, and
    three only if they fill more than the best pair.
    """
    sizes = np.flatnonzero(avail[: room + 1])
    if not len(sizes):
        return [()]
    fit = np.zeros(room + 1, np.int64)
    fit[sizes] = sizes
    fit = np.maximum.accumulate(fit)
    found: list[Pattern] = [(int(sizes[-1]),)]
    best = int(sizes[-1])
    for depth in (2, 3):
        if best == room:
            break
        if depth == 2:
            mates = np.minimum(fit[room - sizes], sizes)
            mates = np.where((mates == sizes) & (avail[sizes] < 2), fit[np.maximum(sizes - 1, 0)], mates)
            ok = mates > 0
            sums = sizes[ok] + mates[ok]
            for i in np.argsort(-sums, kind="stable")[:width]:
                if sums[i] > best:
                    found.append((int(sizes[ok][i]), int(mates[ok][i])))
        else:
            # The largest pair sum under each rest, from pairs of the sizes.
            some = sizes if len(sizes) <= 400 else sizes[np.linspace(0, len(sizes) - 1, 400).astype(int)]
            one, two = np.triu_indices(len(some))
            sums = some[one] + some[two]
            third = np.where(room - sums > 0, fit[np.clip(room - sums, 0, room)], 0)
            total = np.where(third > 0, sums + third, 0)
            for i in np.argsort(-total, kind="stable")[: 4 * width]:
                pattern = sorted((int(some[one[i]]), int(some[two[i]]), int(third[i])), reverse=True)
                if best < total[i] <= room and all(avail[s] >= pattern.count(s) for s in pattern):
                    found.append(tuple(pattern))
        best = max(sum(p) for p in found)
    full = set()
    for pattern in found:
        left, rest = room - sum(pattern), list(pattern)
        while left and fit[left]:
            size = int(fit[left])
            if avail[size] <= rest.count(size):
                smaller = [s for s in sizes[: np.searchsorted(sizes, size)].tolist() if avail[s] > rest.count(s)]
                if not smaller:
                    break
                size = smaller[-1]
            rest.append(size)
            left -= size
        full.add(tuple(sorted(rest, reverse=True)))
    return sorted(full, key=lambda p: (room - sum(p), len(p), [-s for s in p]))[:width]


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = 6_000, width: int = 6) -> Plan:
    """Patterns and how often to use each, with as few bins as the search finds.

    Depth first: take the longest piece left, complete its bin in the undominated ways, least waste first, and use a
    completion as often as the pieces last, or once. A branch ends when its bins and the bound for what is left reach the
    incumbent. Best-fit decreasing gives the first incumbent, and at every node also completes the branch. The search
    ends at the lower bound or after `nodes` nodes; either way every piece has a place.
    """
    counts = {int(s): int(n) for s, n in counts.items() if n}
    best = best_fit(counts, capacity)
    goal, bins = lower_bound(counts, capacity), sum(t for _, t in best)
    start = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        start[size] = n
    # A branch waits as its parent's pieces and what it takes of them; plans share their beginnings.
    stack: list[tuple] = [(start, {}, 0, None, 0)]
    weights = np.arange(capacity + 1)
    for step in itertools.count():
        if bins <= goal or step >= nodes or not stack:
            return best
        before, need, times, plan, used = stack.pop()
        avail = before
        if need:
            avail = before.copy()
            for size, k in need.items():
                avail[size] -= k * times
        if used + -(-int(avail @ weights) // capacity) >= bins:
            continue
        rest = {int(s): int(avail[s]) for s in np.flatnonzero(avail)}
        if step % 16 == 0 or len(rest) < 12:
            tail = best_fit(rest, capacity)
            if used + sum(t for _, t in tail) < bins:
                best, bins = _unrolled(plan) + tail, used + sum(t for _, t in tail)
                continue
        if not rest:
            continue
        longest = max(rest)
        others = avail.copy()
        others[longest] -= 1
        options = []
        for filling in fillings(others, capacity - longest, width):
            pattern = (longest, *filling)
            need = {s: pattern.count(s) for s in set(pattern)}
            times = min(rest[s] // k for s, k in need.items())
            options += [(pattern, need, t) for t in dict.fromkeys((times, 1))]
        for pattern, need, times in reversed(options):
            stack.append((avail, need, times, (plan, (pattern, times)), used + times))


def _unrolled(plan: tuple | None) -> Plan:
    out: Plan = []
    while plan:
        plan, step = plan
        out.append(step)
    return out[::-1]


def _slots(plan: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: the first rank of each slot range, the sequence that rank goes to, the offset in it."""
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    given: dict[int, int] = {}
    first = 0
    for pattern, times in plan:
        offset = 0
        for size in pattern:
            ranges.setdefault(size, []).append((given.get(size, 0), first, offset))
            given[size] = given.get(size, 0) + times
            offset += size
        first += times
    return {s: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for s, r in ranges.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = 6_000) -> DataFrame:
    """The pieces, with sequence_id and offset in place of block and place.

    `pieces` must be a written table with a length of 1 to `capacity`, and in `block` and `place` a number from 0 on for
    each piece of one length in one block. The driver gets the histogram of lengths, at most `capacity` rows, and plans on
    it. The pieces of one length then take that length's slots in the order of their blocks and places; no length, however
    frequent, is gathered. Pieces of other lengths raise an error. An empty table has no sequences.
    """
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if any(s is None or not 1 <= s <= capacity for s in histogram):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    slots = _slots(bin_completion(histogram, capacity, nodes))
    per_block = pieces.groupBy("block", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select("block", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    names = [c for c in pieces.columns if c not in ("block", "place")]
    ranked = pieces.join(offsets, ["block", "length"]).select(*names, (F.col("place") + F.col("_before")).alias("_rank"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            length, rank = frame["length"].to_numpy(), frame["_rank"].to_numpy()
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                ranks, sequences, offsets = slots[int(size)]
                slot = np.searchsorted(ranks, rank[at], side="right") - 1
                sequence[at] = sequences[slot] + rank[at] - ranks[slot]
                offset[at] = offsets[slot]
            yield frame[names].assign(sequence_id=sequence, offset=offset)

    fields = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in names)
    return ranked.mapInPandas(run, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed pieces' ids end to end. A sequence holds at most `capacity` ids."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
