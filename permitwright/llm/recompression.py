"""Substring dedup by recompression: equal stretches of words get equal symbols, and shared symbols reveal the repeats.

A text is a row of symbols, at first its words. Each round names runs of one symbol, then pairs of a left and a right
symbol; a symbol's side is a bit of its name. A name is a hash of its parts, so all tasks name alike without asking each
other, and whether two neighbours join depends on nothing but them and a symbol or two beside them. So every symbol knows
the stretch of words that settles it, and a window that holds this stretch has the symbol wherever it occurs.

After the rounds a few symbols in a row are named once more, as a phrase of a dozen words. Each window of words picks one phrase that
is settled in it, its anchor. Windows that are equal have anchors of one name. Spark then counts in
rounds: names first (a name that occurs once ends all its windows), the words around anchors of one name next, and single
windows only where these differ.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.llm.common import ROWS_AT_ONCE, byte_groups, hashed_words, mixed, saved

# Words of a window that must not repeat.
WINDOW = 35
# Rounds that name runs before pairs. Each makes a symbol depend on one more neighbour on both sides, so that fewer are settled.
RUN_ROUNDS = (0,)
# Symbols in a row that are named together: long enough that what is not a repeat rarely shares one.
PHRASE = 4
# Bits of the bitmaps that keep rows out of a shuffle which cannot find a partner there: 2 MB, whatever the data's size.
BITMAP_BITS = 1 << 24
_FAR = np.int64(1) << np.int64(40)
_PLACE_BITS = np.uint64(28)


def rounds_for(window: int) -> int:
    """Rounds after which a window still holds some dozen settled symbols; a round makes symbols about a third longer."""
    return max(0, round(math.log(max(window / 12, 1)) / math.log(4 / 3)))


def _salt(number: int) -> np.uint64:
    return np.uint64((2 * number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


class Symbols:
    """One level: names in order, and the first and last place that settles each. Borders between texts have `border`."""

    def __init__(self, name: np.ndarray, low: np.ndarray, high: np.ndarray, border: np.ndarray) -> None:
        self.name, self.border = name, border
        # What is settled by a border is never settled inside a window.
        self.low, self.high = np.where(border, -1, low), np.where(border, _FAR, high)

    def runs(self, number: int) -> Symbols:
        """Every run of two or more of a symbol as one symbol. A run is settled by the symbols that end it."""
        same = np.zeros(len(self.name), bool)
        same[1:] = (self.name[1:] == self.name[:-1]) & ~self.border[1:]
        first = np.flatnonzero(~same)
        size = np.diff(np.append(first, len(self.name)))
        before, after = np.maximum(first - 1, 0), np.minimum(first + size, len(self.name) - 1)
        run = mixed(mixed(self.name[first] + _salt(number)) + size.astype(np.uint64))
        return Symbols(np.where(size > 1, run, self.name[first]), self.low[before], self.high[after], self.border[first])

    def pairs(self, number: int) -> Symbols:
        """Every left symbol with a right one after it as one symbol. A symbol left over is settled by the one it faced."""
        left = (mixed(self.name ^ _salt(number)) >> np.uint64(17) & np.uint64(1) == 0) & ~self.border
        right = ~left & ~self.border
        joins = np.zeros(len(left), bool)
        joins[:-1] = left[:-1] & right[1:]
        taken = np.zeros(len(left), bool)
        taken[1:] = joins[:-1]
        kept = np.flatnonzero(~taken)
        before, after = np.maximum(kept - 1, 0), np.minimum(kept + 1, len(left) - 1)
        name = np.where(joins[kept], mixed(self.name[kept] + mixed(self.name[after] + _salt(number))), self.name[kept])
        low = np.where(right[kept], self.low[before], self.low[kept])
        high = np.where(left[kept], self.high[after], self.high[kept])
        return Symbols(name, low, high, self.border[kept])


def levels(name: np.ndarray, border: np.ndarray, rounds: int) -> list[Symbols]:
    place = np.arange(len(name))
    found = [Symbols(name, place, place + 1, border)]
    for number in range(rounds):
        last = found[-1].runs(number) if number in RUN_ROUNDS else found[-1]
        found.append(last.pairs(number))
    return found


def _least(keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least key of each range, by minima over stretches of doubling lengths."""
    size = end - start
    out = np.empty(len(start), keys.dtype)
    step, least = 1, keys
    while len(size) and step <= size.max():
        mine = np.flatnonzero((size >= step) & (size < 2 * step))
        out[mine] = np.minimum(least[start[mine]], least[end[mine] - step])
        if len(least) <= step:
            break
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return out


def phrases(level: Symbols, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first symbol, its settled stretch's start, the last one's end) of every `size` settled symbols in a row, as one longer symbol each."""
    usable = (level.low >= 0) & (level.high < _FAR)
    whole = np.cumsum(np.concatenate(([0], usable)))
    first = np.flatnonzero(whole[size:] - whole[:-size] == size)
    return first, level.low[first], level.high[first + size - 1]


def _phrase_names(level: Symbols, first: np.ndarray, size: int) -> np.ndarray:
    name = np.zeros(len(first), np.uint64)
    for step in range(size):
        name = mixed(name + _salt(step)) + level.name[first + step]
    return mixed(name)


def anchors(found: list[Symbols], starts: np.ndarray, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, identity) of each window's anchor. `starts` ascends.

    It is a phrase of `size` settled symbols of the highest level that has one in the window: the phrase with the smallest hash,
    the leftmost of equal ones.
    """
    name, where = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64)
    todo = np.arange(len(starts))
    low_bits = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    for number in range(len(found) - 1, -1, -1):
        level = found[number]
        # Bounds ascend along a level, so a window's phrases are one range of it.
        place, low, high = phrases(level, size)
        first = np.searchsorted(low, starts[todo], side="left")
        last = np.searchsorted(high, starts[todo] + window, side="right")
        has = last > first
        names = _phrase_names(level, place, size)
        keys = mixed(names + _salt(101)) & ~low_bits | np.arange(len(place)).astype(np.uint64)
        chosen = (_least(keys, first[has], last[has]) & low_bits).astype(np.int64)
        name[todo[has]] = mixed(names[chosen] + np.uint64(number))
        where[todo[has]] = place[chosen] * len(found) + number
        todo = todo[~has]
    return name, where


class Stretches:
    """Hashes of any stretch of a row of words, from running sums."""

    _BASE = np.uint64(0xD1342543DE82EF95)

    def __init__(self, words: np.ndarray) -> None:
        powers = np.full(len(words) + 1, self._BASE, np.uint64)
        powers[0] = 1
        self._sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mixed(words + _salt(77)) * np.multiply.accumulate(powers)[:-1], out=self._sums[1:])
        powers = np.full(len(words) + 1, np.uint64(pow(int(self._BASE), -1, 1 << 64)), np.uint64)
        powers[0] = 1
        self._inverse = np.multiply.accumulate(powers)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._inverse[start] + mixed((end - start).astype(np.uint64)))


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of the words of some texts: what stands between blanks (0x20, 0x09-0x0D)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts, _, word = hashed_words(data, (data != 32) & ((data < 9) | (data > 13)))
    return word, np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")


def text_anchors(texts: list[bytes], window: int) -> pd.DataFrame:
    """(text, name, around, start, n) of every anchor of some texts.

    `start` and `n` say which windows have it: n windows from word `start` on. `around` is a hash of all words of these.
    """
    word, owner = _words(texts)
    counts = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(counts) - counts
    # One border before each text and one at the end.
    place = np.arange(len(word)) + owner + 1
    border = np.ones(len(word) + len(texts) + 1, bool)
    border[place] = False
    name = np.zeros(len(border), np.uint64)
    name[place] = word
    inner = np.arange(len(word)) - first[owner]
    begins = np.flatnonzero(inner + window <= counts[owner])
    names, where = anchors(levels(name, border, rounds_for(window)), place[begins], window, min(PHRASE, window))
    # The windows of one anchor follow each other.
    cut = np.ones(len(begins), bool)
    cut[1:] = (where[1:] != where[:-1]) | (owner[begins][1:] != owner[begins][:-1])
    head = np.flatnonzero(cut)
    size = np.diff(np.append(head, len(begins)))
    at = begins[head]
    around = Stretches(word).of(at, at + size - 1 + window)
    return pd.DataFrame({
        "text": owner[at], "name": names[head].view(np.int64), "around": around.view(np.int64),
        "start": inner[at].astype(np.int32), "n": size.astype(np.int32),
    })


def _anchor_rows(texts: DataFrame, window: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            k1, k2 = frame["k1"].to_numpy(), frame["k2"].to_numpy()
            for first, part in byte_groups(list(frame["text"])):
                found = text_anchors(part, window)
                at = found.pop("text").to_numpy() + first
                yield found.assign(k1=k1[at], k2=k2[at])

    return texts.mapInPandas(run, "name long, around long, start int, n int, k1 long, k2 long")


def _might_hold(keys: DataFrame, key: Column, probe: Column) -> Column:
    """False only for a `probe` that is not among the keys.

    A bitmap of a fixed size, found by a scalar subquery as Spark's own runtime filters are. It keeps rows out of a shuffle; the
    join behind it decides. With very many keys it fills up and keeps less out.
    """
    place = F.pmod(key, F.lit(BITMAP_BITS))
    marks = keys.select(F.shiftright(place, 6).alias("at"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
    marks = marks.select("at", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")).alias("bits"))
    every = keys.sparkSession.range(BITMAP_BITS >> 6).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bits"))
    filled = marks.unionAll(every).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    array = filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "bits"))), lambda s: s["bits"]).alias("a"))
    wanted = F.pmod(probe, F.lit(BITMAP_BITS))
    held = F.get(array.scalar(), F.shiftright(wanted, 6).cast("int"))
    return F.call_function("shiftright", held, F.pmod(wanted, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def _window_rows(reps: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """(same, whole, k1, k2, start) of each window of the given anchors. Equal windows of one anchor name have one `same`."""
    listed = saved(reps.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "name", "whole")).alias("parts")), "parts")
    near = texts.where(_might_hold(listed, F.col("k1"), F.col("k1"))).join(listed, ["k1", "k2"]).select("k1", "k2", "text", "parts")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, part in byte_groups(list(frame["text"])):
                word, owner = _words(part)
                counts = np.bincount(owner, minlength=len(part))
                base, hashes = (np.cumsum(counts) - counts).tolist(), Stretches(word)
                rows = [(row, p["start"], p["n"], p["name"], p["whole"]) for row in range(len(part)) for p in frame["parts"].iloc[first + row]]
                row, start, n, name, whole = (np.array(c) for c in zip(*rows, strict=True))
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start, at = np.repeat(start, n) + step, np.repeat(np.array(base)[row], n)
                same = mixed(hashes.of(at + start, at + start + window) + mixed(np.repeat(name, n).view(np.uint64)))
                k1, k2 = (frame[k].to_numpy()[first + np.repeat(row, n)] for k in ("k1", "k2"))
                yield pd.DataFrame({"same": same.view(np.int64), "whole": np.repeat(whole, n), "k1": k1, "k2": k2, "start": start.astype(np.int32)})

    return near.mapInPandas(run, "same long, whole boolean, k1 long, k2 long, start int")


def repeated_windows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(k1, k2, start, n): stretches of windows, by document key, whose words also start at another place.

    `texts` has k1, k2 (a document's key) and text. Aggregates combine in the map tasks and no name's rows are gathered, however
    often a passage occurs.
    """
    found = _anchor_rows(texts, window)
    names = found.groupBy("name").agg(F.count("*").alias("c"))
    shared = saved(names.where("c > 1").select("name"), "names")
    live = saved(found.where(_might_hold(shared, F.col("name"), F.col("name"))).join(shared, "name"), "live")
    # Words around anchors of one name that occur twice settle all windows in them.
    place = F.struct("k1", "k2", "start")
    rounds = live.groupBy("name", "around").agg(F.min(place).alias("lead"), F.count("*").alias("c"))
    rounds = saved(rounds.select("name", "around", "lead", (F.col("c") > 1).alias("whole")), "rounds")
    whole = rounds.where("whole").select("name", "around")
    settled = live.join(whole, ["name", "around"], "left_semi").select("k1", "k2", "start", "n")
    # Where they differ windows are told one by one. One of each kind stands for those that are settled.
    differing = rounds.groupBy("name").agg(F.count("*").alias("c"), F.bool_and("whole").alias("w")).where("c > 1 and not w")
    leads = rounds.join(differing.select((F.col("name") + 0).alias("name")), "name", "left_semi")
    leads = leads.select("name", "around", "whole", F.col("lead.k1").alias("k1"), F.col("lead.k2").alias("k2"), F.col("lead.start").alias("start"))
    reps = leads.join(live.select("name", "around", "k1", "k2", "start", "n"), ["name", "around", "k1", "k2", "start"]).distinct()
    singles = saved(_window_rows(reps, texts, window), "windows")
    counted = singles.groupBy("same").agg(F.count("*").alias("c"), F.bool_or("whole").alias("w"))
    again = counted.where("c > 1 or w").select((F.col("same") + 0).alias("same"))
    open_ones = singles.where("not whole").join(again, "same", "left_semi").select("k1", "k2", "start", F.lit(1).alias("n"))
    return settled.unionAll(open_ones)


def _kept(text: str | None, parts: list | None, window: int) -> tuple[int, int, bytes]:
    """Number of words, number of those gone, and what stays."""
    words = (text or "").encode("utf-8", "replace").split()
    if parts is None:
        return len(words), 0, b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for part in parts:
        edge[part["start"]] += 1
        edge[part["start"] + part["n"] - 1 + window] -= 1
    left = [word for word, cover in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not cover]
    return len(words), len(words) - len(left), b" ".join(left)


def without_repeats(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """One row per row of `df`: doc_id, n_words, n_removed, kept_sha256 and, if `texts`, kept.

    Words are what stands between blanks (0x20, 0x09-0x0D), unchanged. A word goes if a window of `window` consecutive words
    around it starts with the same words anywhere else: in another row, also one that repeats this one, or later in the same text.
    Windows are judged on the input. What stays is joined by one space. Null texts have no words; texts of fewer words than a
    window stay whole, blanks aside. Null ids are kept, an empty table gives no rows, and other columns are not read, so their
    names cannot clash. A text is one value: its words' hashes have to fit in a task's memory.

    Stretches are compared by 128 bits of hashes. Of the texts only those with repeats are shuffled.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # Rows with one key have the same id and text.
    keyed = rows.select(F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", F.lit("|"), "doc_id").alias("k2"), "doc_id", "text")
    stretches = repeated_windows(keyed.where("text is not null").select("k1", "k2", "text"), window)
    losses = stretches.select("k1", "k2", F.struct("start", "n").alias("part")).groupBy("k1", "k2").agg(F.collect_set("part").alias("parts"))
    losses = saved(losses, "losses")
    may_lose = F.coalesce(_might_hold(losses, F.col("k1"), F.col("k1")), F.lit(True))
    some = keyed.where(may_lose).join(losses, ["k1", "k2"], "left").select("doc_id", "text", "parts")
    part_type = losses.schema["parts"].dataType.simpleString()
    rest = keyed.where(~may_lose).select("doc_id", "text", F.lit(None).cast(part_type).alias("parts"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), ROWS_AT_ONCE):
                part = frame.iloc[at : at + ROWS_AT_ONCE]
                done = [_kept(*row, window) for row in part[["text", "parts"]].itertuples(index=False)]
                out = {"doc_id": part["doc_id"], "n_words": [d[0] for d in done], "n_removed": [d[1] for d in done],
                       "kept_sha256": [hashlib.sha256(d[2]).hexdigest() for d in done]}
                yield pd.DataFrame(out | ({"kept": [d[2].decode() for d in done]} if texts else {}))

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts
    return some.mapInPandas(run, schema).unionAll(rest.mapInPandas(run, schema))
