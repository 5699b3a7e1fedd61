"""Similarity join of word n-gram sets by token-combination prefixes, as classes of linked documents.

Tokens are the n-grams. They are ordered by the number of different sets that hold them, rare ones first. Two sets that
are similar enough share tokens of their prefixes: a rare token they share is a signature by itself, of frequent tokens
it takes a pair of one class. The prefix grows by what that costs. Signatures find candidates, counts of shared tokens
decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations, groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.llm.common import byte_groups, components, hashed_words, mixed, saved

# From this many sets on a token is frequent; below it, rare.
FREQUENT = 16
# Frequent tokens are dealt to one class per so many tokens of a set, by size band.
CLASS_WIDTH = 16
_TOKENS_AT_ONCE = 500_000
# Entries of one hash bucket, on average: there are as many buckets as the corpus's tokens ask for.
BUCKET_TOKENS = 500_000
# Entries of a bucket that a task holds before it settles which of its tokens are frequent.
_HELD = 1_000_000
# The bits of a token or a key that are told.
_PART = np.uint64(0xFFFFFFFF)
# Longs of the bitmap by which sets that are still apart are told from each other.
SKETCH_LONGS = 8
# While more pairs than this per row are still apart, signatures take turns: this many shares of them in each, the rest in the last.
PAIRS_PER_ROW = 8
TURNS = (1, 1, 2, 4, 8)
# Sets drawn from a signature at a time; in turns of few shares this is done again with others, so often as shares go into this number.
DRAWN = 4
DRAWS = 4


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of every distinct `words`-word shingle of every text, sorted by both.

    A-Z count as a-z, words are what stands between blanks (0x20, 0x09-0x0D). A text of fewer words is one shingle, a
    text without words has none.
    """
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8).copy()
    data[(data >= 65) & (data <= 90)] += 32
    starts, _, word = hashed_words(data, (data != 32) & ((data < 9) | (data > 13)))
    text_of = np.searchsorted(np.cumsum(sizes), starts, side="right")
    counts = np.bincount(text_of, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    # A shingle starts at each word that has enough words after it, and at the first word of a short text.
    last = np.maximum(counts - words, 0)
    place = np.arange(len(word)) - first[text_of]
    begin = np.flatnonzero(place <= last[text_of])
    owner = text_of[begin]
    value = np.zeros(len(begin), np.uint64)
    for step in range(words):
        there = place[begin] + step < counts[owner]
        at = np.minimum(begin + step, max(len(word) - 1, 0))
        value = mixed(value + np.uint64(step + 1)) + np.where(there, word[at], np.uint64(0)) if len(begin) else value
    value = mixed(value)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return owner[fresh], value[fresh]


def _set_keys(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit key per text for its set: the sum of its scrambled hashes."""
    running = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(mixed(value ^ np.uint64(0x5555555555555555)), out=running[1:])
    edges = np.searchsorted(owner, np.arange(n + 1))
    sums = running[edges]
    return mixed(sums[1:] - sums[:-1] + (edges[1:] - edges[:-1]).astype(np.uint64))


def _sets(frame: pd.DataFrame, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For a few texts at a time: position of the first, keys, owners and hashes."""
    for start, texts in byte_groups(list(frame["text"])):
        owner, value = shingle_sets(texts, words)
        yield start, _set_keys(owner, value, len(texts)), owner, value


def members(rows: DataFrame, words: int) -> DataFrame:
    """(id, n, key) per row: the set's size, and a key that equal sets share; null for empty sets."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start, keys, owner, _ in _sets(frame, words):
                sizes = np.bincount(owner, minlength=len(keys))
                part = frame.iloc[start : start + len(keys)]
                yield pd.DataFrame({"id": part["id"], "n": sizes, "key": keys.view(np.int64)})

    found = rows.mapInPandas(run, "id long, n long, key long")
    return found.select("id", "n", F.when(F.col("n") > 0, F.col("key")).alias("key"))


def shared_tokens(rows: DataFrame, words: int, total: int, percent: int = 0) -> DataFrame:
    """(key, n, tokens): per set its size and its tokens that other sets hold too, in order. `total` is the number of all tokens.

    A set has a row if at least `percent` of its tokens, and one, are held by others too.

    A token is a long: its number of sets (FREQUENT at most) in the top byte, then its identity, so that ascending
    order is the global order of tokens. Tokens are counted by hash bucket; buckets are sorted by Spark and a task has one of them
    in memory at a time. Each task first counts what it has read: a token it has seen in FREQUENT sets is frequent for sure,
    and of it the bucket gets one notice instead of one entry per set. A bucket that fills up passes on the entries of tokens that
    it has seen in FREQUENT sets, so that it never holds more than those of FREQUENT - 1 sets per token beside those just read.

    An entry is as long however many buckets there are: 32 bits of the token and 32 of its set's key. What is shared goes back to
    the portion of texts it came from, whose own list of keys, none of which agree in those bits, tells the whole key and the set's size. Sets that
    occur in several portions come back once for each; they count once.
    """
    buckets = max(8, -(-total // BUCKET_TOKENS))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, tokens, known_keys, sizes, held = [], [], [], [], 0

        def flush() -> Iterator[pd.DataFrame]:
            key, token = np.concatenate(keys), np.concatenate(tokens)
            whole, first = np.unique(np.concatenate(known_keys), return_index=True)
            size = np.concatenate(sizes)[first]
            layer = _layers(whole)
            of = layer[np.searchsorted(whole, key)]
            for number in range(layer.max() + 1):
                yield dealt_out(key[of == number], token[of == number], whole[layer == number], size[layer == number])

        def dealt_out(key: np.ndarray, token: np.ndarray, whole: np.ndarray, size: np.ndarray) -> pd.DataFrame:
            # What names a portion is what is in it, so one that is read again has the same name.
            source = int.from_bytes(blake2b(whole.tobytes(), digest_size=8).digest(), "little", signed=True)
            bucket = ((token >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            ident = (bucket << 32) | (token & _PART).astype(np.int64)
            part = (key & _PART).astype(np.uint32)
            order = np.lexsort((part, ident))
            part, ident = part[order], ident[order]
            fresh = np.ones(len(part), bool)
            fresh[1:] = (part[1:] != part[:-1]) | (ident[1:] != ident[:-1])
            part, ident = part[fresh], ident[fresh]
            _, group, count = np.unique(ident, return_inverse=True, return_counts=True)
            known = count[group] >= FREQUENT
            notices = np.unique(ident[known])
            p, t = part[~known], ident[~known]
            out = [(b, source, p[lo:hi].tobytes(), _told(t[lo:hi] & 0xFFFFFFFF), None) for b, lo, hi in _runs(t >> 32)]
            out += [(b, 0, None, None, notices[lo:hi]) for b, lo, hi in _runs(notices >> 32)]
            # Frequent tokens go straight on to their sets, and so do the keys; any bucket may carry them.
            if known.any():
                out.append((source % buckets, source, part[known].tobytes(), None, ident[known]))
            out.append((source % buckets, source, np.concatenate((whole, size.astype(np.uint64))).tobytes(), None, None))
            return pd.DataFrame(out, columns=["bucket", "source", "owners", "tokens", "frequent"])

        for frame in frames:
            for _, key, owner, value in _sets(frame, words):
                # Copies in one group of texts count once.
                _, firsts = np.unique(key, return_index=True)
                firsts = firsts[np.isin(firsts, owner)]
                mine = np.isin(owner, firsts)
                known_keys.append(key[firsts])
                sizes.append(np.bincount(owner, minlength=len(key))[firsts])
                keys.append(key[owner[mine]])
                tokens.append(value[mine])
                held += int(mine.sum())
                if held >= _TOKENS_AT_ONCE:
                    yield from flush()
                    keys, tokens, known_keys, sizes, held = [], [], [], [], 0
        if held:
            yield from flush()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for bucket, parts in _by_first(frames):
            yield from counted(bucket, parts)

    def counted(bucket: int, parts: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        entries, known, held = [], np.zeros(0, np.int64), 0
        for _, source, owners, told, frequent in parts:
            if owners is None:
                known = np.union1d(known, np.asarray(frequent, np.int64) & 0xFFFFFFFF)
                continue
            if told is None:
                tokens = None if frequent is None else np.asarray(frequent, np.int64).tobytes()
                yield pd.DataFrame([(int(source), bucket, owners, tokens, None)], columns=back)
                continue
            part = np.frombuffer(owners, np.uint32)
            entries.append((np.full(len(part), int(source), np.int64), part, _heard(told)))
            held += len(part)
            if held >= _HELD:
                source, part, token, number = numbered(entries, known)
                settled = number >= FREQUENT
                yield packed(bucket, source[settled], part[settled], token[settled], number[settled])
                known = np.union1d(known, token[settled])
                entries, held = [(source[~settled], part[~settled], token[~settled])], 0
        if entries:
            found = numbered(entries, known)
            yield packed(bucket, *(x[found[3] > 1] for x in found))

    def numbered(entries: list, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Entries by token, and for each its token's number of sets, FREQUENT at most."""
        source, part, token = (np.concatenate(x) for x in zip(*entries, strict=True))
        order = np.lexsort((part, token))
        source, part, token = source[order], part[order], token[order]
        # The tokens are sorted: the number of sets in a run is told to each of its entries.
        cuts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
        fresh = np.ones(len(token), np.int64)
        fresh[1:] = (part[1:] != part[:-1]) | (token[1:] != token[:-1])
        sets = np.add.reduceat(fresh, cuts) if len(cuts) else cuts
        number = np.where(np.isin(token[cuts], known), FREQUENT, np.minimum(sets, FREQUENT))
        return source, part, token, np.repeat(number, np.diff(np.append(cuts, len(token))))

    def packed(bucket: int, source: np.ndarray, part: np.ndarray, token: np.ndarray, number: np.ndarray) -> pd.DataFrame:
        """One row per portion, so that rows do not multiply with buckets and sets."""
        order = np.lexsort((token, source))
        source, part, token, number = source[order], part[order], token[order], number[order].astype(np.uint8)
        return pd.DataFrame([(of, bucket, part[lo:hi].tobytes(), _told(token[lo:hi]), number[lo:hi].tobytes())
                             for of, lo, hi in _runs(source)], columns=back)

    def gather(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, parts in _by_first(frames):
            whole, size, owners, values = np.zeros(0, np.uint64), np.zeros(0, np.uint64), [], []
            for _, bucket, owner, told, number in parts:
                if told is None:
                    whole, size = np.frombuffer(owner, np.uint64).reshape(2, -1)
                    continue
                owners.append(np.frombuffer(owner, np.uint32))
                if number is None:
                    values.append(np.frombuffer(told, np.int64) | (FREQUENT << 56))
                else:
                    values.append((np.int64(bucket) << 32) | _heard(told) | (np.frombuffer(number, np.uint8).astype(np.int64) << 56))
            if not owners:
                continue
            owner, value = np.concatenate(owners), np.concatenate(values)
            order = np.argsort(whole & _PART)
            whole, size = whole[order], size[order]
            at = np.searchsorted(whole & _PART, owner)
            if len(whole) == 0 or ((whole & _PART)[np.minimum(at, len(whole) - 1)] != owner).any():
                raise RuntimeError("texts changed while they were read")
            order = np.lexsort((value, at))
            at, value = at[order], value[order]
            fresh = np.ones(len(at), bool)
            fresh[1:] = (at[1:] != at[:-1]) | (value[1:] != value[:-1])
            at, value = at[fresh], value[fresh]
            found = [(int(whole[i].view(np.int64)), int(size[i]), value[lo:hi]) for i, lo, hi in _runs(at)]
            yield pd.DataFrame([row for row in found if len(row[2]) * 100 >= percent * row[1]], columns=["key", "n", "tokens"])

    back = ["source", "bucket", "owners", "tokens", "numbers"]
    dealt = rows.mapInPandas(deal, "bucket int, source long, owners binary, tokens binary, frequent array<long>")
    counted_ones = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(
        count, "source long, bucket int, owners binary, tokens binary, numbers binary")
    return counted_ones.repartition("source").sortWithinPartitions("source").mapInPandas(gather, "key long, n long, tokens array<long>")


def _layers(keys: np.ndarray) -> np.ndarray:
    """A number from 0 per key, so that keys that agree in the bits told have different ones; nearly always 0."""
    _, part, times = np.unique(keys & _PART, return_inverse=True, return_counts=True)
    layer = np.empty(len(keys), np.int64)
    layer[np.argsort(part, kind="stable")] = np.arange(len(keys)) - np.repeat(np.cumsum(times) - times, times)
    return layer


def _told(values: np.ndarray) -> bytes:
    """Ascending 32-bit values as their differences, the first bytes of all, then the second ones, which packs well."""
    return np.ascontiguousarray(np.diff(values, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _heard(data: bytes) -> np.ndarray:
    """What `_told` was given, as longs."""
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64))


def _by_first(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows of sorted frames by their first column, one value after the other."""
    rows = (row for frame in frames for row in frame.itertuples(index=False, name=None))
    return groupby(rows, key=itemgetter(0))


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of each run of equal neighbours."""
    if len(values):
        cuts = np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(values[lo]), int(lo), int(hi)


def signatures(n: int, tokens: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """(signature, place) of a set of size `n` whose shared tokens in order are `tokens`.

    `n - len(tokens)` tokens are in no other set and are lost against any partner. The rest may lose as many more as
    the least similar partner allows, so the prefix is long enough that after any such loss one rare token, or two
    frequent ones of a class, remain. The classes depend on the size band of the smaller set of a pair; a set that may
    be the larger one of such a pair also has signatures for the band below.
    """
    spare = n + -percent * n // 100 - (n - len(tokens))
    if spare < 0:
        return []
    out: dict[int, int] = {}
    band = n.bit_length() - 1
    for level in [band] + [band - 1] * (-(-percent * n // 100) < 1 << band and band > 0):
        classes = max(1, (1 << level) // CLASS_WIDTH)
        held: dict[int, list[tuple[int, int]]] = {}
        credit = 0
        for place, token in enumerate(tokens.tolist()):
            if credit > spare:
                break
            if token >> 56 < FREQUENT:
                out[token] = place
                credit += 1
            else:
                mates = held.setdefault(token % 1_000_003 % classes, [])
                credit += bool(mates)
                mates.append((token, place))
        for mates in held.values():
            for (one, at), (two, _) in combinations(mates, 2):
                pair = (one * 0x9E3779B97F4A7C15 + two * 0xC2B2AE3D27D4EB4F + level) & 0xFFFFFFFFFFFFFFFF
                out[((pair ^ pair >> 29) & 0x7FFFFFFFFFFFFFFF) - (1 << 63)] = at
    return list(out.items())


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, n, tokens in zip(frame["key"], frame["n"], frame["tokens"], strict=True):
                found = signatures(int(n), np.asarray(tokens, np.int64), percent)
                if found:
                    yield pd.DataFrame(found, columns=["sig", "place"]).assign(key=key, n=n, r=len(tokens))

    return sets.select("key", "n", "tokens").mapInPandas(run, "sig long, place int, key long, n int, r int")


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether sizes and places leave room for enough shared tokens; `a` and `b` are prefixes of the two sides."""
    c = lambda side, name: F.col(f"{side}{name}").cast("long")
    before = F.least(c(a, "place"), c(b, "place"))
    after = F.least(c(a, "r") - c(a, "place"), c(b, "r") - c(b, "place"))
    return ((before + after) * (100 + percent) >= percent * (c(a, "n") + c(b, "n"))) & (
        F.least(c(a, "n"), c(b, "n")) * 100 >= percent * F.greatest(c(a, "n"), c(b, "n")))


def _sketches(sets: DataFrame) -> DataFrame:
    """(key, b0, b1, ...): for each hash value of tokens whether an odd number of a set's shared tokens has it, as bits of longs."""
    names = [f"b{i}" for i in range(SKETCH_LONGS)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bits = np.zeros((len(frame), SKETCH_LONGS), np.uint64)
            for row, tokens in enumerate(frame["tokens"]):
                place = mixed(np.asarray(tokens, np.int64).view(np.uint64)) % np.uint64(64 * SKETCH_LONGS)
                np.bitwise_xor.at(bits[row], (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
            yield pd.DataFrame(bits.view(np.int64), columns=names).assign(key=frame["key"].to_numpy())[["key", *names]]

    return sets.select("key", "tokens").mapInPandas(run, "key long, " + ", ".join(f"{n} long" for n in names))


def _sketches_allow(a: str, b: str, percent: int) -> Column:
    """Whether the bitmaps leave room for enough shared tokens: bits that differ are at most as many as tokens that one side has alone."""
    alone = sum((F.bit_count(F.col(f"{a}b{i}").bitwiseXOR(F.col(f"{b}b{i}"))) for i in range(SKETCH_LONGS)), F.lit(0))
    twice = (F.col(f"{a}r") + F.col(f"{b}r") - alone).cast("long")
    return twice * (100 + percent) >= 2 * percent * (F.col(f"{a}n") + F.col(f"{b}n")).cast("long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of keys whose sets are similar enough."""
    sides = [sets.select(F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("tokens").alias(f"t_{s}")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    shared = F.size(F.array_intersect("t_a", "t_b"))
    return both.where(shared * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _placed(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows with the component that `links` gives each set."""
    group = components(links).withColumnRenamed("id", "key")
    return saved(rows.join(group, "key", "left").withColumn("component", F.coalesce("component", "key")), "placed")


def _open(placed: DataFrame) -> DataFrame:
    """The rows of signatures whose sets are in several components."""
    mixed_ones = placed.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return placed.join(mixed_ones.select((F.col("sig") + 0).alias("sig")), "sig", "left_semi")


def _many_apart(placed: DataFrame) -> bool | None:
    """Whether the pairs of one signature and different components are many more than the rows; None without rows."""
    sizes = placed.groupBy("sig", "component").agg(F.count("*").cast("double").alias("m"))
    sizes = sizes.groupBy("sig").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("within"))
    rows, pairs = sizes.agg(F.sum("m"), F.sum((F.col("m") * F.col("m") - F.col("within")) / 2)).first()
    return None if rows is None else pairs > PAIRS_PER_ROW * rows


def _strays(placed: DataFrame) -> DataFrame:
    """The rows outside the component that most sets of their signature are in, with that component as `main`."""
    sizes = placed.groupBy("sig", "component").agg(F.count("*").alias("m"))
    main = sizes.groupBy("sig").agg(F.max(F.struct("m", "component"))["component"].alias("main"), F.count("*").alias("parts"))
    main = main.where("parts > 1").select((F.col("sig") + 0).alias("sig"), "main")
    return placed.join(main, "sig").where("component != main")


def _distinct_pairs(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _drawn_pairs(placed: DataFrame, percent: int, salt: int) -> DataFrame:
    """Pairs of a few sets drawn from each signature and its sets of other components.

    Every other draw is one of components, so that one component of most sets does not hide the rest.
    """
    names = placed.columns
    drawn = [F.min(F.struct(F.xxhash64("component" if way % 2 else "key", F.lit(way), F.lit(salt)).alias("drawn"), *names))
             for way in range(DRAWN)]
    drawn = placed.groupBy("sig").agg(F.array(*drawn).alias("l")).select(F.explode("l").alias("l"))
    drawn = drawn.select(*[F.col(f"l.{c}").alias(f"l_{c}") for c in names])
    near = placed.join(drawn, (F.col("sig") == F.col("l_sig")) & (F.col("component") != F.col("l_component"))
                       & _may_link("", "l_", percent) & _sketches_allow("", "l_", percent))
    return _distinct_pairs(near, "l_key", "key")


def _apart_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """All pairs of one signature and different components that may be similar enough."""
    strays = _strays(placed)
    left = strays.withColumn("sig", F.col("sig") + 0).select(*[F.col(c).alias(f"a_{c}") for c in strays.columns])
    right = placed.select(*[F.col(c).alias(f"b_{c}") for c in placed.columns])
    apart = left.join(
        right, (F.col("a_sig") == F.col("b_sig")) & (F.col("a_component") != F.col("b_component"))
        & ((F.col("a_key") < F.col("b_key")) | (F.col("b_component") == F.col("a_main")))
        & _may_link("a_", "b_", percent) & _sketches_allow("a_", "b_", percent))
    return _distinct_pairs(apart, "a_key", "b_key")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of keys that connect exactly what all similar pairs would connect.

    First each signature's sets are compared with one of them, the one with the fewest tokens of its own: what others are
    copies of. That mostly connects them. Only sets of one signature that are then still apart are compared with each other,
    those outside its largest component with all others, so copies of a text do not multiply into all pairs.

    Where many pairs of one signature are still apart, as in a large group that is just about similar, signatures take turns,
    few at first. In a turn some sets of each signature, drawn at random, are compared with those of other components, then what is
    still apart. Sets that are similar share many signatures, so the first turns connect most of what later ones would
    compare again. Each signature has one turn, no pair is compared twice. After a turn without a link all others have theirs at once.
    """
    posted = saved(_postings(sets, percent), "postings")
    lead = posted.groupBy("sig").agg(
        F.min(F.struct((F.col("n") - F.col("r")).alias("own"), "key", "n", "place", "r")).alias("l"), F.count("*").alias("m"))
    lead = lead.where("m > 1").select(
        (F.col("sig") + 0).alias("sig"), *[F.col(f"l.{c}").alias(f"l_{c}") for c in ("key", "n", "place", "r")])
    near = posted.join(lead, "sig").where(F.col("key") != F.col("l_key")).where(_may_link("", "l_", percent))
    seen = saved(_distinct_pairs(near, "l_key", "key"), "pairs")
    links = saved(_verified(seen, sets, percent), "links")

    def compare(candidates: DataFrame) -> bool:
        """Whether a pair that was not compared before is a link."""
        nonlocal seen, links
        pairs = saved(candidates.join(seen, ["a", "b"], "left_anti"), "pairs")
        more = saved(_verified(pairs, sets, percent), "links")
        seen, links = seen.unionAll(pairs), links.unionAll(more)
        return not more.isEmpty()

    open_ones = saved(_open(_placed(posted, links)), "open")
    sketched = sets.join(open_ones.select("key").distinct(), "key", "left_semi")
    open_ones = saved(open_ones.join(saved(_sketches(sketched), "sketches"), "key"), "open")
    share = F.pmod(F.xxhash64("sig"), F.lit(sum(TURNS)))
    rows, done = open_ones.drop("component"), 0
    for size in TURNS:
        mine = (share >= done) & (share < done + size)
        now = _placed(rows.where(mine), links) if done else open_ones.where(mine)
        many = _many_apart(now)
        if many is False:
            break
        done += size
        if many is None:
            continue
        linked = False
        for again in range(max(1, DRAWS // size)):
            if not many or not compare(_drawn_pairs(now, percent, DRAWS * done + again)):
                break
            linked = True
            now = _placed(rows.where(mine), links)
            many = _many_apart(now)
        if not compare(_apart_pairs(now, percent)) and not linked:
            break
    if done < sum(TURNS):
        compare(_apart_pairs(_placed(rows.where(share >= done), links) if done else open_ones, percent))
    return links


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: doc_id, n_shingles and component_id, the smallest id reachable by links.

    Two documents link when 100 * shared >= percent * (shared or not) over their sets of `words`-word shingles. Null and
    empty texts, and texts of blanks only, have empty sets and link with nothing; a text of fewer words is one shingle.
    Rows that repeat an id are one node of the graph, each with its own size. Rows without an id come back without a
    component. `percent` lies above 60. Copies meet at once by a
    64-bit key of their set. An empty table gives no rows; other columns are not
    read, so their names cannot clash.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = saved(members(rows, words), "members")
    heads = saved(known.where("id is not null and key is not null").groupBy("key").agg(F.min("id").alias("head")), "heads")
    total = known.agg(F.sum("n")).first()[0] or 0
    # A set that has more tokens of its own than any partner may miss links with nothing.
    sets = saved(shared_tokens(rows.where("id is not null"), words, total, percent).dropDuplicates(["key"]), "sets")
    links = _links(sets, percent)
    name = heads.select("key", "head")
    between = links.join(name.select(F.col("key").alias("a"), F.col("head").alias("x")), "a").join(
        name.select(F.col("key").alias("b"), F.col("head").alias("y")), "b").select("x", "y")
    copies = known.where("id is not null").join(name, "key").select(F.col("id").alias("x"), F.col("head").alias("y"))
    group = components(between.unionAll(copies), "x", "y")
    return known.join(group, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
