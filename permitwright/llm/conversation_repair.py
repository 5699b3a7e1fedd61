"""Repair of conversation structure at least cost, by a backward programme kept only at checkpoints.

A conversation's rows, in order, are kept, given another role, deleted, or preceded by inserted ones, until the roles read as an
optional system row and pairs of user and assistant. The programme's state is the role that came last. Its costs are computed from
the end; what has to be remembered of them for the way forward is one vector per row, which is too much for a long conversation.
So rows form blocks of about the square root of the longest conversation. Of a block first only the cheapest way from each state to
each state is computed, all blocks at once. From these come, per conversation, the cost vectors at the blocks' ends: the
checkpoints. Each block then computes its own vectors again from its checkpoint and walks forward, all blocks at once again, since
a walk depends on nothing but its first state, and there are four.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permitwright.llm.common import saved

DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
# Fewest rows of a block.
LEAST_BLOCK = 64
BLANKS = " \t\n\x0b\x0c\r"
# States: nothing yet, system, user, assistant. What each may be followed by, by the role's initial.
_AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
# The state that an inserted or changed row leads to, and its role.
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_LEGAL = {"su", "ua", "au"}
# Costs after the last row: inserts until the pattern is complete.
_END = (0, 2 * INSERT, INSERT, 0)
_INITIALS = "sua"
_MUST_GO = 0
_NEVER = 1 << 60

Vector = tuple[int, int, int, int]


def code_of(role: str, faulty: bool, truncated: bool) -> int:
    """What the programme needs to know of a row: 0 if it has to go, else its initial and whether it is truncated."""
    return _MUST_GO if faulty else 1 + 2 * (_INITIALS.find(role[:1] or "-") + 1) + truncated


def _row_ways(code: int, state: int, after: Vector) -> Iterator[tuple[str, int, int]]:
    """(edit, its cost, state after it) for one row, without inserts, in ASCII order."""
    yield "D", DELETE, state
    if code != _MUST_GO:
        initial, extra = "-sua"[(code - 1) // 2], TRUNCATED * ((code - 1) % 2)
        if initial in _AFTER[state]:
            yield "K", extra, _AFTER[state][initial]
        yield "R", REROLE + extra, _NEXT[state]


def step_back(code: int, after: Vector) -> Vector:
    """Costs before a row, inserts in front of it included, from those after it."""
    base = [min(cost + after[to] for _, cost, to in _row_ways(code, state, after)) for state in range(4)]
    user, assistant = min(base[2], INSERT + base[3]), min(base[3], INSERT + base[2])
    return min(base[0], INSERT + user), min(base[1], INSERT + user), user, assistant


class Programme:
    """Steps back, remembered: vectors that differ by a constant share a step, so there are few."""

    def __init__(self) -> None:
        self._known: dict[tuple[int, Vector], Vector] = {}

    def back(self, code: int, after: Vector) -> Vector:
        least = min(after)
        key = (code, tuple(min(v - least, _NEVER) for v in after))
        if key not in self._known:
            self._known[key] = step_back(*key)
        return tuple(v + least for v in self._known[key])

    def ways(self, codes: bytes) -> list[int]:
        """Least costs from each state before a block to each state after it, row by row of the matrix."""
        ends = []
        for end in range(4):
            vector = tuple(0 if s == end else _NEVER for s in range(4))
            for code in reversed(codes):
                vector = self.back(code, vector)
            ends.append(vector)
        return [min(ends[end][start], _NEVER) for start in range(4) for end in range(4)]

    def walk(self, codes: bytes, after: Vector, state: int, last: bool) -> tuple[str, int]:
        """The block's ASCII-least cheapest edits from `state` on, and the state they end in; `after` is its checkpoint."""
        vectors = [after]
        for code in reversed(codes):
            vectors.append(self.back(code, vectors[-1]))
        vectors.reverse()
        edits = []
        place = 0
        while place < len(codes):
            left, ways = vectors[place][state], {}
            for edit, cost, to in _row_ways(codes[place], state, vectors[place + 1]):
                if cost + vectors[place + 1][to] == left:
                    ways[edit] = to
            if INSERT + vectors[place][_NEXT[state]] == left:
                ways["I"] = _NEXT[state]
            edit = min(ways)
            edits.append(edit)
            state = ways[edit]
            place += edit != "I"
        while last and _END[state]:
            edits.append("I")
            state = _NEXT[state]
        return "".join(edits), state


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) with faults planted by a hash of conversation and turn; nulls count as one space.

    The remainder of crc32 by 20 decides: 0 drops a row, 1 empties its text, 2 takes the full stops out, 3 repeats it, 4 makes it
    the user's.
    """
    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", told("role").alias("role"), told("text").alias("text"), kind.alias("_kind"))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1))
    return marked.where("_kind != 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_n")).drop("_n")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in conversation order, ranged over partitions, and before the first of all rows with one role and text a mark.

    A long conversation spreads over partitions. Marks come from an aggregate, so that no task has to remember what a
    conversation has said; they sort next to the row they stand for, so that they meet without a join.
    """
    identity = ["cid", "known", "at", "role", "h1", "h2"]
    told = rows.select(
        F.col("conv_id").cast("string").alias("cid"), F.col("turn").isNotNull().alias("known"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("at"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"))
    told = told.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit("|"), "text"), "kind": F.lit(1)})
    spoken = told.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    first = spoken.groupBy("cid", "role", "h1", "h2").agg(F.min(F.struct("known", "at")).alias("f"))
    marks = first.select("cid", "f.known", "f.at", "role", F.lit(None).cast("string").alias("text"), "h1", "h2", F.lit(0).alias("kind"))
    every = told.select(marks.columns).unionByName(marks)
    return every.repartitionByRange(*identity).sortWithinPartitions(*identity, "kind")


_BLOCK = (
    "cid string, part int, no int, codes binary, roles array<string>, texts array<string>, ways array<long>, blank long, duplicate long, "
    "truncated long, illegal long, first string, last string, turns long, low long, high long"
)


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """The rows in blocks of at most `size` of one conversation, numbered in order, with counts and the ways through each."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[dict]:
        part, programme = TaskContext.get().partitionId(), Programme()
        block: dict = {}
        number = 0
        mark: tuple | None = None

        def closed() -> dict:
            codes = bytes(block.pop("codes"))
            return block | {"part": part, "no": number, "codes": codes, "ways": programme.ways(codes)}

        for frame in frames:
            for cid, known, at, role, text, h1, h2, kind in frame.itertuples(index=False, name=None):
                me = (cid, known, at, role, h1, h2)
                if kind == 0:
                    mark = me
                    continue
                if block and (block["cid"] != cid or len(block["codes"]) >= size):
                    yield closed()
                    block, number = {}, number + 1
                if not block:
                    block = {"cid": cid, "codes": [], "roles": [], "texts": [], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                             "first": role[:1], "last": None, "turns": 0, "low": None, "high": None}
                shown = text.rstrip(BLANKS)
                blank, duplicate = not shown, bool(shown) and mark != me
                mark = None if mark == me else mark
                cut = not blank and not duplicate and shown[-1] not in ".!?"
                block["blank"] += blank
                block["duplicate"] += duplicate
                block["truncated"] += cut
                block["illegal"] += block["last"] is not None and block["last"] + role[:1] not in _LEGAL
                block["last"] = role[:1]
                if known:
                    block["turns"] += at != block["high"]
                    block["low"], block["high"] = at if block["low"] is None else block["low"], at
                block["codes"].append(code_of(role, blank or duplicate, cut))
                block["roles"].append(role)
                block["texts"].append(text)
        if block:
            yield closed()

    columns = ["cid", "known", "at", "role", "text", "h1", "h2", "kind"]
    found = _ordered(rows).select(*columns).mapInPandas(lambda frames: _framed(run(frames)), _BLOCK)
    return found


def _framed(rows: Iterator[dict], at_once: int = 500) -> Iterator[pd.DataFrame]:
    """Rows as frames of a few hundred."""
    names = [f.split()[0] for f in _BLOCK.split(", ")]
    while held := list(islice(rows, at_once)):
        yield pd.DataFrame(held, columns=names).astype({"low": "Int64", "high": "Int64"})


def checkpoints(found: DataFrame) -> DataFrame:
    """Per conversation its counts, least cost, and the cost vectors at its blocks' ends: as many as it has blocks."""
    small = [c for c in found.columns if c not in ("cid", "codes", "roles", "texts")]
    order = F.struct(*[F.col(c) for c in ["part", "no"] + [c for c in small if c not in ("part", "no")]])
    listed = found.groupBy("cid").agg(F.array_sort(F.collect_list(order)).alias("parts"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for cid, parts in frame[["cid", "parts"]].itertuples(index=False):
                vector, ends = _END, []
                for p in reversed(parts):
                    ends.append({"part": p["part"], "no": p["no"], "after": list(vector), "ending": not ends})
                    vector = tuple(min(p["ways"][4 * s + e] + vector[e] for e in range(4)) for s in range(4))
                turns, illegal, before, high = 0, 0, None, None
                dated = [p for p in parts if p["low"] is not None]
                for p in parts:
                    illegal += p["illegal"] + (before is not None and before + p["first"] not in _LEGAL)
                    before = p["last"]
                for p in dated:
                    turns += p["turns"] - (p["low"] == high)
                    high = p["high"]
                gaps = high - dated[0]["low"] + 1 - turns if dated else 0
                counts = {k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated")}
                out.append({"cid": cid, "gaps": gaps, **counts, "illegal": illegal, "cost": vector[0], "ends": ends})
            yield pd.DataFrame(out)

    return listed.mapInPandas(
        run, "cid string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "ends array<struct<part: int, no: int, after: array<long>, ending: boolean>>")


def _first_states(found: DataFrame, ends: DataFrame) -> DataFrame:
    """(part, no, state): the state in which each block's walk begins."""

    def walks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        programme = Programme()
        for frame in frames:
            to = [[programme.walk(codes, tuple(after), s, last)[1] for s in range(4)]
                  for codes, after, last in frame[["codes", "after", "ending"]].itertuples(index=False)]
            yield frame[["cid", "part", "no"]].assign(to=to)

    def chained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for parts in frame["parts"]:
                state = 0
                for p in parts:
                    out.append((p["part"], p["no"], state))
                    state = p["to"][state]
            yield pd.DataFrame(out, columns=["part", "no", "state"])

    met = found.select("cid", "part", "no", "codes").join(ends, ["part", "no"])
    to = met.mapInPandas(walks, "cid string, part int, no int, to array<int>")
    listed = to.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("part", "no", "to"))).alias("parts"))
    return listed.select("parts").mapInPandas(chained, "part int, no int, state int")


def _edited(found: DataFrame, ends: DataFrame, states: DataFrame) -> DataFrame:
    """Per block its edits, its repaired rows as `role:text` lines, and whether it is its conversation's only one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        programme = Programme()
        for frame in frames:
            out = []
            for cid, part, no, only, codes, roles, texts, after, last, state in frame[names].itertuples(index=False):
                edits, _ = programme.walk(codes, tuple(after), state, last)
                lines, place = [], 0
                for edit in edits:
                    if edit == "I":
                        state = _NEXT[state]
                        lines.append(f"{_ROLE[state]}:")
                        continue
                    if edit != "D":
                        state = _NEXT[state] if edit == "R" else _AFTER[state][roles[place][:1]]
                        lines.append(f"{_ROLE[state] if edit == 'R' else roles[place]}:{texts[place]}")
                    place += 1
                out.append((cid, part, no, only, edits, lines))
            yield pd.DataFrame(out, columns=["cid", "part", "no", "only", "edits", "lines"])

    names = ["cid", "part", "no", "only", "codes", "roles", "texts", "after", "ending", "state"]
    met = found.join(ends, ["part", "no"]).join(states, ["part", "no"]).select(*names)
    return met.mapInPandas(run, "cid string, part int, no int, only boolean, edits string, lines array<string>")


def _digests(edited: DataFrame) -> DataFrame:
    """(cid, sha): of a conversation's lines. A long one streams through one task, block by block: a digest has no other way."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, cid, sha, fresh = [], None, None, True
        for frame in frames:
            for this, lines in frame[["cid", "lines"]].itertuples(index=False):
                if sha is None or this != cid:
                    if sha is not None:
                        done.append((cid, sha.hexdigest()))
                    cid, sha, fresh = this, hashlib.sha256(), True
                if len(lines):
                    sha.update((("" if fresh else "\n") + "\n".join(lines)).encode("utf-8", "replace"))
                    fresh = False
            yield pd.DataFrame(done, columns=["cid", "sha"])
            done = []
        if sha is not None:
            yield pd.DataFrame([(cid, sha.hexdigest())], columns=["cid", "sha"])

    single = edited.where("only").select("cid", F.sha2(F.array_join("lines", "\n"), 256).alias("sha"))
    several = edited.where("not only").repartition("cid").sortWithinPartitions("cid", "part", "no").select("cid", "lines")
    return single.unionAll(several.mapInPandas(run, "cid string, sha string"))


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, blocks) of rows of (conv_id, turn, role, text).

    The first has one row per conversation with cid (the id as text), gaps, blank, duplicate, truncated, illegal and cost. The second
    has the edits and the repaired `role:text` lines of each block; blocks sort by part and no.
    """
    longest = rows.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    found = saved(blocks(rows, max(LEAST_BLOCK, math.isqrt(longest))), "blocks")
    plans = saved(checkpoints(found), "checkpoints")
    ends = plans.select(F.explode("ends").alias("e"), (F.size("ends") == 1).alias("only")).select("e.*", "only")
    states = saved(_first_states(found, ends.drop("only")), "states")
    return plans.drop("ends"), saved(_edited(found, ends, states), "edited")


def repair_conversations(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conv_id of `rows`, or of `conversations` (also those without rows): what is wrong and the cheapest repair.

    Columns: conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs), audit and repaired_sha256.
    Rows are taken by turn, nulls first; rows of one turn by role and text hash, which puts equal ones side by side. Null roles
    and texts count as one space. Rows without conv_id are one conversation of their own. Rows that repeat another are duplicates of
    it. Ids without rows have zeros, an empty audit and the digest of the empty string; an empty table gives no rows. Other columns
    are not read, so their names cannot clash. The audit is as long as the conversation, as its contract has it.
    """
    plans, edited = repaired(rows)
    audit = edited.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("part", "no", "edits"))).alias("e"))
    audit = audit.select(F.col("cid").alias("_a"), F.array_join("e.edits", "").alias("audit"))
    sha = _digests(edited).select(F.col("cid").alias("_s"), "sha")
    told = plans.join(audit, F.col("cid").eqNullSafe(F.col("_a"))).join(sha, F.col("cid").eqNullSafe(F.col("_s")))
    ids = (conversations if conversations is not None else rows).select("conv_id").distinct()
    whole = ids.join(told, F.col("conv_id").cast("string").eqNullSafe(F.col("cid")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", nothing).alias("repaired_sha256"))
