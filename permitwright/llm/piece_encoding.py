"""SentencePiece encoding of the merge type by backtracking, and decoding.

A sequence of pieces is the encoding of a text exactly if each two neighbours are what their joined string encodes to. So
the encoder walks from left to right, takes the longest piece that matches and agrees with the piece before it, falls back
to shorter ones, and steps back where none is left; a bitfield remembers the positions from which no way leads on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from permitwright.llm.common import batches

_BLANK = "▁"
_CHUNK = re.compile("\n|▁*[^▁\n]+|▁+")
# Entries of a worker's memories of encoded words, of which it keeps two, and of compared neighbours.
_WORDS_KEPT = 200_000
_PAIRS_KEPT = 500_000
_NEVER = float("inf")


class PieceModel:
    """The pieces of a SentencePiece model file of type BPE with byte fallback and without text normalisation.

    Other models raise ValueError: their texts would have to be normalised, or segmented by another rule.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = model.SentencePiece
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
            raise ValueError("not a BPE model with byte fallback")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("the model normalises texts")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("the model has user-defined or unused pieces")
        self.prefix = _BLANK if spec.add_dummy_prefix else ""
        self.score = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        ids = {p.piece: i for i, p in enumerate(model.pieces)}
        self.bytes = [ids[f"<0x{b:02X}>"] for b in range(256)]
        self.text = [
            bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE
            else p.piece.replace(_BLANK, " ").encode() if p.type == kinds.NORMAL
            else model.trainer_spec.unk_surface.encode() if p.type == kinds.UNKNOWN else b""
            for p in model.pieces
        ]
        self.opens_with_blank = [p.type == kinds.NORMAL and p.piece.startswith(_BLANK) for p in model.pieces]
        # Pieces that merging never yields cannot occur; single characters always can.
        real = [p for p in self.score if len(p) == 1 or self.merged(p) == [p]]
        self.id = {p: ids[p] for p in real}
        self.size = {ids[p]: len(p) for p in real}
        self.piece = {ids[p]: p for p in real}
        self.shorter = {ids[p]: next((ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id), -1) for p in real}
        # Where no piece has two characters side by side, a text may be cut between them.
        self.beside = {p[i : i + 2] for p in real for i in range(len(p) - 1)}
        self.found = ahocorasick.Automaton()
        for p in real:
            self.found.add_word(p, (len(p) - 1, ids[p]))
        self.found.make_automaton()
        self.agreeing: dict[int, bool] = {}
        # Words encoded lately, and those before them.
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merged(self, text: str) -> list[str]:
        """A short string's pieces by merging itself: the best-scored neighbours first, leftmost on a tie."""
        parts, score = list(text), self.score
        costs = [-score[a + b] if a + b in score else _NEVER for a, b in zip(parts[:-1], parts[1:], strict=True)]
        while costs and (least := min(costs)) < _NEVER:
            at = costs.index(least)
            parts[at] += parts.pop(at + 1)
            costs.pop(at)
            for i in (at - 1, at):
                if 0 <= i < len(costs):
                    costs[i] = -score.get(parts[i] + parts[i + 1], -_NEVER)
        return parts

    def agree(self, left: int, right: int) -> bool:
        """Whether two pieces stay as they are when their joined string is merged anew."""
        known = self.agreeing.get(left << 32 | right)
        if known is None:
            if len(self.agreeing) > _PAIRS_KEPT:
                self.agreeing.clear()
            one, two = self.piece[left], self.piece[right]
            known = self.agreeing[left << 32 | right] = (
                one[-1] + two[0] not in self.beside or self.merged(one + two) == [one, two])
        return known

    def _walk(self, text: str) -> list[int]:
        """Ids of a string whose characters all are pieces."""
        size, agree, length, shorter = len(text), self.agree, self.size, self.shorter
        longest = [0] * size
        # Matches come by ascending end, so the last one kept for a start is the longest.
        for end, (back, piece) in self.found.iter(text):
            longest[end - back] = piece
        taken: list[int] = []
        failed, at, piece = 0, 0, longest[0]
        while True:
            if piece < 0:
                # Nothing is left here: no way leads on from this position.
                failed |= 1 << at
                piece = taken.pop()
                at -= length[piece]
                piece = shorter[piece]
                continue
            end = at + length[piece]
            if not failed >> end & 1 and (not taken or agree(taken[-1], piece)):
                taken.append(piece)
                if end == size:
                    return taken
                at, piece = end, longest[end]
            else:
                piece = shorter[piece]

    def _known(self, word: str) -> tuple[int, ...] | None:
        found = self.older.get(word)
        if found is not None:
            self.words[word] = found
        return found

    def _cut(self, word: str) -> tuple[int, ...]:
        """Ids of a word, part by part between the places where no piece can reach across."""
        out: list[int] = []
        start, beside, size = 0, self.beside, len(word)
        for i in range(1, size + 1):
            if i < size and word[i - 1 : i + 1] in beside:
                continue
            part, start = word[start:i], i
            if len(part) == 1:
                out += [self.id[part]] if part in self.id else [self.bytes[b] for b in part.encode("utf-8", "replace")]
                continue
            known = self.words.get(part) or self._known(part)
            if known is None:
                known = tuple(self._walk(part))
                if len(part) < size:
                    self.words[part] = known
            out += known
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, as the library's encode gives them without begin, end or sampling.

        Blanks open words: no piece has one after another character, so words are encoded by themselves.
        """
        if not text:
            return []
        if len(self.words) > _WORDS_KEPT:
            self.words, self.older = {}, self.words
        words = self.words
        out: list[int] = []
        for chunk in _CHUNK.findall(self.prefix + text.replace(" ", _BLANK)):
            known = words.get(chunk)
            if known is None:
                known = words[chunk] = self._known(chunk) or self._cut(chunk)
            out += known
        return out

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of ids, as the library's decode gives it; the blank put before a text goes."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        if not ids:
            return ""
        data = b"".join(map(self.text.__getitem__, ids))
        return data[bool(self.prefix) and self.opens_with_blank[ids[0]] :].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model per worker process."""
    return PieceModel(path)


def encoded(text: Column, path: str) -> Column:
    """A text column as arrays of ids; a null text counts as empty and has no ids."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def run(texts: pd.Series) -> pd.Series:
        model = piece_model(path)
        return pd.Series([np.array(model.encode(t or ""), np.int32) for t in texts], dtype=object)

    return run(text)


def decoded(ids: Column, path: str) -> Column:
    """An array column of ids as texts; null ids are the empty text."""

    @F.pandas_udf(StringType())
    def run(column: pd.Series) -> pd.Series:
        model = piece_model(path)
        return pd.Series([model.decode(i) if i is not None else "" for i in column], dtype=object)

    return run(ids)


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) per row. Null texts count as empty; null ids and repeated rows are kept.

    A text is encoded whole, however long; the work of a step back is bounded by the word. An empty table gives no rows,
    and other columns are not read, so their names cannot clash. Rows are handed on a few hundred at a time.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = piece_model(path)
        for frame in batches(frames, 200):
            ids = [model.encode(t or "") for t in frame["text"]]
            texts = [model.decode(i) for i in ids]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": [np.array(i, np.int32) for i in ids], "decoded": texts})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, ids array<int>, decoded string")
