"""Sentence-piece encoding by a Viterbi pass that an Aho-Corasick automaton over the pieces drives, and decoding.

The automaton reads each character once. Wherever it stands, its state and the chain of output links
name every piece that ends there, longest first; each relaxes the best score at that position. The
path with the highest sum of scores wins; on equal sums the one whose last piece is longest, and so on
backwards. A character no piece covers is one unknown symbol, 10 below the lowest score, and is
written as its UTF-8 bytes' pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import list_array, map_arrow, record_batch, slices, texts_of
from casefile.llm.pieces import SPACE_MARK, PieceTable, UnitMemo, load_pieces, prepared, split_units

UNKNOWN_PENALTY = 10.0


class Automaton:
    """Trie with failure and output links; state 0 is the root."""

    def __init__(self, ids: dict[str, int], scores: dict[str, float]):
        self.step: list[dict[str, int]] = [{}]
        self.ends: list[tuple[int, float, int] | None] = [None]  # length, score, id of the piece that a state spells
        for piece, number in ids.items():
            state = 0
            for char in piece:
                following = self.step[state].get(char)
                if following is None:
                    following = self.step[state][char] = len(self.step)
                    self.step.append({})
                    self.ends.append(None)
                state = following
            if piece:
                self.ends[state] = (len(piece), scores[piece], number)
        self.fail = [0] * len(self.step)
        self.output = [0] * len(self.step)  # nearest state down the failure links that spells a piece
        order = list(self.step[0].values())
        for state in order:  # grows while it is read: breadth first
            for char, following in self.step[state].items():
                back = self.fail[state]
                while back and char not in self.step[back]:
                    back = self.fail[back]
                self.fail[following] = back = self.step[back].get(char, 0)
                self.output[following] = back if self.ends[back] else self.output[back]
                order.append(following)

    def segment(self, unit: str, unknown: float) -> list[tuple[int, int, int]]:
        """(start, end, id) of the best path's pieces in order; id -1 is an unknown character."""
        step, ends, fail, output = self.step, self.ends, self.fail, self.output
        best = [0.0] + [float("-inf")] * len(unit)
        back: list[tuple[int, int]] = [(0, -1)] * (len(unit) + 1)
        state = 0
        for end, char in enumerate(unit, 1):
            while state and char not in step[state]:
                state = fail[state]
            state = step[state].get(char, 0)
            at = state if ends[state] else output[state]
            covered = False
            while at:
                length, score, number = ends[at]
                covered |= length == 1
                total = best[end - length] + score
                if total > best[end]:
                    best[end], back[end] = total, (end - length, number)
                at = output[at]
            if not covered:
                total = best[end - 1] + unknown
                if total > best[end]:
                    best[end], back[end] = total, (end - 1, -1)
        path, end = [], len(unit)
        while end:
            start, number = back[end]
            path.append((start, end, number))
            end = start
        return path[::-1]


class Codec:
    """encode(text) -> int32 array, decode(ids) -> text.

    An exact codec writes a literal U+2581 as its bytes' pieces, so it differs from a space; else it becomes one.
    """

    def __init__(self, table: PieceTable, exact: bool = False):
        self.table, self.exact = table, exact
        self.automaton = Automaton(table.ids, table.scores)
        self.unknown = min(table.scores.values()) - UNKNOWN_PENALTY
        self.units = split_units(table)
        self.memo = UnitMemo(self._unit, limit=300_000)
        byte_of = {number: bytes([b]) for b, number in enumerate(table.byte_ids)}
        self.spelled = [
            byte_of.get(i, piece.replace(SPACE_MARK, " ").encode("utf-8") if piece in table.ids else b"") for i, piece in enumerate(table.pieces)
        ]
        # the space that encoding puts in front: of pieces that begin with the mark, or as bytes if there is no such piece
        self.leads = [piece.startswith(SPACE_MARK) for piece in table.pieces]
        self.no_mark = SPACE_MARK not in table.ids
        self.mark = np.array([table.byte_ids[b] for b in SPACE_MARK.encode("utf-8")], np.int32).tobytes()

    def _unit(self, unit: str) -> bytes:
        numbers = []
        for start, _, number in self.automaton.segment(unit, self.unknown):
            if number < 0:
                char = " " if self.exact and unit[start] == SPACE_MARK else unit[start]  # a vocabulary without the mark
                numbers += [self.table.byte_ids[b] for b in char.encode("utf-8")]
            else:
                numbers.append(number)
        return np.array(numbers, dtype=np.int32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if self.exact and SPACE_MARK in text:
            first, *rest = text.split(SPACE_MARK)
            parts = [prepared(first) or SPACE_MARK, *(part.replace(" ", SPACE_MARK) for part in rest)]
            return np.frombuffer(self.mark.join(map(self._pieces, parts)), dtype=np.int32)
        return np.frombuffer(self._pieces(prepared(text)), dtype=np.int32)

    def _pieces(self, whole: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.units(whole)))

    def decode(self, ids) -> str:
        """The text of any ids; control pieces spell nothing, bytes that are no UTF-8 become U+FFFD.

        A space goes only where the first piece that spells anything begins with it, as the library has it.
        """
        numbers = ids.tolist() if isinstance(ids, np.ndarray) else ids
        first = next((i for i in numbers if self.spelled[i]), None)
        text = b"".join(map(self.spelled.__getitem__, numbers)).decode("utf-8", "replace")
        text = text if self.exact else text.replace(SPACE_MARK, " ")
        put = first is not None and (self.leads[first] or self.no_mark)
        return text[1:] if put and text.startswith(" ") else text


_CODECS: dict[tuple[str, bool], Codec] = {}  # one per Python worker, vocabulary and kind


def _codec(vocabulary: str, table, exact: bool) -> Codec:
    if (vocabulary, exact) not in _CODECS:
        _CODECS[vocabulary, exact] = Codec(table.value, exact)
    return _CODECS[vocabulary, exact]


_ENCODED = [
    ("doc_id", pa.int64()),
    ("n_tokens", pa.int64()),
    ("token_ids", pa.list_(pa.int32())),
    ("round_trip", pa.bool_()),
]


def encode(df: DataFrame, vocabulary: str, id_col="doc_id", text_col="text", exact: bool = False) -> DataFrame:
    """doc_id, n_tokens, token_ids, and round_trip: whether decoding the ids gives the text again.

    With `exact` a literal U+2581 is kept, as bytes, and round_trip compares with the text itself. Without,
    it decodes to a space and round_trip compares with that. `decode` needs the same choice. Null and empty texts have no tokens; a null id stays null; repeated
    rows are encoded each; an empty table gives no rows; other columns are not read. Whole texts of any
    length are encoded; rows need no shuffle.
    """
    table = df.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))  # as large as the vocabulary

    def run(batches):
        codec = _codec(vocabulary, table, exact)
        for batch in (part for whole in batches for part in slices(whole, 1)):
            texts = texts_of(batch.column(1))
            ids = [codec.encode(text) for text in texts]
            same = [codec.decode(x) == (t if exact else t.replace(SPACE_MARK, " ")) for x, t in zip(ids, texts, strict=True)]
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            lists = list_array(flat, map(len, ids), pa.int32())
            yield record_batch(_ENCODED, batch.column(0), [len(x) for x in ids], lists, same)
        codec.memo.forget()

    chosen = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(chosen, run, "doc_id long, n_tokens long, token_ids array<int>, round_trip boolean")


def decode(df: DataFrame, vocabulary: str, id_col="doc_id", ids_col="token_ids", exact: bool = False) -> DataFrame:
    """doc_id and text of rows of token ids; null ids give an empty text. Ids outside the vocabulary raise.

    Any ids decode, as the library does it: also a slice of a text's, or another encoder's.
    """
    table = df.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))

    def run(batches):
        codec = _codec(vocabulary, table, exact)
        for batch in batches:
            texts = [codec.decode(x or []) for x in batch.column(1).to_pylist()]
            yield record_batch([("doc_id", pa.int64()), ("text", pa.string())], batch.column(0), texts)

    chosen = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("token_ids"))
    return map_arrow(chosen, run, "doc_id long, text string")
