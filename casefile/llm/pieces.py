"""A sentence-piece vocabulary as plain data, and the units no piece crosses.

Shared by the token counter (bpe_count) and the encoder (piece_codec). A text is prepared as the
model says: one space is put in front of a text that is not empty, and every space becomes U+2581.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

SPACE_MARK = "▁"


@dataclass(frozen=True)
class PieceTable:
    """Pieces by id. `scores` holds those a text can match; the others stand for bytes, controls, unknown."""

    pieces: tuple[str, ...]
    scores: dict[str, float] = field(repr=False)
    ids: dict[str, int] = field(repr=False)
    byte_ids: tuple[int, ...] = field(repr=False)  # id of byte 0, 1, ...
    unit: str = field(repr=False)  # pattern of the units


def load_pieces(path: str) -> PieceTable:
    """Read a vocabulary with byte fallback and no text normalisation but the space mark.

    A unit is a run of space marks with the characters up to the next mark. No piece has a mark after
    another character, so none crosses a unit's end. Line breaks are units of their own when no piece
    holds one. A vocabulary for which this does not hold makes the whole text one unit.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = tuple(model.id_to_piece(i) for i in range(model.get_piece_size()))
    special = {
        i for i in range(len(pieces)) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
    }
    ids = {piece: i for i, piece in enumerate(pieces) if i not in special}
    by_byte = {pieces[i]: i for i in special if model.is_byte(i)}
    byte_ids = tuple(by_byte[f"<0x{b:02X}>"] for b in range(256))
    if any(SPACE_MARK in piece.lstrip(SPACE_MARK) for piece in ids):
        unit = r"(?s).+"
    elif any("\n" in piece for piece in ids):
        unit = f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+"
    else:
        unit = f"\n|{SPACE_MARK}*[^{SPACE_MARK}\n]+|{SPACE_MARK}+"
    return PieceTable(pieces, {p: model.get_score(i) for p, i in ids.items()}, ids, byte_ids, unit)


def prepared(text: str) -> str:
    return SPACE_MARK + text.replace(" ", SPACE_MARK) if text else ""


class UnitMemo(dict):
    """Unit -> its result. Two generations of at most `limit` units each bound the memory; long units are not kept."""

    def __init__(self, compute, limit: int, longest: int = 40):
        super().__init__()
        self.compute, self.limit, self.longest, self.older = compute, limit, longest, {}

    def __missing__(self, unit: str):
        value = self.older.get(unit)
        if value is None:
            value = self.compute(unit)
        if len(unit) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[unit] = value
        return value

    def forget(self) -> None:
        """At the end of a task: the worker lives on and may serve other work."""
        self.clear()
        self.older = {}


def split_units(table: PieceTable):
    return re.compile(table.unit).findall
