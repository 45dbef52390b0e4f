"""Reads a SentencePiece model file: its pieces, scores and normaliser flags.

Only the fields the operators need are decoded from the file's protobuf
messages. The model is a parameter everywhere; the driver reads the bytes once
and ships them with the task (the size of the file bounds what is shipped).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

#: Fixed values of the file format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Fixed value: the marker that stands for a space inside pieces.
MARK = "▁"


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one protobuf message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 1:
            value, at = data[at:at + 8], at + 8
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        elif kind == 5:
            value, at = struct.unpack("<f", data[at:at + 4])[0], at + 4
        else:
            raise ValueError(f"not a model file: wire type {kind}")
        yield tag >> 3, value


@dataclass
class PieceModel:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    byte_fallback: bool = False
    add_dummy_prefix: bool = True

    @property
    def unknown_id(self) -> int:
        return self.kinds.index(UNKNOWN)

    def byte_ids(self) -> list[int] | None:
        """Ids of the 256 byte pieces in byte order, or None without byte fallback."""
        if not self.byte_fallback:
            return None
        at = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        return [at[f"<0x{b:02X}>"] for b in range(256)]

    def normal_ids(self) -> dict[str, int]:
        """Pieces that may be matched in a text, with their ids."""
        return {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}

    def words_start_with_marks(self) -> bool:
        """True if no piece has a marker after another character, so that no
        piece ever crosses the start of a run of markers."""
        return not any(MARK in p.lstrip(MARK) for p in self.normal_ids())


def read_model(data: bytes) -> PieceModel:
    """Decode a model file. Raises ValueError for normalisers, user-defined
    or unused pieces that the operators do not reproduce."""
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = v
                elif n == 3:
                    kind = v
            if kind in (USER_DEFINED, UNUSED):
                raise ValueError(f"piece {piece!r}: user-defined and unused pieces are not supported")
            model.pieces.append(piece)
            model.scores.append(score)
            model.kinds.append(kind)
        elif number == 2:
            for n, v in _fields(value):
                if n == 35:
                    model.byte_fallback = bool(v)
                elif n == 24 and v:
                    raise ValueError("whitespace as suffix is not supported")
        elif number == 3:
            flags = {3: 1, 4: 1, 5: 1}
            for n, v in _fields(value):
                if n == 2 and v:
                    raise ValueError("only the identity normaliser is supported")
                if n in flags:
                    flags[n] = v
            if flags[4] or not flags[5]:
                raise ValueError("whitespace must be kept and escaped")
            model.add_dummy_prefix = bool(flags[3])
    return model


def read_model_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def marked(text: str, model_adds_prefix: bool = True) -> str:
    """The normalised form: spaces become markers, with a marker in front of a non-empty text."""
    if not text:
        return ""
    text = text.replace(" ", MARK)
    return MARK + text if model_adds_prefix else text
