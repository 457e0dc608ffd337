"""Reading and writing of sentencepiece model files, without a protobuf library.

Only the fields used here are known by number; others pass through unchanged.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

#: Fixed values of the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(number, value, the field as it stands) of each field."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        start = at
        key = varint()
        kind = key & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) if kind != 2 else varint()
            value = data[at : at + size]
            at += size
        yield key >> 3, value, data[start:at]


def _identity_normaliser() -> bytes:
    return _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)


def write_model(pieces: Iterable[tuple[str, float, int]], unk_id: int) -> bytes:
    """A BPE model that leaves its input as it is: no prefix, no white-space handling."""
    pieces = list(pieces)
    body = b"".join(_field(1, _field(1, p.encode()) + _field(2, float(s)) + _field(3, t)) for p, s, t in pieces)
    trainer = _field(3, BPE) + _field(4, len(pieces)) + _field(40, unk_id)
    return body + _field(2, trainer) + _field(3, _identity_normaliser())


def read_pieces(model: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, type) in the order of ids."""
    found = []
    for number, value, _ in _fields(model):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v, _ in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            found.append((piece, score, kind))
    return found


def read_normaliser(model: bytes) -> dict:
    """The settings that decide how a text becomes the string that is merged."""
    found = {"charsmap": b"", "add_dummy_prefix": 1, "remove_extra_whitespaces": 1, "escape_whitespaces": 1}
    names = {2: "charsmap", 3: "add_dummy_prefix", 4: "remove_extra_whitespaces", 5: "escape_whitespaces"}
    for number, value, _ in _fields(model):
        if number == 3:
            for n, v, _ in _fields(value):
                if n in names:
                    found[names[n]] = v
    return found


def without_normaliser(model: bytes) -> bytes:
    """The same model for strings that are normalised already."""
    return b"".join(raw for number, _, raw in _fields(model) if number != 3) + _field(3, _identity_normaliser())
