"""Hashes of words and of five-word shingles, computed for many texts at once with numpy."""

from __future__ import annotations

import re
from functools import cache

import numpy as np

WIDTH = 5
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes that are hashed at once; longer texts are cut at white space.
_PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte (equal for a letter's two cases), which bytes are white space, factors of a shingle's words."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    values[65:91] = values[97:123]
    space = np.zeros(256, bool)
    space[[32, *range(9, 14)]] = True
    return values, space, mix(np.arange(1001, 1001 + WIDTH, dtype=np.uint64)) | np.uint64(1)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    base = 0x5851F42D4C957F2D
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _pieces(text: bytes) -> list[bytes]:
    out, at = [], 0
    while len(text) - at > _PIECE:
        cut = _SPACE.search(text, at + _PIECE)
        if cut is None:
            break
        out.append(text[at : cut.start()])
        at = cut.end()
    return [*out, text[at:]]


def _hashes(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a block and the place where it starts."""
    values, space, _ = _tables()
    data = np.frombuffer(block, np.uint8)
    blank = space[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(1 << max(12, int(len(data) + 1).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=total[1:])
    words = (total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    return mix(words), starts


def word_hashes(texts: list[bytes | None]) -> list[np.ndarray]:
    """For each text the hashes of its words, A-Z lower-cased. A null text has no words."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    owners, block, size = [], [], 0

    def flush() -> None:
        if not block:
            return
        words, starts = _hashes(b" ".join(block))
        begin = np.cumsum([0, *(len(b) + 1 for b in block)])
        cut = np.searchsorted(starts, begin)
        for k, owner in enumerate(owners):
            out[owner].append(words[cut[k] : cut[k + 1]])
        owners.clear(), block.clear()

    for i, text in enumerate(texts):
        for piece in _pieces(text or b""):
            if size + len(piece) > _PIECE:
                flush()
                size = 0
            owners.append(i)
            block.append(piece)
            size += len(piece) + 1
    flush()
    return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]


def shingles(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of the runs of ``width`` words, in order and with repeats; fewer words are one run, none give none."""
    if not len(words):
        return np.empty(0, np.uint64)
    factors = _tables()[2] if width == WIDTH else mix(np.arange(1001, 1001 + width, dtype=np.uint64)) | np.uint64(1)
    n = max(1, len(words) - width + 1)
    total = np.full(n, min(len(words), width), np.uint64)
    for j in range(min(width, len(words))):
        total += words[j : j + n] * factors[j]
    return mix(total)
