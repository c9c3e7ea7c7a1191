"""Content-defined anchors: every window of ``window`` bytes of a text belongs to one of its ``gram``-byte pieces.

A window's anchor is its piece with the smallest hash (of several, the leftmost). Equal windows have equal anchors at
equal places, wherever they stand, so windows can be compared anchor by anchor.
"""

from __future__ import annotations

import numpy as np

GRAM = 24
#: Texts are read in pieces of this many bytes, each repeating the last ``window - 1`` bytes of the one before.
PIECE = 1 << 22
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on."""
    with np.errstate(over="ignore"):
        power, size = data.astype(np.uint64) + np.uint64(1), 1
        out, done = None, 0
        while True:
            if gram & size:
                if out is None:
                    out = power
                else:
                    n = len(data) - done - size + 1
                    out = out[:n] * _ODD + power[done : done + n] * _ODD2
                    out ^= out >> np.uint64(31)
                done += size
            size *= 2
            if size > gram:
                break
            half = size // 2
            power = power[: len(power) - half] * _ODD + power[half:]
            power ^= power >> np.uint64(32)
        out = out * _ODD2
        return out ^ (out >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


_LOW = np.uint64(PIECE.bit_length())


def anchor_place(context: np.ndarray, window: int, gram: int = GRAM) -> int:
    """Where the anchor that all windows of ``context`` share begins."""
    return int(np.argmin(gram_hashes(context[:window], gram) >> _LOW))


def anchors(data: np.ndarray, window: int, gram: int = GRAM):
    """(first, last, hash): the windows from ``first`` to ``last`` share an anchor with that hash. Ends are inclusive."""
    firsts, lasts, hashes = [], [], []
    for at in range(0, max(1, len(data) - window + 1), PIECE):
        part = data[at : at + PIECE + window - 1]
        if len(part) < window:
            break
        own = gram_hashes(part, gram)
        places = np.arange(len(own), dtype=np.uint64)
        best = _least((own >> _LOW << _LOW) | places, window - gram + 1)
        place = (best & ((np.uint64(1) << _LOW) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        firsts.append(first + at)
        lasts.append(np.append(first[1:], len(place)) - 1 + at)
        hashes.append(own[place[first]])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(hashes)
