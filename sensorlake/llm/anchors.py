"""Anchors of the windows of a text: places that two equal windows choose alike, wherever they stand."""

from __future__ import annotations

import numpy as np

from sensorlake.llm.common import mix

BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = mix(np.arange(1, 257, dtype=np.uint64))
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes of a text that are worked on at once, and the bits of a place within them.
PART, PLACE_BITS = 1 << 20, np.uint64(22)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_N = PART + (1 << 13)
_UP, _DOWN = _powers(BASE, _N), _powers(INVERSE, _N)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place; the same for the same bytes anywhere (up to ``PART`` bytes at once)."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_SPREAD[data] * _UP[:n], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * _DOWN[:n - size + 1])


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: running minima of blocks, from both ends."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(data: bytes, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(hash, place, first, last)``: the windows that start at ``first`` to ``last`` have their anchor, the gram of least hash (the
    first of equal ones), at ``place``. Each window of the text is in one of these runs, or in two equal ones where parts meet."""
    whole = np.frombuffer(data, np.uint8)
    found: list[list[np.ndarray]] = []
    for at in range(0, max(1, len(whole) - window + 1), PART):
        part = whole[at:at + PART + window - 1]
        if len(part) < window:
            break
        h = gram_hashes(part, gram)
        # The place in the low bits makes values distinct, so the least one also says where it is.
        ranked = h >> PLACE_BITS << PLACE_BITS | np.arange(len(h), dtype=np.uint64)
        place = (_window_least(ranked, window - gram + 1) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        ends = np.r_[starts[1:], len(place)] - 1
        found.append([h[place[starts]], place[starts] + at, starts + at, ends + at])
    if not found:
        return tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*found))
