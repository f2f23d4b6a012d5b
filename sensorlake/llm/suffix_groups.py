"""Sorted suffixes of symbol sequences, only where a window of a given length occurs twice.

Sequences are laid end to end, each with symbols and an end symbol of its own, so that no window of one sequence equals a window of
another one. Places are ordered by prefix doubling: each round orders the still undecided places by the two halves of a
window twice as long. A place whose window is decided before the window reaches ``least`` has no partner that shares ``least``
symbols, and is left out.
"""

from __future__ import annotations

import numpy as np


def lay_out(sequences: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all sequences, each followed by its end symbol, and the place where each sequence starts."""
    parts, starts, at, used = [], [], 0, 0
    for items in sequences:
        code = {item: used + k for k, item in enumerate(set(items))}
        symbols = np.fromiter(map(code.__getitem__, items), np.int64, len(items))
        parts += [symbols, np.array([used + len(code)])]
        starts.append(at)
        at, used = at + len(items) + 1, used + len(code) + 1
    return np.concatenate(parts) if parts else np.empty(0, np.int64), np.array(starts, np.int64)


def _group_starts(new: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The place of the first member of each one's group, ``new`` marking the first members."""
    return place[new][np.cumsum(new) - 1]


def repeated_suffixes(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The places whose next ``window`` symbols occur twice, in suffix order, and the number of the window's group for each;
    ``window`` is the largest power of two that is not over ``least``."""
    n = len(symbols)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    active, window = np.argsort(symbols, kind="stable"), 1
    ordered = symbols[active]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(n, np.int64)
    rank[active] = _group_starts(new, np.arange(n))
    found = group = np.empty(0, np.int64)
    while True:
        twice = ~(new & np.r_[new[1:], True])
        active = active[twice]
        if window * 2 > least and not len(found):
            found, group = active, rank[active]
        if not len(active):
            break
        key = rank[active] * np.int64(n + 1) + rank[active + window]
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        at = np.arange(len(active))
        place = old + at - _group_starts(np.r_[True, old[1:] != old[:-1]], at)
        new = np.r_[True, key[1:] != key[:-1]]
        rank[active] = _group_starts(new, place)
        window *= 2
    order = np.argsort(rank[found], kind="stable")
    return found[order], group[order]


def common_prefixes(symbols: np.ndarray, suffixes: np.ndarray, groups: np.ndarray, least: int) -> list[int]:
    """Common prefix of each of ``suffixes`` with the one before it, 0 where a group starts. In text order the value falls by one at
    most from place to place, so each symbol is compared about once."""
    text, sa, group = symbols.tolist(), suffixes.tolist(), groups.tolist()
    window = 1 << (least.bit_length() - 1)
    before = {place: sa[k - 1] if k and group[k] == group[k - 1] else -1 for k, place in enumerate(sa)}
    shared: dict[int, int] = {}
    last, h = -2, 0
    for place in sorted(before):
        other = before[place]
        if other < 0:
            h = 0
        else:
            h = max(h - 1, window) if place == last + 1 else window
            while text[place + h] == text[other + h]:
                h += 1
        shared[place], last = h, place
    return [shared[place] for place in sa]
