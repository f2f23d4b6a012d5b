"""Runs of words that repeat periodically, as maximal pairs of an LCP-interval tree.

A maximal pair is two equal stretches of words that cannot be extended on either side: they stand in different children of an
interval of the suffix order, and different words precede them. Two of them ``p`` words apart and ``l`` words long cover a stretch of
``p + l`` words with period ``p`` that no neighbour extends. If ``l >= (times - 1) * p`` and ``p + l >= least``, that stretch is a run
already, without any extension; a multiple of its smallest period gives the same stretch once more, and the smallest one stays.

The tree is walked bottom-up. Each open interval holds its places in classes by the word before them; when a child joins, each
place of the smaller side looks up the places of other classes within reach of the larger side, so no list is compared with
itself and no pair outside the length constraints is made. Only intervals of ``least * (times - 1) / times`` words or more can hold
such a pair, so shorter ones are never built (see ``suffix_groups``).

Work is row by row: one text is held at a time, however long. NULL texts have no words and no runs; so do empty ones. Repeated rows and
repeated or NULL ids give a row each, as they are. Ties of the most repetitive run go to the smallest start, then period. Other
columns of the input, whatever their names, are not read. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame

from sensorlake.llm.common import id_and_bytes, map_batches
from sensorlake.llm.suffix_groups import common_prefixes, lay_out, repeated_suffixes

#: Words of a run at least, and how many times its period it holds at least.
LEAST, TIMES = 24, 3
#: Bytes of text that are sorted in one go; a longer text is on its own.
CHUNK = 1 << 20


class _Places:
    """Places of an interval, all of them and by the word before them."""

    __slots__ = ("all", "classes")

    def __init__(self, place: int, left: int):
        self.all, self.classes = [place], {left: [place]}

    def others(self, place: int, left: int, reach: int) -> Iterator[int]:
        """Places of other classes, up to ``reach`` away: by class, or one by one if that is less work."""
        classes = self.classes
        if len(classes) == 1 and left in classes:
            return
        low, high = bisect_left(self.all, place - reach), bisect_right(self.all, place + reach)
        if high - low <= len(classes):
            for other in self.all[low:high]:
                if left not in classes or classes[left][bisect_left(classes[left], other):][:1] != [other]:
                    yield other
            return
        for c, places in classes.items():
            if c != left:
                yield from places[bisect_left(places, place - reach):bisect_right(places, place + reach)]


def _join(a: _Places, b: _Places, shared: int, least: int, times: int, found: dict) -> _Places:
    """Both children of an interval of ``shared`` words in one, and the maximal pairs between them in ``found``."""
    if len(a.all) < len(b.all):
        a, b = b, a
    reach = shared // (times - 1)
    for c, places in b.classes.items():
        for place in places:
            for other in a.others(place, c, reach):
                first, period = min(place, other), abs(place - other)
                if period + shared >= least:
                    span = first, period + shared
                    found[span] = min(found.get(span, period), period)
    for c, places in b.classes.items():
        if c in a.classes:
            for place in places:
                insort(a.classes[c], place)
        else:
            a.classes[c] = places
        for place in places:
            insort(a.all, place)
    return a


def maximal_pairs(symbols: np.ndarray, least: int, times: int) -> dict[tuple[int, int], int]:
    """``(start, length) -> smallest period`` of the stretches that maximal pairs within the constraints cover."""
    shortest = -(-least * (times - 1) // times)
    suffixes, groups = repeated_suffixes(symbols, shortest)
    found: dict[tuple[int, int], int] = {}
    if not len(suffixes):
        return found
    shared = common_prefixes(symbols, suffixes, groups, shortest)
    # The first word of the whole layout has no word before it: a symbol of its own.
    left = np.r_[-1, symbols[:-1]][suffixes].tolist()
    open_: list[tuple[int, _Places]] = []
    current: _Places | None = None
    for place, before, lcp in zip([*suffixes.tolist(), -1], [*left, -1], [*shared, 0]):
        if lcp < shortest:
            lcp = 0
        while open_ and open_[-1][0] > lcp:
            value, places = open_.pop()
            current = _join(places, current, value, least, times, found)
        if lcp and open_ and open_[-1][0] == lcp:
            open_[-1] = lcp, _join(open_[-1][1], current, lcp, least, times, found)
        elif lcp:
            open_.append((lcp, current))
        current = _Places(place, before)
    return found


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of the runs of each text, by start, then period."""
    symbols, starts = lay_out(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (start, length), period in maximal_pairs(symbols, least, times).items():
        k = int(np.searchsorted(starts, start, side="right")) - 1
        out[k].append((start - int(starts[k]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def most_repeated(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact ratio of length to period; the first, then the shortest period, of equal ones."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that stand in a run behind its first period, one space between them."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def _chunks(column, size: int) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of consecutive rows, up to ``size`` bytes of text at once, and the row they start at."""
    first, held, rows = 0, 0, []
    for k, value in enumerate(column):
        data = value.as_py()
        if rows and held + len(data) > size:
            yield first, rows
            first, held, rows = k, 0, []
        rows.append(data.split())
        held += len(data)
    if rows:
        yield first, rows


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, best, collapsed`` for each row of ``docs``: all runs (``start, length, period`` in words from 0), the most
    repetitive one (NULL without runs), and the text without the repetitions. Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are."""
    if times < 2 or least < times:
        raise ValueError("a run holds its period twice at least")

    def run(batches):
        for batch in batches:
            for first, texts in _chunks(batch.column(1), CHUNK):
                found = runs_of_texts(texts, least, times)
                structs = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
                best = [most_repeated(runs) for runs in found]
                yield {"doc_id": batch.column(0).slice(first, len(texts)), "n_words": [len(t) for t in texts], "runs": structs,
                       "best": [b and dict(zip(("start", "length", "period"), b)) for b in best],
                       "collapsed": [collapse(t, runs) for t, runs in zip(texts, found)]}

    kind = docs.schema[id_col].dataType.simpleString()
    span = "struct<start:long,length:long,period:long>"
    out = map_batches(id_and_bytes(docs, id_col, text_col), f"doc_id {kind}, n_words long, runs array<{span}>, best {span}, collapsed binary", run)
    return out.withColumn("collapsed", out["collapsed"].cast("string"))
