"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from sensorlake.llm import periodic_runs as pr
from sensorlake.llm.queries import QUERIES
from sensorlake.llm.suffix_groups import lay_out, repeated_suffixes

from tests_llm_paths import SF


def plain_runs(words, least=24, times=3):
    """Longest stretches of equal words ``q`` apart, for every ``q``; the smallest period of a stretch counts."""
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w])
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_equals_the_plain_search(spark):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = QUERIES["op11_periodic_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(expected(i, t) for i, t in texts)
    assert sum(r[1] > 0 for r in rows) > 10


@pytest.mark.parametrize("least,times", [(24, 3), (6, 2), (5, 3), (9, 4)])
def test_random_periodic_words(least, times):
    rng = random.Random(least)
    texts = []
    for _ in range(400):
        words = []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.6:
                unit = [rng.choice("ab") for _ in range(rng.randint(1, 7))] * rng.randint(2, 9)
                words += unit[:rng.randint(1, len(unit))]
            words += [rng.choice("abc") for _ in range(rng.randint(0, 4))]
        texts.append([w.encode() for w in words])
    got = pr.runs_of_texts(texts, least, times)
    assert got == [plain_runs(t, least, times) for t in texts]
    assert sum(map(len, got)) > 50


def test_one_word_and_long_periods():
    unit = [str(k).encode() for k in range(3000)]
    texts = [[b"a"] * 20_000, unit * 4 + unit[:1500], [b"a", b"b"] * 12, [b"a"] * 23]
    assert pr.runs_of_texts(texts) == [[(0, 20_000, 1)], [(0, 13_500, 3000)], [(0, 24, 2)], []]


def test_many_words_before_one_passage():
    """A passage that stands behind hundreds of different words: no pair is within reach."""
    passage = [b"p%d" % k for k in range(20)]
    text = [w for k in range(400) for w in (b"x%d" % k, *passage)]
    assert pr.runs_of_texts([text]) == [plain_runs(text)] == [[]]


def test_only_repeated_windows_are_sorted():
    rng = random.Random(3)
    symbols, _ = lay_out([[rng.randint(0, 3) for _ in range(300)] for _ in range(5)])
    text = symbols.tolist()
    found, groups = repeated_suffixes(symbols, 4)
    windows = {}
    for k in range(len(text)):
        windows.setdefault(tuple(text[k:k + 4]), []).append(k)
    assert sorted(found.tolist()) == sorted(k for w in windows.values() if len(w) > 1 for k in w)
    for a, b, same in zip(found, found[1:], groups[1:] == groups[:-1]):
        assert (text[a:a + 4] == text[b:b + 4]) == same
    assert all(len(x) == 0 for x in repeated_suffixes(np.empty(0, np.int64), 4))


def test_nulls_empty_texts_repeats_and_clashing_columns(make):
    again = "to be or not " * 9
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, again), (4, again), (4, again), (5, "é " * 30), (6, "a\x00b " * 24)]
    got = sorted((r["doc_id"] or -1, r["n_words"], [tuple(x) for x in r["runs"]], r["best"] and tuple(r["best"]), r["collapsed"]) for r in pr.periodic_runs(make(rows)).collect())
    again_row = (36, [(0, 36, 4)], (0, 36, 4), "to be or not")
    nothing = (0, [], None, "")
    assert got == [(-1, *again_row), (1, *nothing), (2, *nothing), (3, *nothing), (4, *again_row), (4, *again_row), (5, 30, [(0, 30, 1)], (0, 30, 1), "é"),
                   (6, 24, [(0, 24, 1)], (0, 24, 1), "a\x00b")]
    assert pr.periodic_runs(make([])).count() == 0
    renamed = make(rows).withColumnsRenamed({"doc_id": "data", "text": "runs"})
    assert pr.periodic_runs(renamed, id_col="data", text_col="runs").count() == len(rows)
    with pytest.raises(ValueError):
        pr.periodic_runs(make(rows), times=1)
