"""Collocations against plain counts of all phrases."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from sensorlake.llm import collocations as co
from sensorlake.llm.queries import ORACLES, QUERIES

from tests_llm_paths import SF

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, limit=2000, covered=50):
    """``(lang, rank, phrase, a, l, r, n, score)`` from counts of every phrase."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        usual = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in usual.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= covered * usual.get(q, 10**9)}
        ranked = []
        for p, a in usual.items():
            if p not in gone:
                score, _, l, r = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, k + 1, p.decode(), -a, l, r, total[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(ranked)[:limit])]
    return sorted(out)


def test_query_equals_plain_counts_and_sql(spark):
    rows = duckdb.sql(f"SELECT lang, text FROM '{SF}/documents.parquet'").fetchall()
    got = QUERIES["op13_collocations"](spark, SF)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = sorted(map(tuple, got.collect()))
    assert found == plain(rows) and len(found) > 150
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(con.execute(ORACLES["op13_collocations"]).fetchall()) == found


def some_rows(n=900, seed=4):
    """Languages with few and many phrases, fixed phrases at many rates, and thousands of copies of a passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    fixed = [[f"p{k}", f"q{k % 7}", f"r{k % 3}"] for k in range(40)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            words += rng.choice(fixed) if rng.random() < 0.2 else [rng.choice(vocabulary[:rng.choice((3, 20, 60))])]
        text = "".join(w + rng.choice((" ", " ", "  ", "\t", ", ", ".\n", "; ")) for w in words)
        rows.append((rng.choice(("en", "en", "en", "fr", None, "und")), text))
    rows += [("en", "Alpha BETA gamma delta; É é")] * 500 + [("xx", "only a few words")] * 9 + [("yy", "a b a b a b a b a b a b a b a b a b a b a")]
    return rows + [("zz", None), (None, None), ("zz", ""), ("zz", " ,. \t")]


@pytest.mark.parametrize("limit", [3, 25, 200, 2000])
def test_supersteps_settle_the_first_phrases(spark, limit):
    rows = some_rows()
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string").repartition(7)
    assert sorted(map(tuple, co.mine_collocations(docs, limit=limit).collect())) == plain(rows, limit=limit)


def test_filters_of_any_size_give_the_same_rows(spark, monkeypatch):
    """Full filters let everything through: more is counted, and the rows stay."""
    rows = some_rows(300, 9)
    docs = spark.createDataFrame(rows, "lang string, text string")
    expected = plain(rows, least=4, limit=12, covered=80)
    for bits in (1 << 10, 1 << 26):
        monkeypatch.setattr(co, "FILTER_BITS", bits)
        assert sorted(map(tuple, co.mine_collocations(docs, least=4, limit=12, covered=80).collect())) == expected


def test_longer_phrases_are_counted_once(spark):
    """What an earlier superstep has counted, a later one leaves out."""
    rows = some_rows(400, 2)
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("coalesce(lang, 'und') AS lang", "CAST(coalesce(text, '') AS BINARY) AS data")
    share = spark.sparkContext.broadcast
    all_bits, none = co.BitFilter(np.full(16, 2**64 - 1, np.uint64)), co.BitFilter(np.zeros(16, np.uint64))
    half = co.BitFilter(np.full(16, 0x3F3F3F3F3F3F3F3F, np.uint64))
    known = share(all_bits)
    everything, some = co.Frontier(all_bits, all_bits, none), co.Frontier(half, all_bits, none)
    whole = Counter(map(tuple, co.count_triples(docs, known, known, share(everything), []).collect()))
    first = Counter(map(tuple, co.count_triples(docs, known, known, share(some), []).collect()))
    rest = Counter(map(tuple, co.count_triples(docs, known, known, share(everything), [share(some)]).collect()))
    assert first and rest and first + rest == whole


def test_words_and_pieces():
    found = co.read_words(["A b\tb,c\x0bd É".encode(), b"", b" ?a", b"."], ["en", "fr", "fr", "en"])
    read = [(found.langs[s].as_py(), found.names[s].as_py(), int(p)) for s, p in zip(found.symbols, found.piece)]
    assert [r[:2] for r in read] == [("en", "a"), ("en", "b"), ("en", "b"), ("en", "c"), ("en", "d"), ("en", "É"), ("fr", "a")]
    assert [r[2] for r in read] == [0, 0, 0, 1, 2, 2, 5]
    assert len(co.read_words([b" . "], ["en"]).symbols) == 0


def test_empty_tables_clashing_columns_and_counts_beyond_64_bits(spark, make):
    assert co.mine_collocations(make([])).count() == 0
    assert co.mine_collocations(make([(1, None), (2, "")])).count() == 0
    docs = make([(None, "left right")] * 12).withColumnsRenamed({"n_chars": "n", "source": "w1", "kept": "rank"})
    assert [tuple(r) for r in co.mine_collocations(docs).collect()] == [("en", 1, "left right", 12, 12, 12, 24, 1_000_000)]
    big = spark.createDataFrame([(3 * 10**12, 4 * 10**12, 5 * 10**12)], "n long, l long, r long")
    assert big.select(co._score("n", "l", "r")).first()[0] == 10**6 * 9 // 20
