"""Fingerprints against plain versions of each step, and the query against texts put together by hand."""

import hashlib
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from sensorlake.llm import fingerprints as fp
from sensorlake.llm.queries import QUERIES

from tests_llm_paths import SF


def plain_features(data):
    """Places of the features of one text, window by window."""
    if len(data) < fp.WINDOW:
        return []
    ranks = []
    for k in range(len(data) - fp.WINDOW + 1):
        counts = Counter(data[k:k + fp.WINDOW]).values()
        bits = sum(round(c * math.log2(c) * (1 << 20)) for c in counts)
        largest = round(fp.WINDOW * math.log2(fp.WINDOW) * (1 << 20))
        e = (largest - bits) * 1000 // largest
        ranks.append(2000 - e if e < fp.WEAK else 1000 - abs(e - fp.TYPICAL))
    wins = Counter()
    for k in range(len(ranks) - fp.WINDOW + 1):
        near = ranks[k:k + fp.WINDOW]
        wins[k + near.index(min(near))] += 1
    chosen = sorted(k for k, n in wins.items() if n >= fp.POPULAR)
    if chosen:
        return chosen
    return [min(wins, key=lambda k: (-wins[k], k))] if wins else [ranks.index(min(ranks))]


def some_texts():
    rng = random.Random(8)
    words = ["the", "and", "lake", "sensor", "éèê", "x" * 9, "0123", "\n", "aaaa" * 12]
    return [" ".join(rng.choice(words) for _ in range(n)).encode() for n in (1, 2, 5, 9, 12, 15, 30, 60, 200, 900)] + [b"a" * 500, bytes(range(256)) * 2, b"ab" * 40]


def test_features_equal_the_plain_search():
    texts = some_texts()
    for batch in (texts, texts[::-1]):
        found = fp.feature_hashes(batch)
        for data, hashes in zip(batch, found):
            own = fp._hashes(np.frombuffer(data, np.uint8), np.array(plain_features(data))) if len(data) >= fp.WINDOW else fp._short_hash(data)
            assert hashes.tolist() == list(dict.fromkeys(own.tolist()))


def test_long_texts_in_parts(monkeypatch):
    texts = [t for t in some_texts() if len(t) > 200]
    whole = [h.tolist() for h in fp.feature_hashes(texts)]
    monkeypatch.setattr(fp, "PART", 100)
    assert [h.tolist() for h in fp.feature_hashes(texts)] == whole


def plain_likeness(a, b):
    """Bit by bit, from the text form."""
    def filters(d):
        rows = [np.unpackbits(f) for f in d.filters]
        return [(r, min(fp.FULL, d.n - fp.FULL * k)) for k, r in enumerate(rows)]

    def best(x, y):
        total = 0
        for f, nf in x:
            scores = []
            for g, ng in y:
                p = 1 - 1 / fp.BITS
                chance = fp.BITS * (1 - p ** (5 * nf) - p ** (5 * ng) + p ** (5 * (nf + ng)))
                most = min(f.sum(), g.sum())
                floor = chance + fp.ABOVE_CHANCE * (most - chance)
                scores.append(min(1, max(0, ((f & g).sum() - floor) / max(most - floor, 1e-9))))
            total += max(scores) * nf
        return total / sum(n for _, n in x)

    x, y = filters(a), filters(b)
    if not x or not y:
        return float(len(x) == len(y))
    if len(x) == len(y):
        return 1.0 if a.n == b.n and str(a) == str(b) else (best(x, y) + best(y, x)) / 2
    return best(x, y) if len(x) < len(y) else best(y, x)


def test_likeness_and_text_form(monkeypatch):
    found = fp.digests([b"", *some_texts(), *(t + b" lake" for t in some_texts()), b"".join(random.Random(k).randbytes(20_000).hex().encode() for k in range(2))])
    again = [fp.Digest.parse(str(d)) for d in found]
    assert [str(d) for d in again] == [str(d) for d in found] and len(found[-1].filters) > 10
    for step in (1 << 24, 600):
        monkeypatch.setattr(fp, "COMPARED", step)
        for a in again:
            for b in (found[0], found[3], found[-1], found[9], a):
                assert fp.likeness(a, b) == pytest.approx(plain_likeness(a, b), abs=1e-12)
                assert fp.likeness(a, b) == fp.likeness(b, a)


def test_query_equals_texts_put_together_by_hand(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    ids = sorted(texts, reverse=True)
    rows = QUERIES["op12_fingerprints"](spark, SF).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(got) == len(texts)
    gaps = []
    for i, j in zip(ids, [*ids[1:], ids[0]]):
        text, after, r = texts[i] or "", texts[j] or "", got[i]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, other, following = fp.digests([text.encode(), edited.encode(), after.encode()])
        assert tuple(r) == (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), str(own), str(other), fp.likeness(own, other), fp.likeness(own, following))
        if len(text) > 400 and after != text:
            gaps.append((r["near_edited"], r["near_next"]))
    # Half of a text stays: it is nearer to its edited form than to an unrelated text.
    assert sum(a > b + 0.1 for a, b in gaps) >= 0.98 * len(gaps)
    assert np.mean([a for a, _ in gaps]) > 0.35 and np.mean([b for _, b in gaps]) < 0.1


def test_borders_of_partitions_and_odd_rows(spark, make):
    rows = [(None, "n" * 40), (1, None), (2, ""), (2, "two"), (2, "two"), *((k, f"text {k} " * k) for k in range(3, 40)), (99, "last " * 90)]
    docs = make(rows)
    got = fp.splice_likeness(docs)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    found = got.collect()
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h").collect()}
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (-1 if r[0] is None else r[0], hashes[r[1]]), reverse=True)
    expected = Counter()
    for (i, t), (_, following) in zip(ordered, [*ordered[1:], ordered[0]]):
        expected[i, len(t), hashlib.sha256(fp.spliced(t, following).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == expected
    assert fp.splice_likeness(make([])).count() == 0
    (one,) = fp.splice_likeness(make([(7, "abcd" * 20)])).collect()
    assert one["near_next"] == 1.0 and one["n_chars"] == 80


def test_fingerprints_of_a_table(make):
    rows = [(1, "some text " * 9), (2, "some text " * 9), (3, None), (None, ""), (4, "x")]
    found = {r["doc_id"]: r for r in fp.fingerprints(make(rows)).collect()}
    assert found[1]["fingerprint"] == found[2]["fingerprint"] != found[4]["fingerprint"]
    assert found[3]["fingerprint"] == found[None]["fingerprint"] == "0:" and found[4]["n_features"] == 1
    assert fp.fingerprints(make([])).count() == 0
