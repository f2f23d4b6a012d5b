"""Near duplicates and repeated strings against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from sensorlake.llm import near_dup, repeats
from sensorlake.llm.components import components
from sensorlake.llm.deep_shallow import common_prefix, deep_shallow
from sensorlake.llm.queries import ORACLES, QUERIES

from tests_llm_paths import SF


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1)))


def plain_components(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return Counter((i, len(sets[k]), least.get(root(k)), i == least.get(root(k))) for k, (i, _) in enumerate(rows))


def found(docs, size):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs, size).collect())


def test_near_duplicates_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cursor = con.execute(ORACLES["op1_near_dup"])
    columns = [d[0] for d in cursor.description]
    assert sorted(map(tuple, QUERIES["op1_near_dup"](spark, SF).select(columns).collect())) == sorted(cursor.fetchall())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_of_large_and_odd_groups(make, monkeypatch):
    """A group far above the size of a small node, with members that are alike only through others; and odd rows."""
    rng = random.Random(4)
    seed = [f"v{rng.randrange(10**6)}" for _ in range(60)]
    rows = [(k, edited(rng, seed, rng.randrange(0, 7))) for k in range(100, 260)]
    rows += [(k, edited(rng, [f"u{k % 7}-{j}" for j in range(40)], k % 5)) for k in range(40)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (905, "one two"), (None, "one two"), (None, "lone words here now yes"),
             (906, "same " * 5000), (907, "same " * 3), (908, "Ä é ß"), (909, "ä é ß")]
    assert found(make(rows), 2) == plain_components(rows, 2)
    assert found(make(rows), 5) == plain_components(rows, 5)


def test_near_duplicates_of_two_large_groups_grow_with_their_members(make, monkeypatch):
    """Two groups of copies whose members look alike across the groups, but never enough: what is written follows rows, not pairs."""
    rng = random.Random(6)
    common, kept = [f"c{k}" for k in range(82)], near_dup.written
    rows = [(1000 * g + k, " ".join(common + [f"g{g}-{j}" for j in range(17)] + [f"own{g}-{k}"])) for g in range(2) for k in range(400)]
    rng.shuffle(rows)
    counts = defaultdict(int)

    def counted(df, name):
        out = kept(df, name)
        counts[name] = max(counts[name], out.count())
        return out

    monkeypatch.setattr(near_dup, "written", counted)
    got = found(make(rows), 1)
    assert got == Counter((i, 100, 1000 * (i // 1000), i % 1000 == 0) for i, _ in rows)
    assert counts["pairs"] <= near_dup.TREES * near_dup.BRANCH ** near_dup.BLIND * len(rows)


def test_unwanted_texts_are_left_before_the_shuffle(make, spark):
    docs = make([(k, f"text {k}") for k in range(-1000, 1000)]).select("doc_id", near_dup.F.xxhash64("text").alias("text_key"))
    wanted = docs.where("doc_id % 20 = 0")
    left = {r["doc_id"] for r in near_dup._maybe_wanted(docs, wanted).collect()}
    assert left >= set(range(-1000, 1000, 20)) and len(left) < 400
    assert near_dup._maybe_wanted(docs, docs.limit(0)).count() == 0


def test_overlaps_of_rare_and_frequent_shingles():
    rng = random.Random(2)
    sets = [sorted({rng.randrange(30) if k % 2 else rng.randrange(400) for _ in range(20)}) for k in range(90)]
    flat, sizes = near_dup.np.array(sum(sets, []), near_dup.np.uint64), near_dup.np.array(list(map(len, sets)))
    got = near_dup.overlaps(flat, sizes)
    assert all(got[i, j] == len(set(sets[i]) & set(sets[j])) for i in range(90) for j in range(i + 1, 90))


def test_near_duplicates_empty(make):
    assert near_dup.near_duplicates(make([])).count() == 0


def test_one_stays_of_each_group(make):
    rows = [(3, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (5, "x y z u v w"), (None, "q r s t u v"), (8, None), (9, "")]
    docs = make(rows)
    out = near_dup.keep_one_each(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter([2, 5, None, 8, 9])


def test_one_stays_of_each_group_without_or_under_repeated_ids(make):
    """Components are not told apart by their ids: many have none, others share one, also with an empty text."""
    lone = [(None, " ".join(f"n{k}w{j}" for j in range(8))) for k in range(30)]
    shared = [(7, " ".join(f"s{k}w{j}" for j in range(8))) for k in range(20)]
    rows = lone + lone[:10] + shared + shared[:5] + [(7, ""), (7, None), (None, ""), (None, " \n")]
    rows += [(3, lone[0][1]), (9, shared[0][1])]
    got = Counter((r["doc_id"], r["text"]) for r in near_dup.keep_one_each(make(rows)).collect())
    assert got == Counter([(3, lone[0][1]), *lone[1:], *shared, (7, ""), (7, None), (None, ""), (None, " \n")])


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(f"c{k:04d}".encode(), f"c{k + 1:04d}".encode()) for k in range(300)] + [(b"s0", f"s{k}".encode()) for k in range(1, 400)] + [(b"z", b"z")]
    df = spark.createDataFrame([(bytes(a), bytes(b)) for a, b in links], "a binary, b binary").repartition(8)
    got = {bytes(r["v"]): bytes(r["label"]) for r in components(df).collect()}
    assert got == {v: (b"c0000" if v[:1] == b"c" else b"s0") for x in links for v in x if v != b"z"}


def plain_repeats(rows, length):
    counts = Counter(d[s:s + length] for _, d in rows for s in range(len(d) - length + 1))
    out = []
    for i, d in rows:
        gone = {q for s in range(len(d) - length + 1) if counts[d[s:s + length]] > 1 for q in range(s, s + length)}
        kept = bytes(b for k, b in enumerate(d) if k not in gone)
        out.append((i, len(d), len(gone), sum(k in gone and k - 1 not in gone for k in range(len(d))), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def removed(found):
    return Counter((r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), r["kept_sha256"]) for r in found.collect())


def test_repeats_query(spark):
    rows = [(i, t.encode()) for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()]
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES["op7_suffix_dedup"](spark, SF).collect())
    assert got == plain_repeats(rows, 400)


@pytest.mark.parametrize("hot", [50_000, 3])
def test_repeats_of_odd_texts(make, hot):
    rng = random.Random(8)
    shared = "".join(rng.choice("abé") for _ in range(90))
    rows = [(k, shared[rng.randrange(40):rng.randrange(50, 90)] + "".join(rng.choice("ab") for _ in range(rng.randrange(60))) + shared[:rng.randrange(90)]) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "a" * 500), (103, "ab" * 300), (104, "ab" * 300), (None, shared), (105, shared), (105, shared), (106, "short")]
    got = removed(repeats.repeated_spans(make(rows), length=24, hot=hot))
    assert got == plain_repeats([(i, (t or "").encode()) for i, t in rows], 24)
    assert repeats.repeated_spans(make([])).count() == 0


def test_deep_shallow_sorting():
    rng = random.Random(3)
    for _ in range(200):
        pre = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40)))
        strings = [pre[:rng.randint(0, len(pre))] + bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 60))]
        ranked, lcps = deep_shallow(strings, rng.choice([0, 4, 16]))
        assert [strings[k] for k in ranked] == sorted(strings)
        assert lcps == [0] + [common_prefix(strings[a], strings[b]) for a, b in zip(ranked, ranked[1:])]


def test_anchors_cover_all_windows_of_long_texts(monkeypatch):
    from sensorlake.llm import anchors as module
    monkeypatch.setattr(module, "PART", 500)
    data = bytes(random.Random(1).choice(b"abcd") for _ in range(3000))
    _, place, first, last = module.anchors(data, 60, 30)
    covered = sorted({s for a, b in zip(first.tolist(), last.tolist()) for s in range(a, b + 1)})
    assert covered == list(range(3000 - 60 + 1)) and all(a <= p <= a + 30 for p, a in zip(place.tolist(), last.tolist()))
