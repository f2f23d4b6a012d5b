"""Language-model scores, decontamination and the pipeline."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sensorlake.llm import decontaminate, near_dup, packing, quality, secrets, suffix_tree_lm
from sensorlake.llm.queries import QUERIES

from tests_llm_paths import SF


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def check_base(rows, got):
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    want = Counter((i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
                    round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens(t)), 6)) for i, t in rows)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] <= 1e-9 for r in got)


def test_scores(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = QUERIES["op3_suffix_tree_lm"](spark, SF).collect()
    check_base(rows, got)
    out = [r for r in got if r["held_out"]]
    assert out and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_scores_of_odd_rows(make):
    rows = [(1, None), (2, ""), (3, "A b a b a b"), (3, "A b a b a b"), (None, "é É"), (4, "x " * 20000), (9, "never seen")]
    rows += [(k, "the cat sat on the mat") for k in range(20, 60)]
    check_base(rows, suffix_tree_lm.score(make(rows)).collect())
    assert suffix_tree_lm.score(make([])).count() == 0


class PlainTree:
    """The suffix tree over whole counts in dictionaries, straight from its definition."""

    def __init__(self, rows):
        texts = [tokens(t) for i, t in rows if not held(i)]
        self.c = Counter(w for t in texts for w in t)
        self.total = sum(self.c.values())
        once, twice = (sum(n == k for n in self.c.values()) for k in (1, 2))
        self.discount = once / (once + 2 * twice) if once and twice else 0.5
        self.n = Counter((tuple(["<"] + t)[k - d + 1:k + 1], w) for t in texts for k, w in enumerate(t) for d in range(1, min(suffix_tree_lm.DEPTH, k + 1) + 1))
        self.behind = {}
        for (context, w), n in self.n.items():
            self.behind.setdefault(context, {})[w] = n
        self.behind = {c: ws for c, ws in self.behind.items() if sum(ws.values()) >= suffix_tree_lm.LEAST}
        self.retained = set()
        for context in sorted(self.behind, key=len):
            ws = self.behind[context]
            total = sum(ws.values())
            gain = sum(n * math.log2(n / total / self.chance(context[1:], w)) for w, n in ws.items())
            if gain > suffix_tree_lm.DIVERGENCE * len(ws):
                self.retained.add(context)

    def chance(self, context, w):
        if not context:
            return (self.c[w] - self.discount if self.c[w] else self.discount * len(self.c)) / self.total if self.total else 1.0
        below = self.chance(context[1:], w)
        if context not in self.retained:
            return below
        ws = self.behind[context]
        return (ws.get(w, 0) + len(ws) * below) / (sum(ws.values()) + len(ws))

    def score(self, text):
        marked = ["<"] + tokens(text)
        return sum(math.log10(self.chance(tuple(marked[max(0, k - suffix_tree_lm.DEPTH):k]), w)) for k, w in enumerate(marked) if k)


def check_tree(rows, got):
    tree = PlainTree(rows)
    want = Counter((i, len(tokens(t)), round(tree.score(t), 4)) for i, t in rows)
    assert Counter((r["doc_id"], r["n_tokens"], round(r["score"], 4) + 0.0) for r in got) == want
    return tree


@pytest.mark.parametrize("block", [1 << 24, 3000])
def test_scores_are_those_of_the_plain_tree(spark, monkeypatch, block):
    monkeypatch.setattr(suffix_tree_lm, "BLOCK_BYTES", block)
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    rows = [(i, t) for i, t in rows if t is None or len(t) < 6000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tree = check_tree(rows, suffix_tree_lm.score(docs).collect())
    assert {len(c) for c in tree.retained} == {1, 2, 3}
    some = [(), ("the",), ("<",)] + sorted(tree.retained, key=str)[::50]
    for context in some:
        assert sum(tree.chance(context, w) for w in tree.c) + tree.chance(context, "never seen") == pytest.approx(1.0)


def test_scores_of_hot_words_and_unknown_contexts(make):
    rows = [(k, "the " * (k % 50) + f"w{k % 3} the end w{k % 5}") for k in range(200)] + [(k, "new words of its own the") for k in range(2)]
    rows += [(None, None), (7, ""), (7, "the the")]
    check_tree(rows, suffix_tree_lm.score(make(rows)).collect())
    unlearned = [(k, "x y") for k in range(60) if held(k)]
    check_tree(unlearned, suffix_tree_lm.score(make(unlearned)).collect())


def test_verbatim_passages_are_found(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = (dict(duckdb.sql(f"SELECT {c}, text FROM '{folder}/{t}.parquet'").fetchall()) for c, t in (("doc_id", "documents"), ("item_id", "benchmark")))
    clean = {i: b" ".join(decontaminate._words(t.encode())) for i, t in docs.items()}
    want = {(d, i) for d, x in clean.items() for i, t in items.items() if b" ".join(decontaminate._words(t.encode())) in x}
    got = QUERIES["op9_decontaminate"](spark, folder).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert want and len(pairs) == len(got) and len(want - pairs) <= 0.02 * len(want)
    assert all(r["aligned"] >= decontaminate.PARAPHRASE for r in got) and len(pairs - want) <= 0.05 * len(want)


def test_paraphrases_and_odd_rows(spark, make):
    base = [f"filler{k % 90}" for k in range(900)]
    item = [f"item{k}" for k in range(30)]
    reworded = [w if k % 4 else f"other{k}" for k, w in enumerate(item)]
    rows = [(k, " ".join(base[k:k + 200])) for k in range(40)]
    rows += [(50, " ".join(base[:100] + item + base[:100])), (51, " ".join(base[:77] + reworded + base[:9])), (52, " ".join(item[:7] + base[:50])),
             (53, " ".join(base * 60 + item + base)), (54, None), (55, ""), (None, " ".join(item)), (56, " ".join(item).upper()), (56, " ".join(item).upper())]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "two words"), (4, " ".join(base[500:530])), (None, "a b c d e f g h")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(make(rows), benchmark).collect()}
    assert {x for x in got if x[1] == 1} == {(d, 1) for d in (50, 51, 53, None, 56)}
    docs = make(rows)
    kept = decontaminate.keep_clean(docs, benchmark.where("item_id = 1"))
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in rows if r[0] not in (50, 51, 53, None, 56))
    assert decontaminate.find_leaks(make(rows), benchmark.limit(0)).count() == 0
    assert decontaminate.find_leaks(make([]), benchmark).count() == 0


def test_blocks_of_items_give_the_same(spark, make, monkeypatch):
    items = [" ".join(f"i{n}w{k}" for k in range(20)) for n in range(7)]
    rows = [(n, f"front words here {t} and behind") for n, t in enumerate(items)] + [(k, f"other text {k} " * 9) for k in range(10, 30)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    monkeypatch.setattr(decontaminate, "ITEMS", 3)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(make(rows), benchmark).collect()} == {(n, n) for n in range(7)}


def test_the_space_is_fitted_on_all_passages(spark, make, monkeypatch):
    """More passages than fit a sample: the fit sees each segment that is searched."""
    seen = []
    fit = decontaminate.latent_space
    monkeypatch.setattr(decontaminate, "latent_space", lambda table, weight: seen.append(table.agg({"n_words": "sum"}).first()[0]) or fit(table, weight))
    item = " ".join(f"item{k}" for k in range(20))
    rows = [(k, f"{item} {k} " + "x " * 100_000) for k in range(30)]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.find_leaks(make(rows), benchmark).collect()} == set(range(30))
    # Segments overlap, so the sum is more than the words.
    assert seen[0] >= 30 * 100_021


def test_leaks_that_many_documents_share(spark, make):
    """An item in most of the texts, and one in a third of the rows next to a rare benchmark word: all copies are found."""
    often, third = ([f"{c}{k}" for k in range(30)] for c in ("often", "third"))
    rows = [(k, " ".join([*(f"d{k}w{j}" for j in range(10)), *(often if k % 3 else third), "scarce" if k % 3 == 0 else f"e{k}", f"d{k}end"])) for k in range(120)]
    rows += [(k, "the same copy " + " ".join(third) + " scarce") for k in range(200, 260)]
    rows += [(300, "plain words without any of them " * 5)]
    benchmark = spark.createDataFrame([(1, " ".join(often)), (2, " ".join(third)), (3, "scarce benchmark words that nothing has")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(make(rows), benchmark).collect()}
    assert got == {(k, 1 if k % 3 else 2) for k in range(120)} | {(k, 2) for k in range(200, 260)}


def test_common_subsequence():
    item = decontaminate.Item(1, [1, 2, 3, 2, 5])
    assert decontaminate.common_subsequence(item.masks, 5, [9, 1, 3, 2, 2, 5]) == 4
    assert decontaminate.common_subsequence(item.masks, 5, []) == 0


def test_stages_do_what_their_operators_say(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "benchmark decontamination", "secret scans", "best-fit packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = dict(corpus_pipeline.STAGES)

    def ids(df):
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
        return {r["doc_id"] for r in df.collect()}

    good = ids(names["quality rules"](spark, docs, SF))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert good == {r["doc_id"] for r in quality.quality(docs, labels).where("kept").collect()}
    assert ids(names["near duplicates"](spark, docs, SF)) == {r["doc_id"] for r in near_dup.near_duplicates(docs).where("kept").collect()}
    leaked = {r["doc_id"] for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert ids(names["benchmark decontamination"](spark, docs, SF)) == texts.keys() - leaked
    novelty = secrets.Novelty()
    for r in names["secret scans"](spark, docs, SF).collect():
        spans = secrets.spans_of(texts[r["doc_id"]], texts[r["doc_id"]].encode(), novelty)
        assert r["text"] == secrets.redact(texts[r["doc_id"]], spans) and r["n_chars"] == len(r["text"])
        assert not list(secrets.base_spans(r["text"], r["text"].encode()))


def test_pipeline_runs_its_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    want = Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.best_fit_packing(spark, docs, SF).collect())
    assert Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SF).collect()) == want and want


def test_stages_take_odd_tables(make, spark):
    odd = make([(1, None), (None, ""), (2, "x " * 50), (2, "x " * 50), (3, "plain words that go on " * 3)])
    for rows in (odd, make([])):
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, rows, SF).collect()


def test_stages_take_any_extra_column(spark):
    """Columns with the names of helper columns, of outputs, and of the other tables."""
    extra = {"__key": 1, "__id": "x", "__key_": 2.5, "label": "l", "text_key": 7, "item_id": "i", "component_id": "c", "quality": "q", "kept": True, "n": 3}
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.select("*", *(F.lit(v).alias(k) for k, v in extra.items()))
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= 60, name


def test_packing_replaces_places_of_before(spark):
    pieces = spark.createDataFrame([(k, 100 + k, "old", -1) for k in range(40)], "doc_id long, length long, offset string, sequence_id int")
    out = packing.pack(pieces)
    assert out.columns == ["doc_id", "length", "sequence_id", "offset"] and out.count() == 40 and out.where("offset < 0").count() == 0
