"""Chat formatting by round trip, packing against whole-text tokenizing and a plain best fit."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import chat, packing
from sensorlake.llm.queries import ORACLES, QUERIES

from tests_llm_paths import SF


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, turns string, formatted int").repartition(3)


def test_chat_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    cursor = con.execute(ORACLES["op2_chat_format"])
    columns = [d[0] for d in cursor.description]
    got = QUERIES["op2_chat_format"](spark, SF)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(cursor.fetchall())


PARTS = [*chat.RESERVED, "\\", "\\\\", "\n", "\\n", "<", ">", "s>", "/s>", "<s", "</", "[", "INST]", "ok", " ", "é😀", "\x00", "$1", "\\E", "\\Q"]


def test_chat_round_trip(spark):
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb", "<s>", "\\", "", None, "x\\n"]),
             None if rng.random() < 0.05 else "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(None, None, None, None), (7, 1, "user", "again"), (7, 1, "user", "again")]
    out = chat.format_chat(conversations(spark, rows)).select("*", chat.parse(F.col("formatted")).alias("back"), chat.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    got = {r["conv_id"]: r for r in out.collect()}
    assert got.keys() == want.keys()
    for c, turns in want.items():
        assert [tuple(t) for t in got[c]["back"]] == turns and got[c]["n_turns"] == len(turns)
        assert list(got[c]["loss"]) == [t for r, t in turns if r == "assistant"]
        assert got[c]["formatted"].count("</s>") == got[c]["formatted"].count("<s>") == len(turns)
        assert not any(x in got[c]["formatted"] for x in ("[INST]", "<<SYS>>"))


def test_chat_plain_text_stays_as_it_is(spark):
    out = chat.format_chat(conversations(spark, [(1, 0, "user", "a \\ b"), (1, 1, "assistant", "see </s>")])).collect()[0]
    assert out["formatted"] == "<s> user\na \\ b</s><s>\\assistant\nsee <\\/s></s>"
    assert chat.format_chat(conversations(spark, [])).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_packing_query(spark, tokenizer):
    got = QUERIES["op4_best_fit_packing"](spark, SF).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    sequences, pieces = defaultdict(list), defaultdict(dict)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]][r["piece"]] = r
    assert pieces.keys() == texts.keys()
    total = 0
    for i, text in texts.items():
        ids = whole(tokenizer, text)
        total += len(ids)
        assert sorted(pieces[i]) == list(range(-(-len(ids) // 2048)))
        for p, r in pieces[i].items():
            part = ids[2048 * p:2048 * p + 2048]
            assert (r["start"], r["length"], r["ids_crc32"]) == (2048 * p, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 2


def test_word_ids_equal_whole_texts(tokenizer):
    import public_tokenizers
    ids = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    odd = ["", " a  B́ ́x \x1c\x1dq <|endoftext|>a<|startoftext|> don't 'S ΑΣ ΣΑΣ", "x<|endoftext|>y", "Å가 ...,. Word!! a,b, 1,2. é, É.", "<|ENDOFTEXT|>, Word,", "क़ ड़ा İx ǅ ﬁ ª ⅷ 日本, ß."]
    odd += ["".join(rng.choice(["a", "B", ",", ".", "!!", " ", "'s", "é", "É", "1", "\n", "\x85", "<|", "|>", "endoftext"]) for _ in range(30)) for _ in range(400)]
    for text in odd:
        assert ids.texts([text.encode()])[0] == np.array(whole(tokenizer, text)[:-1], "<u4").tobytes()


def plain_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps[gaps.index(fit)] -= n
    return len(gaps)


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_plain_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 50, 200])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 300))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    fill, taken = defaultdict(list), defaultdict(list)
    for length, rank, n, first, per, offset in packing.plan_runs(counts, capacity):
        for k in range(n):
            fill[first + k // per].append((offset + k % per * length, length))
            taken[length].append(rank + k)
    assert {n: sorted(r) for n, r in taken.items()} == {n: list(range(c)) for n, c in counts.items()}
    for placed in fill.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(fill) == plain_best_fit(lengths, capacity)


def test_packing_odd_rows(make, tokenizer):
    rows = [(1, None), (2, ""), (2, ""), (None, "word"), (3, "many words " * 3000)]
    got = packing.pack(packing.cut_pieces(make(rows), capacity=64), 64).collect()
    assert sum(r["length"] for r in got) == sum(len(whole(tokenizer, t)) for _, t in rows)
    assert sorted((r["doc_id"], r["piece"]) for r in got if r["doc_id"] in (1, 2)) == [(1, 0), (2, 0), (2, 0)]
    assert packing.pack(packing.cut_pieces(make([]))).count() == 0
