"""Collocations by best-first branch and bound: the best phrases of two and three words of each language.

A phrase with count ``a`` scores the least of ``a * a / (l * r)`` over its cuts, ``l`` and ``r`` counting the words before and behind the cut.
Phrases grow from prefixes, and counts of prefixes bound what can grow from them. Growing ``w1 w2`` by ``w3`` gives at most
``f(w1 w2) / f(w1)``, since ``a <= f(w2 w3)`` in the cut behind the first word; in the cut before the last word it gives at most
``f(w2 w3) / f(w3)`` in the same way. Both are known before a longer phrase is counted.

The frontier is expanded in supersteps, best bounds first. Each superstep lowers a threshold per language and counts those longer
phrases, not counted so far, that

* can reach the threshold: both bounds do, or
* can decide whether a phrase that has reached it survives: they contain that phrase.

No longer phrase is counted if one of its parts is too rare. A language is settled once ``limit`` phrases at or above its threshold
survive: all that score the same as the last one are at or above it as well, so ties are complete. Otherwise the threshold falls to
a score four times as deep, down to 0, where everything is expanded.

What a superstep may count is decided by filters of fixed size (at most ``FILTER_BITS`` bits, whatever the corpus). They never miss a
phrase; a phrase that they let through by chance is counted for nothing. Results rest on exact counts of words, never on hashes. Counts
are summed per block of text, then before and after the shuffle, so a phrase or language with a third of all words is a few rows per task;
scores are exact decimals. The first ``limit`` of a language are taken from the first ``limit`` of each of ``SPREAD`` parts of it.

NULL text is empty, NULL language is ``und``; languages without a phrase that qualifies have no rows, and neither has an empty table.
Repeated rows and ids count as often as they are there. Texts are read in whole, in blocks of ``BLOCK`` bytes; a longer text is a
block of its own. Columns other than text and language, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sensorlake.llm.common import LOWER, map_batches, mix
from sensorlake.session import written

LEAST, LIMIT, COVERED_PERCENT = 10, 2000, 50
BLOCK = 1 << 21
#: Rows of counts that a task hands over at once.
ROWS = 1 << 16
FILTER_BITS, PROBES = 1 << 26, 3
#: Parts of a language that are ranked apart before the whole, and how much deeper each superstep goes.
SPREAD, DEEPER = 64, 4

# Kinds of bytes: 0 is part of a word, 1 stands between words, 2 between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PROBE = mix(np.arange(1, PROBES + 1, dtype=np.uint64))


@dataclass
class Words:
    """Words of a block of texts. A symbol is a word of a language; ``names`` and ``langs`` say which."""

    symbols: np.ndarray
    piece: np.ndarray
    names: pa.Array
    langs: pa.Array

    def hashes(self) -> np.ndarray:
        """Hash of each symbol, the same in every block."""
        return start_hash(self.langs.to_pylist(), self.names.to_pylist())


def _hash_strings(values: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(values, object), categorize=False) if values else np.empty(0, np.uint64)


def start_hash(langs: list[str], words: list[str]) -> np.ndarray:
    """Hash of words of languages."""
    return mix(_hash_strings(langs) * _STEP + _hash_strings(words))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of two words in a row from the hashes of both."""
    return mix(first * _STEP + second)


def read_words(texts: list[bytes], langs: list[str]) -> Words:
    """All words of the texts, A-Z in lower case, with the number of the piece they are in."""
    data = np.frombuffer(b"\n".join(texts).translate(LOWER), np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    starts, ends = edges[::2], edges[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
    lang_names = sorted(set(langs))
    code = {name: k for k, name in enumerate(lang_names)}
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    lang = np.array([code[x] for x in langs], np.int64)[np.searchsorted(text_ends, starts, side="right")]
    both, symbols = np.unique(lang * max(1, len(words.dictionary)) + words.indices.to_numpy(), return_inverse=True)
    lang_of, word_of = np.divmod(both, max(1, len(words.dictionary)))
    return Words(symbols, piece, words.dictionary.cast(pa.string()).take(pa.array(word_of)), pa.array(lang_names, pa.string()).take(pa.array(lang_of)))


class BitFilter:
    """Phrases by hash, in bits of a size that does not depend on how many there are. It never denies one that was put in."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in _places(hashes, len(self.bits) * 64):
            found &= (self.bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found

    @classmethod
    def of(cls, phrases: DataFrame, count: int, words: list[str]) -> BitFilter:
        """From a table of phrases (``lang`` and one column per word) with ``count`` rows. At most ``FILTER_BITS / 64`` numbers reach the driver."""
        size = min(FILTER_BITS, 1 << max(10, (16 * count).bit_length()))

        def run(batches):
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                h = start_hash(columns[0], columns[1])
                if len(words) == 2:
                    h = pair_hash(h, start_hash(columns[0], columns[2]))
                at = np.concatenate(_places(h, size))
                yield {"slot": (at >> np.uint64(6)).astype(np.int64), "mask": (np.uint64(1) << (at & np.uint64(63))).view(np.int64)}

        slots = map_batches(phrases.select("lang", *words), "slot long, mask long", run).groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
        bits = np.zeros(size // 64, np.uint64)
        bits[slots["slot"].to_numpy()] = slots["mask"].to_numpy().view(np.uint64)
        return cls(bits)


def _places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    return [mix(hashes ^ salt) & np.uint64(size - 1) for salt in _PROBE]


def _blocks(batch: pa.RecordBatch):
    """Texts and languages of consecutive rows, about ``BLOCK`` bytes at once."""
    texts, langs, held = [], [], 0
    for text, lang in zip(batch.column(1), batch.column(0).to_pylist()):
        data = text.as_py()
        if texts and held + len(data) > BLOCK:
            yield texts, langs
            texts, langs, held = [], [], 0
        texts.append(data)
        langs.append(lang)
        held += len(data) + 1
    if texts:
        yield texts, langs


def _slices(columns: dict):
    """The columns in batches of ``ROWS`` rows."""
    for at in range(0, len(columns["n"]), ROWS):
        yield {name: values[at:at + ROWS] for name, values in columns.items()}


def _summed(counted: DataFrame, words: list[str]) -> DataFrame:
    return counted.groupBy("lang", *words).agg(F.sum("n").alias("n"))


def count_words(docs: DataFrame) -> DataFrame:
    """``lang, w1, n`` of all words of ``docs`` (``lang, data``)."""
    def run(batches):
        for batch in batches:
            for texts, langs in _blocks(batch):
                found = read_words(texts, langs)
                yield from _slices({"lang": found.langs, "w1": found.names, "n": np.bincount(found.symbols, minlength=len(found.names))})

    return _summed(map_batches(docs, "lang string, w1 string, n long", run), ["w1"])


def count_pairs(docs: DataFrame, usual) -> DataFrame:
    """``lang, w1, w2, n`` of all pairs of words that the filter ``usual`` (broadcast) knows."""
    def run(batches):
        for batch in batches:
            for texts, langs in _blocks(batch):
                found = read_words(texts, langs)
                known = usual.value.has(found.hashes())[found.symbols]
                both = np.flatnonzero(known[:-1] & known[1:] & (found.piece[:-1] == found.piece[1:]))
                key, n = np.unique(found.symbols[both] * len(found.names) + found.symbols[both + 1], return_counts=True)
                first, second = map(pa.array, np.divmod(key, max(1, len(found.names))))
                yield from _slices({"lang": found.langs.take(first), "w1": found.names.take(first), "w2": found.names.take(second), "n": n})

    return _summed(map_batches(docs, "lang string, w1 string, w2 string, n long", run), ["w1", "w2"])


@dataclass
class Frontier:
    """Filters of a superstep: pairs whose bound as the first or as the last part of a longer phrase reaches the threshold, and pairs that
    have reached it themselves."""

    opening: BitFilter
    closing: BitFilter
    reached: BitFilter

    def wants(self, hashes: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which longer phrases it counts, by the places in ``hashes`` of their first and last two words."""
        reached = self.reached.has(hashes)
        return reached[first] | reached[second] | self.opening.has(hashes)[first] & self.closing.has(hashes)[second]


def count_triples(docs: DataFrame, usual, frequent, frontier, earlier: list) -> DataFrame:
    """``lang, w1, w2, w3, n`` of the phrases of three words that ``frontier`` wants, both pairs being ``frequent``, and that no ``earlier``
    frontier has wanted."""
    def run(batches):
        for batch in batches:
            for texts, langs in _blocks(batch):
                found = read_words(texts, langs)
                h, width = found.hashes(), max(1, len(found.names))
                known = usual.value.has(h)[found.symbols]
                both = known[:-1] & known[1:] & (found.piece[:-1] == found.piece[1:])
                place = np.flatnonzero(both)
                key, pair = np.unique(found.symbols[place] * width + found.symbols[place + 1], return_inverse=True)
                hashes = pair_hash(*(h[s] for s in np.divmod(key, width)))
                often = frequent.value.has(hashes)
                # Two pairs that follow each other in one piece are a phrase of three words.
                chain = np.flatnonzero((np.diff(place) == 1) & often[pair[:-1]] & often[pair[1:]]) if len(place) > 1 else np.empty(0, np.int64)
                first, second = pair[chain], pair[chain + 1]
                wanted = frontier.value.wants(hashes, first, second)
                for old in earlier:
                    wanted &= ~old.value.wants(hashes, first, second)
                triple, n = np.unique(first[wanted] * width + found.symbols[place[chain[wanted]] + 2], return_counts=True)
                pairs, third = np.divmod(triple, width)
                one, two = map(pa.array, np.divmod(key[pairs], width))
                yield from _slices({"lang": found.langs.take(one), "w1": found.names.take(one), "w2": found.names.take(two), "w3": found.names.take(pa.array(third)), "n": n})

    return _summed(map_batches(docs, "lang string, w1 string, w2 string, w3 string, n long", run), ["w1", "w2", "w3"])


def _score(a: str, left: str, right: str) -> Column:
    """``floor(1000000 * a * a / (l * r))`` in decimals of 38 digits."""
    return F.expr(f"1000000BD * CAST({a} AS DECIMAL(15)) * CAST({a} AS DECIMAL(15)) div (CAST({left} AS DECIMAL(15)) * CAST({right} AS DECIMAL(15)))")


def _bound(end: str) -> Column:
    """Whether a phrase that grows from a pair, with ``end`` as its first or last word, can reach the threshold."""
    return F.expr(f"1000000BD * n >= CAST(threshold AS DECIMAL(7)) * {end}")


def _thresholds(pairs: DataFrame, reach: int) -> DataFrame:
    """``lang, threshold``: the score that ``reach`` pairs have at least, 0 if there are fewer pairs. A language has a million scores at most."""
    levels = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    above = F.sum("n").over(W.partitionBy("lang").orderBy(F.col("score").desc()))
    return levels.select("lang", "score", above.alias("above")).groupBy("lang").agg(
        F.coalesce(F.max(F.when(F.col("above") >= reach, F.col("score"))), F.lit(0)).alias("threshold"))


def _scored_triples(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """``lang, w1, w2, w3, n, l, r, score``: the cut with the lowest score, the first of equal ones."""
    front = pairs.select("lang", "w1", "w2", F.col("n").alias("n12"), F.col("l").alias("n1"))
    back = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23"), F.col("r").alias("n3"))
    cuts = triples.join(front, ["lang", "w1", "w2"]).join(back, ["lang", "w2", "w3"]).withColumns({
        "early": _score("n", "n1", "n23"), "late": _score("n", "n12", "n3")})
    first = F.col("early") <= F.col("late")
    return cuts.select("lang", "w1", "w2", "w3", "n", F.when(first, F.col("n1")).otherwise(F.col("n12")).alias("l"),
                       F.when(first, F.col("n23")).otherwise(F.col("n3")).alias("r"), F.least("early", "late").alias("score"))


def _survivors(pairs: DataFrame, triples: DataFrame, thresholds: DataFrame, covered: int) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of what reaches the threshold and is not covered by a longer phrase."""
    inside = triples.select("lang", "w1", "w2", "n").unionAll(triples.select("lang", "w2", "w3", "n")).groupBy("lang", "w1", "w2").agg(F.max("n").alias("longer"))
    reached = F.col("score") >= F.col("threshold")
    short = (pairs.join(thresholds, "lang").where(reached).join(inside, ["lang", "w1", "w2"], "left")
             .where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("n")))
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), "l", "r", "score"))
    long = triples.join(thresholds, "lang").where(reached).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"), "l", "r", "score")
    return short.unionAll(long)


def _first_ranked(found: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` of each language: of each part of it first, then of these."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    within = found.withColumn("rank", F.row_number().over(W.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= limit)
    return within.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= limit)


def mine_collocations(docs: DataFrame, least: int = LEAST, limit: int = LIMIT, covered: int = COVERED_PERCENT, text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``limit`` phrases of each language by score, count and phrase, among those that
    occur ``least`` times. A phrase that lies in a longer one which occurs at least ``covered`` percent as often is left out. ``n`` counts the
    words of the language; words are separated by blanks and tabs, pieces by ``.,;:!?`` and line ends."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"))
    words = written(count_words(source), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    common = words.where(F.col("n") >= least)
    usual = spark.sparkContext.broadcast(BitFilter.of(common, common.count(), ["w1"]))
    often = count_pairs(source, usual).where(F.col("n") >= least)
    left = common.select("lang", "w1", F.col("n").alias("l"))
    right = common.select("lang", F.col("w1").alias("w2"), F.col("n").alias("r"))
    pairs = written(often.join(left, ["lang", "w1"]).join(right, ["lang", "w2"]).withColumn("score", _score("n", "l", "r")), "pairs")
    frequent = spark.sparkContext.broadcast(BitFilter.of(pairs, pairs.count(), ["w1", "w2"]))

    settled: list[DataFrame] = []
    earlier: list = []
    triples: DataFrame | None = None
    open_pairs, open_source, reach = pairs, source, 2 * limit
    while True:
        thresholds = written(_thresholds(open_pairs, reach), "thresholds")
        bounded = open_pairs.join(thresholds, "lang").withColumns({
            "opens": _bound("l"), "closes": _bound("r"), "reached": F.col("score") >= F.col("threshold")})
        sizes = bounded.agg(*(F.count_if(c) for c in ("opens", "closes", "reached"))).first()
        frontier = spark.sparkContext.broadcast(Frontier(*(
            BitFilter.of(bounded.where(c), n, ["w1", "w2"]) for c, n in zip(("opens", "closes", "reached"), sizes))))
        grown = written(count_triples(open_source, usual, frequent, frontier, earlier).where(F.col("n") >= least), "triples")
        triples = grown if triples is None else triples.unionAll(grown)
        scored = _scored_triples(triples.join(thresholds.select("lang"), "lang", "left_semi") if earlier else triples, pairs)
        found = written(_survivors(open_pairs, scored, thresholds, covered), "survivors")
        counts = found.groupBy("lang").agg(F.count("*").alias("found"))
        state = written(thresholds.join(counts, "lang", "left").select("lang", (F.coalesce("found", F.lit(0)) >= limit).alias("full"), "threshold"), "state")
        settled.append(found.join(state.where("full OR threshold = 0"), "lang", "left_semi"))
        unsettled = state.where("NOT full AND threshold > 0").select("lang")
        if unsettled.isEmpty():
            break
        earlier.append(frontier)
        reach *= DEEPER
        open_pairs, open_source = pairs.join(unsettled, "lang", "left_semi"), source.join(unsettled, "lang", "left_semi")
    best = settled[0]
    for more in settled[1:]:
        best = best.unionAll(more)
    return _first_ranked(best, limit).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")

