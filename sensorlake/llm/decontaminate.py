"""Benchmark passages in documents, by latent semantic retrieval and an exact check.

Documents are read once: what is kept are the places of words that the benchmark has (no other word can match), in segments of bounded
length that overlap by more than a passage. Passages are windows of two steps of ``STEP`` words, one from each step. Their TF-IDF
vectors (inverse frequencies over the segments of distinct texts; no word has weight 0) are reduced by a distributed randomised SVD: a random projection,
one power step (each task sums its part of A'A times the projection), and the small eigenproblem of the projected passages. The
space is fitted on all passages, and every passage of every document is searched in it.
Passages and items are compared by cosine in the latent space, each dimension divided by the root of its singular value; what passes,
and every passage that has ``GRAM`` words of an item in a row, however many others have them too, is aligned with the item: the longest common subsequence of their words, and the words of the item's answer, its last part.

A document is a hit for an item if the aligned share of the item is at least ``EXACT``, or at least ``PARAPHRASE`` with
``ANSWER`` of the answer's words in their order; and if the words found there have ``TELLING`` of the item's TF-IDF weight, since
common words align anywhere. Words are letters, digits and characters outside ASCII, in lower case.

The benchmark is the query set. It is taken in blocks of ``ITEMS`` items, each block with its own scan, so what the tasks
carry is bounded. NULL or empty texts and items have no words and no hits; items of fewer than ``LEAST`` words are too short to
tell and are left out. Repeated rows give repeated hits; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import alnum_words, free_name, map_batches, mix
from sensorlake.session import scratch_path

STEP = 24
WINDOW, SEGMENT = 2 * STEP, 1024 * STEP
#: Latent dimensions, and further ones of the projection.
RANK, SPARE, SEED = 160, 32, 7
#: Share of the largest squared singular value that is added to each, and the power of the sum that a dimension is divided by.
DAMPING, SHARPEN = 0.01, 0.25
COSINE, EXACT, PARAPHRASE, ANSWER, TELLING, LEAST = 0.4, 0.6, 0.45, 0.75, 0.5, 6
ITEMS = 4096
#: Words in a row that make a passage a candidate without the latent space; at most ``LEAST``.
GRAM = 5
#: Entries of the sparse matrix that a task multiplies at once.
CHUNK = 60_000


def _words(data: bytes) -> list[bytes]:
    return alnum_words(data if data.isascii() else data.decode("utf-8", "replace").lower().encode())


class Item:
    """The words of an item as numbers, with a bit mask per word for alignment."""

    def __init__(self, item_id, words: list[int]):
        self.item_id, self.words = item_id, words
        self.masks = self._masks(words)
        self.answer = words[-max(3, len(words) // 5):]
        self.answer_masks = self._masks(self.answer)

    @staticmethod
    def _masks(words: list[int]) -> dict[int, int]:
        masks: dict[int, int] = {}
        for k, w in enumerate(words):
            masks[w] = masks.get(w, 0) | 1 << k
        return masks


def common_subsequence(masks: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence with the masked words, by bit vectors."""
    full = (1 << size) - 1
    row = full
    for w in text:
        if m := masks.get(w):
            hit = row & m
            row = (row + hit | row - hit) & full
    return size - row.bit_count()


def _found_words(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, text_key, first, n_words, steps, words``: per segment, the distances between words of the vocabulary and their numbers."""
    def run(batches):
        get = vocabulary.get
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows, cut = [], []
                for k, value in enumerate(part.column(2)):
                    words = _words(value.as_py())
                    numbers = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
                    for first in range(0, max(1, len(words) - 2 * WINDOW), SEGMENT):
                        own = numbers[first:first + SEGMENT + 2 * WINDOW]
                        place = np.flatnonzero(own >= 0)
                        rows.append((k, first, len(own)))
                        cut.append((np.diff(place, prepend=0).astype("<u4").tobytes(), own[place].astype("<u4").tobytes()))
                take = pa.array([r[0] for r in rows], pa.int64())
                yield {"doc_id": part.column(0).take(take), "text_key": part.column(1).take(take), "first": [r[1] for r in rows],
                       "n_words": [r[2] for r in rows], "steps": [c[0] for c in cut], "words": [c[1] for c in cut]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = map_batches(docs, f"doc_id {kind}, text_key long, first long, n_words long, steps binary, words binary", run)
    path = scratch_path(docs.sparkSession, "benchmark-words")
    found.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


class Grams:
    """Each run of ``GRAM`` words of the items, and the items that have it."""

    def __init__(self, items: list[Item]):
        runs: dict[tuple[int, ...], list[int]] = {}
        for i, item in enumerate(items):
            for run in {tuple(item.words[k:k + GRAM]) for k in range(len(item.words) - GRAM + 1)}:
                runs.setdefault(run, []).append(i)
        keys = self._keys(np.array(list(runs), np.int64).reshape(-1, GRAM).T)
        order = np.argsort(keys, kind="stable")
        lists = list(runs.values())
        self.keys, self.items = keys[order], [lists[k] for k in order.tolist()]

    @staticmethod
    def _keys(columns: np.ndarray) -> np.ndarray:
        key = np.zeros(columns.shape[1], np.uint64)
        for column in columns:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1))
        return key

    def found(self, place: np.ndarray, words: np.ndarray) -> set[tuple[int, int]]:
        """``(step, item)`` of each run in a segment, by the step that it begins in."""
        n = len(words) - GRAM + 1
        if n <= 0 or not len(self.keys):
            return set()
        begin = np.flatnonzero(place[GRAM - 1:] - place[:n] == GRAM - 1)
        key = self._keys(np.stack([words[begin + k] for k in range(GRAM)]))
        # Runs of equal keys are neighbours if hashes collide; all their items are candidates.
        low, high = np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, side="right")
        hits = np.flatnonzero(high > low)
        return {(s, i) for s, a, b in zip((place[begin[hits]] // STEP).tolist(), low[hits].tolist(), high[hits].tolist())
                for k in range(a, b) for i in self.items[k]}


class Chunk(NamedTuple):
    """Some segments of a batch: their rows, their ``(place, word)`` arrays, the first step of each, and the step and word of all entries."""

    rows: list[int]
    segments: list[tuple[np.ndarray, np.ndarray]]
    base: np.ndarray
    step: np.ndarray
    word: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        """Steps with which a passage begins: all but the last of a segment, or its only one."""
        out = np.ones(self.base[-1], bool)
        out[(self.base[1:] - 1)[np.diff(self.base) > 1]] = False
        return np.flatnonzero(out)

    def passages(self, weight: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rows of the TF-IDF passages times ``right``, one for each of ``starts``."""
        steps = np.zeros((self.base[-1] + 1, right.shape[1]), np.float32)
        use = np.flatnonzero(weight[self.word] > 0)
        if len(use):
            step, word = self.step[use], self.word[use]
            first = np.flatnonzero(np.r_[True, step[1:] != step[:-1]])
            steps[step[first]] = np.add.reduceat(right[word] * weight[word, None], first, axis=0)
        starts = self.starts
        follows = np.ones(self.base[-1], bool)
        follows[self.base[1:] - 1] = False
        return steps[starts] + steps[starts + 1] * follows[starts, None]


def _chunks(batch) -> Iterator[Chunk]:
    steps, words, sizes = (batch.column(name) for name in ("steps", "words", "n_words"))
    rows: list[int] = []
    entries = 0
    for k in range(batch.num_rows):
        rows.append(k)
        entries += len(words[k].as_buffer()) // 4
        if entries < CHUNK and k < batch.num_rows - 1:
            continue
        segments = [(np.cumsum(np.frombuffer(steps[r].as_buffer(), "<u4").astype(np.int64)), np.frombuffer(words[r].as_buffer(), "<u4").astype(np.int64)) for r in rows]
        base = np.r_[0, np.cumsum([max(1, -(-sizes[r].as_py() // STEP)) for r in rows])]
        own = np.repeat(base[:-1], [len(p) for p, _ in segments])
        yield Chunk(rows, segments, base, own + np.concatenate([p for p, _ in segments]) // STEP, np.concatenate([w for _, w in segments]))
        rows, entries = [], 0


def _sums(table: DataFrame, width: int, fn) -> dict[int, np.ndarray]:
    """Sum over all tasks of the rows of a matrix that ``fn(matrix, chunk)`` adds to; the matrix has ``width`` columns."""
    def run(batches):
        total = None
        for batch in batches:
            for chunk in _chunks(batch):
                total = fn(total, chunk)
        if total is not None:
            there = np.flatnonzero(total.any(axis=1))
            yield {"row": there, "values": total[there].tolist()}

    parts = map_batches(table.select("n_words", "steps", "words"), "row long, values array<double>", run)
    summed = parts.groupBy("row").agg(*(F.sum(F.col("values")[k]).alias(f"v{k}") for k in range(width))).toArrow()
    values = np.stack([summed.column(k + 1).to_numpy() for k in range(width)], axis=1)
    return dict(zip(summed.column(0).to_pylist(), values))


def _frequencies(table: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Segments of distinct texts that have each word, and such segments in all."""
    def add(total, chunk):
        total = np.zeros((size + 1, 1)) if total is None else total
        for _, words in chunk.segments:
            total[np.unique(words), 0] += 1
        total[size, 0] += len(chunk.rows)
        return total

    # Copies shrink to one in each task before the shuffle.
    one = F.max(F.struct("n_words", "steps", "words")).alias("one")
    distinct = table.groupBy("text_key", "first").agg(one).select("one.*")
    out = np.zeros(size + 1)
    for row, value in _sums(distinct, 1, add).items():
        out[row] = value[0]
    return out[:size], int(out[size])


def latent_space(table: DataFrame, weight: np.ndarray) -> np.ndarray:
    """Right singular vectors (words by dimensions) of the TF-IDF passages over the roots of their singular values, by randomised SVD with one
    power step."""
    size, width = len(weight), RANK + SPARE
    start = np.random.default_rng(SEED).standard_normal((size, width)).astype(np.float32)

    def add_power(total, chunk):
        total = np.zeros((size, width)) if total is None else total
        rows, starts = chunk.passages(weight, start), chunk.starts
        # A step is in the passage that it begins, and in the one that the step before it begins if that is of its segment.
        of_step = np.zeros((chunk.base[-1] + 1, width), np.float32)
        of_step[starts] = rows
        follows = np.setdiff1d(starts + 1, chunk.base, assume_unique=True)
        of_step[follows] += rows[np.searchsorted(starts, follows - 1)]
        use = np.flatnonzero(weight[chunk.word] > 0)
        order = use[np.argsort(chunk.word[use], kind="stable")]
        word = chunk.word[order]
        if len(word):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            total[word[first]] += np.add.reduceat(of_step[chunk.step[order]] * weight[word, None], first, axis=0)
        return total

    power = np.zeros((size, width))
    for row, values in _sums(table, width, add_power).items():
        power[row] = values
    basis = np.linalg.qr(power)[0].astype(np.float32)
    columns = basis.shape[1]

    def add_gram(total, chunk):
        total = np.zeros((columns, columns)) if total is None else total
        rows = chunk.passages(weight, basis)
        return total + rows.T @ rows

    gram = np.zeros((columns, columns))
    for row, values in _sums(table, columns, add_gram).items():
        gram[row] = values
    values, vectors = np.linalg.eigh(gram)
    best = np.argsort(-values)[:RANK]
    # Damped, so that directions with next to no share in the corpus do not decide.
    return (basis @ (vectors[:, best] / (np.maximum(values[best], 0) + DAMPING * max(values.max(), 1e-12)) ** SHARPEN)).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.maximum(length, 1e-12)


def _search(table: DataFrame, items: list[Item], weight: np.ndarray, space: np.ndarray) -> DataFrame:
    """Hits ``doc_id, text_key, item_id, cosine, aligned, answer, first_word, last_word``; a document may have an item more than once."""
    targets = _unit(np.stack([(space[item.words] * weight[item.words, None]).sum(axis=0) for item in items])).T.copy()
    telling = [frozenset(w for w in item.words if weight[w] > 0) for item in items]
    enough = [TELLING * float(sum(weight[w] for w in t)) for t in telling]
    weights = weight.tolist()
    grams = Grams(items)

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            firsts = batch.column("first").to_pylist()
            for chunk in _chunks(batch):
                starts = chunk.starts
                cosines = _unit(chunk.passages(weight, space)) @ targets
                near, which = np.nonzero(cosines >= COSINE)
                segment = np.searchsorted(chunk.base, starts[near], side="right") - 1
                best: dict[tuple[int, int], tuple] = {}
                candidates = {(s, int(starts[n] - chunk.base[s]), i): float(cosines[n, i]) for n, i, s in zip(near.tolist(), which.tolist(), segment.tolist())}
                for s, (place, words) in enumerate(chunk.segments):
                    passages = int(np.searchsorted(starts, chunk.base[s + 1]) - np.searchsorted(starts, chunk.base[s]))
                    for step, i in grams.found(place, words):
                        step = min(step, passages - 1)
                        candidates.setdefault((s, step, i), float(cosines[np.searchsorted(starts, chunk.base[s] + step), i]))
                for (s, step, i), cosine in candidates.items():
                    (place, words), item = chunk.segments[s], items[i]
                    at = step * STEP
                    # The item may begin or end in the neighbouring passages.
                    reach = max(STEP, len(item.words) - STEP)
                    low, high = np.searchsorted(place, (at - reach, at + WINDOW + reach))
                    text = words[low:high].tolist()
                    if sum(weights[w] for w in telling[i].intersection(text)) < enough[i]:
                        continue
                    aligned = common_subsequence(item.masks, len(item.words), text) / len(item.words)
                    if aligned < PARAPHRASE or aligned <= best.get((s, i), (0,))[0]:
                        continue
                    answer = common_subsequence(item.answer_masks, len(item.answer), text) / len(item.answer)
                    if aligned >= EXACT or answer >= ANSWER:
                        offset = firsts[chunk.rows[s]]
                        best[s, i] = aligned, answer, cosine, offset + int(place[low]), offset + int(place[high - 1])
                out += [(chunk.rows[s], items[i].item_id, *found) for (s, i), found in best.items()]
            take = pa.array([r[0] for r in out], pa.int64())
            yield {"doc_id": batch.column("doc_id").take(take), "text_key": batch.column("text_key").take(take), "item_id": [r[1] for r in out],
                   "cosine": [r[4] for r in out], "aligned": [r[2] for r in out], "answer": [r[3] for r in out],
                   "first_word": [r[5] for r in out], "last_word": [r[6] for r in out]}

    kind = table.schema["doc_id"].dataType.simpleString()
    return map_batches(table, f"doc_id {kind}, text_key long, item_id long, cosine double, aligned double, answer double, "
                              "first_word long, last_word long", run)


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with enough words, ``ITEMS`` at a time."""
    block: list[tuple[int, list[bytes]]] = []
    for row in benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).alias("t")).where("i IS NOT NULL").distinct().orderBy("i", "t").toLocalIterator():
        words = _words((row["t"] or "").encode())
        if len(words) >= LEAST:
            block.append((row["i"], words))
        if len(block) == ITEMS:
            yield block
            block = []
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """One row for each document and item of which it has a passage: ``doc_id, item_id, cosine, aligned, answer, first_word, last_word,
    text_key``. Places are words of the document from 0, of the aligned surroundings; ``text_key`` is ``xxhash64`` of the text's bytes."""
    spark = docs.sparkSession
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    small = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(data).alias("text_key"), data.alias("data"))
    kind = small.schema["doc_id"].dataType.simpleString()
    hits = spark.createDataFrame([], f"doc_id {kind}, text_key long, item_id long, cosine double, aligned double, answer double, first_word long, last_word long")
    for block in _item_blocks(benchmark, item_col, item_text_col):
        vocabulary: dict[bytes, int] = {}
        items = [Item(i, [vocabulary.setdefault(w, len(vocabulary)) for w in words]) for i, words in block]
        table = _found_words(small, vocabulary)
        frequency, segments = _frequencies(table, len(vocabulary))
        weight = np.log1p(segments / np.maximum(frequency, 1.0)).astype(np.float32)
        hits = hits.unionAll(_search(table, items, weight, latent_space(table, weight)))
    best = F.max_by(F.struct("cosine", "aligned", "answer", "first_word", "last_word"), F.struct("aligned", "cosine", "first_word")).alias("b")
    return hits.groupBy("doc_id", "text_key", "item_id").agg(best).select("doc_id", "item_id", "b.*", "text_key")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that have no passage of the benchmark."""
    own_id, own_key = (free_name([*docs.columns, text_col], n) for n in ("__id", "__key"))
    bad = find_leaks(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key)).distinct()
    key = F.xxhash64(F.coalesce(docs[text_col].cast("binary"), F.lit(b"")))
    return docs.join(bad, docs[id_col].eqNullSafe(bad[own_id]) & (key == bad[own_key]), "left_anti")
