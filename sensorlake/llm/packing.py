"""Best-fit packing of token pieces into sequences of bounded length, in bulk-synchronous steps.

Pieces are ranged by length, and the gaps of the open sequences by size. A superstep takes all pieces of the longest length that
is left and sweeps the gaps upward from the successor of that length: conflicts are resolved by rank (the k-th piece of
the length takes the k-th place in the sweep), the gaps are updated, and the next step begins; pieces that find no gap open new
sequences. This is best-fit decreasing, so the number of sequences is within a few of the least possible on real lengths.

Pieces of one length and gaps of one size are exchangeable, so a step works on runs (first rank, count). There are at most
``capacity`` lengths and gap sizes, however many documents there are: the runs are planned on the driver from one count per length,
while ranks, counts and the places of all pieces are worked out by the tasks. No piece, id or text passes the driver.

A NULL or empty text is the end token alone. Repeated rows are packed one by one. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import functools
import unicodedata
from collections.abc import Iterable

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.common import id_and_bytes, map_batches
from sensorlake.session import written

CAPACITY, END = 2048, 0
#: Remembered words of a task; bounds memory only.
CACHE_ENTRIES, CACHE_LENGTH = 500_000, 64
ENDINGS = (b",", b".", b"!", b"?", b";", b":", b"!!")


class WordIds(dict):
    """Little-endian 32-bit ids of the words of a text that is split at ASCII white space.

    The vocabulary drops white space and never joins what stands on both sides of it, it folds case, and it splits
    punctuation from a letter in front: so words stand for themselves, as in lower case, and as word and ending.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.endings = {e: self.encode(e) for e in ENDINGS}
        closing = [i for piece, i in self.tokenizer.get_vocab().items() if piece.endswith("</w>")]
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closes[closing] = True

    def encode(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def stem(self, word: bytes) -> bytes:
        """The word without its ending, if what is in front of that is a letter."""
        tail = word[-2:] if word[-2:] in self.endings else word[-1:]
        return word[:-len(tail)] if tail in self.endings and len(word) > len(tail) and 97 <= word[-len(tail) - 1] <= 122 else word

    def learn(self, words: Iterable[bytes]) -> None:
        """Remember new words of letters, many to a call: one is one symbol of the splitting step, whose last piece closes it."""
        new = [w for w in {self.stem(w) for w in words if w not in self} if w not in self and len(w) <= CACHE_LENGTH]
        new = [w for w, t in ((w, w.decode("utf-8", "replace")) for w in new)
               if t.isalpha() and t == t.lower() and unicodedata.is_normalized("NFC", t) and t.encode() == w]
        if len(self) + len(new) > CACHE_ENTRIES:
            self.clear()
        for at in range(0, len(new), 256):
            part = new[at:at + 256]
            ids = np.array(self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(part):
                self.update(zip(part, (x.tobytes() for x in np.split(ids, ends[:-1]))))

    def __missing__(self, word: bytes) -> bytes:
        stem = self.stem(word)
        ids = self.encode(word) if stem is word else self[stem] + self.endings[word[len(stem):]]
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids

    def texts(self, texts: list[bytes]) -> list[bytes]:
        # A special token is known only as it is written, so a text that may have one keeps its case.
        split = [(data if b"<|" in data else data.lower()).split() for data in texts]
        self.learn(set().union(*split) - self.keys())
        return [b"".join(map(self.__getitem__, words)) for words in split]


@functools.cache
def word_ids(path: str) -> WordIds:
    """One per worker process, so that the tasks it runs share what is remembered."""
    return WordIds(path)


def cut_pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY, end: int = END, id_col: str = "doc_id",
               text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids``: the ids of each text and the end token, cut only where a text exceeds ``capacity``.

    ``ids`` is binary, little-endian unsigned 32-bit. ``vocabulary`` is looked up among the public tokenizers on the executor.
    """
    width = 4 * capacity

    def run(batches):
        import public_tokenizers

        ids = word_ids(path or public_tokenizers.path(vocabulary))
        closing = np.array([end], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows, pieces = [], []
                for k, whole in enumerate(ids.texts(part.column(1).to_pylist())):
                    whole += closing
                    for p in range(0, len(whole), width):
                        rows.append((k, p // width))
                        pieces.append(whole[p:p + width])
                yield {"doc_id": part.column(0).take([r[0] for r in rows]), "piece": [r[1] for r in rows],
                       "start": [r[1] * capacity for r in rows], "length": [len(x) // 4 for x in pieces], "ids": pieces}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(id_and_bytes(docs, id_col, text_col), f"doc_id {kind}, piece int, start long, length long, ids binary", run)


def plan_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places of runs: ``(length, first rank, pieces, first sequence, pieces per sequence, offset)``.

    ``counts`` has the number of pieces by length. Gaps are runs ``size -> [(first sequence, count)]``.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    opened, out = 0, []

    def add(size: int, first: int, count: int) -> None:
        if size and count:
            if size not in gaps:
                bisect.insort(sizes, size)
                gaps[size] = []
            gaps[size].append((first, count))

    for length in sorted(counts, reverse=True):
        left, rank, at = counts[length], 0, bisect.bisect_left(sizes, length)
        taken = []
        while left:
            if at < len(sizes):
                size = sizes[at]
                first, count = gaps[size].pop()
                if not gaps[size]:
                    del gaps[size], sizes[at]
            else:  # no gap fits: open as many sequences as the rest of this length fills
                size, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            per = size // length
            full = min(count, left // per)
            if full:
                out.append((length, rank, full * per, first, per, capacity - size))
                taken.append((size - per * length, first, full))
            rest = left - full * per if full < count else 0
            if rest:
                out.append((length, rank + full * per, rest, first + full, rest, capacity - size))
                taken.append((size - rest * length, first + full, 1))
            used = full + (rest > 0)
            left, rank = left - full * per - rest, rank + full * per + rest
            if used < count:
                taken.append((size, first + used, count - used))
        for gap in taken:
            add(*gap)
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, among them ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``; columns of these names are replaced.

    Offsets within a sequence have no gaps from 0. The pieces are written once to the shared folder: a rank is the place of a piece
    among those of its length in the task that wrote it, plus what the tasks before it have, so it stays as it is when a task
    is repeated.
    """
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    place = columns.index("length")

    def number(batches):
        import pyarrow as pa

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            lengths = batch.column(place).to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.argsort(lengths, kind="stable")
            ranked = lengths[order]
            within = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
            local = np.empty(len(ranked), np.int64)
            local[order] = seen[ranked] + within
            seen += np.bincount(lengths, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(ranked), task), pa.int32()), pa.array(local, pa.int64())],
                                             names=[*batch.schema.names, "__task", "__local"])

    schema = pieces.select("*", F.lit(0).cast("int").alias("__task"), F.lit(0).cast("long").alias("__local")).schema
    table = written(pieces.mapInArrow(number, schema), "pieces")
    per_task = table.groupBy("length", "__task").agg(F.count("*").alias("__n"))
    before = per_task.select("length", "__task", (F.sum("__n").over(Window.partitionBy("length").orderBy("__task")) - F.col("__n")).alias("__before"))
    # One row for each length, so at most ``capacity`` rows.
    counts = {int(r["length"]): int(r["n"]) for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = np.array(sorted(plan_runs(counts, capacity)), np.int64).reshape(-1, 6)
    ranked = table.join(before, ["length", "__task"]).select(*columns, (F.col("__before") + F.col("__local")).alias("__rank"))

    def locate(batches):
        import pyarrow as pa

        keys = places[:, 0] << 48 | places[:, 1]
        for batch in batches:
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            lengths = batch.column(place).to_numpy(zero_copy_only=False).astype(np.int64)
            run = places[np.searchsorted(keys, lengths << 48 | rank, side="right") - 1]
            nth = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(run[:, 3] + nth // run[:, 4]), pa.array(run[:, 5] + nth % run[:, 4] * lengths)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    return ranked.mapInArrow(locate, schema)
