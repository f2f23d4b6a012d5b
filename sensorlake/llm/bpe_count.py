"""Token counts of texts under a merge-based vocabulary, without making identifiers.

A text becomes a list of characters, white space written as the vocabulary's mark with one mark in front. A heap holds the
adjacent pairs that form a piece, the lowest rank first, then the leftmost; a linked list joins them. The count is the
number of initial symbols (a character outside the vocabulary is as many symbols as it has bytes) less the merges.

No piece of the vocabulary has the mark after another character, so merges never cross the start of a run of marks: a text
is the sum of its runs, and the counts of frequent runs are remembered within a task.

NULL and empty texts have no tokens. Columns of the input other than id and text are not looked at.
"""

from __future__ import annotations

import functools
import heapq

from pyspark.sql import DataFrame

from sensorlake.llm.common import id_and_bytes, map_batches

MARK = "▁"
#: Remembered runs of a task, and the longest run that is remembered; both bound memory only.
CACHE_ENTRIES, CACHE_LENGTH = 600_000, 64


def load_ranks(path: str) -> dict[str, int]:
    """Piece to rank (the lower merges first) of a sentencepiece model file; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    order = [i for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = sorted({model.get_score(i) for i in order}, reverse=True)
    place = {s: k for k, s in enumerate(scores)}
    return {model.id_to_piece(i): place[model.get_score(i)] for i in order}


def merge_count(run: str, ranks: dict[str, int]) -> int:
    """Tokens of one run of characters: heap of ranked pairs over a linked list."""
    symbols = list(run)
    last = len(symbols)
    before, after = list(range(-1, last - 1)), list(range(1, last + 1))
    heap = [(ranks[pair], i, pair) for i in range(last - 1) if (pair := run[i:i + 2]) in ranks]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, pair = heapq.heappop(heap)
        left = symbols[i]
        j = after[i] if left is not None else last
        if j == last or len(left) + len(symbols[j]) != len(pair) or left + symbols[j] != pair:
            continue  # one of the two has been merged since
        symbols[i], symbols[j] = pair, None
        after[i] = k = after[j]
        merges += 1
        if k < last:
            before[k] = i
            if (longer := pair + symbols[k]) in ranks:
                heapq.heappush(heap, (ranks[longer], i, longer))
        if (h := before[i]) >= 0 and (longer := symbols[h] + pair) in ranks:
            heapq.heappush(heap, (ranks[longer], h, longer))
    outside = sum(len(s.encode()) - 1 for s in symbols if s is not None and len(s) == 1 and s not in ranks)
    return last + outside - merges


class RunCounts(dict):
    """Counts of runs; a run is written with spaces, its first mark left out."""

    def __init__(self, ranks: dict[str, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, run: str) -> int:
        count = merge_count(MARK + run.replace(" ", MARK), self.ranks)
        if len(run) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[run] = count
        return count

    def text(self, text: str) -> int:
        runs = text.replace(MARK, " ").split(" ")
        if "" not in runs:
            return sum(map(self.__getitem__, runs))
        if not text:
            return 0
        total, blanks = 0, ""
        for run in runs[:-1]:
            if run:
                total, blanks = total + self[blanks + run], ""
            else:
                blanks += " "
        return total + self[blanks + runs[-1]]


@functools.cache
def run_counts(path: str) -> RunCounts:
    """One per worker process, so that the tasks it runs share what is remembered."""
    return RunCounts(load_ranks(path))


def count_tokens(docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``; repeated rows stay repeated.

    ``vocabulary`` is looked up among the public tokenizers on the executor; ``path`` names a file instead.
    """
    def run(batches):
        import public_tokenizers

        counts = run_counts(path or public_tokenizers.path(vocabulary))
        for batch in batches:
            data = batch.column(1)
            tokens = [counts.text(b.as_py().decode("utf-8", "replace")) for b in data]
            yield {"doc_id": batch.column(0), "n_bytes": [len(b.as_py()) for b in data], "n_tokens": tokens,
                   "over_limit": [n > limit for n in tokens]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(id_and_bytes(docs, id_col, text_col), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", run)
