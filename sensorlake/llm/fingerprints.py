"""Fingerprints of improbable features: rare byte windows in chained Bloom filters, compared by the bits they share.

Every window of ``WINDOW`` bytes has an entropy, in thousandths of the largest one possible. Windows of typical prose are near
``TYPICAL``; the farther a window is from it, the less probable it is. Windows that hardly vary (under ``WEAK``) say nothing about a text and
come last. In each ``WINDOW`` consecutive windows the least probable one wins, the first of equal ones; a window that wins ``POPULAR`` times
is a feature. The scale is fixed, not fitted, so fingerprints made at different times or from different corpora compare.

Features go in text order, each once, into Bloom filters of ``BITS`` bits with ``HASHES`` bits a feature; a filter holds ``FULL`` of them, then the
next one begins. Two filters are alike by the share of common bits above what chance gives; two fingerprints, by the mean over
the filters of the shorter one, each with the filter of the other one that is most like it.

A text without bytes (NULL too) has no features: its fingerprint is like that of another such text (1) and unlike all others (0). A text
shorter than a window is one feature; one without a window that wins often enough has the one that wins most often, or its least probable
one if there are too few to compete. Long texts are worked on in parts of ``PART`` bytes that overlap, so a text needs its own size, no more.
Equal texts have equal fingerprints wherever they stand.
"""

from __future__ import annotations

import base64
import hashlib
import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import id_and_bytes, map_batches, mix
from sensorlake.session import written

WINDOW, POPULAR = 32, 8
TYPICAL, WEAK = 780, 200
BITS, HASHES, FULL = 2048, 5, 160
#: Share of the way from chance to all bits that two filters must have in common before they count as alike at all.
ABOVE_CHANCE = 0.3
#: Bytes that are worked on at once; a place in a part takes so many bits.
PART, PLACE_BITS = 1 << 17, 18
#: Bytes of filters that are compared at once.
COMPARED = 1 << 24

# Growth of c * log2(c) from c to c + 1 equal bytes, in integers, so that running sums never drift.
_LEVELS = np.arange(WINDOW + 2, dtype=float)
_TERMS = np.round(_LEVELS * np.log2(np.maximum(_LEVELS, 1)) * (1 << 20)).astype(np.int64)
_GROWTH = np.diff(_TERMS)
_LEVEL_BITS = np.uint64(BITS.bit_length() - 1)
_SALT = mix(np.arange(1, WINDOW // 8 + 2, dtype=np.uint64))


def window_entropies(data: np.ndarray) -> np.ndarray:
    """Entropy of each ``WINDOW`` bytes in thousandths of the largest one possible."""
    n = len(data)
    if n < WINDOW:
        return np.empty(0, np.int32)
    before, behind = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        before[d:] += same
        behind[:-d] += same
    # The window loses its first byte, whose equals stand behind it, and gains the next one, whose equals stand before it.
    joins, leaves = _GROWTH[before], _GROWTH[behind]
    sums = np.cumsum(joins)
    sums = sums[WINDOW - 1:] - np.r_[0, np.cumsum(leaves[:n - WINDOW])]
    largest = _TERMS[WINDOW]
    return ((largest - sums) * 1000 // largest).astype(np.int32)


def improbability(entropy: np.ndarray) -> np.ndarray:
    """Rank of windows by entropy: the least is the least probable."""
    return np.where(entropy < WEAK, 2000 - entropy, 1000 - np.abs(entropy - TYPICAL)).astype(np.int32)


def _wins(ranks: np.ndarray) -> np.ndarray:
    """The place of the least rank, the first of equal ones, in each ``WINDOW`` consecutive ones."""
    least = ranks << np.int32(PLACE_BITS) | np.arange(len(ranks), dtype=np.int32)
    step = 1
    while step < WINDOW:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return least & np.int32((1 << PLACE_BITS) - 1)


def _part_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of the features of texts that lie end to end; a text has a window at least."""
    ranks = improbability(window_entropies(data))
    counts = np.zeros(len(data), np.int32)
    if len(ranks) >= WINDOW:
        winner = _wins(ranks)
        # A competition counts if all its windows lie in one text.
        text = np.searchsorted(ends, np.arange(len(winner)), side="right")
        whole = np.arange(len(winner)) + 2 * WINDOW - 1 <= ends[text]
        counts += np.bincount(winner[whole], minlength=len(counts)).astype(np.int32)
    chosen = counts >= POPULAR
    some = np.add.reduceat(chosen, starts) > 0
    for start, end in zip(starts[~some].tolist(), ends[~some].tolist()):
        windows = slice(start, end - WINDOW + 1)
        chosen[start + (np.argmax(counts[windows]) if counts[windows].any() else np.argmin(ranks[windows]))] = True
    return np.flatnonzero(chosen)


def _long_features(data: np.ndarray) -> np.ndarray:
    """The same for one text of any length, part by part; each part sees all competitions that its windows take part in."""
    counts, n = np.zeros(len(data) - WINDOW + 1, np.uint8), len(data) - WINDOW + 1
    for at in range(0, n, PART):
        low, high = max(0, at - WINDOW + 1), min(n, at + PART + WINDOW - 1)
        winner = _wins(improbability(window_entropies(data[low:high + WINDOW - 1]))) + low
        inside = winner[(winner >= at) & (winner < at + PART)]
        counts[at:at + PART] += np.bincount(inside - at, minlength=min(PART, n - at)).astype(np.uint8)
    return np.flatnonzero(counts >= POPULAR) if (counts >= POPULAR).any() else np.array([np.argmax(counts)])


def _hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows at ``places``."""
    h = np.full(len(places), _SALT[-1])
    words = np.ascontiguousarray(data[places[:, None] + np.arange(WINDOW)]).view(np.uint64)
    for k in range(words.shape[1]):
        h = mix(h ^ words[:, k] * _SALT[k])
    return h


def _short_hash(data: bytes) -> np.ndarray:
    padded = np.frombuffer(data.ljust(WINDOW, b"\0"), np.uint8)
    return mix(_hashes(padded, np.array([0])) + np.uint64(len(data)))


def feature_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Hashes of the features of each text, each once, in text order."""
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)

    def put(members: list[int]) -> None:
        sizes = np.array([len(texts[k]) for k in members])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(texts[k] for k in members), np.uint8)
        places = _part_features(data, ends - sizes, ends)
        hashes = _hashes(data, places)
        cuts = np.searchsorted(places, ends[:-1])
        for k, own in zip(members, np.split(hashes, cuts)):
            out[k] = own[np.sort(np.unique(own, return_index=True)[1])]

    held, members = 0, []
    for k, data in enumerate(texts):
        if len(data) > PART:
            whole = np.frombuffer(data, np.uint8)
            own = _hashes(whole, _long_features(whole))
            out[k] = own[np.sort(np.unique(own, return_index=True)[1])]
        elif len(data) >= WINDOW:
            if held + len(data) > PART:
                put(members)
                held, members = 0, []
            members.append(k)
            held += len(data)
        elif data:
            out[k] = _short_hash(data)
    if members:
        put(members)
    return out


class Digest:
    """Chained Bloom filters: ``filters`` of packed bits, ``n`` features in all."""

    __slots__ = ("filters", "n")

    def __init__(self, filters: np.ndarray, n: int):
        self.filters, self.n = filters, n

    @classmethod
    def of(cls, hashes: np.ndarray) -> Digest:
        n = len(hashes)
        bits = np.zeros((-(-n // FULL), BITS), bool)
        rows = np.arange(n) // FULL
        for k in range(HASHES):
            bits[rows, (hashes >> np.uint64(k) * _LEVEL_BITS & np.uint64(BITS - 1)).astype(np.int64)] = True
        return cls(np.packbits(bits, axis=1), n)

    def __str__(self) -> str:
        return f"{self.n}:{base64.b64encode(bytes(self)).decode()}"

    def __bytes__(self) -> bytes:
        return self.filters.tobytes()

    @classmethod
    def parse(cls, text: str) -> Digest:
        n, _, body = text.partition(":")
        return cls(np.frombuffer(base64.b64decode(body), np.uint8).reshape(-1, BITS // 8), int(n))

    def counts(self) -> np.ndarray:
        """Features of each filter."""
        return np.minimum(FULL, self.n - FULL * np.arange(len(self.filters)))


def _best(a: Digest, b: Digest) -> float:
    """Mean over the filters of ``a``, by their features, of the likeness to the most like filter of ``b``."""
    na, nb = a.counts(), b.counts()
    set_b = np.bitwise_count(b.filters).sum(axis=1)
    stay = 1 - 1 / BITS
    empty_b = stay ** (HASHES * nb)
    best = np.zeros(len(na))
    step = max(1, COMPARED // b.filters.nbytes)
    for at in range(0, len(na), step):
        some = a.filters[at:at + step]
        common = np.bitwise_count(some[:, None, :].view(np.uint64) & b.filters[None].view(np.uint64)).sum(axis=2, dtype=np.int64)
        most = np.minimum(np.bitwise_count(some).sum(axis=1)[:, None], set_b[None])
        empty_a = (stay ** (HASHES * na[at:at + step]))[:, None]
        chance = BITS * (1 - empty_a - empty_b[None] + empty_a * empty_b[None])
        floor = chance + ABOVE_CHANCE * (most - chance)
        best[at:at + step] = np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1).max(axis=1)
    return float((best * na).sum() / a.n)


def likeness(a: Digest, b: Digest) -> float:
    """0 to 1; the same both ways. Of fingerprints with as many filters, both directions count alike."""
    if not a.n or not b.n:
        return float(a.n == b.n)
    if len(a.filters) == len(b.filters):
        if a.n == b.n and np.array_equal(a.filters, b.filters):
            return 1.0
        return (_best(a, b) + _best(b, a)) / 2
    return _best(*sorted((a, b), key=lambda d: len(d.filters)))


def digests(texts: list[bytes]) -> list[Digest]:
    """The fingerprint of each text."""
    return [Digest.of(h) for h in feature_hashes(texts)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_features, fingerprint`` for each row of ``docs``. Other columns, whatever their names, are not read; repeated rows and ids give
    a row each, and an empty table none."""
    def run(batches):
        for batch in batches:
            found = digests([v.as_py() for v in batch.column(1)])
            yield {"doc_id": batch.column(0), "n_features": [d.n for d in found], "fingerprint": [str(d) for d in found]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(id_and_bytes(docs, id_col, text_col), f"doc_id {kind}, n_features long, fingerprint string", run)


def spliced(text: str, other: str) -> str:
    """The text with its last half replaced by the first as many characters (or all) of the other one."""
    half = len(text) // 2
    return text[:len(text) - half] + other[:half]


#: Rows of ``_with_next``: ready, the first of a partition (its next text is in another one), and the last text of a partition.
READY, FIRST, LAST = 0, 1, 2
_FIGURES = "n_chars long, edited_sha256 binary, n_own long, own binary, n_edited long, edited binary, near_edited double, near_next double"
_NAMES = [f.split()[0] for f in _FIGURES.split(", ")]


def _compare(texts: list[str], following: list[str], own: list[Digest], nexts: list[Digest]) -> dict[str, list]:
    """Figures of texts and the ones that follow them, with the fingerprints of both."""
    edited = [spliced(t, o).encode() for t, o in zip(texts, following)]
    changed = digests(edited)
    return dict(zip(_NAMES, ([len(t) for t in texts], [hashlib.sha256(e).digest() for e in edited], [d.n for d in own], [bytes(d) for d in own],
                             [d.n for d in changed], [bytes(d) for d in changed], [likeness(a, b) for a, b in zip(own, changed)],
                             [likeness(a, b) for a, b in zip(own, nexts)])))


def _with_next(ordered: DataFrame, kind: str) -> DataFrame:
    """Figures of all rows but the first of each partition of ``ordered``; that one, and the last one, come with their texts."""
    def run(batches):
        part, last_id, text, digest = TaskContext.get().partitionId(), None, None, None
        empty = [None] * len(_NAMES)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if not texts:
                continue
            own = digests([t.encode() for t in texts])
            first = text is None
            if first:
                yield {"part": [part], "role": [FIRST], "doc_id": batch.column(0).slice(0, 1), "text": texts[:1]} | {n: [None] for n in _NAMES}
            rows, before, nexts = texts[first:], [*([] if first else [text]), *texts], [*([] if first else [digest]), *own]
            yield {"part": [part] * len(rows), "role": [READY] * len(rows), "doc_id": batch.column(0).slice(int(first)), "text": [None] * len(rows)} | _compare(
                rows, before[:len(rows)], own[first:], nexts[:len(rows)])
            last_id, text, digest = batch.column(0).slice(len(texts) - 1), texts[-1], own[-1]
        if text is not None:
            yield {"part": [part], "role": [LAST], "doc_id": last_id, "text": [text]} | {n: [x] for n, x in zip(_NAMES, empty)}

    return map_batches(ordered, f"part int, role byte, doc_id {kind}, text string, {_FIGURES}", run)


def splice_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How alike a text stays to itself when its last half is replaced by the start of the next document's text, and how alike it is to
    that document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for each row of ``docs``.

    The next document has the next smaller id; after the smallest id (NULL ids are smaller than all others) comes the greatest one. Rows of
    one id are in the order of a hash of their texts, so a repeated id is spread over partitions; a single row is its own next one. The texts are sorted by
    range once; only the first and the last one of each partition travel again, to meet across the border. Other columns, whatever their
    names, are not read; an empty table gives no rows.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    found = written(_with_next(ordered, kind), "fingerprints")
    # One number for each partition that has rows.
    parts = sorted(r["part"] for r in found.where(F.col("role") == FIRST).select("part").collect())
    borders = spark.createDataFrame(list(zip(parts, [*parts[-1:], *parts[:-1]])), "part int, other int")
    first = found.where(F.col("role") == FIRST).select("part", "doc_id", "text").join(borders, "part")
    last = found.where(F.col("role") == LAST).select(F.col("part").alias("other"), F.col("text").alias("following"))

    def run(batches):
        for batch in batches:
            texts, following = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            both = digests([t.encode() for t in texts + following])
            yield {"doc_id": batch.column(0)} | _compare(texts, following, both[:len(texts)], both[len(texts):])

    met = map_batches(first.join(last, "other").select("doc_id", "text", "following"), f"doc_id {kind}, {_FIGURES}", run)
    every = found.where(F.col("role") == READY).select("doc_id", *_NAMES).unionByName(met)

    def text_form(n: str, filters: str) -> Column:
        # Some settings break base64 into lines.
        return F.concat(F.col(n).cast("string"), F.lit(":"), F.translate(F.base64(filters), "\r\n", ""))

    return every.select("doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), text_form("n_own", "own").alias("fingerprint"),
                        text_form("n_edited", "edited").alias("edited_fingerprint"), "near_edited", "near_next")
