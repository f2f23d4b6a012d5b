"""Removal of long strings that repeat anywhere in a corpus, by sorted suffixes at anchors.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts at another place too. Each window of that length has an
anchor: its gram of least hash, which equal windows choose at the same distance. So only windows of one anchor can be equal, and only
an anchor that occurs twice is looked at. For those, the text around each occurrence goes to one group per anchor: the suffix behind
the anchor, and the prefix in front of it read backwards. Both are sorted (deep-shallow: multikey quicksort, then blind
tries); the sorted neighbours' common prefixes give, for each distance of the window start, the classes of equal left and of
equal right parts, and a window repeats if another one shares both classes.

Groups of more than ``HOT`` occurrences are not gathered: their windows are counted by a 128-bit hash instead, with partial
aggregates. Copies of a whole text are one text for all of this; they are removed in full if the text has a window at all.

Texts are UTF-8 bytes; NULL is empty. Matches never cross documents. Repeated rows are copies. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.anchors import anchors
from sensorlake.llm.common import map_batches
from sensorlake.llm.deep_shallow import common_prefix, deep_shallow
from sensorlake.session import written

LENGTH = 400
#: Rows of one anchor up to which they are gathered, and members up to which they are compared two by two.
HOT, FEW = 50_000, 5


def _inside(length: int) -> int:
    return max(1, length // 2)


def _count_anchors(texts: DataFrame, length: int) -> DataFrame:
    """``t, h, m``: the anchors of each text and how often each occurs in it."""
    def run(batches):
        for batch in batches:
            for k, value in enumerate(batch.column(1)):
                h, place, _, _ = anchors(value.as_py(), length, _inside(length))
                if len(h):
                    # A part of a long text may see the anchor of the part before it again: places count, not runs.
                    h, m = np.unique(h[np.unique(place, return_index=True)[1]], return_counts=True)
                    yield {"t": batch.column(0).take(pa.array(np.full(len(h), k))), "h": h.view(np.int64), "m": m}

    return map_batches(texts, "t binary, h long, m long", run)


def _occurrences(touched: DataFrame, length: int) -> DataFrame:
    """``h, hot, t, place, front, back`` of the repeated anchors of each text: the bytes before and behind the anchor's gram
    that its windows reach."""
    gram = _inside(length)

    def run(batches):
        for batch in batches:
            for k, (value, wanted) in enumerate(zip(batch.column(1), batch.column(2))):
                data = value.as_py()
                hot = {w["h"]: w["hot"] for w in wanted.as_py()}
                h, place, first, last = anchors(data, length, gram)
                keep = np.flatnonzero(np.isin(h.view(np.int64), np.fromiter(hot, np.int64)))
                h, place, first, last = h.view(np.int64)[keep].tolist(), place[keep].tolist(), first[keep].tolist(), last[keep].tolist()
                yield {"h": h, "hot": [hot[x] for x in h], "t": batch.column(0).take(pa.array(np.full(len(h), k, np.int64))), "place": place,
                       "front": [data[a:p] for a, p in zip(first, place)], "back": [data[p + gram:b + length] for b, p in zip(last, place)]}

    return map_batches(touched, "h long, hot boolean, t binary, place long, front binary, back binary", run)


def repeated_distances(members: list[tuple[bytes, bytes]], reach: int) -> list[list[tuple[int, int]]]:
    """For different ``(front, back)`` around one anchor: the distances d (first, last) of window starts before the anchor whose window,
    d bytes of front and ``reach`` - d of back, another member has as well."""
    n = len(members)
    found: list[list[tuple[int, int]]] = [[] for _ in members]
    backwards = [front[::-1] for front, _ in members]
    if n <= FEW:
        for i in range(n):
            for j in range(i + 1, n):
                low = reach - common_prefix(members[i][1], members[j][1])
                high = common_prefix(backwards[i], backwards[j])
                if low <= high:
                    found[i].append((low, high))
                    found[j].append((low, high))
        return found
    right, right_lcp = map(np.array, deep_shallow([back for _, back in members]))
    left, left_lcp = map(np.array, deep_shallow(backwards))
    fronts, backs = np.array([len(f) for f, _ in members]), np.array([len(b) for _, b in members])
    changes = np.unique(np.concatenate([left_lcp + 1, fronts + 1, reach - right_lcp, reach - backs, [0, reach + 1]]))
    changes = changes[(changes >= 0) & (changes <= reach + 1)]
    classes = np.empty(n, np.int64)
    for low, after in zip(changes[:-1].tolist(), changes[1:].tolist()):
        there = np.flatnonzero((fronts >= low) & (backs >= reach - low))
        if len(there) < 2:
            continue
        # Neighbours in the sorted order are in one class if they share as much as the window takes of them.
        classes[right] = np.cumsum(right_lcp < reach - low) * np.int64(n + 1)
        own = classes[there]
        classes[left] = np.cumsum(left_lcp < low)
        both, counts = np.unique(own + classes[there], return_inverse=True, return_counts=True)[1:]
        for k in there[counts[both] > 1].tolist():
            found[k].append((low, after - 1))
    return found


def _compare(rows: DataFrame, length: int) -> DataFrame:
    """``t, start, end`` of repeated bytes, from occurrences sorted by anchor."""
    gram = _inside(length)
    reach = length - gram

    def group(rows):
        same: dict[tuple[bytes, bytes], list[tuple[bytes, int]]] = {}
        for t, place, front, back in rows:
            same.setdefault((front, back), []).append((t, place))
        members = list(same)
        for (front, back), distances in zip(members, repeated_distances(members, reach) if len(members) > 1 else [[]]):
            places = set(same[front, back])
            if len(places) > 1:
                distances = [(reach - len(back), len(front))]
            for t, place in places:
                for low, high in distances:
                    yield t, place - high, place - low + length

    def run(batches):
        current, rows = None, []
        for batch in batches:
            out = []
            for h, *row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if h != current:
                    out += group(rows) if len(rows) > 1 else ()
                    current, rows = h, []
                rows.append(row)
            yield {"t": [x[0] for x in out], "start": [x[1] for x in out], "end": [x[2] for x in out]}
        out = list(group(rows)) if len(rows) > 1 else []
        yield {"t": [x[0] for x in out], "start": [x[1] for x in out], "end": [x[2] for x in out]}

    return map_batches(rows.select("h", "t", "place", "front", "back"), "t binary, start long, end long", run)


def _count_windows(rows: DataFrame, length: int) -> DataFrame:
    """``t, start, end`` of repeated windows, by a hash of each window."""
    gram = _inside(length)
    reach = length - gram

    def run(batches):
        import xxhash

        for batch in batches:
            for k, (h, place, front, back) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4)))):
                distances = range(reach - len(back), len(front) + 1)
                seed = h.to_bytes(8, "little", signed=True)
                yield {"w": [xxhash.xxh3_128_digest(seed + front[len(front) - d:] + b"|" + back[:reach - d]) for d in distances],
                       "t": batch.column(1).take(pa.array(np.full(len(distances), k))), "start": [place - d for d in distances]}

    windows = written(map_batches(rows.select("h", "t", "place", "front", "back"), "w binary, t binary, start long", run), "windows")
    key = F.xxhash64("t", "start")
    twice = windows.groupBy("w").agg(F.min(key).alias("x"), F.max(key).alias("y")).where("x <> y").select("w")
    return windows.join(twice, "w").select("t", "start", (F.col("start") + length).alias("end"))


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def _cut(touched: DataFrame, covers: DataFrame) -> DataFrame:
    """``t, spans, kept_sha256`` of the texts that lose bytes."""
    spans = covers.groupBy("t").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches):
        for batch in batches:
            merged, digests = [], []
            for value, found in zip(batch.column(1), batch.column(2)):
                data, at, kept = value.as_py(), 0, hashlib.sha256()
                merged.append(_merge([(s["start"], s["end"]) for s in found.as_py()]))
                for start, end in merged[-1]:
                    kept.update(data[at:start])
                    at = end
                kept.update(data[at:])
                digests.append(kept.hexdigest())
            yield {"t": batch.column(0), "spans": [[{"start": a, "end": b} for a, b in m] for m in merged], "kept_sha256": digests}

    return map_batches(touched.select("t", "data").join(spans, "t"), "t binary, spans array<struct<start:long,end:long>>, kept_sha256 string", run)


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept_sha256`` for each row of ``docs``: the bytes that go (from 0, end exclusive), and the digest of the
    bytes that stay."""
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    digest = F.unhex(F.sha2(data, 256))
    texts = docs.select(digest.alias("t"), data.alias("data"))
    counted = written(_count_anchors(texts, length), "anchors")
    key = F.xxhash64("t")
    twice = (counted.groupBy("h").agg(F.min(key).alias("x"), F.max(key).alias("y"), F.max("m").alias("most"), F.sum("m").alias("n"))
             .where("x <> y OR most > 1").select("h", (F.col("n") > hot).alias("hot")))
    wanted = counted.join(twice, "h").groupBy("t").agg(F.collect_set(F.struct("h", "hot")).alias("wanted"))
    touched = written(texts.dropDuplicates(["t"]).join(wanted, "t"), "touched")
    found = _occurrences(touched, length)
    usual = found.where("NOT hot").repartition("h").sortWithinPartitions("h")
    covers = _compare(usual, length).unionAll(_count_windows(found.where("hot"), length))
    cut = written(_cut(touched, covers), "cut")
    rows = docs.select(F.col(id_col).alias("doc_id"), digest.alias("t"), F.octet_length(data).cast("long").alias("n_bytes"))
    copies = rows.groupBy("t").agg((F.count("*") > 1).alias("copied"))
    all_gone = F.col("copied") & (F.col("n_bytes") >= length)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    nothing = F.array().cast("array<struct<start:long,end:long>>")
    return rows.join(copies.join(cut, "t", "left"), "t").select(
        "doc_id", "n_bytes", F.when(all_gone, everything).otherwise(F.coalesce("spans", nothing)).alias("spans"),
        F.when(all_gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("t")))).alias("kept_sha256"))
