"""License detections in texts: ordered signature rules behind keywords, overlaps resolved by priority and containment.

A text becomes words (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, A-Z in lower case). A rule is tried only where one of its keywords occurs. Of
two detections, one that lies inside the other is dropped if the other has a higher priority, or the same and is longer; the
fixed base phrases are never dropped. NULL and empty texts have no words and no detections; repeated
rows are scanned one by one.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import alnum_words, id_and_bytes, map_batches
from sensorlake.llm.license_rules import KINDS, Rule, rules

DETECTION = "struct<label:string,rule:string,kind:string,first_word:long,last_word:long>"


#: A clue says nothing more when a license is named within so many characters behind it.
CLUE_REACH = 80


@functools.cache
def gated() -> dict[bytes, tuple[int, ...]]:
    """Places of the rules in their order, by keyword."""
    by: dict[bytes, list[int]] = {}
    for k, rule in enumerate(rules()):
        for keyword in rule.keywords:
            by.setdefault(keyword, []).append(k)
    return {k: tuple(v) for k, v in by.items()}


@functools.cache
def ordered() -> tuple[Rule, ...]:
    return rules()


def resolve(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of ``(start, end, rule)``, drop what lies inside a detection that wins: higher priority, or equal priority and longer, or the
    same interval and an earlier rule. Clues also yield to what follows them."""
    order, kept = ordered(), []
    for start, end, k in sorted(found, key=lambda d: (-order[d[2]].priority, d[0] - d[1], d[2], d[0])):
        kind = order[k].kind
        if kind == "base" or not any(a <= start and end <= b or kind == "clue" and start <= a <= end + CLUE_REACH for a, b, _ in kept):
            kept.append((start, end, k))
    return sorted(kept)


def detect(words: list[bytes]) -> list[dict]:
    """Detections among the words of one text, by place."""
    by = gated()
    tried = {k for word in by.keys() & set(words) for k in by[word]}
    if not tried:
        return []
    line = b" " + b" ".join(words) + b" "
    order = ordered()
    found = [(m.start(), m.end(), k) for k in tried for m in order[k].pattern.finditer(line)]
    out, at, word = [], 0, -1
    for start, end, k in resolve(found):
        word += line.count(b" ", at, start)
        at = start
        out.append({"label": order[k].label, "rule": order[k].name, "kind": order[k].kind, "first_word": word,
                    "last_word": word + line.count(b" ", start, end)})
    return out


def score(found: list[dict]) -> float:
    """Chance that at least one detection is right, each with the confidence of its kind; 0 without any."""
    wrong = 1.0
    for kind in {d["kind"] for d in found}:
        wrong *= 1.0 - KINDS[kind][0]
    return 1.0 - wrong


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, detections, score`` for each row of ``docs``."""
    def run(batches):
        for batch in batches:
            words = [alnum_words(b.as_py()) for b in batch.column(1)]
            found = [detect(w) for w in words]
            yield {"doc_id": batch.column(0), "n_words": [len(w) for w in words], "detections": found, "score": [score(d) for d in found]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(id_and_bytes(docs, id_col, text_col), f"doc_id {kind}, n_words long, detections array<{DETECTION}>, score double", run)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, places and label lists of ``scan_licenses``. The base labels stand in ``labels`` as well."""
    base = F.filter("detections", lambda d: d["kind"] == "base")

    def joined(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")

    # A place is the word on which a phrase starts.
    starts = F.transform(base, lambda d: d["first_word"])
    return scanned.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                          F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"),
                          joined(F.col("detections")).alias("labels"), "score")
