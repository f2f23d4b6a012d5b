"""Quality rules: how far the characters and common words of a text are from those of its language.

A text has two histograms: its characters by class, and its words by common word of the language (the rest is one bin). Both are
compared with the language's reference by Jensen-Shannon distance (base 2, so 0 to 1). The references are sums over documents that
are labelled as good (at most ``LABELLED`` of them, those with the least hash of their id) and pass the base rules, gathered in a first pass (a
few rows of fixed length per task). They do not depend on what else the corpus holds: a verdict stays as it is however much junk
is around. Without labels, all documents that pass the base rules make the references, which is right only where good ones prevail. A language
that is not in the list, or NULL, shares the reference ``other``; a language without a reference is judged by the base rules alone.
Short texts are guarded: below ``MIN_CHARS`` word characters or ``MIN_WORDS`` words the histogram says too little, and the comparison is left out.

Base rules: fewer than 20 words, or more than 30 % of the words in windows of 8 words that the text has twice. A NULL or empty
text has no words and is rejected by them. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import free_name, map_batches, mix

#: Common words of the four languages, and of all of them for texts in another one.
COMMON = {
    "en": "the of and to a in that it is was for on are as with be by at from this have an he she they which or not but we his her has had were been".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei".split(),
    "fr": "de la le et les des en un une du est pour que qui dans par sur au pas plus avec ce il se son sont ou mais nous vous ils elle".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre".split(),
}
COMMON["other"] = sorted({w for words in COMMON.values() for w in words[:16]})
#: Bins of a word histogram: the common words, words without a letter or digit, and all others.
WORD_BINS = 2 + max(map(len, COMMON.values()))
MARKS = [m * k for m in "|#*$%&<>=+-_~/\\^•·–—" for k in (1, 2, 3)]
INDEX = {lang: {(form + end).encode(): k for k, w in enumerate(words) for form in {w, w.capitalize(), w.upper()} for end in ("", *".,;:!?")}
         | {m.encode(): WORD_BINS - 2 for m in MARKS} for lang, words in COMMON.items()}
CLASSES = ("lower", "upper", "digit", "space", "stop", "quote", "bracket", "symbol", "control", "beyond")

#: Distances from which a text is rejected, and the least size of what is compared.
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE, MIN_CHARS, MIN_WORDS = 0.3, 0.45, 80, 40
MIN_TEXT_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Labelled documents from which the references are made, at most.
LABELLED = 50_000


def _class(c: int) -> int:
    if 97 <= c <= 122:
        return 0
    if 65 <= c <= 90:
        return 1
    if 48 <= c <= 57:
        return 2
    if c == 32 or 9 <= c <= 13:
        return 3
    if chr(c) in ".,;:!?":
        return 4
    if chr(c) in "'\"`-":
        return 5
    if chr(c) in "()[]{}":
        return 6
    if c < 32 or c == 127:
        return 8
    return 9 if c >= 128 else 7


CLASS_OF = np.array([_class(c) for c in range(256)])
STARTS = np.array([not 128 <= c < 192 for c in range(256)])
SYMBOLS = [ord(c) for c in "#*$%&|<>"]
BLANK = [32, *range(9, 14)]


#: Odd factors that tell the places in a window apart.
FACTORS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64)) | np.uint64(1)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window of ``window`` words that occurs at least twice in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = mix(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64))
    key = np.zeros(n, np.uint64)
    for k in range(window):
        key += h[k:k + n] * FACTORS[k]
    ranked = np.sort(key)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return 0
    hits = np.flatnonzero(np.isin(key, twice))
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, hits, 1)
    np.add.at(cover, hits + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def _known(lang: str | None) -> str:
    return lang if lang in COMMON else "other"


def measure(data: bytes, lang: str | None) -> dict:
    """Base figures and both histograms of one text."""
    bytes_of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    chars = np.bincount(CLASS_OF, weights=bytes_of * STARTS, minlength=len(CLASSES))
    repeats = repeated_words(words)
    counts = np.bincount([k for k in map(INDEX[_known(lang)].get, words) if k is not None], minlength=WORD_BINS).astype(float)
    counts[-1] = len(words) - counts.sum()
    return {
        "n_words": len(words), "word_chars": int((bytes_of * STARTS).sum() - bytes_of[BLANK].sum()),
        "n_symbols": int(bytes_of[SYMBOLS].sum()), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeats,
        "base_failed": len(words) < MIN_TEXT_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words),
        "chars": chars, "words": counts,
    }


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence of two histograms, in bits; 0 if one of them is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def kl(a):
        there = a > 0
        return float((a[there] * np.log2(a[there] / m[there])).sum())

    return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5


def _inputs(text_col: str, lang_col: str) -> tuple[Column, Column]:
    return F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"), F.col(lang_col).cast("string").alias("lang")


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Histograms of all documents by language. At most five rows of fixed length reach the driver."""
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for data, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                m = measure(data.as_py(), lang)
                if not m["base_failed"]:
                    both = np.concatenate([m["chars"], m["words"]])
                    sums[_known(lang)] = sums.get(_known(lang), 0) + both
        if sums:
            yield {"lang": list(sums), "bins": [v.tolist() for v in sums.values()]}

    width = len(CLASSES) + WORD_BINS
    parts = map_batches(docs.select(*_inputs(text_col, lang_col)), "lang string, bins array<double>", run)
    rows = parts.groupBy("lang").agg(*(F.sum(F.col("bins")[k]).alias(f"b{k}") for k in range(width))).collect()
    return {r["lang"]: (np.array(r[1:1 + len(CLASSES)]), np.array(r[1 + len(CLASSES):])) for r in rows}


def _references(docs: DataFrame, labels: DataFrame | None, id_col: str, text_col: str, lang_col: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Histograms of the documents with quality 1 in ``labels`` (``doc_id, quality``), or of all documents without ``labels``."""
    if labels is None:
        return language_references(docs, text_col, lang_col)
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    own = free_name(docs.columns, "__id")
    # At most ``LABELLED`` ids, so they can go to every task and no text is shuffled.
    chosen = F.broadcast(good.withColumnRenamed("doc_id", own))
    return language_references(docs.join(chosen, docs[id_col] == chosen[own], "left_semi"), text_col, lang_col)


def verdict(m: dict, reference: tuple[np.ndarray, np.ndarray] | None) -> tuple[float | None, float | None, bool]:
    """Both distances (NULL below the guards or without a reference) and whether the text is kept."""
    chars = words = None
    if reference is not None and m["word_chars"] >= MIN_CHARS:
        chars = js_distance(m["chars"], reference[0])
    if reference is not None and m["n_words"] >= MIN_WORDS:
        words = js_distance(m["words"], reference[1])
    far = chars is not None and chars > MAX_CHAR_DISTANCE or words is not None and words > MAX_WORD_DISTANCE
    return chars, words, not (m["base_failed"] or far)


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def quality(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id``, the base figures, both distances and ``kept`` for each row of ``docs``; ``labels`` say which documents the references are made of."""
    references = _references(docs, labels, id_col, text_col, lang_col)

    def run(batches):
        for batch in batches:
            langs = batch.column(2).to_pylist()
            found = [measure(d.as_py(), lang) for d, lang in zip(batch.column(1), langs)]
            judged = [verdict(m, references.get(_known(lang))) for m, lang in zip(found, langs)]
            yield {"doc_id": batch.column(0)} | {k: [m[k] for m in found] for k in FIGURES} | {
                name: [j[k] for j in judged] for k, name in enumerate(("char_distance", "word_distance", "kept"))}

    kind = docs.schema[id_col].dataType.simpleString()
    small = docs.select(F.col(id_col).alias("doc_id"), *_inputs(text_col, lang_col))
    return map_batches(small, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                              "base_failed boolean, char_distance double, word_distance double, kept boolean", run)


def keep_good(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    references = _references(docs, labels, id_col, text_col, lang_col)
    text_at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            langs = batch.column(lang_at).to_pylist()
            texts = (value.as_py() or "" for value in batch.column(text_at))
            yield batch.filter(pa.array([verdict(measure(t.encode(), lang), references.get(_known(lang)))[2] for t, lang in zip(texts, langs)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
