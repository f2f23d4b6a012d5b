"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. Equal sets are one vertex from the start. Each vertex has a sketch of minwise tokens.
A tree branches a vertex along ``BRANCH`` chosen tokens at each node: node and choice are functions of the path, so each task
finds the nodes of its vertices without talking to others, and two sets of similarity s share a chosen token with
probability s. Nodes of one vertex are dropped, small ones compared exhaustively; larger ones link their members to one
of them and branch on. What is still large after ``BLIND`` levels are groups of copies rather than chance. If its members all belong to
one component, nothing is left to find in it. Otherwise the members outside its largest component meet all others on their full sets,
block by block; only nodes in which these fill several blocks branch on first, down to ``DEPTH``. A list of two blocks counts all
common shingles at once and returns a forest of links, so what leaves it is bounded by its members, not by their pairs.
A pair of similarity 0.8 survives ``BLIND`` levels of a tree with probability 0.91, so ``TREES`` = 6 independent trees miss it with
probability 5e-7. Sketches only propose: every link is confirmed on the full sets.

Defined cases: a NULL or empty text, or one without words, has no shingles and is linked with nothing. Fewer words than a shingle
are one shingle. Repeated rows and copies share a component. A NULL id does not become a component's id unless it has no other.
An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import free_name, lower_words, map_batches, mix
from sensorlake.llm.components import components
from sensorlake.session import written

TREES, POOL, BRANCH = 6, 10, 2
SKETCH = TREES * POOL
#: Nodes up to this size are compared exhaustively; the depth to which all larger ones branch; the depth to which mixed ones branch whose
#: smaller components fill several blocks; rows and shingles of a block.
SMALL, BLIND, DEPTH, BLOCK, WEIGHT = 24, 3, 5, 512, 1 << 19
#: Shingles of more members of a list than this are counted by a matrix product, others by their pairs; columns of a product.
FEW, COLUMNS = 32, 2048
#: Share of equal sketch tokens from which a pair is confirmed on its full sets: 4.4 deviations below 0.8 at 60 tokens.
PROPOSED = 0.57
CACHE_ENTRIES = 400_000
#: Bits that say which texts are wanted, at most.
FILTER_BITS = 1 << 26

_SEEDS = mix(np.arange(1, 4 * SKETCH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FACTOR, SHIFT, PLACE, SALT = _SEEDS[:SKETCH, None] | np.uint64(1), _SEEDS[SKETCH:2 * SKETCH, None], _SEEDS[2 * SKETCH:3 * SKETCH] | np.uint64(1), _SEEDS[3 * SKETCH:]


class WordHashes(dict):
    """64-bit hashes of words; remembers some of them."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(data: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``size`` words."""
    words = lower_words(data)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    key = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(size, len(h))):
        key += h[k:k + n] * PLACE[k % SKETCH]
    return np.unique(mix(key))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The least hash of the set under each function, 32 bits of it."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[None, at:at + 2048] * FACTOR + SHIFT).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _vertices(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, v, sketch, brief``: a hash of the whole set, its minwise tokens, and a byte of each token; all
    three are NULL for empty sets."""
    def run(batches):
        import xxhash

        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(value.as_py(), size, hashes) for value in batch.column(2)]
            tokens = [sketch(s) if len(s) else None for s in sets]
            yield {"doc_id": batch.column(0), "text_key": batch.column(1), "n_shingles": [len(s) for s in sets],
                   "v": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                   "sketch": [None if t is None else t.tobytes() for t in tokens],
                   "brief": [None if t is None else t.astype(np.uint8).tobytes() for t in tokens]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs, f"doc_id {kind}, text_key long, n_shingles long, v binary, sketch binary, brief binary", run)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), SKETCH)


def _branch(rows: DataFrame, fresh: bool) -> DataFrame:
    """Children ``(node, tree, used, v)`` of the nodes of ``rows``, or of all roots if ``fresh``; needs ``v, sketch``."""
    def run(batches):
        for batch in batches:
            tokens = _matrix(batch.column("sketch"), "<u4")
            n = len(tokens)
            if not n:
                continue
            if fresh:
                starts = [(np.full(n, SALT[t]), np.full(n, t, np.int32), np.zeros(n, np.int32)) for t in range(TREES)]
            else:
                starts = [(batch.column("node").to_numpy().view(np.uint64), batch.column("tree").to_numpy(), batch.column("used").to_numpy())]
            for path, tree, used in starts:
                used = used.copy()
                for k in range(BRANCH):
                    # The unused token of the tree's pool that the path ranks first; a later child may not repeat an earlier one's.
                    ranks = mix(path[:, None] + SALT[None, :POOL])
                    ranks[(used[:, None] >> np.arange(POOL)) & 1 == 1] = np.iinfo(np.uint64).max
                    token = np.argsort(ranks, axis=1, kind="stable")[:, k]
                    value = tokens[np.arange(n), tree * POOL + token].astype(np.uint64)
                    child = mix(mix(path + PLACE[token] * np.uint64(3)) + value * np.uint64(0x9E3779B97F4A7C15))
                    yield {"node": child.view(np.int64), "tree": tree, "used": used | (1 << token).astype(np.int32), "v": batch.column("v")}

    return map_batches(rows, "node long, tree int, used int, v binary", run)


def _proposed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def _alike_in_size(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of so many shingles can be similar enough."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _compare_lists(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b, share)`` with different labels within ``members array<struct<v, brief, label, n_shingles>>``."""
    def run(batches):
        for batch in batches:
            out: dict[str, list] = {"a": [], "b": [], "share": []}
            for members in batch.column(0).to_pylist():
                keys = [m["v"] for m in members]
                tokens = np.frombuffer(b"".join(m["brief"] for m in members), np.uint8).reshape(len(members), SKETCH)
                labels = np.unique(np.array([m["label"] for m in members], dtype=object), return_inverse=True)[1]
                sizes = np.array([m["n_shingles"] for m in members])
                for i in range(len(keys) - 1):
                    share = _proposed(tokens[i], tokens[i + 1:])
                    for j in np.flatnonzero((share >= PROPOSED) & (labels[i + 1:] != labels[i]) & _alike_in_size(sizes[i], sizes[i + 1:], percent)):
                        a, b = sorted((keys[i], keys[i + 1 + j]))
                        if a != b:
                            out["a"].append(a), out["b"].append(b), out["share"].append(float(share[j]))
            yield out

    return map_batches(lists.select("members"), "a binary, b binary, share double", run)


def _compare_pivots(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b, share)`` of ``v, brief, n_shingles`` with ``pivot struct<v, brief, n_shingles>``."""
    def run(batches):
        for batch in batches:
            pivot = batch.column("pivot")
            share = _proposed(_matrix(batch.column("brief"), "u1"), _matrix(pivot.field("brief"), "u1"))
            share[~_alike_in_size(batch.column("n_shingles").to_numpy(), pivot.field("n_shingles").to_numpy(), percent)] = 0
            hits = [(*sorted((v, p)), s) for v, p, s in zip(batch.column("v").to_pylist(), pivot.field("v").to_pylist(), share) if s >= PROPOSED and v != p]
            yield {"a": [h[0] for h in hits], "b": [h[1] for h in hits], "share": [float(h[2]) for h in hits]}

    return map_batches(rows.select("v", "brief", "n_shingles", "pivot"), "a binary, b binary, share double", run)


def _maybe_wanted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` less most rows whose ``text_key`` is not in ``wanted``, so that few texts are shuffled. No wanted one is lost: a bit per key, in
    at most ``FILTER_BITS`` bits, whose 64-bit words are all that passes the driver."""
    spark, size = docs.sparkSession, min(FILTER_BITS, 1 << max(10, (16 * wanted.count()).bit_length()))
    at = F.pmod("text_key", F.lit(size))
    word, bit = F.floor(at / 64), (at % 64).cast("int")
    held = wanted.groupBy(word.alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(text_key, {size}) % 64 AS int)))").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[held.column("word").to_numpy()] = held.column("bits").to_numpy()
    known = spark.createDataFrame(pa.table({"bits": pa.array([bits], pa.list_(pa.int64()))}))
    return docs.join(F.broadcast(known), F.getbit(F.get("bits", word.cast("int")), bit) == 1, "left_semi")


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``(v, shingles)`` of the vertices in ``wanted (v, doc_id, text_key)``, from the texts of one document each."""
    docs = _maybe_wanted(docs, wanted)
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["text_key"] == wanted["text_key"])).select(wanted["v"], "data")

    def run(batches):
        import xxhash

        hashes = WordHashes()
        for batch in batches:
            keys, sets = batch.column(0).to_pylist(), [shingle_set(value.as_py(), size, hashes).tobytes() for value in batch.column(1)]
            same = [k for k, (v, s) in enumerate(zip(keys, sets)) if xxhash.xxh3_128_digest(s) == v]
            yield {"v": [keys[k] for k in same], "shingles": [sets[k] for k in same]}

    return map_batches(texts, "v binary, shingles binary", run).dropDuplicates(["v"])


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b, la, lb`` whose full sets are similar enough."""
    first = pairs.select("a", "b", "la", "lb").join(sets.select(F.col("v").alias("b"), F.col("shingles").alias("sb")), "b")
    both = first.join(sets.select(F.col("v").alias("a"), F.col("shingles").alias("sa")), "a").select("a", "b", "la", "lb", "sa", "sb")

    def run(batches):
        for batch in batches:
            hits = []
            for k, (x, y) in enumerate(zip(batch.column(4), batch.column(5))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                ranked = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((ranked[1:] == ranked[:-1]).sum())
                if 100 * common >= percent * (len(ranked) - common):
                    hits.append(k)
            yield {c: batch.column(c).take(pa.array(hits, pa.int64())) for c in ("a", "b", "la", "lb")}

    return map_batches(both, "a binary, b binary, la binary, lb binary", run)


class _Links:
    """Confirmed links so far, and the component of each linked vertex."""

    def __init__(self, spark, sets: DataFrame, percent: int):
        self.sets, self.percent, self.started = sets, percent, False
        self.labels = spark.createDataFrame([], "v binary, label binary")

    def add(self, pairs: DataFrame) -> None:
        """Confirm what may join two components. At first the likeliest pair of each vertex, then whatever is still between two."""
        rounds = [pairs] if self.started else [pairs.groupBy("b").agg(F.max_by("a", "share").alias("a")), pairs]
        self.started = True
        for some in rounds:
            left = written(self._between(some), "pairs")
            if left.isEmpty():
                continue
            found = written(_confirm(left, self.sets, self.percent), "links")
            self.join(found)

    def join(self, found: DataFrame) -> None:
        """Take in links ``a, b`` between components ``la, lb``."""
        # A component stands for its vertices: what is new are links between labels, and those change labels.
        joined = components(found.select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()).select(F.col("v").alias("label"), F.col("label").alias("new"))
        ends = found.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("la").alias("label")), F.struct(F.col("b").alias("v"), F.col("lb").alias("label")))).alias("e"))
        known = self.labels.unionAll(ends.select("e.*")).distinct()
        self.labels = written(known.join(joined, "label", "left").select("v", F.coalesce("new", "label").alias("label")), "labels")

    def _between(self, pairs: DataFrame) -> DataFrame:
        """Pairs of different components, with both labels."""
        la, lb = (self.labels.select(F.col("v").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
        both = pairs.select("a", "b").distinct().join(la, "a", "left").join(lb, "b", "left")
        return both.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb")).where("la <> lb")

    def labelled(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.labels, "v", "left").withColumn("label", F.coalesce("label", "v"))


def _sized(rows: DataFrame) -> DataFrame:
    """Nodes with at least two vertices, and with two labels where ``rows`` have labels; adds the size ``n``."""
    what = [F.count("*").alias("n")]
    if "label" in rows.columns:
        what += [F.min("label").alias("first"), F.max("label").alias("last")]
    sizes = rows.groupBy("node").agg(*what).where("n > 1")
    if "label" in rows.columns:
        sizes = sizes.where("first <> last")
    return rows.join(sizes.select("node", "n"), "node")


def _propose(active: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """Pairs within small nodes, and of large nodes' members with one of them."""
    if "label" not in active.columns:
        active = active.withColumn("label", F.col("v"))
    rows = active.join(vertices.select("v", "brief", "n_shingles"), "v")
    small = rows.where(F.col("n") <= SMALL).groupBy("node").agg(F.collect_list(F.struct("v", "brief", "label", "n_shingles")).alias("members"))
    large = rows.where(F.col("n") > SMALL)
    pivots = large.groupBy("node").agg(F.min_by(F.struct("v", "brief", "n_shingles"), F.xxhash64("tree", "v")).alias("pivot"))
    return _compare_lists(small, percent).unionAll(_compare_pivots(large.join(pivots, "node"), percent))


def _mixed(rows: DataFrame, vertices: DataFrame) -> DataFrame:
    """``rows (node, v, label, ..)`` of the nodes with several components; adds the largest, ``main``, and into how many blocks it and the
    others are dealt."""
    parts = rows.join(vertices.select("v", "n_shingles"), "v").groupBy("node", "label").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("w"))
    nodes = parts.groupBy("node").agg(F.max(F.struct("m", "label", "w")).alias("most"), F.sum("m").alias("m"), F.sum("w").alias("w")).where("most.m < m")

    def blocks(members, shingles):
        return F.greatest(F.ceil(members / BLOCK), F.ceil(shingles / WEIGHT)).cast("long")

    most = {c: F.col(f"most.{c}") for c in ("m", "label", "w")}
    return rows.join(nodes.select("node", most["label"].alias("main"), blocks(most["m"], most["w"]).alias("main_blocks"),
                                  blocks(F.col("m") - most["m"], F.col("w") - most["w"]).alias("other_blocks")), "node")


def _lists(mixed: DataFrame) -> DataFrame:
    """``node, low, high, v, label``: two blocks make a list. A block of the main component meets those of the others, which also meet
    each other; the main component's do not, as all is known in it."""
    main = F.col("label") == F.col("main")
    own = F.pmod(F.xxhash64("v"), F.when(main, F.col("main_blocks")).otherwise(F.col("other_blocks")))

    def each(blocks, low, high):
        return F.transform(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1), lambda b: F.struct(low(b).alias("low"), high(b).alias("high")))

    rest = F.filter(each("other_blocks", lambda b: F.least(b, F.col("own")), lambda b: F.greatest(b, F.col("own"))), lambda x: x["low"] < x["high"])
    met = F.when(main, each("other_blocks", lambda b: -1 - F.col("own"), lambda b: b)).otherwise(
        F.concat(each("main_blocks", lambda b: -1 - b, lambda b: F.col("own")), rest))
    return mixed.withColumn("own", own).select("node", "v", "label", F.inline(met))


def overlaps(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many shingles the sets have in common that stand one after another in ``flat``; right above the diagonal."""
    n = len(sizes)
    order = np.argsort(flat, kind="stable")
    ranked, row = flat[order], np.repeat(np.arange(n), sizes)[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    counts = np.diff(np.r_[starts, len(ranked)])
    column = np.repeat(np.arange(len(counts)), counts)
    out = np.zeros((n, n), np.int64)
    held = ((counts > 1) & (counts <= FEW))[column]
    r, c = row[held], column[held]
    for d in range(1, min(FEW, len(r))):
        same = np.flatnonzero(c[d:] == c[:-d])
        if not len(same):
            break
        out += np.bincount(r[same] * n + r[same + d], minlength=n * n).reshape(n, n)
    many = np.flatnonzero(counts > FEW)
    place = np.full(len(counts), -1)
    place[many] = np.arange(len(many))
    place = place[column]
    for at in range(0, len(many), COLUMNS):
        part = np.flatnonzero((place >= at) & (place < at + COLUMNS))
        there = np.zeros((n, min(COLUMNS, len(many) - at)), np.float32)
        there[row[part], place[part] - at] = 1
        out += (there @ there.T).astype(np.int64)
    return out


def _linked_within(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, la, lb``: a forest of the links between components within each list, with labels for both ends."""
    def run(table: pa.Table) -> pa.Table:
        labels = table.column("label").combine_chunks().dictionary_encode()
        codes, names = labels.indices.to_numpy(), labels.dictionary.to_pylist()
        data = table.column("shingles").to_pylist()
        sizes = np.array([len(s) // 8 for s in data])
        common = overlaps(np.frombuffer(b"".join(data), np.uint64), sizes)
        hits = np.triu(100 * common >= percent * (sizes[:, None] + sizes[None, :] - common), 1) & (codes[:, None] != codes[None, :])
        i, j = np.nonzero(hits)
        up = list(range(len(names)))

        def root(k):
            while up[k] != k:
                up[k] = k = up[up[k]]
            return k

        found = []
        for pair in np.unique(codes[i].astype(np.int64) * len(names) + codes[j]).tolist():
            x, y = root(pair // len(names)), root(pair % len(names))
            if x != y:
                up[x] = y
                found.append((names[pair // len(names)], names[pair % len(names)]))
        a, b = pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())
        return pa.table({"a": a, "b": b, "la": a, "lb": b})

    lists = _lists(mixed).join(sets, "v").select("node", "low", "high", "label", "shingles")
    return lists.groupBy("node", "low", "high").applyInArrow(run, "a binary, b binary, la binary, lb binary")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_key, label`` for each row of ``docs``.

    ``component_id`` is the smallest id that links of at least ``percent`` of the union reach; ``kept`` marks the rows that have it.
    ``text_key`` is ``xxhash64`` of the text's bytes. ``label`` names the component whatever its ids are, NULL without shingles.
    """
    spark = docs.sparkSession
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    small = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(data).alias("text_key"), data.alias("data"))
    rows = written(_vertices(small, shingle), "documents")
    vertices = written(rows.where("v IS NOT NULL").groupBy("v").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("one"), F.min("sketch").alias("sketch"), F.min("brief").alias("brief"),
        F.min("n_shingles").alias("n_shingles")), "vertices")
    active = written(_sized(_branch(vertices.select("v", "sketch"), fresh=True)), "nodes")
    pairs = written(_propose(active, vertices, percent), "pairs")
    for _ in range(1, BLIND):
        children = _branch(active.where(F.col("n") > SMALL).join(vertices.select("v", "sketch"), "v"), fresh=False)
        active = written(_sized(children), "nodes")
        pairs = pairs.unionAll(written(_propose(active, vertices, percent), "pairs"))
    # The full sets of all that may be linked, made from the texts once.
    large = active.where(F.col("n") > SMALL)
    wanted = pairs.select(F.col("a").alias("v")).unionAll(pairs.select(F.col("b").alias("v"))).unionAll(large.select("v")).distinct()
    one = written(vertices.join(wanted, "v", "left_semi").select("v", "one.doc_id", "one.text_key"), "wanted")
    links = _Links(spark, written(_full_sets(small, one, shingle), "sets"), percent)
    links.add(pairs)
    large = large.select("node", "tree", "used", "v")
    for depth in range(BLIND, DEPTH + 1):
        mixed = written(_mixed(links.labelled(large), vertices), "mixed")
        found = written(_linked_within(mixed if depth == DEPTH else mixed.where("other_blocks = 1"), links.sets, percent), "links")
        if not found.isEmpty():
            links.join(found)
        deeper = mixed.where("other_blocks > 1").select("node", "tree", "used", "v")
        if depth == DEPTH or deeper.isEmpty():
            break
        children = _branch(deeper.join(vertices.select("v", "sketch"), "v"), fresh=False)
        active = written(_sized(links.labelled(children)), "nodes")
        links.add(written(_propose(active, vertices, percent), "pairs"))
        large = active.where(F.col("n") > SMALL).select("node", "tree", "used", "v")
    labelled = written(links.labelled(rows.select("doc_id", "text_key", "n_shingles", "v")), "labelled")
    reached = labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    joined = labelled.join(reached, "label", "left")
    component = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key", "label")


def keep_one_each(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but one row of each component.

    Of the rows with the component's id, the one with the smallest text hash stays; of rows equal in both, any one. Components are
    told apart by label, as ids may be NULL or repeated. Rows without shingles stay.
    """
    found = near_duplicates(docs, shingle, percent, id_col, text_col).where("label IS NOT NULL")
    one = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("one")
    # The helper columns have names that the documents do not have.
    own_id, own_key = (free_name(docs.columns, n) for n in ("__id", "__key"))
    reps = found.groupBy("label").agg(one).select(F.col("one.doc_id").alias(own_id), F.col("one.text_key").alias(own_key)).distinct()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lone = ~text.rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.where(~lone).withColumn(own_key, F.xxhash64(F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))))
    kept = keyed.join(reps, keyed[id_col].eqNullSafe(reps[own_id]) & (keyed[own_key] == reps[own_key])).select(keyed["*"])
    return kept.dropDuplicates([id_col, own_key]).drop(own_key).unionAll(docs.where(lone))
