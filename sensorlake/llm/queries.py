"""The corpus operators over the given tables: one query each, with a SQL oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import bpe_count, chat, collocations, decontaminate, fingerprints, license_scan, near_dup, packing, periodic_runs, quality, repeats, secrets, suffix_tree_lm
from sensorlake.session import require_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(require_utc(spark), folder)
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


NEAR_DUP_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON s.doc_id = c.x
"""


@query("op1_near_dup", NEAR_DUP_SQL)
def op1_near_dup(spark, folder):
    found = near_dup.near_duplicates(table(spark, folder, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


_REPLACED = "text"
for _control in chat.RESERVED:
    _REPLACED = f"replace({_REPLACED}, '{_control}', '{_control[0]}\\{_control[1:]}')"
_RESERVED_IN = " OR ".join(f"contains(text, '{c}')" for c in chat.RESERVED)
CHAT_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
rendered AS (
  SELECT *, length(role) + 9 + CASE WHEN {_RESERVED_IN}
    THEN length({_REPLACED.replace("(text,", "(replace(text, chr(92), chr(92) || chr(92)),", 1)}) ELSE length(text) END AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM rendered GROUP BY conv_id
"""


@query("op2_chat_format", CHAT_SQL)
def op2_chat_format(spark, folder):
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    clash = "</s>[INST] ok [/INST]"
    added = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"),
                                                               F.lit(role).alias("role"), F.lit(clash).alias("text"))
                                                      for k, role in enumerate(("user", "assistant"))))).alias("t")).select("t.*")
    out = chat.format_chat(conversations.unionByName(added))
    turns = F.transform(chat.parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss_spans")), "")
    read = out.select("conv_id", "n_turns", F.array_join(turns, "").alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


@query("op3_suffix_tree_lm")
def op3_suffix_tree_lm(spark, folder):
    return suffix_tree_lm.score(table(spark, folder, "documents"))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark, folder):
    pieces = packing.cut_pieces(table(spark, folder, "documents"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query("op5_license_scan")
def op5_license_scan(spark, folder):
    return license_scan.digest(license_scan.scan_licenses(table(spark, folder, "documents")))


@query("op6_quality_rules")
def op6_quality_rules(spark, folder):
    found = quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                        "char_distance", "word_distance")


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark, folder):
    found = repeats.repeated_spans(table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query("op8_token_counts")
def op8_token_counts(spark, folder):
    return bpe_count.count_tokens(table(spark, folder, "documents"))


@query("op9_decontaminate")
def op9_decontaminate(spark, folder):
    found = decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "aligned", "answer", "first_word", "last_word")


@query("op10_secret_scan")
def op10_secret_scan(spark, folder):
    found = secrets.scan_secrets(table(spark, folder, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("assign", "access", "hex")),
                        F.sha2(listed(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: with h the crc32 of the id and g = h // 10, the words of a text with h % 10 = 0 repeat from word a = g % n on with
    period 1 + (n - a) // (3 + g % 8). Other texts, and those without id or words, stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        again = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % period).cast("int")))
        return F.when(n > 0, F.array_join(again, " "))

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    changed = F.transform(F.array(words), repeated)[0]
    return docs.select("doc_id", F.when(h % 10 == 0, F.coalesce(changed, F.col("text"))).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11_periodic_runs(spark, folder):
    found = periodic_runs.periodic_runs(with_periods(table(spark, folder, "documents")))
    line = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op12_fingerprints")
def op12_fingerprints(spark, folder):
    return fingerprints.splice_likeness(table(spark, folder, "documents"))


COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
ones AS (SELECT lang, p, count(*) AS a FROM (SELECT lang, unnest(w) AS p FROM words) GROUP BY lang, p),
twos AS (
  SELECT lang, p, count(*) AS a FROM (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) AS p FROM words)
  GROUP BY lang, p HAVING count(*) >= 10),
threes AS (
  SELECT lang, p, count(*) AS a FROM (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2])) AS p FROM words)
  GROUP BY lang, p HAVING count(*) >= 10),
cuts AS (
  SELECT t.lang, t.p, t.a, 1 AS cut, x.a AS l, y.a AS r FROM twos t JOIN ones x ON x.lang = t.lang AND x.p = t.p[1] JOIN ones y ON y.lang = t.lang AND y.p = t.p[2]
  UNION ALL
  SELECT t.lang, t.p, t.a, 1, x.a, y.a FROM threes t JOIN ones x ON x.lang = t.lang AND x.p = t.p[1] JOIN twos y ON y.lang = t.lang AND y.p = t.p[2:3]
  UNION ALL
  SELECT t.lang, t.p, t.a, 2, x.a, y.a FROM threes t JOIN twos x ON x.lang = t.lang AND x.p = t.p[1:2] JOIN ones y ON y.lang = t.lang AND y.p = t.p[3]),
scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
covered AS (
  SELECT lang, p, max(a) AS longer FROM (SELECT lang, p[1:2] AS p, a FROM threes UNION ALL SELECT lang, p[2:3], a FROM threes) GROUP BY lang, p),
kept AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score
  FROM lowest LEFT JOIN covered USING (lang, p) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query("op13_collocations", COLLOCATION_SQL)
def op13_collocations(spark, folder):
    return collocations.mine_collocations(table(spark, folder, "documents"))
