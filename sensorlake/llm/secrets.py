"""Secrets in texts: three fixed shapes, and strings in a sensitive context that do not compress.

A string of 16 or more key characters that mixes letters and digits is a candidate if a sensitive word stands beside it on its line or on one of the
``LINES`` lines before, or if it is in the PEM block of a key. Behind a colon or an equals sign, with a sensitive word in front on the line, so is a
quoted string of 16 or more printable characters without a space, and a bare number of 16 or more digits; addresses, templates and names (words of
four letters and more on average, joined by case or by ``-_./``) are none. The novelty of a candidate is the number of bytes it adds to a zstandard frame: the frame of
the text on both sides of it with the candidate, less the frame without, both primed with a dictionary of common identifiers. A name, a word or a repeated
string is a back reference and adds little; a random key has to be spelled out.

Spans are code points, end exclusive. NULL and empty texts have none; repeated rows are judged one by one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import LOWER, map_batches

#: The three base shapes, in the order of their kinds, with the least length of the judged part.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
KINDS = ("assign", "access", "hex", "novel")
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
HEX = bytes(120 if chr(c) in "0123456789abcdef" else 32 for c in range(256))

#: Words that make their line and the next ``LINES`` lines sensitive, strings that may be keys, and PEM blocks.
SENSITIVE_WORDS = (b"key", b"secret", b"token", b"passw", b"passphrase", b"pwd", b"credential", b"bearer", b"auth", b"private",
                   b"signature", b"session", b"cookie", b"salt", b"webhook", b"connectionstring")
SENSITIVE = re.compile("|".join(w.decode() for w in SENSITIVE_WORDS), re.I | re.A)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,64}KEY[A-Z0-9 ]{0,64})-----(.*?)(?:-----END \1-----|\Z)", re.S)
ASSIGNED = re.compile(r"""[:=][\x20\t]*(?:"([\x21\x23-\x7E]{16,})"|'([\x21-\x26\x28-\x7E]{16,})'|([0-9]{16,})(?![0-9A-Za-z+/_.=-]))""")
TEMPLATE = re.compile(r"://|\$\{|\{\{|[<>()]")
NAME, NAME_PART, LEAST_PART = re.compile(r"[A-Za-z]+(?:[-_./][A-Za-z]+)*"), re.compile(r"[A-Z]?[a-z]+|[A-Z]+"), 4
LINE_END = re.compile(r"\r\n?|\n")
LINES = 2
#: Characters of code on each side that a candidate is measured against.
CONTEXT = 256
#: Least added bytes, absolute and as a share of the candidate's length (hexadecimal digits alone need half).
LEAST_BYTES, LEAST_SHARE = 10, 0.45

IDENTIFIERS = (
    "import from return class function const static public private protected void string boolean integer double float null "
    "true false none self this default config settings environment variable parameter argument options request response "
    "header authorization authentication bearer basic digest session cookie username user_name password passwd secret token "
    "access_token refresh_token client_id client_secret api_key apikey api_token private_key public_key secret_key "
    "access_key access_key_id secret_access_key aws_access_key_id aws_secret_access_key credentials connection_string "
    "database_url database_password postgres mysql redis mongodb localhost example.com https://www. http:// ssh-rsa "
    "-----BEGIN PRIVATE KEY----- -----END PRIVATE KEY----- getElementById addEventListener querySelector innerHTML "
    "application/json content-type text/html charset=utf-8 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "changeme placeholder example your_api_key_here your-token-here xxxxxxxxxxxxxxxx 00000000-0000-0000-0000-000000000000"
).encode()


class Novelty:
    """Marginal compressed bytes of a string behind its context."""

    def __init__(self, identifiers: bytes = IDENTIFIERS, level: int = 3):
        import zstandard

        primed = zstandard.ZstdCompressionDict(identifiers, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=level)
        self.frame = zstandard.ZstdCompressor(dict_data=primed, write_content_size=False, write_checksum=False)

    def added(self, context: str, candidate: str, behind: str = "") -> int:
        """The code behind goes first, so that a candidate can refer back to both sides."""
        around = behind.encode("utf-8", "replace") + b"\n" + context.encode("utf-8", "replace") if behind else context.encode("utf-8", "replace")
        return len(self.frame.compress(around + candidate.encode())) - len(self.frame.compress(around))


def base_spans(text: str, data: bytes) -> Iterator[tuple[int, int, str]]:
    """Leftmost matches of each base shape that do not overlap, less those whose judged part is too short."""
    low = data.translate(LOWER)
    may = (any(w in low for w in ASSIGN_WORDS), b"AKIA" in data, b"x" * 24 in data.translate(HEX))
    for there, (kind, shape, group, least) in zip(may, BASE):
        if there:
            for m in shape.finditer(text):
                if m.end(group) - m.start(group) >= least:
                    yield m.start(), m.end(), kind


def _is_name(found: str) -> bool:
    """Words in one piece, as ``camelCase`` or ``words-with-marks``; letters drawn at random change their case more often."""
    return bool(NAME.fullmatch(found)) and len(found) >= LEAST_PART * len(NAME_PART.findall(found))


def novel_spans(text: str, data: bytes, novelty: Novelty, least_bytes: int = LEAST_BYTES,
                least_share: float = LEAST_SHARE) -> Iterator[tuple[int, int, str]]:
    """Strings in a sensitive context that may be keys and add many bytes to what stands around them; none overlaps another."""
    low = data.translate(LOWER)
    if not any(w in low for w in SENSITIVE_WORDS) and b"-----BEGIN " not in data:
        return
    words = [m.start() for m in SENSITIVE.finditer(text)]
    blocks = [m.span(2) for m in PEM.finditer(text)]
    breaks = [m.end() for m in LINE_END.finditer(text)]

    def novel(start: int, end: int) -> bool:
        added = novelty.added(text[max(0, start - CONTEXT):start], text[start:end], text[end:end + CONTEXT])
        return added >= max(least_bytes, least_share * (end - start))

    assigned = []
    for m in ASSIGNED.finditer(text):
        start, end = m.span(m.lastindex)
        line = bisect_right(breaks, m.start())
        front = bisect_left(words, breaks[line - 1] if line else 0)
        if front < len(words) and words[front] < m.start() and not TEMPLATE.search(text, start, end) and not _is_name(text[start:end]) and novel(start, end):
            assigned.append((start, end))
            yield start, end, "novel"
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        found = m.group()
        near = bisect_left(assigned, (end,)) - 1
        if near >= 0 and start < assigned[near][1]:
            continue
        if not (any(c.isdigit() for c in found) and any(c.isalpha() for c in found)):
            continue
        line = bisect_right(breaks, start)
        low, high = breaks[line - 1 - LINES] if line > LINES else 0, breaks[line] if line < len(breaks) else len(text)
        # A word within the string is beside it only as a name in front of an equals sign.
        front, behind = bisect_left(words, low), bisect_left(words, end)
        beside = front < len(words) and words[front] < start + max(0, found.rstrip("=").rfind("=")) or behind < len(words) and words[behind] < high
        block = bisect_right(blocks, (start, len(text))) - 1
        if not (beside or block >= 0 and end <= blocks[block][1]):
            continue
        if novel(start, end):
            yield start, end, "novel"


def spans_of(text: str, data: bytes, novelty: Novelty) -> list[tuple[int, int, str]]:
    """All spans by start, then kind. A novel string that a base shape covers already is not named again."""
    base = sorted(base_spans(text, data))
    starts, reach = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))

    def covered(start: int, end: int) -> bool:
        # A base span that starts no later has to reach the end.
        at = bisect_right(starts, start) - 1
        return at >= 0 and reach[at] >= end

    more = [s for s in novel_spans(text, data, novelty) if not covered(s[0], s[1])]
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end, base>>`` for each row of ``docs``."""
    def run(batches):
        novelty = Novelty()
        for batch in batches:
            found = []
            for value in batch.column(1):
                text = value.as_py()
                found.append([{"kind": k, "start": a, "end": b, "base": k != "novel"}
                              for a, b, k in spans_of(text, text.encode("utf-8", "replace"), novelty)] if text else [])
            yield {"doc_id": batch.column(0), "spans": found}

    kind = docs.schema[id_col].dataType.simpleString()
    small = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_batches(small, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long,base:boolean>>", run)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span (overlapping ones as one) replaced by a mark of its first kind."""
    out, at, k = [], 0, 0
    while k < len(spans):
        start, end, kind = spans[k]
        while k + 1 < len(spans) and spans[k + 1][0] < end:
            k += 1
            end = max(end, spans[k][1])
        out += [text[at:start], f"[{kind} removed]"]
        at, k = end, k + 1
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the same columns and rows, secrets in the text replaced; rows without any stay as they are."""
    place = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        novelty = Novelty()
        for batch in batches:
            texts = []
            for value in batch.column(place):
                text = value.as_py()
                spans = spans_of(text, text.encode("utf-8", "replace"), novelty) if text else []
                texts.append(redact(text, spans) if spans else text)
            columns = [pa.array(texts, batch.schema.field(place).type) if i == place else batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
