"""Chat formatting with a grammar that reads back exactly what was written.

    conversation := turn*
    turn         := "<s>" flag role "\\n" text "</s>"
    flag         := " " (role and text as they are) | "\\" (escaped)

A turn is first rendered as it is and reparsed by the grammar. If what comes back differs from the source, because the role
or the text holds a control string, the turn is rendered again, escaped: backslashes are doubled and a backslash is put behind
the first character of each control string, so none is left. The rendered conversation is parsed as a whole and compared
with its turns once more; a difference stops the job.

All of it is built-in expressions. Turns are ordered by turn number (NULL first), then role and text; repeated turns stay.
NULL texts and roles are empty. The rows of one conversation become one string, so a conversation has to fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings of the template and of its relatives, reserved inside roles and texts.
RESERVED = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
RESERVED_PATTERN = "|".join(r"\Q" + c + r"\E" for c in RESERVED)
OPEN, CLOSE, PLAIN, ESCAPED = "<s>", "</s>", " ", "\\"
#: Backslash and new line inside an escaped role, so that the first new line of a turn ends its role.
ROLE_LINE = "\\n"


def escape(text: Column) -> Column:
    """Double backslashes, then break each control string behind its first character."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in RESERVED:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    """Drop single backslashes, halve double ones."""
    parts = F.transform(F.split(text, r"\\\\"), lambda p: F.replace(p, F.lit("\\"), F.lit("")))
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(ROLE_LINE))


def unescape_role(role: Column) -> Column:
    parts = F.transform(F.split(role, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit(ROLE_LINE), F.lit("\n")), F.lit("\\"), F.lit("")))
    return F.when(F.contains(role, F.lit("\\")), F.array_join(parts, "\\")).otherwise(role)


def render(role: Column, text: Column, flag: str) -> Column:
    return F.concat(F.lit(OPEN + flag), role, F.lit("\n"), text, F.lit(CLOSE))


def _read(body: Column) -> Column:
    """``struct<role, text>`` of what stands between the control strings of a turn."""
    role = F.substring_index(body.substr(F.lit(2), F.length(body)), "\n", 1)
    text = body.substr(F.length(role) + 3, F.length(body))
    escaped = F.startswith(body, F.lit(ESCAPED))
    return F.struct(F.when(escaped, unescape_role(role)).otherwise(role).alias("role"),
                    F.when(escaped, unescape(text)).otherwise(text).alias("text"))


def parse_turn(rendered: Column) -> Column:
    """A single turn, NULL if the grammar finds other than one opening, one body and one closing."""
    pieces = F.split(rendered, RESERVED_PATTERN)
    return F.when((F.size(pieces) == 3) & (pieces[0] == "") & (pieces[2] == ""), _read(pieces[1]))


def parse(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of a rendered conversation."""
    pieces = F.split(formatted, RESERVED_PATTERN)
    # Text, control, text, control ...: the bodies are every second piece, between an opening and a closing.
    bodies = F.filter(pieces, lambda _, k: k % 2 == 1)
    return F.transform(bodies, _read)


def format_chat(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", trained_role: str = "assistant") -> DataFrame:
    """``conv_id, n_turns, formatted, loss_spans`` for each conversation.

    ``loss_spans`` are the places in ``formatted`` (from 0, in code points) of the texts of ``trained_role``, with their flag
    ``escaped``.
    """
    turns = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                 F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    plain = turns.withColumn("plain", render(F.col("role"), F.col("text"), PLAIN))
    back = parse_turn(F.col("plain"))
    same = (back["role"] == F.col("role")) & (back["text"] == F.col("text"))
    marked = plain.withColumn("escaped", ~F.coalesce(same, F.lit(False)))
    escaped = F.col("escaped")
    rendered = marked.select(
        "conv_id", "turn", "role", "text", "escaped",
        F.when(escaped, render(escape_role(F.col("role")), escape(F.col("text")), ESCAPED)).otherwise(F.col("plain")).alias("rendered"),
        F.length(F.when(escaped, escape(F.col("text"))).otherwise(F.col("text"))).cast("long").alias("width"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rendered.select(
        "conv_id", "role", "text", "rendered", "width", "escaped", F.row_number().over(order).alias("at"),
        F.sum(F.length("rendered").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "role", "text", "rendered", "width", "escaped", "end"))).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["role"] == trained_role), lambda t: F.struct(
        (t["end"] - len(CLOSE) - t["width"]).alias("start"), t["width"].alias("length"), t["escaped"].alias("escaped")))
    formatted = whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"), spans.alias("loss_spans"),
                             F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    checked = F.when(parse(F.col("formatted")) == F.col("source"), F.size("source").cast("long")).otherwise(
        F.raise_error(F.lit("a conversation does not read back as it was")).cast("long"))
    return formatted.select("conv_id", checked.alias("n_turns"), "formatted", "loss_spans")


def loss_texts(formatted: Column, loss_spans: Column) -> Column:
    """The unescaped texts under the mask, in order."""
    def cut(span):
        text = formatted.substr((span["start"] + 1).cast("int"), span["length"].cast("int"))
        return F.when(span["escaped"], unescape(text)).otherwise(text)

    return F.transform(loss_spans, cut)
