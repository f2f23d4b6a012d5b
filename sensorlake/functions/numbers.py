"""Numbers: text coercion, significant digits, annotated laboratory values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One plain number. Tested before the cast, because a cast that fails costs an exception per row.
NUMBER_PATTERN = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity|nan))$"

# Cell texts that mean "missing" in sensor files.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "NAN", "Null",
)


def is_number(text: Column) -> Column:
    """True when the trimmed text is one plain number (a type suffix such as ``5d`` is not)."""
    return F.coalesce(F.trim(text).rlike(NUMBER_PATTERN), F.lit(False))


def to_number(text: Column) -> Column:
    """Number of a plain numeric text, else NULL."""
    return F.when(is_number(text), F.trim(text).cast("double"))


def coerce_numeric(text: Column, missing: tuple[str, ...] = MISSING_TOKENS) -> Column:
    """Missing cells become NaN, text that is not a number becomes NULL, numbers stay."""
    trimmed = F.trim(text)
    return F.when(text.isNull() | trimmed.isin(*missing), F.lit(float("nan"))).otherwise(to_number(text))


def short_precision(value: Column, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits. Zero, NULL, NaN and infinities pass through."""
    magnitude = F.floor(F.log10(F.abs(value)))
    power = F.lit(float(digits - 1)) - magnitude
    scaled = F.when(power > 300, value).otherwise(
        F.when(power >= 0, F.rint(value * F.pow(F.lit(10.0), power)) / F.pow(F.lit(10.0), power))
        .otherwise(F.rint(value / F.pow(F.lit(10.0), -power)) * F.pow(F.lit(10.0), -power)))
    plain = value.isNull() | F.isnan(value) | value.isin(0.0, float("inf"), float("-inf"))
    return F.when(plain, value).otherwise(scaled)


def annotated_tokens(cell: Column) -> dict[str, Column]:
    """First step of reading a laboratory cell: trimmed text, its tokens, and whether text and first token are
    plain values. Kept apart from :func:`annotated_parts` so that each is computed once per row."""
    trimmed = F.trim(cell)
    tokens = F.split(trimmed, r"\s+")
    time = trimmed.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$")
    return {"_text": trimmed, "_tokens": tokens, "_plain": (trimmed == "nan") | is_number(trimmed) | time,
            "_leads": is_number(F.get(tokens, F.lit(0)))}


def annotated_parts(cell: Column) -> dict[str, Column]:
    """``remark``, ``value`` and ``qualifiers`` from the token columns.

    Numbers, ``nan`` and timestamps are the value itself. Otherwise two tokens are (value, qualifiers) when the
    first is a number, else (remark, value); three are (remark, value, qualifiers); one is a remark. More than
    three tokens is an error.
    """
    plain, leads, count = F.col("_plain"), F.col("_leads"), F.size("_tokens")
    first, second, third = (F.get("_tokens", F.lit(i)) for i in range(3))
    nothing = F.lit(None).cast("string")
    too_many = F.raise_error(F.concat(F.lit("more than three parts in result: "), cell)).cast("string")
    return {
        "remark": F.when(plain, nothing).when(count > 3, too_many).when((count == 2) & leads, nothing).otherwise(first),
        "value": F.when(plain, F.col("_text")).when((count == 2) & leads, first).when(count > 1, second),
        "qualifiers": F.when(plain, nothing).when(count == 3, third).when((count == 2) & leads, second),
    }
