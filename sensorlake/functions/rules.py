"""Value rules: each returns a column that is NULL when the value is valid, else a short message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake.functions.numbers import is_number, to_number

# Accepted boolean texts.
TRUE_TEXTS = ("true", "1")
FALSE_TEXTS = ("false", "0")


def _bounds(number: Column, lower, upper) -> Column:
    broken = F.lit(False)
    if lower is not None:
        broken = broken | (number < lower)
    if upper is not None:
        broken = broken | (number > upper)
    return broken


def _message(bad: Column, text: str) -> Column:
    return F.when(F.coalesce(bad, F.lit(True)), F.lit(text))


def integer(text: Column, lower=None, upper=None) -> Column:
    """Whole number (``3`` or ``3.0``) within bounds; booleans are rejected."""
    number = to_number(text)
    whole = number.isNotNull() & ~F.isnan(number) & (number == F.floor(number))
    return _message(~whole | _bounds(number, lower, upper), "integer")


def floating(text: Column, lower=None, upper=None) -> Column:
    """Number within bounds."""
    number = to_number(text)
    return _message(number.isNull() | _bounds(number, lower, upper), "float")


def boolean(text: Column) -> Column:
    """``true``/``false`` in any case, ``1`` or ``0``."""
    return _message(~F.lower(F.trim(text)).isin(*TRUE_TEXTS, *FALSE_TEXTS), "bool")


def one_of(text: Column, values: list[str], fold_case: bool = True) -> Column:
    """Member of a fixed list."""
    probe = F.lower(text) if fold_case else text
    allowed = [v.lower() for v in values] if fold_case else values
    return _message(~probe.isin(*allowed), "enum")


def identifier(text: Column) -> Column:
    """Whole number from 1."""
    return F.when(integer(text, lower=1).isNotNull(), F.lit("id"))


def id_list(text: Column, enforce_list: bool = False) -> Column:
    """One id, or a JSON list of ids."""
    items = F.from_json(text, "array<string>")
    ids = F.forall(items, lambda i: identifier(i).isNull())
    listed = items.isNotNull() & text.rlike(r"^\s*\[") & ids
    ok = F.coalesce(listed, F.lit(False))
    if not enforce_list:
        ok = ok | identifier(text).isNull()
    return _message(~ok, "id_list")


def epoch_of(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Epoch seconds of a numeric text or of a date text."""
    return F.when(is_number(text), F.floor(to_number(text)).cast("bigint")).otherwise(
        F.unix_seconds(F.try_to_timestamp(text, F.lit(fmt))))


def date_time(text: Column, lower=None, upper=None, fmt: str = "yyyy-MM-dd") -> Column:
    """Epoch number or formatted date within bounds."""
    epoch = epoch_of(text, fmt)
    return _message(epoch.isNull() | _bounds(epoch, lower, upper), "datetime")


def date_range(start: Column, end: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Two valid dates, the first not after the second."""
    first, last = epoch_of(start, fmt), epoch_of(end, fmt)
    return _message(first.isNull() | last.isNull() | (first > last), "datetime_range")


def text_length(text: Column, exact=None, lower=None, upper=None) -> Column:
    """Text length rule."""
    size = F.char_length(text)
    bad = size.isNull() | _bounds(size, lower, upper)
    if exact is not None:
        bad = bad | (size != exact)
    return _message(bad, "length")


def port(text: Column) -> Column:
    """Network port number."""
    return F.when(integer(text, lower=1, upper=65535).isNotNull(), F.lit("port"))


def json_text(text: Column) -> Column:
    """Well-formed JSON."""
    return _message(F.try_parse_json(text).isNull(), "json")


def timezone_name(text: Column, names: list[str]) -> Column:
    """Member of the zone name list."""
    return _message(~text.isin(*names), "timezone")


def violations(**rules: Column) -> Column:
    """Collect ``column:rule`` messages of one row into an array; empty when the row is valid."""
    return F.array_compact(F.array(*[F.concat(F.lit(f"{name}:"), rule) for name, rule in rules.items()]))
