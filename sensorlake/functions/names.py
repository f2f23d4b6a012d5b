"""Column and datastream names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered replacements that turn a file header into a stored column name.
HEADER_REPLACEMENTS = (
    (" ", "_"), ("-", "_"), ("/", "_"), ("²", "2"), ("³", "3"), ("°", "deg"), ("__", "_"), ("%", "percent"),
    ("^", ""), ("µ", "u"), ("Ω", "ohm"), ("₂", "2"), (":", ""),
)
# The shorter list used for plain time-series CSV files, applied after lower-casing.
CSV_HEADER_REPLACEMENTS = HEADER_REPLACEMENTS[:8]

NAME_BYTES = 53


def clean_name(header: str, variant: str = "default") -> str:
    """Stored name of one file header (driver side, headers only)."""
    if variant == "csv":
        header = header.lower()
    for old, new in CSV_HEADER_REPLACEMENTS if variant == "csv" else HEADER_REPLACEMENTS:
        header = header.replace(old, new)
    header = header.lower()
    if not header.isascii():
        raise ValueError(f"column name {header!r} still has special characters")
    return header


def clean_name_col(header: Column, variant: str = "default") -> Column:
    """Column form of :func:`clean_name` for tables that hold names."""
    cleaned = F.lower(header) if variant == "csv" else header
    for old, new in CSV_HEADER_REPLACEMENTS if variant == "csv" else HEADER_REPLACEMENTS:
        cleaned = F.replace(cleaned, F.lit(old), F.lit(new))
    cleaned = F.lower(cleaned)
    message = F.concat(F.lit("column name still has special characters: "), cleaned)
    return F.when(cleaned.rlike(r"[^\x00-\x7F]"), F.raise_error(message).cast("string")).otherwise(cleaned)


def expand_columns(patterns: list[str], columns: list[str]) -> list[str]:
    """Expand ``abc*`` entries to every column with that prefix, keeping the order of the patterns."""
    expanded: list[str] = []
    for pattern in patterns:
        if pattern.endswith("*"):
            expanded.extend(c for c in columns if c.startswith(pattern[:-1]))
        else:
            expanded.append(pattern)
    return expanded


def datastream_name(feeder: Column, column: Column, sensor_type: Column) -> Column:
    """``<feeder>_<column>`` cut to at most 53 UTF-8 bytes without a trailing space or underscore, plus
    ``_meas`` or ``_calc``."""
    full = F.concat(feeder, F.lit("_"), column)
    fits = F.filter(
        F.sequence(F.lit(1), F.lit(NAME_BYTES)),
        lambda n: F.octet_length(F.substring(full, F.lit(1), n)) <= NAME_BYTES)
    cut = F.when(F.octet_length(full) <= NAME_BYTES, full).otherwise(F.substring(full, F.lit(1), F.array_max(fits)))
    base = F.regexp_replace(cut, "[ _]+$", "")
    suffix = F.when(sensor_type == "calculated", "_calc").when(sensor_type == "measured", "_meas").otherwise("")
    return F.concat(base, suffix)
