"""Helpers that the corpus operators share: Arrow batches in and out, words of a text, hashes of words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# ASCII letters in lower case; every other ASCII byte but digits and letters becomes a space, longer characters stay.
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def map_batches(df: DataFrame, schema: str, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` with plain dicts of columns as output; ``fn`` gets the batches of one partition."""
    out = StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches):
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c.cast(t.type) if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns.values(), arrow)],
                schema=arrow)

    return df.mapInArrow(run, out)


def free_name(taken: list[str], name: str) -> str:
    """A column name that is not among the taken ones, whatever their case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"{name}_"
    return name


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the UTF-8 bytes of the text (NULL: no bytes), whatever else ``docs`` has."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"))


def lower_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    return data.translate(LOWER).split()


def alnum_words(data: bytes) -> list[bytes]:
    """Runs of letters, digits and characters outside ASCII, A-Z in lower case."""
    return data.translate(ALNUM).split()


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer over unsigned 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
