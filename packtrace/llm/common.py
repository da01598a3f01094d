"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WHITE = " \t\n\x0b\x0c\r"  # the characters x20 and x09 to x0D


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column | str, divisor: int) -> Column:
    """crc32 of the key written as text, modulo ``divisor``; a null key counts as empty text."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def free(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def piece(text: Column, key: Column, chars: int) -> Column:
    """The whole text, or of a longer one ``chars`` characters from a place that a hash of its key picks."""
    over = F.char_length(text) - chars
    return F.when(over <= 0, text).otherwise(F.substring(text, F.pmod(F.xxhash64(key), over + 1).cast("int") + 1, F.lit(chars)))


def without_white(text: Column) -> Column:
    for c in WHITE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, with A to Z lower-cased; other characters stay as they are."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def slices(batches: Iterator[pa.RecordBatch], text: str, chars: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``chars`` bytes of text, one row at least.

    Bounds what a task holds at once, however long the texts of a batch are.
    """
    for batch in batches:
        column = batch.column(text)
        sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + chars, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
