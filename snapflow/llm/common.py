"""Shared pieces of the text operators: word rules, Arrow batch helpers, bounded samples."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space; bytes.split() without arguments uses exactly this set.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only, other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(id_column: str, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % parts


def id_and_text(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text is an empty one.

    Other columns never reach the operator, so their names cannot clash with its own.
    """
    return docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A text column as UTF-8 bytes, without decoding."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``most`` bytes of text; a single longer text stays whole."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def hash_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows whose key hashes smallest: the same rows on every run, a bounded number at every size."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(rows)
