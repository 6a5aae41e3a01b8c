"""Small shared steps: whole columns under fixed names, batches of bounded text, written tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.session import discard, materialize

TEXT_BYTES = 4 << 20


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key (long) and text of every row, so that no other column can clash."""
    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in runs of about ``most`` bytes of text (one longer text goes alone)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin = held = 0
        for i, n in enumerate(lengths.tolist()):
            if held and held + n > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)


def remainder(key: str = "doc_id", base: int = 5) -> Column:
    """crc32 of the key as text, modulo ``base``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % base


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back; later passes do not repeat the work."""
    return materialize(df, purpose)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, each job's shuffle files go when it ends: what later jobs read has been written to the shared folder."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


__all__ = ["brief_shuffles", "discard", "remainder", "slices", "texts_of", "written"]
