"""What the operators of this package share: their input columns and the tokens of the contracts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.operators.quality import first_per_key

# Java and RE2 read this class alike: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null as empty) and the columns asked for; whatever else the table has stays out,
    so that its names cannot clash with those of an operator."""
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        *[F.col(column).alias(name) for name, column in more.items()],
    )


def word_count(text: Column) -> Column:
    """Number of words, without building them: each run of blanks and each run of others becomes one character."""
    return F.length(F.regexp_replace(F.regexp_replace(text, WORD, "w"), SPACE, "")).cast("long")


def id_order(doc_id: Column) -> Column:
    """Orders ids with nulls last, also inside ``min`` (which would skip a bare null)."""
    return F.struct(doc_id.isNull().alias("missing"), doc_id.alias("id"))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_row_per_id(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``text`` and the columns of ``chosen`` (doc_id, ...; a bounded number of rows) of the documents chosen, one row each.

    Of rows that repeat an id the one with the smallest digest of its text counts; each task passes on one at most, so
    that an id that very many rows have neither fills a task nor multiplies the sample.
    """
    found = texts(docs).join(F.broadcast(chosen), "doc_id")
    return first_per_key(found.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)), ["doc_id"], ["digest"]).select(
        "text", *[c for c in chosen.columns if c != "doc_id"]
    )


class TaskCache(dict):
    """A cache that each task fills for itself; it travels empty."""

    def __reduce__(self):
        return (TaskCache, ())


def by_size(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of so many bytes of text; a single longer text is a part of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, side="right"))
        end = max(end, start + 1)
        yield batch.slice(start, end - start)
        start = end
