"""Exact duplicates, with the heavy hitters split off.

A digest that a large share of all rows has would meet in one task. Misra-Gries counters (Spark's ``freqItems``, a
mergeable form of that algorithm) over the digests yield every digest with more than ``support`` of the rows among at
most ``1 / support`` candidates. One more pass counts the candidates exactly and finds the row of each that stays
(partial sums of at most ``1 / support`` rows a task). These verified winners, of which there are ``1 / support`` at
most, are broadcast, and the rows of their groups are judged where they are. The other digests are shuffled as usual;
none of them has more than ``support`` of the rows.

Defined results: a null text counts as empty, and so empty texts are copies of each other; of equal texts the smallest
id stays, a null id only if there is no other; of rows that repeat id and text as well exactly one is kept; an empty
table gives an empty result; other columns, whatever their names, neither disturb nor are read (``deduplicate`` passes
them on).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latewatch.llm.inputs import SPACE, id_order, texts
from latewatch.session import durable

SUPPORT = 0.002


def text_digest(text: Column) -> Column:
    """SHA-256, in lowercase hex, of the text with each run of blanks as one blank."""
    return F.sha2(F.regexp_replace(text, SPACE, " ").cast("binary"), 256)


def digest_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Stored ``doc_id``, ``digest`` and ``row``, a number of its own for every row. The texts are read once."""
    rows = texts(docs, id_column, text_column)
    return durable(
        rows.select("doc_id", text_digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row"))
    )


def frequent_winners(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Of every digest that more than ``support`` of the rows have (and of some rarer ones): the row that stays, and the
    size of its group. At most about ``1 / support`` rows, stored."""
    candidates = digests.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    return durable(
        digests.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.min(F.struct(id_order(F.col("doc_id")).alias("order"), "row")).alias("winner"), F.count("*").alias("group_size"))
    )


def judge_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", support: float = SUPPORT
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    digests = digest_rows(docs, id_column, text_column)
    winners = frequent_winners(digests, support)
    frequent = digests.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = (
        digests.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("winner", F.min(F.struct(id_order(F.col("doc_id")).alias("order"), "row")).over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return frequent.unionByName(rest).select(
        "doc_id",
        F.col("winner.order.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicate(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", support: float = SUPPORT
) -> DataFrame:
    """The rows that stay, with all their columns.

    Rows of frequent digests other than the winner go before anything is shuffled. What is left is dealt out by
    digest, and the first row of each digest stays.
    """
    winners = frequent_winners(digest_rows(docs, id_column, text_column), support)
    doc_id, text = F.col(f"held.{id_column}"), F.coalesce(F.col(f"held.{text_column}").cast("string"), F.lit(""))
    held = docs.select(F.struct("*").alias("held")).select("held", doc_id.alias("doc_id"), text_digest(text).alias("digest"))
    marked = held.join(
        F.broadcast(winners.select("digest", F.col("winner.order.id").alias("keep_id"), F.lit(True).alias("frequent"))),
        "digest",
        "left",
    ).filter(F.col("frequent").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = Window.partitionBy("digest").orderBy(F.col("doc_id").asc_nulls_last())
    return marked.withColumn("place", F.row_number().over(first)).filter("place = 1").select("held.*")


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER g = 1 AS kept, text_sha256
FROM rows WINDOW g AS (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST)
"""
