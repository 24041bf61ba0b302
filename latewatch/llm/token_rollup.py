"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A change of the corpus is a batch of deltas: an insert adds a document and its tokens, a delete takes both away, a
revised count takes the old tokens away and adds the new ones (the document stays). A batch is summed by key, which is
additive and runs as partial sums before its one small shuffle, and is stored as one folder of the rollup, named by the
batch; totals are the sums over all committed batches. Committing a batch again changes nothing: a folder is written
only if the batch has none that is complete, and a half-written folder (its writer was lost) is written anew. Only complete
folders, those with Spark's ``_SUCCESS`` mark, count.

``compact`` folds the committed batches into one snapshot that remembers their names, so that totals stay cheap and a late
repetition of an old batch is still recognised.

Where token counts come from is the caller's: any table of ``doc_id, source, lang, tokenizer, tokens``
(``count_tokens`` counts by an expression; ``bpe.digests`` gives ``n_tokens`` of a subword tokenizer).

Defined results: null sources and languages are keys of their own; null counts are 0 (the document counts); repeated
rows count as often as they occur; keys whose documents and tokens are both 0 are not listed; an empty batch is a
committed batch without rows, and an empty rollup has no totals; other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.llm.inputs import texts, word_count
from latewatch.session import durable

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def count_tokens(docs: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """``doc_id, source, lang, tokenizer, tokens``: one row per row of ``docs`` and tokenizer version; ``counts`` are
    expressions over ``text``."""
    rows = texts(docs, source="source", lang="lang")
    each = F.array(*[F.struct(F.lit(name).alias("tokenizer"), n.cast("long").alias("tokens")) for name, n in counts.items()])
    return rows.select("doc_id", "source", "lang", F.explode(each).alias("c")).select("doc_id", "source", "lang", "c.*")


def words_v1(text: Column) -> Column:
    return word_count(text)


def pieces_v2(text: Column) -> Column:
    """Runs of letters a-z and of digits, and every other character but blanks. Each becomes one mark, then blanks go."""
    marked = F.regexp_replace(F.regexp_replace(text, r"[A-Za-z]+|[0-9]+", "w"), r"[\x20\x09-\x0D]+", "")
    return F.length(marked)


def inserts(counted: DataFrame) -> DataFrame:
    return counted.select(*KEYS, F.lit(1).cast("long").alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


def deletes(counted: DataFrame) -> DataFrame:
    return inserts(counted).select(*KEYS, (-F.col("documents")).alias("documents"), (-F.col("tokens")).alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Documents counted anew: ``old`` goes, ``new`` comes, key by key."""
    return deletes(old).unionByName(inserts(new))


def summed(deltas: DataFrame) -> DataFrame:
    """Totals of signed rows."""
    return deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))


class Rollup:
    """A rollup in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        held = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return held.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(held)

    def _folders(self) -> dict[str, str]:
        """Complete folders by name."""
        held = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        system = held.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath() for s in system.listStatus(held)] if system.exists(held) else []
        return {p.getName(): p.toString() for p in found if self._exists(f"{p.toString()}/_SUCCESS")}

    def _snapshots(self) -> list[str]:
        """Snapshots, oldest first: the last one holds all that those before it hold."""
        return sorted(n for n in self._folders() if n.startswith("snapshot-") and not n.endswith("-names"))

    def committed(self) -> set[str]:
        """Names of the batches that count."""
        batches = {n.removeprefix("batch-") for n in self._folders() if n.startswith("batch-")}
        if snapshots := self._snapshots():
            rows = self.spark.read.text(f"{self.folder}/{snapshots[-1]}-names")
            batches |= {r["value"] for r in rows.collect()}
        return batches

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Adds the deltas of a batch; false if it had been committed before."""
        if batch in self.committed():
            return False
        summed(deltas).write.mode("overwrite").parquet(f"{self.folder}/batch-{batch}")
        return True

    def _parts(self) -> DataFrame:
        folders, snapshots = self._folders(), self._snapshots()
        held = set()
        if snapshots:
            held = {r["value"] for r in self.spark.read.text(f"{self.folder}/{snapshots[-1]}-names").collect()}
        paths = [p for n, p in folders.items() if n.startswith("batch-") and n.removeprefix("batch-") not in held]
        paths += [folders[snapshots[-1]]] if snapshots else []
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens`` over all committed batches."""
        return summed(self._parts()).filter("documents <> 0 or tokens <> 0")

    def compact(self) -> None:
        """Folds all committed batches into a new snapshot. Names are stored first: a snapshot is complete only with its own mark."""
        snapshot = f"{self.folder}/snapshot-{len(self._snapshots()):08d}"
        names = [(n,) for n in sorted(self.committed())]
        self.spark.createDataFrame(names, "value string").write.mode("overwrite").text(f"{snapshot}-names")
        self.totals().write.mode("overwrite").parquet(snapshot)


def corpus_rollup(spark: SparkSession, docs: DataFrame, labels: DataFrame, folder: str) -> DataFrame:
    """The rollup of a corpus through its changes: all documents come in under ``words-1``; those that a label calls bad
    are deleted; toxic ones lose their digits (revised counts); the rest is counted anew under ``pieces-2``.
    Batches are sent twice, as after a failure."""
    rollup = Rollup(spark, f"{folder}/rollup-{uuid.uuid4()}")
    text = F.col("text")
    counted = count_tokens(
        docs, {"words-1": words_v1(text), "pieces-2": pieces_v2(text), "revised": words_v1(F.regexp_replace(text, "[0-9]+", ""))}
    )
    # The texts are read once; from here on only counts are joined and summed.
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    marked = durable(counted.join(marks, "doc_id", "left"))
    good = F.coalesce(F.col("quality"), F.lit(1)) != 0

    def counts(version: str, chosen: Column = F.lit(True)) -> DataFrame:
        return marked.filter((F.col("tokenizer") == version) & chosen)

    revised = good & (F.col("toxic") == 1)
    batches = {
        "1-insert": inserts(counts("words-1")),
        "2-delete": deletes(counts("words-1", ~good)),
        "3-revise": revisions(counts("words-1", revised), counts("revised", revised).withColumn("tokenizer", F.lit("words-1"))),
        "4-recount": inserts(counts("pieces-2", good)),
    }
    for name, deltas in batches.items():
        rollup.commit(name, deltas)
    rollup.compact()
    for name, deltas in batches.items():
        rollup.commit(name, deltas)
    return rollup.totals()


ORACLE = r"""
WITH marks AS (SELECT doc_id, min(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
rows AS (
  SELECT d.source, d.lang, coalesce(m.quality, 1) AS quality, coalesce(m.toxic, 0) AS toxic, coalesce(d.text, '') AS text
  FROM documents d LEFT JOIN marks m ON d.doc_id = m.doc_id
)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS documents,
       CAST(sum(len(regexp_extract_all(CASE WHEN toxic = 1 THEN regexp_replace(text, '[0-9]+', '', 'g') ELSE text END,
                                       '[^\x20\x09-\x0D]+'))) AS BIGINT) AS tokens
FROM rows WHERE quality <> 0 GROUP BY source, lang
UNION ALL
SELECT source, lang, 'pieces-2', count(*),
       CAST(sum(len(regexp_extract_all(text, '[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D]'))) AS BIGINT)
FROM rows WHERE quality <> 0 GROUP BY source, lang
"""
