"""The registered queries of this package: each applies one operator, with production settings, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.llm import bag_minhash, bpe, exact_dedup, jaccard_join, licenses, mixing, pii, prefix_trie, quality, token_rollup
from latewatch.llm import toxicity, url_rules, whitening
from latewatch.llm.inputs import table
from latewatch.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(oracle: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if oracle:
            ORACLES[run.__name__] = oracle
        return run

    return add


@register(url_rules.oracle())
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"))


@register()
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.annotate(table(spark, sf_dir, "documents")))


@register(exact_dedup.ORACLE)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.judge_copies(table(spark, sf_dir, "documents"))


@register(token_rollup.ORACLE)
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.corpus_rollup(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ensure_checkpoint_dir(spark)
    )


@register()
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@register()
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@register(mixing.ORACLE)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@register()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"))).drop("ids")


@register()
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@register()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted"
    )


@register()
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_components(table(spark, sf_dir, "documents"))


@register()
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.vectors(table(spark, sf_dir, "embeddings"))
    return whitening.whiten(vectors, whitening.fit(vectors))


@register(prefix_trie.ORACLE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
