"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source is a stream of equal blocks of ``block`` words. Blocks are seats: the seats of the whole mix go to the
sources by the highest quotients target / (2 k + 1), and the seats of a source go to its shards in the same way, by the
words of the shards, so that every shard has an integer quota. A shard then takes each of its blocks ``quota div
blocks`` times and ``quota mod blocks`` of them once more: its documents stand in a seeded order, and the run of blocks
from a seeded offset on (past the last block it goes on at the first) is taken, so that nearly all documents are taken
whole. The words that a document gives are a difference of two closed forms, and no block is ever built as a row.

The highest quotients are found without listing all of them: with divisors a little too large and a little too small
every party has a lower and an upper number of seats that enclose the exact one, and together they leave at most about
two open quotients per party to rank.

Work: one pass for the words of every shard (partial sums), then one shuffle of ids and sizes by shard for the running
positions. A shard is a hash of the row, and a source has as many shards as its rows need, so a hot source is many
tasks. The ranking windows see one row per source, or the shards of one source.

Defined results: a null text has size 0 and gives nothing; a null source is a source of its own and comes last; a
source without words has target 0; an empty table gives an empty result; documents that repeat an id are documents of
their own; rows equal in id and size share the places among them. Reruns and other partitionings give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latewatch.llm.inputs import texts, word_count
from latewatch.operators.joins import sized as broadcast_if_sized
from latewatch.session import durable

BLOCK = 16
ROWS_PER_SHARD = 20_000
WEIGHTS = (5, 2, 1)


def _seeded(seed: int, *parts: Column) -> Column:
    """Hex digits that follow from the seed and the parts."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))


def _number(digits: Column, start: int) -> Column:
    """Seven of the hex digits as an integer, below 2 to the 28th."""
    return F.conv(F.substring(digits, start, 7), 16, 10).cast("long")


def apportion(parties: DataFrame, seats: str, votes: str, name: str, *keys: str) -> DataFrame:
    """``parties`` with ``quota``: the ``seats`` of each group of ``keys`` by the highest quotients votes / (2 k + 1).

    Equal quotients go by ``name``. Groups without votes get no seats.
    """
    group = Window.partitionBy(*(keys or [F.lit(1)]))
    share = F.col("seats_") * F.col("votes_") / F.col("all_votes")
    slack = F.col("parties") / 2.0
    bounded = (
        parties.withColumns({"votes_": F.col(votes).cast("double"), "seats_": F.col(seats).cast("double")})
        .withColumns({"all_votes": F.sum("votes_").over(group), "parties": F.count(F.when(F.col("votes_") > 0, 1)).over(group)})
        .withColumns(
            {
                "low": F.when(
                    F.col("votes_") > 0,
                    F.greatest(F.lit(0), F.floor(share * F.greatest(F.lit(0.0), 1 - slack / F.greatest(F.col("seats_"), F.lit(1.0))) + 0.499999)),
                ).otherwise(0).cast("long"),
                "high": F.when(
                    F.col("votes_") > 0, F.floor(share * (1 + slack / F.greatest(F.col("seats_"), F.lit(1.0))) + 1.500001)
                ).otherwise(0).cast("long"),
            }
        )
        .withColumn("open", F.col("seats_").cast("long") - F.sum("low").over(group))
    )
    ranked = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(F.col("quotient").desc(), F.col(name).asc_nulls_last())
    won = (
        bounded.filter("high > low and open > 0")
        .select(*keys, name, "votes_", "open", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("k"))
        .withColumn("quotient", F.col("votes_") / (2 * F.col("k") + 1))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= F.col("open"))
        .groupBy(*keys, name)
        .agg(F.count("*").alias("won"))
    )
    same = F.lit(True)
    for key in (*keys, name):
        same &= F.col(f"b.{key}").eqNullSafe(F.col(f"w.{key}"))
    return bounded.alias("b").join(won.alias("w"), same, "left").select(
        *[F.col(f"b.{c}") for c in parties.columns], (F.col("b.low") + F.coalesce(F.col("w.won"), F.lit(0))).alias("quota")
    )


def source_targets(sources: DataFrame, share: float = 1.5, weights: tuple[int, ...] = WEIGHTS, most: int = 2) -> DataFrame:
    """``source, source_size`` with ``weight`` and ``target``.

    The sources, by code point and null last, weigh ``weights`` over and over. They share ``share`` times all words; a
    target stops at ``most`` times its source's words, and what that leaves is shared again. In the order of ``most *
    size / weight`` the sources that stop come first, so running sums tell where the stops end.
    """
    everything = Window.partitionBy(F.lit(1))
    by_name = everything.orderBy(F.col("source").cast("binary").asc_nulls_last())
    by_fill = everything.orderBy("fill", F.col("source").cast("binary").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    weighed = (
        sources.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * most)
        .withColumn("fill", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * share)
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0)))
                    / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    )
    # The level of the first source that does not stop is everyone's; from there on levels only fall.
    return weighed.withColumn("common", F.max(F.when(F.col("fill") >= F.col("level"), F.col("level"))).over(everything)).select(
        "source", "source_size", "documents", "weight",
        F.when(F.col("common").isNull() | (F.col("fill") < F.col("common")), F.col("most").cast("double"))
        .otherwise(F.col("common") * F.col("weight")).alias("target"),
    )


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """The documents as often as the mix takes them (words taken over size, rounded), with all their columns.

    Rows equal in id and size are taken alike, by their mean.
    """
    copies = (
        mix(docs, id_column, text_column, **settings)
        .filter("size > 0")
        .groupBy(F.col("doc_id").alias("mix_id"), F.col("size").alias("mix_size"))
        .agg(F.round(F.avg(F.col("taken") / F.col("size"))).cast("int").alias("copies"))
        .filter("copies > 0")
    )
    text = F.coalesce(F.col(f"held.{text_column}").cast("string"), F.lit(""))
    held = docs.select(F.struct("*").alias("held")).select("held", F.col(f"held.{id_column}").alias("held_id"), word_count(text).alias("held_size"))
    return (
        held.join(copies.hint("shuffle_hash"), F.col("held_id").eqNullSafe(F.col("mix_id")) & (F.col("held_size") == F.col("mix_size")))
        .select("held", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("held.*")
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    share: float = 1.5,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = 2,
    block: int = BLOCK,
    rows_per_shard: int = ROWS_PER_SHARD,
    seed: int = 17,
) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken, source, shard, quota``."""
    sized = durable(
        texts(docs, id_column, text_column, source=source_column).select(
            "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"),
            _seeded(seed, F.col("doc_id")).alias("order"),
        )
    )
    sources = durable(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents")), share, weights, most)
        .withColumn("all_seats", F.round(F.sum("target").over(Window.partitionBy(F.lit(1))) / block).cast("long"))
    )
    seats = apportion(sources, "all_seats", "target", "source").select(
        "source", "source_size", "target", F.col("quota").alias("source_quota"),
        F.ceil(F.col("documents") / rows_per_shard).cast("long").alias("shards"),
    )
    # One row per source beside every document: copied to every executor if its measured size allows that.
    seats = broadcast_if_sized(seats=durable(seats))["seats"]
    same_source = F.col("r.source").eqNullSafe(F.col("s.source"))
    rows = sized.alias("r").join(seats.alias("s"), same_source).select(
        "r.doc_id", "r.source", "r.size", "r.order", "s.source_size", "s.target", "s.source_quota",
        (_number(F.col("order"), 1) % F.col("s.shards")).alias("shard"),
    )
    shards = rows.groupBy("source", "shard", "source_quota").agg(F.sum("size").alias("shard_size"))
    quotas = apportion(shards, "source_quota", "shard_size", "shard", "source").select(
        "source", "shard", F.ceil(F.col("shard_size") / block).cast("long").alias("blocks"), "quota"
    )
    stream = Window.partitionBy("source", "shard").orderBy("order", F.col("doc_id").asc_nulls_last(), "size")
    placed = rows.withColumn("end", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    joined = placed.alias("p").join(
        quotas.alias("q"), F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("p.shard") == F.col("q.shard"))
    ).select("p.*", "q.blocks", F.least(F.col("q.quota"), most * F.col("q.blocks")).alias("quota"))
    whole = F.floor(F.col("quota") / F.col("blocks"))
    extra = F.col("quota") % F.col("blocks")
    offset = _number(_seeded(seed, F.col("source"), F.col("shard")), 8) % F.greatest(F.col("blocks"), F.lit(1))

    def chosen(blocks: Column) -> Column:
        """How many of the first so many blocks lie in the run, or in its part that goes on at the first block."""

        def within(start: Column) -> Column:
            return F.least(F.greatest(blocks - start, F.lit(0)), extra)

        passed = F.least(F.greatest(F.col("blocks") - offset, F.lit(0)), extra)
        return within(offset) + within(offset - F.col("blocks")) - passed

    def words(position: Column) -> Column:
        """Words of blocks taken once more before a position of the shard's stream."""
        full = F.floor(position / block)
        return block * chosen(full) + (position % block) * (chosen(full + 1) - chosen(full))

    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        whole * F.col("size") + words(F.col("end")) - words(F.col("end") - F.col("size"))
    )
    return joined.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "shard", "quota")


ORACLE = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS "order"
  FROM documents
), weighed AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS documents,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS fill,
         (CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE)
           - CAST(coalesce(sum(2 * source_size) OVER before, 0) AS DOUBLE))
         / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW before AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), leveled AS (
  SELECT *, max(CASE WHEN fill >= level THEN level END) OVER () AS common FROM filled
), targets AS (
  SELECT source, source_size, documents,
         CASE WHEN common IS NULL OR fill < common THEN CAST(2 * source_size AS DOUBLE) ELSE common * weight END AS target
  FROM leveled
), seats AS (SELECT CAST(round(sum(target) / {BLOCK}) AS BIGINT) AS seats FROM targets),
source_quotients AS (
  SELECT source, target / (2 * k + 1) AS quotient
  FROM targets, range(CAST((SELECT seats FROM seats) AS BIGINT)) AS r(k)
  WHERE target > 0 AND k <= target / {BLOCK} + 100
), source_quotas AS (
  SELECT source, count(*) AS quota FROM (
    SELECT source, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST) AS rank FROM source_quotients
  ) WHERE rank <= (SELECT seats FROM seats) GROUP BY source
), rows AS (
  SELECT z.doc_id, z.source, z.size, z."order", t.source_size, t.target, coalesce(q.quota, 0) AS source_quota,
         CAST('0x' || substr(z."order", 1, 7) AS BIGINT) % CAST(ceil(t.documents / {ROWS_PER_SHARD}) AS BIGINT) AS shard
  FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source
  LEFT JOIN source_quotas q ON z.source IS NOT DISTINCT FROM q.source
), shards AS (
  SELECT source, shard, any_value(source_quota) AS source_quota, CAST(sum(size) AS BIGINT) AS shard_size
  FROM rows GROUP BY source, shard
), shard_quotas AS (
  SELECT source, shard, count(*) AS quota FROM (
    SELECT source, shard, source_quota, row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k + 1) DESC, shard) AS rank
    FROM shards, LATERAL (SELECT unnest(range(CAST(source_quota AS BIGINT))) AS k) WHERE shard_size > 0
  ) WHERE rank <= source_quota GROUP BY source, shard
), placed AS (
  SELECT r.*, sum(size) OVER (PARTITION BY r.source, r.shard ORDER BY "order", doc_id NULLS LAST, size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS "end"
  FROM rows r
), runs AS (
  SELECT p.*, b.blocks, least(coalesce(q.quota, 0), 2 * b.blocks) AS quota,
         CAST('0x' || substr(md5('17|' || coalesce(p.source, '-') || '|' || p.shard), 8, 7) AS BIGINT) % greatest(b.blocks, 1) AS "offset"
  FROM placed p
  JOIN (SELECT source, shard, CAST(ceil(shard_size / {BLOCK}) AS BIGINT) AS blocks FROM shards) b
    ON p.source IS NOT DISTINCT FROM b.source AND p.shard = b.shard
  LEFT JOIN shard_quotas q ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard
), listed AS (
  SELECT *, unnest(range(CAST(("end" - size) // {BLOCK} AS BIGINT), CAST(("end" - 1) // {BLOCK} + 1 AS BIGINT))) AS block FROM runs WHERE size > 0
), given AS (
  SELECT doc_id, source, shard, "order", size, "end",
         sum((least("end", (block + 1) * {BLOCK}) - greatest("end" - size, block * {BLOCK}))
             * (quota // blocks + CASE WHEN (block - "offset" + blocks) % blocks < quota % blocks THEN 1 ELSE 0 END)) AS taken
  FROM listed GROUP BY ALL
)
SELECT r.doc_id, r.size, r.source_size, r.target, CAST(coalesce(o.taken, 0) AS BIGINT) AS taken, r.source, r.shard,
       CAST(r.quota AS BIGINT) AS quota
FROM runs r LEFT JOIN given o
  ON r.doc_id IS NOT DISTINCT FROM o.doc_id AND r."end" = o."end" AND r.source IS NOT DISTINCT FROM o.source
     AND r.shard = o.shard AND r.size = o.size
"""
