"""Joins of a large table with a side table whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latewatch.session import durable

# A side is broadcast only up to both bounds.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
# A key is hot if it has more than this share of the rows.
HOT_SHARE = 0.005


def affordable(*sides: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> list[bool]:
    """Which side tables may be copied to every executor: smallest first, while they fit both bounds together.

    Measured, not estimated: row count and text length of all columns plus eight bytes each, in one
    job. Hand in durable or stored side tables, or they are computed once more for this.
    """
    measured = None
    for place, side in enumerate(sides):
        width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in side.columns), F.lit(0))
        part = side.agg(F.lit(place).alias("place"), F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b"))
        measured = part if measured is None else measured.unionByName(part)
    fits = [False] * len(sides)
    for found in sorted(measured.collect(), key=lambda found: (found.b, found.n)):  # one row per side
        rows, size = rows - found.n, size - found.b
        if rows < 0 or size < 0:
            break
        fits[found.place] = True
    return fits


def fits_broadcast(*sides: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether side tables are, together, small enough to copy to every executor."""
    return all(affordable(*sides, rows=rows, size=size))


def sized(**sides: DataFrame) -> dict[str, DataFrame]:
    """Side tables, marked for broadcast where their measured size allows that, all together."""
    fits = affordable(*sides.values())
    return {name: F.broadcast(side) if fit else side for (name, side), fit in zip(sides.items(), fits)}


def hot_keys(fact: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Hashes of all keys that more than ``share`` of the rows have, and of some rarer ones: at most ``1 / share``.

    Stored, because the rarer ones may differ from run to run and both sides of a join have to read the same list.
    """
    found = fact.select(F.xxhash64(*keys).alias("_hash")).stat.freqItems(["_hash"], share)
    return durable(found.select(F.explode("_hash_freqItems").alias("_hash"), F.lit(True).alias("_hot")))


def join_dimension(
    fact: DataFrame,
    side: DataFrame,
    key: str | list[str],
    how: str = "left",
    fits: bool | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Left, inner or anti equi-join of a large table with a side table that is unique on the key.

    ``fits`` is the outcome of the size check where the caller has made it already.
    Below the bounds the side is broadcast and the large table is not shuffled. Beyond them both
    sides are shuffled on key and salt. Only keys that a counting pass over the keys finds hot are
    salted, and rows without a key; only their few side rows are copied. The salt is a row's place in
    its partition, so that rows equal in all columns are spread too.
    """
    if fits_broadcast(side) if fits is None else fits:
        return fact.join(F.broadcast(side), key, how)
    keys = [key] if isinstance(key, str) else list(key)
    found = hot_keys(fact, keys)
    copies = salted(side, keys, F.sequence(F.lit(0), F.lit(salts - 1)), F.array(F.lit(0)), found)
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    return (
        salted(fact, keys, spread, F.lit(0), found)
        .join(copies.withColumn("_salt", F.explode("_salt")), [*keys, "_salt"], how)
        .drop("_salt")
    )


def salted(df: DataFrame, keys: list[str], hot: Column, other: Column, found: DataFrame) -> DataFrame:
    """Add ``_salt``: ``hot`` where the key is among those found or missing, ``other`` elsewhere."""
    missing = F.lit(False)
    for key in keys:
        missing |= F.col(key).isNull()
    marked = df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(found), "_hash", "left")
    return marked.withColumn("_salt", F.when(missing | F.col("_hot").isNotNull(), hot).otherwise(other)).drop("_hash", "_hot")
