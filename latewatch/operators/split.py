"""Repeatable splits and samples: membership follows from a row's key, not from partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the integer mix: a Mersenne prime and a multiplier of full period modulo it.
MODULUS = 2_147_483_647
MULTIPLIER = 48_271


def integer_share(key: Column, seed: int) -> Column:
    """Number in [0, 1) from an integer key by modular arithmetic, the same in any SQL engine."""
    start = F.pmod(key.cast("bigint"), F.lit(MODULUS))
    mixed = F.pmod((start + F.lit(seed)) * F.lit(MULTIPLIER), F.lit(MODULUS))
    return F.pmod(mixed * F.lit(MULTIPLIER), F.lit(MODULUS)) / F.lit(float(MODULUS))


def hash_share(*keys: Column, seed: int) -> Column:
    """Number in [0, 1) from keys of any type."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(MODULUS)) / F.lit(float(MODULUS))


def split_share(df: DataFrame, keys: Sequence[str], seed: int) -> Column:
    """Share of a row: integer arithmetic for one integer key, a hash otherwise."""
    kinds = dict(df.dtypes)
    if len(keys) == 1 and kinds[keys[0]] in ("tinyint", "smallint", "int", "bigint"):
        return integer_share(F.col(keys[0]), seed)
    return hash_share(*[F.col(key) for key in keys], seed=seed)


def hash_split(
    df: DataFrame, keys: Sequence[str] = ("busbreakdown_id",), train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; rows with equal keys are on the same side."""
    share = split_share(df, keys, seed)
    return df.filter(share < train), df.filter(~F.coalesce(share < train, F.lit(False)))


def hash_sample(
    df: DataFrame, fraction: float, keys: Sequence[str] = ("busbreakdown_id",), seed: int = 1
) -> DataFrame:
    """About ``fraction`` of the rows, the same ones on every run."""
    return df.filter(split_share(df, keys, seed) < fraction)


def with_folds(df: DataFrame, folds: int = 3, keys: Sequence[str] = ("busbreakdown_id",), seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..folds-1 for cross-validation."""
    return df.withColumn("fold", F.floor(split_share(df, keys, seed) * folds).cast("int"))
