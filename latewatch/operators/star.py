"""Star schema: dimensions with repeatable ids, id look-up, fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch import functions as fn
from latewatch.operators.joins import affordable, join_dimension
from latewatch.operators.ranking import dense_ids
from latewatch.schema import CALENDAR_KEY, DIMENSION_IDS, FACT_INCIDENT, FEATURE_COLUMNS
from latewatch.session import durable


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several text columns, NULL included, in one pass: (column_name, value)."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "column_name", "value")
        .distinct()
    )


def build_dimensions(
    features: DataFrame, ids: Mapping[str, str] = DIMENSION_IDS, stored: Mapping[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """One dimension per natural key: every distinct value, NULL included, numbered in key order.

    With ``stored`` dimensions of earlier loads their members keep their ids, and only members that are not among them
    get new ones, in key order after the largest id stored. The distinct values of all keys come from one scan, are
    numbered together and kept in the checkpoint folder, so that ids, size checks and joins all see the same rows without
    touching the features again.
    """
    values = distinct_values(features, list(ids))
    known = None
    for key, dimension in (stored or {}).items():
        rows = dimension.select(F.lit(key).alias("column_name"), F.col(key).cast("string").alias("value"), F.col(ids[key]).alias("id"))
        known = rows if known is None else known.unionByName(rows)
    if known is None:
        numbered = durable(dense_ids(values, ["value"], "id", within=["column_name"]))
    else:
        numbered = durable(lasting_ids(values, known, ["value"], "id", within=["column_name"]))
    return {
        key: numbered.filter(F.col("column_name") == key).select(F.col("value").alias(key), F.col("id").alias(id_column))
        for key, id_column in ids.items()
    }


def lasting_ids(
    keys: DataFrame, stored: DataFrame, columns: Sequence[str], name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Stored keys with their ids, and distinct ``keys`` that are not among them with ids of their own.

    New ids follow the largest stored id (per ``within`` group) in key order; NULL is a key like others. Only keys move,
    never the rows that use them.
    """
    match = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in (*within, *columns)]
    fresh = keys.select(*within, *columns).alias("new").join(stored.select(*within, *columns).alias("old"), match, "left_anti")
    numbered = dense_ids(fresh, columns, name, within)
    largest = stored.groupBy(*within).agg(F.max(name).alias("_largest"))
    if within:
        numbered = numbered.join(F.broadcast(largest), list(within), "left")  # one row per group
    else:
        numbered = numbered.withColumn("_largest", largest.scalar())
    placed = numbered.withColumn(name, F.col(name) + F.coalesce("_largest", F.lit(0))).drop("_largest")
    return stored.select(*within, *columns, name).unionByName(placed.select(*within, *columns, name))


def calendar_dimension(
    features: DataFrame, key: Sequence[str] = CALENDAR_KEY, name: str = "date_id", stored: DataFrame | None = None
) -> DataFrame:
    """Distinct calendar combinations with an id in key order; combinations that are ``stored`` keep their ids."""
    keys = features.select(*key).distinct()
    return dense_ids(keys, list(key), name) if stored is None else lasting_ids(keys, stored, list(key), name)


def date_dimension(features: DataFrame) -> DataFrame:
    """One row per day; of several school years on a day the smallest is kept.

    Duplicates are removed first by a plain distinct, which keeps nothing but keys in memory.
    """
    day = ["date_key", "year", "month", "day_of_week", "season", "is_weekend"]
    days = features.select(fn.date_key(F.col("occurred_ts")).alias("date_key"), *day[1:], "school_year")
    return days.distinct().groupBy(*day).agg(F.min("school_year").alias("school_year"))


def attach_ids(features: DataFrame, dimensions: Mapping[str, DataFrame], broadcast: bool = True) -> DataFrame:
    """Left-join the surrogate id of every dimension by plain equality: a NULL key has no id.

    Dimensions whose measured size allows it are broadcast, unless ``broadcast`` is off; the others are joined by shuffle.
    """
    fitting = affordable(*dimensions.values()) if broadcast else [False] * len(dimensions)
    for (key, dimension), fits in zip(dimensions.items(), fitting):
        features = join_dimension(features, dimension.filter(F.col(key).isNotNull()), key, fits=fits)
    return features


def feature_table(features: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """The analysis table: features plus surrogate ids, in the fixed column order."""
    return attach_ids(features, dimensions).select(*FEATURE_COLUMNS)


def fact_table(feature_rows: DataFrame) -> DataFrame:
    """Fact columns of the analysis table; the day as key, the time as text."""
    return feature_rows.withColumns(
        {
            "date_key": fn.date_key(F.col("occurred_ts")),
            "occurred_ts": F.col("occurred_ts").cast("string"),
        }
    ).select(*FACT_INCIDENT.columns)
