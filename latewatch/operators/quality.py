"""Row quality: the record filter, its accounting, and relational constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import window as W

from latewatch.functions.labels import BREAKDOWN, RUNNING_LATE
from latewatch.operators.joins import join_dimension

# The accepted years, both ends included.
FIRST_YEAR, LAST_YEAR = 2010, 2027


def quality_rules(first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> dict[str, Column]:
    """What a usable record must meet, by rule name.

    The year rule is a membership test so that the timestamp is evaluated once per row where the
    filter is pushed into a scan of raw records; it also rules out missing timestamps.
    """
    return {
        "incident_type": F.col("incident_type").isin(BREAKDOWN, RUNNING_LATE),
        "record_id": F.col("busbreakdown_id").isNotNull(),
        "year": F.col("year").isin(*range(first_year, last_year + 1)),
    }


def quality_filter(features: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """Keep usable records."""
    for rule in quality_rules(first_year, last_year).values():
        features = features.filter(rule)
    return features


def quality_measures(first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> dict[str, Column]:
    """Rows in, kept and dropped, and failures per rule, as aggregates by name."""
    rules = quality_rules(first_year, last_year)
    timestamp_known = F.col("year").isNotNull()
    checks = {
        "bad_incident_type": rules["incident_type"],
        "bad_timestamp": timestamp_known,
        "bad_record_id": rules["record_id"],
        "bad_year": ~timestamp_known | rules["year"],
    }
    kept = rules["incident_type"] & rules["record_id"] & rules["year"]
    return {
        "all": F.count(F.lit(1)),
        "kept": F.count_if(kept),
        "dropped": F.count_if(~F.coalesce(kept, F.lit(False))),
        **{name: F.count_if(~F.coalesce(check, F.lit(False))) for name, check in checks.items()},
    }


def quality_report(features: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """Rows in, kept and dropped, and failures per rule, with their share; one pass."""
    counts = quality_measures(first_year, last_year)
    row = features.agg(*[count.alias(name) for name, count in counts.items()])
    lines = [
        F.struct(
            F.lit(name).alias("measure"),
            F.col(name).alias("n_rows"),
            F.try_divide(F.col(name) * 100.0, F.col("all")).alias("percent"),
        )
        for name in counts
    ]
    return row.select(F.inline(F.array(*lines)))


def observed(
    features: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR, more: Mapping[str, Column] | None = None
) -> tuple[DataFrame, Observation]:
    """The same rows, and the counts of ``quality_report`` (and ``more`` aggregates) as the next action passes over them.

    The action should write the rows without a shuffle: a task that is run again then counts once.
    """
    counts = quality_measures(first_year, last_year) | dict(more or {})
    seen = Observation()
    return features.observe(seen, *[count.alias(name) for name, count in counts.items()]), seen


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first in the stated order (make the order total).

    Spark limits each key to its first row before the shuffle as well as after it, so that a key
    holding most rows sends at most one row per task.
    """
    window = W.Window.partitionBy(*key).orderBy(*order_by)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def split_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every required column present, and the rejected rest."""
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    return df.filter(complete), df.filter(~complete)


def orphans(fact: DataFrame, parent: DataFrame, column: str, target: str | None = None) -> DataFrame:
    """Fact rows whose non-NULL foreign key has no parent row."""
    keys = parent.select(F.col(target or column).alias(column)).filter(F.col(column).isNotNull())
    return join_dimension(fact.filter(F.col(column).isNotNull()), keys, column, how="left_anti")


def _comparable(fact: DataFrame, column: str, parent: DataFrame, target: str) -> tuple[Column, Column]:
    """Both keys as texts that are equal exactly if the keys are equal as ``=`` compares them: cast to their common type first."""
    common = fact.select(F.col(column)).limit(0).union(parent.select(F.col(target)).limit(0)).schema[0].dataType

    def text(name: str) -> Column:
        value = F.col(name).cast(common)
        if common.typeName() in ("float", "double"):
            value = value + F.lit(0.0)  # no negative zero
        return value.cast("string")

    return text(column), text(target)


def orphan_counts(fact: DataFrame, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Number of orphans of every foreign key, 0 included; ``parents`` maps the key column to (table, target column).

    The fact rows are counted per key value first, in one pass for all keys, so that only distinct
    values are shuffled and met with the parent keys: no hot key, nothing to broadcast.
    """
    texts = {column: _comparable(fact, column, *parent) for column, parent in parents.items()}
    used = (
        fact.select(*[ours.alias(column) for column, (ours, _) in texts.items()])
        .unpivot([], list(parents), "foreign_key", "key_value")
        .filter(F.col("key_value").isNotNull())
        .groupBy("foreign_key", "key_value")
        .agg(F.count("*").alias("n"))
    )
    known = None
    for column, (parent, _) in parents.items():
        keys = parent.select(F.lit(column).alias("foreign_key"), texts[column][1].alias("key_value"), F.lit(1).alias("known"))
        known = keys if known is None else known.unionByName(keys)
    counted = (
        used.join(known.distinct(), ["foreign_key", "key_value"], "left")
        .groupBy("foreign_key")
        .agg(F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("n_orphans"))
    )
    # One row per foreign key on either side.
    listed = fact.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in parents])).alias("foreign_key"))
    return listed.join(F.broadcast(counted), "foreign_key", "left").select(
        "foreign_key", F.coalesce("n_orphans", F.lit(0)).alias("n_orphans")
    )
