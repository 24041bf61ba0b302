"""Scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from latewatch.schema import RAW_SCHEMA


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    """First of several paths that exists on its file system (local, HDFS, object store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for candidate in candidates:
        path = jvm.org.apache.hadoop.fs.Path(candidate)
        if path.getFileSystem(conf).exists(path):
            return candidate
    raise FileNotFoundError(f"none of {list(candidates)} exists")


def read_records(
    spark: SparkSession, *candidates: str, schema: StructType = RAW_SCHEMA, multi_line: bool = False
) -> DataFrame:
    """Raw CSV records: header, doubled quotes, permissive, fixed all-string schema.

    Files stay splittable unless ``multi_line`` is asked for.
    """
    path = candidates[0] if len(candidates) == 1 else first_existing(spark, candidates)
    return (
        spark.read.schema(schema)
        .options(header=True, quote='"', escape='"', mode="PERMISSIVE", multiLine=multi_line)
        .csv(path)
    )


# The text of a line that does not have the fields of its table, and why it was set aside.
BROKEN, CAUSE = "_broken", "cause"
CAUSES = ("unclosed quote", "too few fields", "too many fields", "unreadable")


def read_checked_records(
    spark: SparkSession, *candidates: str, schema: StructType = RAW_SCHEMA, multi_line: bool = False, header: bool = True
) -> DataFrame:
    """Raw CSV records as ``read_records`` reads them, with the whole text of each broken line in ``_broken``.

    Whole lines are parsed whatever columns are asked for, because a pruned parse cannot count fields.
    """
    path = candidates[0] if len(candidates) == 1 else first_existing(spark, candidates)
    return (
        spark.read.schema(StructType([*schema.fields, StructField(BROKEN, StringType())]))
        .options(header=header, quote='"', escape='"', mode="PERMISSIVE", multiLine=multi_line)
        .options(columnNameOfCorruptRecord=BROKEN, columnPruning=False)
        .csv(path)
    )


def cause_of(line: Column, fields: int) -> Column:
    """Why a line of a table with so many fields is broken; NULL for a line that is not."""
    bare = F.regexp_replace(line, r'"(?:[^"]|"")*"', "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    cause = F.when(bare.contains('"'), CAUSES[0]).when(found < fields, CAUSES[1]).when(found > fields, CAUSES[2])
    return F.when(line.isNotNull(), cause.otherwise(CAUSES[3]))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; with ``columns`` only those are read."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


# Scans of fewer partitions than this may be spread; a larger scan keeps enough tasks busy by itself.
FEW_PARTITIONS = 64


def fill_cores(df: DataFrame) -> DataFrame:
    """Spread a small scan that would leave cores idle, before costly work on its rows.

    One small file is one task. A scan of many partitions is never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    found = df.rdd.getNumPartitions()
    return df.repartition(min(cores, FEW_PARTITIONS)) if found < min(cores, FEW_PARTITIONS) else df


def with_timestamp(df: DataFrame, column: str = "occurred_ts") -> DataFrame:
    """Make sure ``column`` is a timestamp; texts that are none become NULL."""
    if dict(df.dtypes)[column] == "string":
        return df.withColumn(column, F.try_to_timestamp(F.col(column)))
    return df


def read_document(spark: SparkSession, path: str) -> DataFrame | None:
    """A JSON metrics document, or None where there is none."""
    try:
        return spark.read.option("multiLine", True).json(first_existing(spark, [path]))
    except FileNotFoundError:
        return None


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """A stored prediction sample."""
    return spark.read.schema("actual double, prediction double, residual double, abs_error double").csv(
        path, header=True
    )


def read_relation(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table over JDBC, read by several tasks when a split column is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if split_on and bounds:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def register(df: DataFrame, name: str = "incidents") -> DataFrame:
    """Give a frame a name for SQL."""
    df.createOrReplaceTempView(name)
    return df
