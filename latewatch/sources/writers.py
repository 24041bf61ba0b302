"""Sinks."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from latewatch.schema import Table
from latewatch.session import spread


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    files: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Parquet.

    Each task writes its rows as they are, without a shuffle. ``files`` asks for an exact number of
    round-robin partitions instead. ``partition_by`` lays the table out so that filters on it skip
    folders; rows are brought together by it first, or every task would write a file per value.
    """
    out = df
    if files:
        out = df.repartition(files)
    elif partition_by:
        out = spread(df, None, *partition_by)
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Several small tables, one Parquet folder each."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """A table of the session's catalogue whose rows lie in ``buckets`` files by the hash of ``keys``, sorted in each.

    Tables bucketed alike are joined, and a bucketed table is grouped, on those keys without a shuffle. The rows are
    brought to their buckets once, so that each bucket is one file, under ``path`` or in the warehouse. Returns the stored table.
    """
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def write_sample(df: DataFrame, path: str, rows: int = 2000, order_by: Sequence[str] = ("busbreakdown_id",)) -> None:
    """The first rows in a stated order as one CSV file with header."""
    df.orderBy(*order_by).limit(rows).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_relation(
    df: DataFrame, url: str, table: Table, batch: int = 10_000, connections: int = 8, mode: str = "append",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Rows into a database table over JDBC, from a bounded number of connections."""
    df.coalesce(connections).write.format("jdbc").options(
        url=url, dbtable=table.name, batchsize=batch, **(properties or {})
    ).mode(mode).save()


def insert_statements(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One INSERT statement per row: NULL for missing, quoted text with doubled quotes, bare numbers."""
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)

    def literal(name: str):
        text = F.col(name).cast("string")
        if kinds[name] in ("string", "date", "timestamp", "timestamp_ntz"):
            text = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
        return F.coalesce(text, F.lit("NULL"))

    head = f"INSERT INTO {table} ({','.join(names)}) VALUES ("
    values = F.concat_ws(",", *[literal(name) for name in names])
    return df.select(F.concat(F.lit(head), values, F.lit(");")).alias("statement"))


def write_dump(frames: Mapping[str, DataFrame], tables: Sequence[Table], folder: str, fact_rows: int | None = 5000) -> None:
    """SQL text dump: table definitions, every dimension row and a sample of the fact rows.

    The last table is the fact table; its sample is its first rows by primary key.
    """
    spark = next(iter(frames.values())).sparkSession
    ddl = spark.createDataFrame([(table.create_statement,) for table in tables], "statement string")
    ddl.coalesce(1).write.mode("overwrite").text(f"{folder}/schema")
    for table in tables:
        rows = frames[table.name].select(*table.columns)
        if table is tables[-1] and fact_rows is not None:
            rows = rows.orderBy(*table.primary_key).limit(fact_rows)
        insert_statements(rows, table.name).write.mode("overwrite").text(f"{folder}/{table.name}")


def write_document(spark: SparkSession, document: Mapping[str, object], path: str) -> None:
    """A small metrics document as JSON text, on whatever file system the path names."""
    text = spark.createDataFrame([(json.dumps(document),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)


def write_model(model, path: str) -> None:
    """A fitted model or pipeline model."""
    model.write().overwrite().save(path)
