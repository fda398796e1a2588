"""Table sources: queries, JDBC, in-code lists, date ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settings


def scan_query(
    spark: SparkSession, query: str, params: Mapping[str, object] | None = None, **tables: DataFrame
) -> DataFrame:
    """Parameterised SQL over the given tables; ``:name`` markers are bound, never pasted."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=dict(params or {}))


def _listing(spark: SparkSession) -> dict[str, str]:
    """Settings to list a table's folders in a few tasks for each core, however many folders there are.

    Spark takes a task for each folder, up to ten thousand, and the starting of them is most of the time.
    """
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a stored table whose partition columns are text, as their folder names are.

    Reading a table without a schema would turn a partition value such as ``00123`` into 123.
    """
    return read_table(spark, path).schema


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Stored table with the given schema, or its own one with text partition columns; its folders are listed once."""
    as_text = {} if schema else {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}
    with settings(spark, _listing(spark) | as_text):
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _footers_only(spark: SparkSession) -> SparkSession:
    """A session whose Parquet aggregates are answered from the files' footers where these can tell."""
    own = spark.newSession()
    sources = [s for s in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(sources))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return own


def stored_max(spark: SparkSession, path: str, col: str) -> object:
    """Highest value of a numeric or date column of a stored table, None if it has none; no row is read.

    A file whose column is null throughout has no highest value in its footer; then the column is read.
    """
    schema = table_schema(spark, path)
    top = F.max(F.col(f"`{col}`"))
    try:
        return _footers_only(spark).read.schema(schema).parquet(path).agg(top).first()[0]
    except Exception as error:
        if "No min/max found for Parquet file" not in str(error):
            raise
    return spark.read.schema(schema).parquet(path).agg(top).first()[0]


def scan_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Database table read in parallel ranges; connection options come from the caller."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    reader = reader.option("fetchsize", fetch_size)
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", partitions)
        )
    return reader.load()


def literal_relation(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str] | str) -> DataFrame:
    """A list written in code as a table."""
    return spark.createDataFrame(list(rows), names if isinstance(names, str) else list(names))


def date_spine(spark: SparkSession, start: str, end: str, name: str = "date") -> DataFrame:
    """One row per calendar day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias(name))


def spine_per_row(df: DataFrame, start: str, end: str, name: str = "date") -> DataFrame:
    """Every row repeated for each day from its ``start`` to its ``end`` column."""
    days = F.when(F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end)))
    return df.withColumn(name, F.explode(days))
