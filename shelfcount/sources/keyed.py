"""What a table has loaded, told without reading its rows.

* ``partition_keys``: keys that are partition columns, from the names of the table's folders.
* ``append_load`` and ``loaded_keys``: other keys, from a small table of the distinct keys of every load that is kept
  beside the rows. Gates take either in place of the loaded table.

A load writes its rows and then its keys into folders of its own name, so a load that is repeated under the same name
replaces what its first attempt left, and its gate leaves out that attempt's keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.gates import distinct_keys
from ..session import durable
from .sinks import clustered, remove_partition
from .tables import read_table

LOAD = "load_id"
#: Name that Spark gives to the folder of a null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def partition_keys(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Distinct values, as text, of partition columns of a stored table; no data file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = listed.load(path).select("path")

    def value(name: str):
        # Spark writes special signs of a value as %XX; a plus sign stays one.
        folder = F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
        return F.when(folder != NULL_FOLDER, F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))).alias(name)

    return files.select(*[value(k) for k in keys]).distinct()


def _keys_path(path: str) -> str:
    return f"{path.rstrip('/')}_keys"


def prepare_keyed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
    """An empty keyed table, which the first load's gate can read."""
    for place, kept in ((path, schema), (_keys_path(path), T.StructType([schema[k] for k in keys]))):
        # A load without rows, whose file holds the columns.
        spark.createDataFrame([], kept).coalesce(1).write.parquet(f"{place.rstrip('/')}/{LOAD}=none")


def append_load(df: DataFrame, path: str, load: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> None:
    """Rows of one load and their distinct keys; a repeated load replaces all of its first attempt.

    The keys are taken from the written rows.
    """
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/{LOAD}={load}"
    written = df.select(*[c for c in df.columns if c != LOAD])
    replace = {"partitionOverwriteMode": "static"}
    clustered(written, partition_by).write.mode("overwrite").options(**replace).partitionBy(*partition_by).parquet(folder)
    own = distinct_keys(spark.read.schema(written.schema).parquet(folder), keys)
    own.coalesce(1).write.mode("overwrite").options(**replace).parquet(f"{_keys_path(path)}/{LOAD}={load}")


def loaded_keys(spark: SparkSession, path: str, load: str | None = None) -> DataFrame:
    """Keys of all loads of a table, but for the one that is about to be written."""
    stored = read_table(spark, _keys_path(path))
    others = stored if load is None else stored.filter(F.col(LOAD) != load)
    return others.drop(LOAD)


def loaded_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path).drop(LOAD)


def sum_keys(spark: SparkSession, path: str) -> None:
    """One folder in place of one for each load. Run it while no load is being written.

    The sum is written before the folders it comes from go. Keys are a set, so one that ends in between does no harm.
    """
    place = _keys_path(path)
    stored = read_table(spark, place)
    before = [r[0] for r in stored.select(LOAD).distinct().collect()]
    summed = durable(stored.drop(LOAD).distinct())
    summed.write.parquet(f"{place}/{LOAD}=sum-{uuid.uuid4().hex}")
    for load in before:
        remove_partition(spark, place, {LOAD: load})
