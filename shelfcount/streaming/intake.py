"""Incremental intake with file streams: each dropped file is loaded once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.gates import distinct_keys, exists_gate, not_loaded, planned_only
from ..operators.stock import high_water

QUERY, BATCH = "query_id", "batch_id"
#: Batches after which the notes of a table are summed up.
SUMMED = 32


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    fmt: str = "csv",
    files_per_trigger: int | None = None,
    clean: str | None = None,
    **options: object,
) -> DataFrame:
    """Stream over the files dropped into a folder, with the name of the file per row.

    ``clean='delete'`` removes finished files; the checkpoint remembers them either way.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if clean:
        reader = reader.option("cleanSource", clean)
    return reader.load(folder).select("*", F.col("_metadata.file_name").alias("file"))


def run_available(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
) -> StreamingQuery:
    """Work through everything that has arrived, then stop; a rerun goes on from the checkpoint.

    The ended query tells what was done, the size of its state among it (``recentProgress``).
    """
    query = (
        stream.writeStream.foreachBatch(each)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def query_of(batch: DataFrame) -> str:
    """Id of the stream that a micro-batch belongs to: fixed for a checkpoint, new for each."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def batch_folder(path: str, query: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/{QUERY}={query}/{BATCH}={batch_id}"


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(QUERY, T.StringType()), T.StructField(BATCH, T.LongType())])


def prepare_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Create an empty table partitioned by stream and batch, so that the first batch can read it."""
    empty = spark.createDataFrame([], _with_batch(schema))
    empty.write.mode("append").partitionBy(QUERY, BATCH).parquet(path)


def _write_batch(df: DataFrame, path: str, query: str, batch_id: int) -> None:
    """Write a batch into a folder of its own; a retry replaces all of it, also by nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(batch_folder(path, query, batch_id))


class BatchTable:
    """A table written batch by batch, with a small table of notes about each batch beside it.

    Later batches read the notes (key groups, highest id) instead of the rows. A batch looks only
    at notes of earlier batches, so a retried one does not see its first attempt. Every ``SUMMED``
    batches the notes so far are summed up in one folder, so a batch reads that one and at most as
    many more, by their names. One stream at a time may write to a table; a new checkpoint starts
    from the notes of all streams before it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        notes: T.StructType,
        note: Callable[[DataFrame], DataFrame],
    ):
        self.spark, self.path, self.schema, self.note_schema, self.note = spark, path, schema, notes, note
        self.note_path = f"{path.rstrip('/')}_notes"
        self.sum_path = f"{path.rstrip('/')}_sums"
        prepare_table(spark, self.path, schema)
        prepare_table(spark, self.note_path, notes)

    def _notes(self, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(self.note_schema).parquet(*folders)

    def notes_before(self, query: str, batch_id: int) -> DataFrame:
        first = batch_id // SUMMED * SUMMED
        total = batch_folder(self.sum_path, query, first)
        if batch_id == first:
            if first:
                last = first - SUMMED
                names = [batch_folder(self.note_path, query, k) for k in range(last, first)]
                before = self._notes([batch_folder(self.sum_path, query, last), *names])
            else:
                every = self.spark.read.schema(_with_batch(self.note_schema)).parquet(self.note_path)
                before = every.filter(F.col(QUERY) != query).select(*self.note_schema.names)
            _write_batch(self.note(before), self.sum_path, query, first)
        return self._notes([total, *[batch_folder(self.note_path, query, k) for k in range(first, batch_id)]])

    def write(self, df: DataFrame, query: str, batch_id: int) -> None:
        """Write the rows, then the notes taken from the written rows."""
        _write_batch(df.select(*self.schema.names), self.path, query, batch_id)
        written = self.spark.read.schema(self.schema).parquet(batch_folder(self.path, query, batch_id))
        _write_batch(self.note(written), self.note_path, query, batch_id)

    def add_notes(self, rows: DataFrame) -> None:
        """Notes about rows that were stored before the first batch."""
        _write_batch(self.note(rows), self.note_path, "before", 0)


def intake(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function that appends every row once."""

    def each(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, path, query_of(batch), batch_id)

    return each


def gate_append(
    path: str,
    schema: T.StructType,
    plan: DataFrame,
    plan_keys: Sequence[str],
    loaded_keys: Sequence[str],
    loaded: DataFrame | None = None,
) -> Callable[[DataFrame, int], None]:
    """Batch function: planned rows whose key group neither ``loaded`` nor an earlier batch has."""
    keys = T.StructType([schema[k] for k in loaded_keys])
    table = BatchTable(plan.sparkSession, path, schema, keys, lambda rows: distinct_keys(rows, loaded_keys))
    if loaded is not None:
        table.add_notes(loaded)

    def each(batch: DataFrame, batch_id: int) -> None:
        earlier = table.notes_before(query_of(batch), batch_id)
        if list(plan_keys) == list(loaded_keys):
            fresh = exists_gate(batch, plan, earlier, plan_keys)
        else:
            fresh = not_loaded(planned_only(batch, plan, plan_keys), earlier, loaded_keys)
        table.write(fresh, query_of(batch), batch_id)

    return each


def append_above_high_water(
    spark: SparkSession, path: str, schema: T.StructType, id_col: str, stored: DataFrame | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch function: rows whose id is above the highest one in ``stored`` and earlier batches."""
    def top(rows: DataFrame) -> DataFrame:
        return rows.agg(F.max(id_col).alias(id_col))

    table = BatchTable(spark, path, schema, T.StructType([schema[id_col]]), top)
    if stored is not None:
        table.add_notes(stored)

    def each(batch: DataFrame, batch_id: int) -> None:
        query = query_of(batch)
        table.write(high_water(batch, table.notes_before(query, batch_id), id_col), query, batch_id)

    return each
