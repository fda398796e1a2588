"""Writers. The new contents are computed by ``operators.maintain``."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import maintain
from ..operators.keys import key_set
from ..session import durable, scratch_path
from .tables import read_table, table_schema

BOM = "\ufeff"


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def full_refresh(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table by data that does not come from the table itself."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partition_by
    ).parquet(path)


def rewrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table by contents computed from it.

    The result is first written in full to a staging folder, so the table is only touched
    when every row of its successor exists, and a lost executor cannot leave it half read.
    """
    staged = scratch_path(df.sparkSession, "staged")
    df.write.parquet(staged)
    full_refresh(df.sparkSession.read.schema(df.schema).parquet(staged), path, partition_by)


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Key replacement on a table partitioned by the keys: untouched partitions are not read."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def touched_partitions(target: DataFrame, df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of the target in the partitions that ``df`` has rows for.

    The lowest and highest value of each partition column bound the scan, however many partitions
    are touched; the semi join picks among the partitions between.
    """
    aggregates = []
    for c in partition_by:
        aggregates += [F.min(c), F.max(c), F.max(F.col(c).isNull())]
    bounds = df.agg(*aggregates).first()
    picked = target
    for k, c in enumerate(partition_by):
        low, high, nulls = bounds[3 * k : 3 * k + 3]
        test = F.lit(False) if low is None else F.col(c).between(F.lit(low), F.lit(high))
        picked = picked.filter(test | F.col(c).isNull() if nulls else test)
    renamed = key_set(df, partition_by).withColumnsRenamed({c: f"__p_{c}" for c in partition_by})
    same = [picked[c].eqNullSafe(renamed[f"__p_{c}"]) for c in partition_by]
    return picked.join(renamed, same, "left_semi")


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition together, so that a write leaves few files in it.

    A rebalance splits a large partition again and joins small ones, by their measured size.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def replace_keys(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Key replacement inside a partitioned table: only the touched partitions are read and written.

    A key must not move between partitions. The new partitions are staged before any is replaced.
    Partition columns are text, whatever their values look like, unless ``df`` types them.
    """
    spark = df.sparkSession
    stored = table_schema(spark, path)
    typed = [df.schema[f.name] if f.name in partition_by and f.name in df.columns else f for f in stored.fields]
    target = read_table(spark, path, T.StructType(typed))
    fresh = maintain.replace_keys(touched_partitions(target, df, partition_by), df, keys)
    replace_partitions(clustered(durable(fresh), partition_by), path, partition_by)


def replace_rows(
    path: str, spark: SparkSession, doomed: Column, rows: DataFrame, partition_by: Sequence[str] = ()
) -> None:
    """Rows of a table that fulfil ``doomed`` give way to ``rows``; other partitions keep their files.

    Partitions are touched if they hold such a row or get a new one; where ``doomed`` names a
    partition column the scan skips the others. A table without partitions is rewritten.
    """
    target = read_table(spark, path)
    gone = F.coalesce(doomed, F.lit(False))
    if not partition_by:
        rewrite(maintain.append(target.filter(~gone), rows), path)
        return
    touched = target.filter(gone).select(*partition_by).unionByName(rows.select(*partition_by)).distinct()
    staged = durable(touched)
    kept = touched_partitions(target, staged, partition_by).filter(~gone)
    fresh = durable(maintain.append(kept, rows))
    replace_partitions(clustered(fresh, partition_by), path, partition_by)
    # A partition that lost its last row gets no file from the overwrite.
    left = key_set(fresh, partition_by).withColumnsRenamed({c: f"__p_{c}" for c in partition_by})
    emptied = staged.join(left, [staged[c].eqNullSafe(left[f"__p_{c}"]) for c in partition_by], "left_anti")
    for part in emptied.toLocalIterator():
        remove_partition(spark, path, {c: part[c] for c in partition_by})


def remove_partition(spark: SparkSession, path: str, values: Mapping[str, str | None]) -> None:
    """Delete the folder of one partition."""
    jvm = spark.sparkContext._jvm
    names = [
        jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(c, v)
        for c, v in values.items()
    ]
    folder = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def replace_range(
    path: str, rows: DataFrame, col: str, lo: object, hi: object, partition_by: Sequence[str] = ()
) -> None:
    """Stored rows in the inclusive range give way to ``rows``."""
    replace_rows(path, rows.sparkSession, F.col(col).between(lo, hi), rows, partition_by)


def replace_in_list(
    path: str, source: DataFrame, col: str, values: Sequence[object], partition_by: Sequence[str] = (), **equal: object
) -> None:
    """Stored rows of the listed groups give way to the source's."""
    listed = maintain.listed(col, values, **equal)
    replace_rows(path, source.sparkSession, listed, source.filter(listed), partition_by)


def insert_new_or_reload(
    path: str,
    incoming: DataFrame,
    batch: str,
    check_keys: Sequence[str],
    delete_keys: Sequence[str],
    partition_by: Sequence[str] = (),
) -> None:
    """Unseen rows of a batch are appended; batches without any replace their counts.

    Rows to append are added as new files. Only partitions that a reload touches are written anew,
    so ``partition_by`` must be among ``delete_keys``.
    """
    spark = incoming.sparkSession
    target = read_table(spark, path)
    unseen, reload = (durable(x.drop(batch)) for x in maintain.unseen_and_reload(target, incoming, batch, check_keys))
    if not reload.isEmpty():
        if partition_by:
            touched = touched_partitions(target, reload, partition_by)
            fresh = maintain.replace_keys(touched, reload, delete_keys)
            replace_partitions(clustered(durable(fresh), partition_by), path, partition_by)
        else:
            rewrite(maintain.replace_keys(target, reload, delete_keys), path)
    append(clustered(unseen, partition_by), path, partition_by)


def archive_new(
    source: DataFrame, path: str, keys: Sequence[str], col: str, lo: str, hi: str, partition_by: Sequence[str] = ()
) -> None:
    """Rows of the range whose key group the archive lacks are added to it; the archive is not rewritten."""
    spark = source.sparkSession
    fresh = durable(maintain.rows_to_archive(source, read_table(spark, path), keys, col, lo, hi))
    append(clustered(fresh, partition_by), path, partition_by)


def archive_move(
    spark: SparkSession,
    source: str,
    archive: str,
    keys: Sequence[str],
    col: str,
    lo: str,
    hi: str,
    partition_by: Sequence[str] = (),
) -> None:
    """The range moves to the archive: it is added there first and only then leaves the source.

    A run that ends between the two is repeated as a whole: key groups that the archive has are not
    added again.
    """
    rows = read_table(spark, source)
    archive_new(rows, archive, keys, col, lo, hi, partition_by)
    replace_rows(source, spark, F.col(col).between(lo, hi), rows.limit(0), partition_by)


def copy_table(
    spark: SparkSession,
    source: str,
    target: str,
    lo_hi: tuple[str, str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    """Copy a table, or the rows of an inclusive range ``(column, lo, hi)``, into the given partitions."""
    df = read_table(spark, source)
    if lo_hi:
        column, lo, hi = lo_hi
        df = df.filter(F.col(column).between(lo, hi))
    append(clustered(df, partition_by), target, partition_by)


def export_csv(df: DataFrame, path: str, bom: bool = False, single: bool = False) -> None:
    """CSV with a header, optionally marked as UTF-8 for spreadsheets.

    The output is a folder whose parts have a header each, or with ``single`` one file: the tasks write parts
    without header, in the order of the rows if ``df`` is sorted, and the file system puts them together.
    """
    if single:
        _export_file(df, path, bom)
        return
    if bom:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def _csv_line(cells: Sequence[str]) -> str:
    """One line as the CSV writer quotes it."""
    quoted = ['"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\r\n') else c for c in cells]
    return ",".join(quoted) + "\n"


def _export_file(df: DataFrame, path: str, bom: bool) -> None:
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    # Beside the target: joining files needs one file system.
    staged = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    df.write.csv(f"{staged}/rows", header=False, escape='"', emptyValue="")
    rows = [s.getPath() for s in system.listStatus(jvm.org.apache.hadoop.fs.Path(f"{staged}/rows")) if s.getLen()]
    parts = sorted((p for p in rows if p.getName().startswith("part-")), key=lambda p: p.getName())
    whole = jvm.org.apache.hadoop.fs.Path(f"{staged}/whole")
    # A distributed file system joins files by their blocks; others are copied.
    joins = system.getScheme() == "hdfs"
    out = system.create(whole, True)
    try:
        out.write(bytearray(((BOM if bom else "") + _csv_line(df.columns)).encode()))
        if not joins:
            # Parts pass through a small buffer, one after the other.
            for part in parts:
                source = system.open(part)
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
                finally:
                    source.close()
    finally:
        out.close()
    if parts and joins:
        listed = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for k, part in enumerate(parts):
            listed[k] = part
        system.concat(whole, listed)
    system.delete(target, True)
    if not system.rename(whole, target):
        raise OSError(f"could not put the file in place: {path}")
    system.delete(jvm.org.apache.hadoop.fs.Path(staged), True)


def append_log(spark: SparkSession, path: str, **entry: str | int) -> None:
    """One run or error entry added to a log table."""
    spark.createDataFrame([entry]).write.mode("append").json(path)


def append_jdbc(df: DataFrame, options: Mapping[str, str], table: str, batch_size: int = 1000) -> None:
    """Insert into a database table in batches; connection options come from the caller."""
    df.write.format("jdbc").options(**options).option("dbtable", table).option(
        "batchsize", batch_size
    ).mode("append").save()
