"""Streams over files that Spark derives from the tables; each must equal its batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcount.session import scratch_path
from shelfcount.streaming import intake, scans

from .inputs import QTY, Inputs, check


def dropped(i: Inputs, df) -> str:
    """The rows as files of a drop folder, one per partition they are in."""
    path = scratch_path(i.spark, "drop")
    df.write.parquet(path)
    return path


def some_files(i: Inputs) -> int:
    """Files per micro-batch: a few batches however many cores write the files."""
    return max(1, i.spark.sparkContext.defaultParallelism // 3)


@check("SELECT stcode, cntdate, sku, count(*) AS n FROM v_stk GROUP BY 1, 2, 3")
def stream_intake(i: Inputs):
    rows = i.stk.select("stcode", "cntdate", "sku")
    folder, table, state = dropped(i, rows), scratch_path(i.spark, "table"), scratch_path(i.spark, "state")
    for _ in range(2):  # the second run finds nothing new
        stream = intake.stream_files(i.spark, folder, rows.schema, "parquet", some_files(i))
        intake.run_available(stream, intake.intake(table), state)
    return i.spark.read.parquet(table).groupBy("stcode", "cntdate", "sku").agg(F.count(F.lit(1)).alias("n"))


@check("SELECT stcode, cntdate, sku, 2 * count(*) AS n FROM v_stk GROUP BY 1, 2, 3")
def stream_intake_two_checkpoints(i: Inputs):
    rows = i.stk.select("stcode", "cntdate", "sku")
    folder, table = dropped(i, rows), scratch_path(i.spark, "table")
    for _ in range(2):  # a new checkpoint loads every file again, beside what the first one loaded
        stream = intake.stream_files(i.spark, folder, rows.schema, "parquet", some_files(i))
        intake.run_available(stream, intake.intake(table), scratch_path(i.spark, "state"))
    return i.spark.read.parquet(table).groupBy("stcode", "cntdate", "sku").agg(F.count(F.lit(1)).alias("n"))


@check("""SELECT stcode, cntdate, sku FROM v_stk s WHERE CAST(stcode AS BIGINT) % 4 <> 0 AND EXISTS (SELECT 1 FROM v_planm p WHERE p.stcode = s.stcode AND p.cntdate = s.cntdate)""")
def stream_gate_append(i: Inputs):
    rows = i.stk.select("stcode", "cntdate", "sku")
    folder, table, state = dropped(i, rows), scratch_path(i.spark, "table"), scratch_path(i.spark, "state")
    keys = ["stcode", "cntdate"]
    loaded = rows.filter(F.col("stcode").cast("bigint") % 4 == 0)
    each = intake.gate_append(table, rows.schema, i.planm, keys, keys, loaded)
    for _ in range(2):  # a drop is one batch; the same rows dropped again belong to loaded groups
        stream = intake.stream_files(i.spark, folder, rows.schema, "parquet")
        intake.run_available(stream, each, state)
        rows.write.mode("append").parquet(folder)
    return i.spark.read.parquet(table).select("stcode", "cntdate", "sku")


@check("SELECT stocktakeid, location, sku, CAST(sum(qty) AS DOUBLE) AS qty, count(*) AS lines FROM v_scan GROUP BY 1, 2, 3")
def scan_totals(i: Inputs):
    rows = i.scan.select("stocktakeid", "location", "sku", "qty")
    folder, table, state = dropped(i, rows), scratch_path(i.spark, "table"), scratch_path(i.spark, "state")
    keys = ["stocktakeid", "location", "sku"]
    stream = scans.scan_totals(intake.stream_files(i.spark, folder, rows.schema, "parquet", some_files(i)), keys)
    intake.run_available(stream, scans.changed_rows(table), state, "update")
    out = scans.current_rows(i.spark.read.parquet(table), keys)
    return out.withColumn("qty", F.col("qty").cast("double"))


@check("""SELECT scan_id, CAST(coalesce(e.qty, s.qty) AS DOUBLE) AS qty FROM v_scan s LEFT JOIN v_edit e ON e.id = s.scan_id""")
def latest_quantity(i: Inputs):
    edits = i.edit.select(F.col("id").alias("scan_id"), F.lit(1).alias("modified"), F.col("qty").cast(QTY).alias("qty"))
    rows = i.scan.select("scan_id", F.lit(0).alias("modified"), "qty").unionByName(edits)
    folder, table, state = dropped(i, rows), scratch_path(i.spark, "table"), scratch_path(i.spark, "state")
    stream = scans.latest_quantity(intake.stream_files(i.spark, folder, rows.schema, "parquet", some_files(i)))
    intake.run_available(stream, scans.changed_rows(table), state, "update")
    out = scans.current_rows(i.spark.read.parquet(table), ["scan_id"])
    return out.withColumn("qty", F.col("qty").cast("double"))


@check("SELECT stocktakeid, location, sku, CAST(sum(qty) AS DOUBLE) AS qty, count(*) AS lines FROM v_scan GROUP BY 1, 2, 3")
def arrival_totals(i: Inputs):
    """Totals of spans of arrival so short that every run and most batches open one."""
    rows = i.scan.select("stocktakeid", "location", "sku", "qty")
    folder, table, state = dropped(i, rows), scratch_path(i.spark, "table"), scratch_path(i.spark, "state")
    stream = scans.arrival_totals(intake.stream_files(i.spark, folder, rows.schema, "parquet", some_files(i)), span="100 milliseconds")
    intake.run_available(stream, scans.changed_rows(table), state, "update")
    return scans.settled_totals(i.spark.read.parquet(table)).withColumn("qty", F.col("qty").cast("double"))


def edited(i: Inputs):
    """The stored changes of a stream that gets the newest change of every scan first and all others after it."""
    edits = i.edit.select(F.col("id").alias("scan_id"), F.lit(1).alias("modified"), F.col("qty").cast(QTY).alias("qty"))
    counted = i.scan.select("scan_id", F.lit(0).alias("modified"), "qty")
    known = edits.join(counted.select("scan_id"), "scan_id", "left_semi")
    plain = counted.join(edits.select("scan_id"), "scan_id", "left_anti")
    folder, table, state = scratch_path(i.spark, "drop"), scratch_path(i.spark, "table"), scratch_path(i.spark, "state")
    for part in (known.unionByName(plain), counted.join(edits.select("scan_id"), "scan_id", "left_semi")):
        part.write.mode("append").parquet(folder)
        stream = scans.arrival_latest(intake.stream_files(i.spark, folder, counted.schema, "parquet"), span="100 milliseconds")
        intake.run_available(stream, scans.changed_rows(table), state, "update")
    return i.spark.read.parquet(table)


@check("""SELECT scan_id, CAST(coalesce(e.qty, s.qty) AS DOUBLE) AS qty FROM v_scan s LEFT JOIN v_edit e ON e.id = s.scan_id""")
def arrival_latest(i: Inputs):
    return scans.settled_latest(edited(i)).withColumn("qty", F.col("qty").cast("double"))


@check("SELECT scan_id, 0 AS modified, CAST(s.qty AS DOUBLE) AS qty FROM v_scan s JOIN v_edit e ON e.id = s.scan_id")
def late_changes(i: Inputs):
    return scans.late_changes(edited(i)).select("scan_id", "modified", F.col("qty").cast("double").alias("qty"))


@check("SELECT scan_id, sku FROM v_scan")
def incremental_by_id(i: Inputs):
    rows = i.scan.select("scan_id", "sku")
    folder, table, state = scratch_path(i.spark, "drop"), scratch_path(i.spark, "table"), scratch_path(i.spark, "state")
    each = intake.append_above_high_water(i.spark, table, rows.schema, "scan_id")
    top = rows.agg(F.floor(F.max("scan_id") / 2)).scalar()
    for part in (rows.filter(F.col("scan_id") <= top), rows):  # the second export repeats the first
        part.write.mode("append").parquet(folder)
        stream = intake.stream_files(i.spark, folder, rows.schema, "parquet")
        intake.run_available(stream, each, state)
    return i.spark.read.parquet(table).select("scan_id", "sku")
