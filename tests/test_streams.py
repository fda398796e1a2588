"""Streams equal their batch result, also after a restart and a repeated batch."""

import os
import random
import time

from pyspark.sql import functions as F

from shelfcount.streaming import intake, scans

SCHEMA = "stcode string, cntdate string, qty int"


def values(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def drop(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as target:
        target.write(text)


def test_each_file_once(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    os.makedirs(inbox)
    drop(inbox, "a.csv", "1,d,5\n")
    for step in range(3):
        stream = intake.stream_files(spark, inbox, SCHEMA, "csv")
        intake.run_available(stream, intake.intake(table), state)
        if step == 0:
            drop(inbox, "b.csv", "2,d,6\n")
    assert values(spark.read.parquet(table), "stcode", "qty", "file") == [("1", 5, "a.csv"), ("2", 6, "b.csv")]


def test_gate_survives_a_repeated_batch(spark, tmp_path):
    table = str(tmp_path / "table")
    rows = spark.createDataFrame([("1", "d", 5), ("1", "d", 6), ("9", "d", 7)], SCHEMA)
    plan = spark.createDataFrame([("1", "d"), ("1", "d")], "stcode string, cntdate string")
    each = intake.gate_append(table, rows.schema, plan, ["stcode", "cntdate"], ["stcode", "cntdate"])
    each(rows, 0)
    each(rows, 0)  # the same batch again after a failure
    each(rows, 1)  # the same groups later
    assert values(spark.read.parquet(table), "stcode", "qty") == [("1", 5), ("1", 6)]


def test_totals_equal_batch_after_restart(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    schema = "stocktakeid string, location string, sku string, qty int"
    os.makedirs(inbox)
    for n in range(4):
        drop(inbox, f"{n}.csv", "".join(f"T,L,s{k % 3},{k}\n" for k in range(n, n + 10)))
        stream = scans.scan_totals(intake.stream_files(spark, inbox, schema, "csv", 1))
        intake.run_available(stream, scans.changed_rows(table), state, "update")
    keys = ["stocktakeid", "location", "sku"]
    live = scans.current_rows(spark.read.parquet(table), keys)
    batch = scans.scan_totals(spark.read.schema(schema).csv(inbox))
    assert values(live, *keys, "qty", "lines") == values(batch, *keys, "qty", "lines")


def test_edit_replaces_quantity(spark):
    rows = spark.createDataFrame([(1, 0, 5), (1, 2, 7), (1, 1, 9), (2, 0, 3)], "scan_id int, modified int, qty int")
    assert values(scans.latest_quantity(rows), "scan_id", "qty") == [(1, 7), (2, 3)]


def test_ids_above_high_water(spark, tmp_path):
    table = str(tmp_path / "table")
    rows = spark.range(10).select("id", F.lit("x").alias("v"))
    each = intake.append_above_high_water(spark, table, rows.schema, "id")
    each(rows.filter("id < 6"), 0)
    each(rows, 1)
    each(rows, 1)
    each(rows, 2)  # nothing new
    assert values(spark.read.parquet(table), "id") == [(k,) for k in range(10)]


def test_rows_stored_before_the_stream_count(spark, tmp_path):
    rows = spark.range(10).select("id", F.lit("x").alias("v"))
    each = intake.append_above_high_water(spark, str(tmp_path / "a"), rows.schema, "id", rows.filter("id < 4"))
    each(rows, 0)
    assert values(spark.read.parquet(str(tmp_path / "a")), "id") == [(k,) for k in range(4, 10)]
    more = spark.createDataFrame([("1", "d", 5), ("2", "d", 6)], SCHEMA)
    gate = intake.gate_append(str(tmp_path / "b"), more.schema, more, ["stcode"], ["stcode"], more.filter("stcode = '1'"))
    gate(more, 0)
    assert values(spark.read.parquet(str(tmp_path / "b")), "stcode") == [("2",)]


def test_a_new_checkpoint_keeps_loaded_rows(spark, tmp_path):
    inbox, table = str(tmp_path / "in"), str(tmp_path / "table")
    os.makedirs(inbox)
    for step in range(2):
        drop(inbox, f"{step}.csv", f"{step},d,5\n")
        stream = intake.stream_files(spark, inbox, SCHEMA, "csv")
        intake.run_available(stream, intake.intake(table), str(tmp_path / f"state{step}"))
    assert values(spark.read.parquet(table), "stcode") == [("0",), ("0",), ("1",)]


def test_a_repeated_batch_may_become_empty(spark, tmp_path):
    table = str(tmp_path / "table")
    rows = spark.createDataFrame([("1", "d", 5)], SCHEMA)
    each = intake.intake(table)
    each(rows, 0)
    each(rows, 1)
    each(rows.limit(0), 1)
    assert values(spark.read.parquet(table), "stcode") == [("1",)]


def test_many_batches_read_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(intake, "SUMMED", 8)
    path = str(tmp_path / "table")
    schema = spark.createDataFrame([], "id long").schema
    table = intake.BatchTable(spark, path, schema, schema, lambda rows: rows.select("id").distinct())
    for k in range(50):
        earlier = table.notes_before("q", k)
        folders = {os.path.dirname(f) for f in earlier.inputFiles()}
        assert len(folders) <= 8
        assert values(earlier, "id") == sorted([(n,) for n in range(k)])
        table.write(spark.range(k, k + 1).coalesce(1), "q", k)
    again = table.notes_before("other", 0)
    assert values(again, "id") == [(n,) for n in range(50)]


def test_newest_version_across_checkpoints(spark, tmp_path):
    table = str(tmp_path / "table")
    each = scans.changed_rows(table)
    each(spark.createDataFrame([("a", 1)], "k string, qty int"), 7)
    each(spark.createDataFrame([("a", 2)], "k string, qty int"), 0)
    assert values(scans.current_rows(spark.read.parquet(table), ["k"]), "k", "qty") == [("a", 2)]


def test_compaction_keeps_the_newest_versions(spark, tmp_path):
    table = str(tmp_path / "table")
    each = scans.changed_rows(table)
    for n in range(4):
        each(spark.createDataFrame([("a", n), (f"k{n}", 0)], "k string, qty int"), n)
    for _ in range(2):
        scans.compact(spark, table, ["k"])
        assert sum("batch_id=" in folder for folder, _, _ in os.walk(table)) == 1
        live = scans.current_rows(spark.read.parquet(table), ["k"])
        assert values(live, "k", "qty") == [("a", 3), ("k0", 0), ("k1", 0), ("k2", 0), ("k3", 0)]
    each(spark.createDataFrame([("a", 9)], "k string, qty int"), 4)
    assert ("a", 9) in values(scans.current_rows(spark.read.parquet(table), ["k"]), "k", "qty")


KEYS = ["stocktakeid", "location", "sku"]


def state_rows(query):
    """Rows of state after the last batch."""
    return query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]


def test_state_of_totals_falls(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    schema = "stocktakeid string, location string, sku string, qty int"
    os.makedirs(inbox)
    held = []
    for n in range(4):
        # Two large stocktakes, a quiet time, then one more scan of the first and a small stocktake.
        take = ["A", "B", "A", "C"][n]
        drop(inbox, f"{n}.csv", "".join(f"{take},L,s{k},{k}\n" for k in range([300, 200, 1, 5][n])))
        stream = scans.arrival_totals(intake.stream_files(spark, inbox, schema, "csv", 1), span="1 second", slack="0 seconds")
        held.append(state_rows(intake.run_available(stream, scans.changed_rows(table), state, "update")))
        if n == 1:
            time.sleep(3)
    assert max(held[:2]) >= 200 and held[-1] <= 6, held
    batch = scans.scan_totals(spark.read.schema(schema).csv(inbox))
    want = values(batch, *KEYS, "qty", "lines")
    assert values(scans.settled_totals(spark.read.parquet(table)), *KEYS, "qty", "lines") == want
    for _ in range(2):
        scans.fold_totals(spark, table, "2999-01-01")
        assert spark.read.parquet(table).count() == len(want)
        assert values(scans.settled_totals(spark.read.parquet(table)), *KEYS, "qty", "lines") == want


def test_shuffled_edits_and_late_ones(spark, tmp_path):
    inbox, table, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    schema = "scan_id int, modified int, qty int"
    os.makedirs(inbox)
    rng = random.Random(4)
    edits = [(k, m, rng.randrange(100)) for k in range(40) for m in range(rng.randrange(1, 9))]
    rng.shuffle(edits)
    newest, late = {}, []
    for n in range(4):
        part = edits[n::4]
        drop(inbox, f"{n}.csv", "".join(f"{a},{b},{c}\n" for a, b, c in part))
        stream = scans.arrival_latest(intake.stream_files(spark, inbox, schema, "csv", 1), span="100 milliseconds", slack="0 seconds")
        query = intake.run_available(stream, scans.changed_rows(table), state, "update")
        own = {}
        for k, m, q in part:
            own[k] = max(own.get(k, (m, q)), (m, q))
        late += [(k, m, q) for k, (m, q) in own.items() if m < newest.get(k, (-1,))[0]]
        newest.update({k: max(v, newest.get(k, v)) for k, v in own.items()})
    assert state_rows(query) <= 40
    stored = spark.read.parquet(table)
    batch = scans.latest_quantity(spark.createDataFrame(edits, schema))
    assert values(scans.settled_latest(stored), "scan_id", "qty") == values(batch, "scan_id", "qty")
    assert len(late) > 5 and values(scans.late_changes(stored), "scan_id", "modified", "qty") == sorted(late)
