from __future__ import annotations

from datetime import datetime, timedelta

from conftest import rows as table
from pyspark.sql import functions as F

from millwatt import schemas
from millwatt.operators import changes
from millwatt.sources.changelog import ChangeTable
from millwatt.sources.files import erp_table, or_empty
from millwatt.session import work_folder

LOG = "id int, status string, __op string, __source_ts_ms bigint, __lsn bigint, __deleted string"
ENVELOPE = "op string, before struct<id:int,status:string>, after struct<id:int,status:string>, source struct<ts_ms:bigint,lsn:bigint>"
START = datetime(2024, 1, 1)


def test_unwrap_takes_the_last_known_row_of_a_delete(frame):
    df = frame(
        [("c", None, (1, "new"), (5, 1)), ("u", (1, "new"), (1, "run"), (6, 2)), ("d", (1, "run"), None, (7, 3))], ENVELOPE
    )
    assert table(changes.unwrap(df), "id", "status", "__op", "__deleted") == [
        (1, "new", "c", "false"), (1, "run", "d", "true"), (1, "run", "u", "false")
    ]


def test_current_breaks_ties_and_drops_deletes(frame):
    df = frame(
        [
            (1, "a", "c", 1, 1, "false"), (1, "b", "u", 2, 2, "false"), (1, "c", "u", 2, 3, "false"),
            (2, "a", "c", 1, 4, "false"), (2, "a", "d", 9, 5, "true"),
            (3, "x", "u", None, 6, None), (3, "y", "u", 1, 7, None),
            (4, "z", "u", 3, 8, "true"),
        ],
        LOG,
    )
    assert table(changes.current(df, ["id"]), "id", "status") == [(1, "c"), (3, "y")]
    assert table(changes.current(df, ["id"], keep_deleted=True), "id") == [(1,), (2,), (3,), (4,)]


def test_capture_of_two_snapshots(frame):
    before = frame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    after = frame([(2, "B"), (3, None), (4, "d")], "id int, v string")
    got = changes.capture(before, after, ["id"])
    assert table(got, "id", "op", "before.v", "after.v") == [(1, "d", "a", None), (2, "u", "b", "B"), (4, "c", None, "d")]


def test_route(frame):
    df = frame([("erp.public.work_orders",), ("erp.public.a.b",), ("other.topic",)], "t string")
    assert table(df.select(changes.target_table(F.col("t")))) == [("a.b",), ("other.topic",), ("work_orders",)]


def test_history_keeps_real_changes(frame):
    steps = [("PLANNED", 1), ("PLANNED", 1), ("RUNNING", 1), ("RUNNING", 2), ("RUNNING", 2), ("PLANNED", 2)]
    rows = [(7, s, q, START + timedelta(days=i), i) for i, (s, q) in enumerate(steps)] + [(8, "DONE", None, START, 0)]
    df = frame(rows, "id int, status string, qty int, at timestamp, version int")
    for max_rows in (1, 100):
        got = changes.history(df, ["id"], ["status", "qty"], "at", ["version"], max_rows=max_rows)
        days = [
            (r.id, r.status, r.qty, (r.valid_from - START).days, (r.valid_to - START).days if r.valid_to else None, r.is_current)
            for r in got.orderBy("id", "valid_from").collect()
        ]
        assert days == [
            (7, "PLANNED", 1, 0, 2, False), (7, "RUNNING", 1, 2, 3, False), (7, "RUNNING", 2, 3, 5, False),
            (7, "PLANNED", 2, 5, None, True), (8, "DONE", None, 0, None, True),
        ]


def test_change_table_replays_and_compacts(spark, frame):
    table_ = ChangeTable(spark, work_folder(spark, "table"), ["id"], "id int, status string")
    assert table_.current().count() == 0 and table_.compact() == -1
    first = frame([(1, "a", "c", 1, 1, "false"), (1, "b", "u", 2, 2, "false"), (2, "a", "c", 1, 3, "false")], LOG)
    second = frame([(2, "a", "d", 5, 4, "true"), (3, "n", "c", 5, 5, "false")], LOG)
    table_.append(first, 0)
    table_.append(first, 0)
    assert table(table_.current(), "id", "status") == [(1, "b"), (2, "a")]
    table_.append(second, 1)
    assert table(table_.current(), "id", "status") == [(1, "b"), (3, "n")]
    assert table_.compact() == 0
    assert table(table_.current(), "id", "status") == [(1, "b"), (3, "n")]
    table_.append(frame([(1, "late", "u", 1, 0, "false"), (2, "back", "c", 9, 9, "false")], LOG), 2)
    assert table(table_.current(), "id", "status") == [(1, "b"), (2, "back"), (3, "n")]
    assert table_.compact() == 1 and table_.compact() == 1
    assert table(table_.current(), "id", "status") == [(1, "b"), (2, "back"), (3, "n")]
    table_.clean()
    assert table(table_.current(), "id", "status") == [(1, "b"), (2, "back"), (3, "n")]
    assert table_.compact() == 1
    table_.append(frame([(5, "x", "c", 20, 20, "false")], LOG), 3)
    assert table(table_.current(), "id") == [(1,), (2,), (3,), (5,)]
    assert table_.compact() == 2
    assert table(table_.current(), "id") == [(1,), (2,), (3,), (5,)]
    # Another stream begins at batch 0 again: nothing is hidden or replaced, before and after compactions.
    table_.append(frame([(6, "other", "c", 21, 21, "false")], LOG), 0, "other")
    assert table(table_.current(), "id") == [(1,), (2,), (3,), (5,), (6,)]
    assert table_.compact() == 3
    table_.clean()
    table_.append(frame([(7, "third", "c", 22, 22, "false")], LOG), 0, "third")
    assert table(table_.current(), "id") == [(1,), (2,), (3,), (5,), (6,), (7,)]


def test_missing_table_is_typed_and_empty(spark):
    got = erp_table(spark, work_folder(spark, "none"), "machine_states")
    assert got.count() == 0
    assert got.schema["started_at"].dataType.typeName() == "timestamp"
    assert set(schemas.ERP_TABLES) == set(schemas.ERP_KEYS)
    missing = or_empty(spark, lambda: spark.table("no_such_table"), "a int")
    assert missing.schema.simpleString() == "struct<a:int>"


def test_added_columns_are_merged(spark, frame):
    folder = work_folder(spark, "evolve")
    frame([(1, "a")], "work_order_id int, status string").write.parquet(f"{folder}/work_orders/part=1")
    frame([(2, "b", 9)], "work_order_id int, status string, extra int").write.parquet(f"{folder}/work_orders/part=2")
    assert table(erp_table(spark, folder, "work_orders"), "work_order_id", "extra") == [(1, None), (2, 9)]
