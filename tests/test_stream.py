import os
import random
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from samples import land, linked, pages, record
from tidemark.functions.casts import parse_instant
from tidemark.functions.naming import plan_columns
from tidemark.operators.records import flatten_records
from tidemark.plans.warehouse import Warehouse
from tidemark.streaming.feed import drop_repeats, stream_pages, stream_upsert

COLUMNS = plan_columns([("name", "string"), ("hs_lastmodifieddate", "datetime")])


@pytest.fixture
def house(spark):
    return Warehouse(spark, "s" + uuid.uuid4().hex, buckets=2)


def run(spark, house, folder, checkpoint, files_per_batch=1, edges=False):
    carry = ("_ord", "_corrupt", "archivedAt", *(("id", "associations") if edges else ()))
    rows = flatten_records(
        stream_pages(spark, str(folder), files_per_batch=files_per_batch), COLUMNS, datetime(2024, 7, 1), carry=carry)
    query = stream_upsert(
        rows, house, "people", ["hs_object_id"], ["hs_lastmodifieddate", "_ord"],
        str(checkpoint), guard="hs_lastmodifieddate", archived=F.col("fivetran_deleted"),
        archived_at=parse_instant(F.col("archivedAt")), rejects="rejects", edges=edges)
    query.awaitTermination()
    return query


def state(house):
    return {r.hs_object_id: (r.name, r.fivetran_deleted) for r in house.read("people").collect()}


def version(id, name, day, **more):
    return record(id, name=name, hs_lastmodifieddate=f"2024-06-{day:02d}T00:00:00Z", **more)


def test_stream_keeps_the_newest_version(spark, house, tmp_path):
    folder, checkpoint = tmp_path / "records", tmp_path / "checkpoint"
    land(folder, *pages([version("1", "a", 1), version("2", "b", 5), version("1", "a2", 3)]))
    land(folder, *pages([version("2", "late", 2), version("3", "c", 1)], [version("1", "a3", 4)]))
    run(spark, house, folder, checkpoint)
    assert state(house) == {1: ("a3", False), 2: ("b", False), 3: ("c", False)}

    land(folder, *pages([record("3", archived=True), version("4", "d", 1)]))
    run(spark, house, folder, checkpoint)
    assert state(house) == {1: ("a3", False), 2: ("b", False), 3: ("c", True), 4: ("d", False)}


def test_nothing_new_changes_nothing(spark, house, tmp_path):
    folder, checkpoint = tmp_path / "records", tmp_path / "checkpoint"
    land(folder, *pages([version("1", "a", 1)]))
    run(spark, house, folder, checkpoint)
    before = house.version("people")
    run(spark, house, folder, checkpoint)
    assert house.version("people") == before


def test_replayed_batch_is_recognised(spark, house, tmp_path):
    folder, checkpoint = tmp_path / "records", tmp_path / "checkpoint"
    land(folder, *pages([version("1", "a", 1)]))
    run(spark, house, folder, checkpoint)
    replay(checkpoint)
    before = house.version("people")
    run(spark, house, folder, checkpoint)
    assert house.version("people") == before and state(house) == {1: ("a", False)}


def test_batching_does_not_change_the_result(spark, tmp_path):
    folder = tmp_path / "records"
    for i in range(4):
        land(folder, *pages([version(str(k), f"v{i}", 1 + (i * 7 + k) % 20) for k in range(10)]))
    results = []
    for size in (1, 4):
        house = Warehouse(spark, "s" + uuid.uuid4().hex, buckets=2)
        run(spark, house, folder, tmp_path / f"checkpoint{size}", size)
        results.append(state(house))
    assert results[0] == results[1]


HISTORY = [
    version("1", "a", 1), version("1", "gone", 2, archived=True), version("1", "back", 3),
    version("2", "b", 5), version("2", "old", 2, archived=True),
    version("3", "gone", 6, archived=True), version("3", "late", 4), version("3", "later", 5),
    version("4", "d", 1), record("4", archived=True, archivedAt="2024-06-09T00:00:00Z"),
    version("5", "e", 1), record("5", archived=True),
    version("6", "tie", 3), version("6", "tie", 3, archived=True),
    version("7", "never", 3, archived=True),
]


@pytest.mark.parametrize("seed", [None, 1, 2])
def test_any_order_and_any_batches_of_one_history(spark, tmp_path, seed):
    rng = random.Random(seed)
    history = rng.sample(HISTORY, len(HISTORY)) if seed else HISTORY
    cuts = sorted(rng.sample(range(1, len(history)), 3))
    for page in [history[a:b] for a, b in zip([0, *cuts], [*cuts, len(history)])]:
        land(tmp_path / "records", {"results": page})
    for size in (1, 2, 9):
        house = Warehouse(spark, "s" + uuid.uuid4().hex, buckets=2)
        run(spark, house, tmp_path / "records", tmp_path / f"checkpoint{size}", size)
        assert state(house) == {
            1: ("back", False), 2: ("b", False), 3: ("later", True), 4: ("d", True), 5: ("e", True), 6: ("tie", True)}


def replay(checkpoint, batch=0):
    """Lose the commit of a batch, which is then delivered again under the same number."""
    (checkpoint / "commits" / f".{batch}.crc").unlink(missing_ok=True)
    (checkpoint / "commits" / str(batch)).unlink()


def edges_of(house):
    return sorted((r.from_id, r.to_id) for r in house.read("people_edges").collect())


def test_stream_keeps_the_links_of_the_newest_version(spark, house, tmp_path):
    folder, checkpoint = tmp_path / "records", tmp_path / "checkpoint"
    link = lambda *ids: {"deals": linked(*[(i, "1") for i in ids])}
    land(folder, *pages([version("1", "a", 5, associations=link("10", "11")), version("2", "b", 1, associations=link("20"))]))
    run(spark, house, folder, checkpoint, edges=True)
    assert edges_of(house) == [(1, 10), (1, 11), (2, 20)]
    # An older version changes nothing, one that tells of no links takes them, one without a word keeps them.
    land(folder, *pages([version("1", "late", 2, associations=link("99")), version("2", "b2", 3, associations={}), version("3", "c", 1, associations=link("30"))]))
    land(folder, *pages([version("3", "c2", 4)]))
    run(spark, house, folder, checkpoint, edges=True)
    assert edges_of(house) == [(1, 10), (1, 11), (3, 30)] and state(house)[2] == ("b2", False)
    assert {(r.people_id, r.deals_id) for r in house.read("people_deals").collect()} == {(1, 10), (1, 11), (3, 30)}


@pytest.mark.parametrize("lost", ["nothing but the commit", "the main table", "main table and edges"])
def test_a_replayed_batch_repeats_nothing(spark, house, tmp_path, lost, monkeypatch):
    folder, checkpoint = tmp_path / "records", tmp_path / "checkpoint"
    land(folder, *pages([version("1", "a", 1, associations={"deals": linked(("10", "1"))}), version("x7", "b", 1), record("9", archived=True)]))
    publish, failing = Warehouse.publish, {"the main table": ["people"], "main table and edges": ["people", "people_edges"]}.get(lost, [])

    def breaks(self, df, name, *args, **more):
        if name in failing:
            raise RuntimeError("lost")
        return publish(self, df, name, *args, **more)

    monkeypatch.setattr(Warehouse, "publish", breaks)
    if failing:
        with pytest.raises(Exception, match="lost"):
            run(spark, house, folder, checkpoint, edges=True)
        failing.clear()
    else:
        run(spark, house, folder, checkpoint, edges=True)
        replay(checkpoint)
    run(spark, house, folder, checkpoint, edges=True)
    assert state(house) == {1: ("a", False)} and edges_of(house) == [(1, 10)]
    assert [r.id_text for r in house.read("rejects").collect()] == ["x7"]
    assert {n: house.version(n) for n in ("people", "people_edges", "people_archived")} == {
        "people": 1, "people_edges": 1, "people_archived": 1}


def test_micro_batches_leave_no_scratch(spark, house, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    land(tmp_path / "records", *pages([version("1", "a", 1, associations={"deals": linked(("10", "1"))})]))
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    run(spark, house, tmp_path / "records", tmp_path / "checkpoint", edges=True)
    assert set(os.listdir(shared)) == before


def test_the_later_page_of_a_file_wins(spark, house, tmp_path):
    folder = tmp_path / "records"
    land(folder, *pages([version("0", "x", 1), version("1", "first", 5)], [version("1", "second", 5)]))
    run(spark, house, folder, tmp_path / "checkpoint")
    assert state(house)[1] == ("second", False)


def test_unreadable_pages_and_bad_ids_are_told(spark, house, tmp_path):
    folder = tmp_path / "records"
    land(folder, *pages([version("1", "a", 1), version("x7", "b", 1)]), '{"results": [{"id": "9", ')
    run(spark, house, folder, tmp_path / "checkpoint")
    assert state(house) == {1: ("a", False)}
    told = {(r.error_type, r.id_text) for r in house.read("rejects").collect()}
    assert ("ValueError", "x7") in told and any(kind == "JSONDecodeError" for kind, _ in told)


def test_repeats_are_dropped_within_and_across_batches(spark, tmp_path):
    folder, shape = str(tmp_path / "rows"), "k long, v string"

    def take(*rows):
        spark.createDataFrame(list(rows), shape).coalesce(1).write.mode("append").parquet(folder)
        stream = drop_repeats(spark.readStream.schema(shape).parquet(folder), ["k"], "1 day").writeStream
        stream = stream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True)
        stream.format("parquet").start(str(tmp_path / "out")).awaitTermination()
        return sorted(((r.k, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=str)

    assert take((1, "a"), (1, "a"), (None, "n")) == [(1, "a"), (None, "n")]
    assert take((1, "again"), (None, "n"), (2, "b")) == [(1, "a"), (2, "b"), (None, "n")]


def test_a_batch_moves_to_the_buckets_and_the_tables_stay(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, "s" + uuid.uuid4().hex, buckets=3)
    folder, checkpoint = tmp_path / "records", tmp_path / "checkpoint"
    publish, plans = Warehouse.publish, {}

    def noted(self, df, name, *args, **more):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return publish(self, df, name, *args, **more)

    monkeypatch.setattr(Warehouse, "publish", noted)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for day in (1, 2):
            land(folder, *pages([version(str(i), "a", day) for i in range(20)] + [record("3", archived=True)]))
            run(spark, house, folder, checkpoint, files_per_batch=10)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for name in ("people", "people_archived"):
        lines = [(len(x) - len(x.lstrip(" :+-")), x) for x in plans[name].splitlines()]
        for at, (depth, line) in enumerate(lines):
            if "Scan parquet" not in line or f"{name}__v" not in line:
                continue
            above = []
            for d, x in reversed(lines[:at]):
                if d < depth:
                    above, depth = [*above, x], d
            assert above and not [x for x in above if "Exchange" in x], plans[name]
