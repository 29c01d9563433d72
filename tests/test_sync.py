import os
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from samples import CATALOG, PEOPLE, land, linked, pages, record
from tidemark.plans.sync import Feed, Landed, read_catalog, read_links, sync_all, sync_object
from tidemark.plans.warehouse import ConcurrentPublish, Warehouse

JUNE, JULY, AUGUST = datetime(2024, 6, 10), datetime(2024, 7, 1), datetime(2024, 8, 1)
TREES = [{"id": "p1", "label": "Sales", "stages": [{"id": "77-a", "label": "New"}, {"id": "78", "label": "Won"}]}]
SCHEMA = {"objectTypeId": "0-1", "name": "CONTACT", "associations": [
    {"fromObjectTypeId": "0-1", "toObjectTypeId": "2-9", "name": "CONTACT_TO_METERS"},
    {"fromObjectTypeId": "0-1", "toObjectTypeId": "0-1", "name": "CONTACT_TO_CONTACT"}]}


@pytest.fixture
def house(spark):
    return Warehouse(spark, "w" + uuid.uuid4().hex, buckets=3)


def landing(root, people=PEOPLE, archived=(), links=True, catalog=CATALOG):
    base = root / "contacts"
    land(base / "records", *pages(people[:2], people[2:]))
    land(base / "properties", {"results": [*catalog, {"name": "hs_date_entered_77_a_123", "type": "datetime"}]})
    land(base / "schema", SCHEMA)
    land(base / "pipelines", {"results": TREES})
    land(base / "archived", {"results": list(archived)})
    if links:
        land(base / "links" / "to_type=2-9", {"results": [
            {"from": {"id": "811"}, "to": [{"toObjectId": 900, "associationTypes": [{"typeId": 1}, {"typeId": 2}]}]},
            {"from": {"id": "555"}, "to": [{"toObjectId": 901, "associationTypes": [{"typeId": 1}]}]}]})
        land(base / "links" / "to_type=0-1", {"results": [
            {"from": {"id": "824"}, "to": [{"toObjectId": 811, "associationTypes": [{"typeId": 3}]}]}]})
    return Feed.under(str(root), "contacts")


def people(house, *columns):
    return {r.hs_object_id: tuple(r)[1:] for r in house.read("contact").select("hs_object_id", *columns).collect()}


def test_full_load_builds_every_table(spark, house, tmp_path):
    summary = sync_object(spark, landing(tmp_path), house, mark=JUNE)
    assert people(house, "firstname", "fivetran_deleted") == {
        811: ("Ilse", False), 824: ("Noor", False), 839: ("Tariq", False), 852: ("Wren", False)}
    assert "hs_date_entered_77_a" in house.read("contact").columns
    assert {tuple(r)[:3] for r in house.read("contact_meters").collect()} == {(811, 900, "1"), (811, 900, "2")}
    assert house.read("contact_contact").columns[:2] == ["from_contact_id", "to_contact_id"]
    assert house.read("contact_companies").count() == 4
    assert house.read("contact_pipeline").count() == 1 and house.read("contact_pipeline_stage").count() == 2
    assert (summary.status, summary.records_fetched, summary.db_upserts, summary.sync_mode) == ("healthy", 4, 4, "full")
    assert (summary.associations_found, summary.association_tables_created) == (8, 4)
    assert (summary.pipelines_loaded, summary.stages_loaded, summary.records_deleted) == (1, 2, 0)
    state = house.read("sync_state").first()
    assert (state.object_type, state.last_sync_timestamp, state.sync_mode) == ("contacts", JUNE, "full")
    assert house.read("sync_runs").count() == 1


def test_full_load_marks_vanished_and_revives(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    summary = sync_object(spark, landing(tmp_path / "b", PEOPLE[1:4]), house, force_full=True, mark=JULY)
    assert summary.records_deleted == 1 and people(house, "fivetran_deleted", "fivetran_synced")[811] == (True, JULY)
    sync_object(spark, landing(tmp_path / "c"), house, force_full=True, mark=AUGUST)
    assert people(house, "fivetran_deleted")[811] == (False,)


def test_incomplete_load_marks_nothing(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    feed = landing(tmp_path / "b", PEOPLE[1:4])
    land(tmp_path / "b" / "contacts" / "records", '{"results": [{"id": "811", ')
    summary = sync_object(spark, feed, house, force_full=True, mark=JULY)
    assert summary.records_deleted == 0 and summary.status == "with_errors"
    assert people(house, "fivetran_deleted")[811] == (False,)


def test_incremental_load(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    changed = [
        record("824", firstname="Maria", hs_lastmodifieddate="2024-06-10T00:00:00Z", associations={"deals": linked(("9", "1"))}),
        record("839", firstname="stale", hs_lastmodifieddate="2024-06-09T23:59:59Z"),
        record("4411", firstname="Neu", hs_lastmodifieddate="2024-06-20T00:00:00Z"),
    ]
    gone = [{"id": "852", "archived": True, "archivedAt": "2024-06-15T00:00:00Z"},
            {"id": "811", "archived": True, "archivedAt": "2024-06-01T00:00:00Z"}]
    summary = sync_object(spark, landing(tmp_path / "b", changed, gone, links=False), house, mark=JULY)
    assert (summary.sync_mode, summary.records_fetched, summary.records_deleted) == ("incremental", 2, 1)
    assert people(house, "firstname", "fivetran_deleted") == {
        811: ("Ilse", False), 824: ("Maria", False), 839: ("Tariq", False), 852: ("Wren", True), 4411: ("Neu", False)}
    assert people(house, "lastname")[824] == (None,)
    # Only the record that brought links has its links replaced.
    edges = {(r.from_id, r.to_type, r.to_id) for r in house.read("contact_edges").collect()}
    assert (824, "deals", 9) in edges and (824, "companies", 4425) not in edges and (811, "meters", 900) in edges


def test_too_many_changes_mean_a_full_load(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=datetime(2024, 5, 1))
    summary = sync_object(spark, landing(tmp_path / "b"), house, max_changes=3, mark=JULY)
    assert summary.sync_mode == "full"


def test_full_after_incremental_equals_full_alone(spark, tmp_path):
    later = [*PEOPLE[:4], record("300", firstname="Late", hs_lastmodifieddate="2024-06-30T00:00:00Z")]
    tables = []
    for first in (PEOPLE[:2], None):
        house = Warehouse(spark, "w" + uuid.uuid4().hex, buckets=2)
        if first:
            sync_object(spark, landing(tmp_path / "x", first), house, mark=datetime(2024, 5, 1))
            sync_object(spark, landing(tmp_path / "y", later), house, mark=JUNE)
        sync_object(spark, landing(tmp_path / f"z{bool(first)}", later), house, force_full=True, mark=JULY)
        table = house.read("contact")
        tables.append(table.select(*sorted(table.columns)).collect())
    assert sorted(map(str, tables[0])) == sorted(map(str, tables[1]))


def test_new_columns_are_added(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    more = [*CATALOG, {"name": "Teléfono", "type": "phone_number"}]
    late = [record("811", **{"Teléfono": "555"}, hs_lastmodifieddate="2024-06-20T00:00:00Z")]
    summary = sync_object(spark, landing(tmp_path / "b", late, catalog=more), house, mark=JULY)
    assert summary.schema_changes == 1
    assert people(house, "telefono")[811] == ("555",) and people(house, "telefono")[824] == (None,)


def test_failing_object_does_not_stop_the_rest(spark, house, tmp_path):
    landing(tmp_path)
    land(tmp_path / "deals" / "properties", {"results": [{"name": "x"}]})
    land(tmp_path / "deals" / "records", *pages([record("1", x="y")]))
    land(tmp_path / "bad" / "pipelines", {"results": [{"label": "no id", "stages": [{"id": "s"}]}]})
    done, errors = sync_all(spark, str(tmp_path), ["contacts", "bad", "deals"], house)
    assert [s.object_type for s in done] == ["contacts", "deals"]
    assert [e["object_type"] for e in errors] == ["bad"]
    assert house.read("deals").count() == 1
    assert house.read("sync_runs").where("status = 'healthy'").count() == 2
    up = house.read("sync_rollups").first()
    assert (up.all_healthy, up.objects, up.objects_failed, up.records_processed_ok) == (False, 3, 1, 5)
    failed = house.read("sync_rejects").first()
    assert (failed.object_type, failed.error_type, failed["class"]) == ("bad", "ValueError", "unknown")
    nulls = {(r.object_type, r.column): (r.null_count, r.pct, r.alert) for r in house.read("sync_nulls").collect()}
    assert nulls["contacts", "es_activo"] == (4, 100.0, True) and ("deals", "x") not in nulls


def test_versions_switch_and_old_ones_stay_until_vacuum(spark, house):
    for i in range(3):
        house.publish(spark.range(i + 1), "t", ["id"], source=f"run{i}")
        reader = reader if i else house.read("t")
    house.publish(spark.range(9), "q", ["id"], source="it's \\ odd")
    assert house.source("q") == "it's \\ odd"
    assert (house.version("t"), house.source("t"), house.read("t").count()) == (3, "run2", 3)
    assert reader.count() == 1
    assert house.vacuum() == []
    assert len(house.vacuum(older_than=0)) == 2
    tables = [r.name.split("_")[0] + r.name[1:5] for r in spark.catalog.listTables(house.database) if not r.isTemporary]
    assert len(tables) == 4 and house.read("t").count() == 3
    assert house.version("unknown") == 0 and house.read("unknown") is None


def test_a_second_run_on_one_table_fails(spark, house, monkeypatch):
    house.publish(spark.range(1), "t", ["id"])
    versions = iter([1, 2])
    monkeypatch.setattr(house, "version", lambda name: next(versions))
    with pytest.raises(ConcurrentPublish):
        house.publish(spark.range(2), "t", ["id"])
    monkeypatch.undo()
    assert house.version("t") == 1 and house.read("t").count() == 1


def edges(house):
    return sorted((r.from_id, r.to_type, r.to_id) for r in house.read("contact_edges").collect())


BROKEN = '{"results": [{"id": "811", '


def test_incremental_run_keeps_unreadable_and_undated(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    feed = landing(tmp_path / "b", [record("900", firstname="undated"), record("901", firstname="odd", hs_lastmodifieddate="?")])
    land(tmp_path / "b" / "contacts" / "records", BROKEN)
    summary = sync_object(spark, feed, house, mark=JULY)
    assert (summary.status, summary.records_failed, summary.sync_mode) == ("with_errors", 1, "incremental")
    assert {900, 901} <= set(people(house))
    state = house.read("sync_state").collect()
    assert [r.last_sync_timestamp for r in state] == [JUNE]
    reject = house.read("sync_rejects").first()
    assert (reject.error_type, reject.content.strip()) == ("JSONDecodeError", BROKEN.strip())
    assert reject.page.endswith(".json")


def test_unreadable_archived_page_holds_the_mark(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    feed = landing(tmp_path / "b", archived=[])
    land(tmp_path / "b" / "contacts" / "archived", BROKEN)
    summary = sync_object(spark, feed, house, mark=JULY)
    assert (summary.status, summary.records_failed, summary.sync_mode) == ("with_errors", 1, "incremental")
    assert [r.last_sync_timestamp for r in house.read("sync_state").collect()] == [JUNE]
    reject = house.read("sync_rejects").first()
    assert reject.content.strip() == BROKEN.strip() and "/archived/" in reject.page


@pytest.mark.parametrize("full", [True, False])
def test_unreadable_link_page_takes_no_edges(spark, house, tmp_path, full):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    before = edges(house)
    told = {"companies": linked(("77", "1"))}
    changed = [record(i, associations=told, hs_lastmodifieddate="2024-06-20T00:00:00Z") for i in ("811", "824")]
    feed = landing(tmp_path / "b", changed, links=False)
    land(tmp_path / "b" / "contacts" / "links" / "to_type=2-9", BROKEN)
    summary = sync_object(spark, feed, house, force_full=full, mark=JULY)
    assert (summary.status, summary.records_failed) == ("with_errors", 1)
    assert summary.records_processed_ok == summary.records_fetched == 2
    assert edges(house) == sorted([*before, (811, "companies", 77), (824, "companies", 77)])
    assert [r.last_sync_timestamp for r in house.read("sync_state").collect()] == [JUNE]
    assert "/links/" in house.read("sync_rejects").first().page


def test_full_run_over_an_empty_feed_changes_nothing(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    before = edges(house)
    summary = sync_object(spark, landing(tmp_path / "b", [], links=False), house, force_full=True, mark=JULY)
    assert edges(house) == before and summary.records_deleted == 0
    assert not any(deleted for (deleted,) in people(house, "fivetran_deleted").values())


def test_incomplete_full_run_replaces_only_edges_it_saw(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    before = edges(house)
    feed = landing(tmp_path / "b", [record("824", firstname="Noor", associations={}, hs_lastmodifieddate="2024-06-20T00:00:00Z")], links=False)
    land(tmp_path / "b" / "contacts" / "records", BROKEN)
    sync_object(spark, feed, house, force_full=True, mark=JULY)
    # What the link feed told of the record stays.
    assert edges(house) == [e for e in before if e[:2] != (824, "companies")]


def test_records_that_lose_all_links(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    before = edges(house)
    late = [record("811", associations={"companies": linked()}, hs_lastmodifieddate="2024-06-20T00:00:00Z"),
            record("824", hs_lastmodifieddate="2024-06-20T00:00:00Z")]
    sync_object(spark, landing(tmp_path / "b", late, links=False), house, mark=JULY)
    # A record that came without any associations says nothing about them, and none about the link feed's.
    assert edges(house) == [e for e in before if e[0] != 811 or e[1] == "meters"]


def metered(*pairs):
    """A link page: (record, target) with one link type, no target for a record without links."""
    return {"results": [
        {"from": {"id": i}, "to": [{"toObjectId": t, "associationTypes": [{"typeId": 1}]}] if t else []} for i, t in pairs]}


def meters(house):
    return sorted((r.contact_id, r.meters_id) for r in house.read("contact_meters").collect())


@pytest.mark.parametrize("same_folder", [True, False])
def test_links_of_unchanged_and_of_later_records(spark, house, tmp_path, same_folder):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    root = tmp_path / ("a" if same_folder else "b")
    if not same_folder:
        landing(root, [], links=False)
    links = root / "contacts" / "links" / "to_type=2-9"
    # 839 did not change; 811 is told to have no meters any more; 555 is not there yet, and told anew.
    land(links, metered(("839", 910), ("811", None), ("555", 902), ("556", 903)))
    before = edges(house)
    summary = sync_object(spark, Feed.under(str(root), "contacts"), house, mark=JULY)
    assert (summary.sync_mode, summary.status) == ("incremental", "healthy")
    assert meters(house) == [(839, 910)]
    assert [e for e in edges(house) if e[1] != "meters"] == [e for e in before if e[1] != "meters"]
    waiting = {(r.from_id, r.to_type, r.to_id) for r in house.read("contact_links_waiting").collect()}
    assert waiting == {(555, "meters", 902), (556, "meters", 903)}
    # The record comes, its link page was read long ago.
    late = [record("555", firstname="Late", hs_lastmodifieddate="2024-07-20T00:00:00Z")]
    sync_object(spark, landing(tmp_path / "c", late, links=False), house, mark=AUGUST)
    assert meters(house) == [(555, 902), (839, 910)]
    assert [r.from_id for r in house.read("contact_links_waiting").collect()] == [556]


def test_a_changed_record_keeps_the_links_of_its_feed(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    changed = [record("811", associations={"companies": linked(("77", "1"))}, hs_lastmodifieddate="2024-06-20T00:00:00Z")]
    summary = sync_object(spark, landing(tmp_path / "b", changed, links=False), house, mark=JULY)
    assert {e[1:] for e in edges(house) if e[0] == 811} == {("companies", 77), ("meters", 900)}
    assert summary.associations_found == 1


def test_an_edge_told_twice_is_shown_once(spark, house, tmp_path):
    told = [record("811", associations={"meters": linked(("900", "1"))}, hs_lastmodifieddate="2024-06-01T00:00:00Z")]
    sync_object(spark, landing(tmp_path / "a", told), house, mark=JUNE)
    # Type 1 is told by the record and by the link feed, type 2 by the feed alone.
    assert house.read("contact_edges").where("to_type = 'meters'").count() == 3 and meters(house) == [(811, 900)] * 2
    gone = [record("811", associations={}, hs_lastmodifieddate="2024-06-20T00:00:00Z")]
    sync_object(spark, landing(tmp_path / "b", gone, links=False), house, mark=JULY)
    assert meters(house) == [(811, 900)] * 2


def test_links_of_a_deleted_record_wait(spark, house, tmp_path):
    sync_object(spark, landing(tmp_path / "a"), house, mark=JUNE)
    feed = landing(tmp_path / "b", [], [{"id": "839", "archived": True}], links=False)
    land(tmp_path / "b" / "contacts" / "links" / "to_type=2-9", metered(("839", 910)))
    sync_object(spark, feed, house, mark=JULY)
    assert (839, 910) not in meters(house)
    assert 839 in {r.from_id for r in house.read("contact_links_waiting").collect()}


def test_counts_do_not_grow_on_a_repeated_run(spark, house, tmp_path):
    feed = landing(tmp_path)
    sync_object(spark, feed, house, force_full=True, mark=JUNE)
    before = sorted(map(tuple, house.read("contact_edges").drop("fivetran_synced").collect()))
    sync_object(spark, feed, house, force_full=True, mark=JULY)
    assert sorted(map(tuple, house.read("contact_edges").drop("fivetran_synced").collect())) == before
    assert house.read("contact").where(F.col("fivetran_deleted")).isEmpty()


def test_files_are_opened_by_what_they_hold(spark, house, tmp_path):
    def one(id, day, name="n"):
        return record(str(id), firstname=name, hs_lastmodifieddate=f"2024-{day}T00:00:00Z")

    feed = landing(tmp_path, people=[one(1, "06-01"), one(2, "06-02")], catalog=[{"name": "firstname"}])
    records = tmp_path / "contacts" / "records"
    land(records, *pages([one(3, "07-20", "ahead")]))
    land(records, *pages([one(4, "06-03")]))

    def wanted(since):
        return sorted(p.rsplit("/", 1)[1] for p in Landed(house, feed).choose("records", since))

    def run(mark):
        return sync_object(spark, feed, house, mark=mark, by_file=True)

    assert run(JUNE).records_fetched == 4
    noted = {r.file.rsplit("/", 1)[1]: r for r in house.read("sync_files").where("kind = 'records'").collect()}
    assert {k: (r.records, r.undated) for k, r in noted.items()} == {
        "0000.json": (2, 0), "0001.json": (1, 0), "0002.json": (1, 0)}
    assert noted["0000.json"].oldest < noted["0000.json"].newest
    # Only the file that holds a change after the mark is wanted, and what is new.
    assert wanted(JUNE) == ["0001.json"]
    land(records, *pages([one(1, "06-20", "late"), one(5, "06-21")]))
    os.utime(records / "0003.json", (0, 0))
    land(tmp_path / "contacts" / "links" / "to_type=2-9", {"results": [
        {"from": {"id": "2"}, "to": [{"toObjectId": 77, "associationTypes": [{"typeId": 1}]}]}]})
    assert wanted(JUNE) == ["0001.json", "0003.json"]
    second = run(JULY)
    assert (second.sync_mode, second.records_fetched, second.associations_found) == ("incremental", 3, 1)
    assert {k: v[0] for k, v in people(house, "firstname").items()} == {1: "late", 2: "n", 3: "ahead", 4: "n", 5: "n"}
    assert wanted(JULY) == ["0001.json"] and wanted(AUGUST) == []
    # A rewritten file is another one; a run that is not complete notes nothing.
    (records / "0002.json").write_text('{"results": [')
    assert run(AUGUST).status == "with_errors" and wanted(AUGUST) == ["0002.json"]


def test_a_property_declared_late_is_filled_from_what_rows_keep(spark, house, tmp_path):
    odd = """a "b" 'c'"""
    crew = [record("1", age="7", **{odd: "x", "N.o de [pie]": {"k": 1}}), record("2", age="old"), record("3")]
    few = [{"name": "firstname"}]
    landing(tmp_path / "one", people=crew, links=False, catalog=few)
    sync_object(spark, Feed.under(str(tmp_path / "one"), "contacts"), house, mark=JUNE, keep_raw=True)
    assert "age" not in house.read("contact").columns
    more = [*few, {"name": "age", "type": "number"}, {"name": odd}, {"name": "N.o de [pie]"}]
    landing(tmp_path / "two", people=[record("3", age="9"), record("4", age="10")], links=False, catalog=more)
    run = sync_object(spark, Feed.under(str(tmp_path / "two"), "contacts"), house, mark=JULY)
    assert run.schema_changes == 3 and run.sync_mode == "incremental"
    got = people(house, "age", "a_b_c", "no_de_pie")
    assert got[1] == (7.0, "x", '{"k":1}')
    assert {k: v[0] for k, v in got.items()} == {1: 7.0, 2: None, 3: 9.0, 4: 10.0}


def test_of_several_link_files_the_last_to_land_counts(spark, tmp_path):
    """One of two files that name a record counts, others are as they were."""
    links = tmp_path / "contacts" / "links" / "to_type=2-9"
    land(links, metered(("811", 901), ("824", 902), ("824", 903)))
    land(links, metered(("811", 904), ("839", None)))
    for name, at in (("0000", 1_800_000_000), ("0001", 1_700_000_000)):
        os.utime(links / f"{name}.json", (at, at))
    feed = landing(tmp_path, links=False)
    found = read_links(spark, feed, read_catalog(spark, feed).link_names)
    assert sorted((r.from_id, r.to_id) for r in found.found.collect()) == [(811, 901), (824, 902), (824, 903)]
    assert sorted(r.from_id for r in found.told.collect()) == [811, 824, 839]
