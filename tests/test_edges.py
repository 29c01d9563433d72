import json

from pyspark.sql import functions as F

from samples import PEOPLE, land
from tidemark.operators import edges as E
from tidemark.operators import resolve as R
from tidemark.sources import pages as G

FIELDS = ["from_id", "to_type", "to_id", "type_id", "category"]


def records(spark, *cells):
    rows = [(i, a if a is None or isinstance(a, str) else json.dumps(a), n) for n, (i, a) in enumerate(cells)]
    return spark.createDataFrame(rows, "id string, associations string, _ord int")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or FIELDS)).collect())


def test_sample_records(spark):
    edges = E.normalize_edges(records(spark, *[(p["id"], p.get("associations")) for p in PEOPLE]))
    assert rows(edges, "from_id", "to_type", "to_id") == [
        (811, "companies", 4411), (811, "deals", 6602), (824, "companies", 4425),
        (852, "companies", 4411), (852, "companies", 4438), (867, "deals", 6617),
    ]
    assert {r.category for r in edges.collect()} == {"HUBSPOT_DEFINED"}
    counts = {r.to_type: r.edges for r in E.edge_counts(edges).collect()}
    assert counts == {"companies": 4, "deals": 2}


def test_odd_values_cost_only_themselves(spark):
    odd = {
        "good": {"results": [{"id": 1}, "str", 7, {"x": 1}, None, {"id": "2", "type": 5, "category": "USER"}]},
        "text": "abc", "list": [1], "none": None, "number": {"results": 3}, "bare": {},
        "Más Cosas": {"results": [{"id": 9}]},
    }
    df = records(spark, ("1", odd), ("2", '"abc"'), ("3", "[1]"), ("4", None), ("5", "not json"), ("6", {"a": {"results": [{"id": 1}]}}))
    assert rows(E.normalize_edges(df)) == [
        (1, "good", 1, "", "HUBSPOT_DEFINED"), (1, "good", 2, "5", "USER"),
        (1, "mas_cosas", 9, "", "HUBSPOT_DEFINED"), (6, "a", 1, "", "HUBSPOT_DEFINED"),
    ]


def test_ids_that_are_no_numbers_are_not_usable(spark):
    edges = E.normalize_edges(records(spark, ("x", {"a": {"results": [{"id": 1}]}}), ("1", {"a": {"results": [{"id": "y"}, {"id": 2}]}})))
    assert edges.count() == 3
    assert rows(E.usable_edges(edges), "from_id", "to_id") == [(1, 2)]


def test_link_batches(spark, tmp_path):
    batch = [
        {"from": {"id": 31}, "to": [
            {"toObjectId": "77", "associationTypes": [{"typeId": 280}, {"typeId": "9", "category": "USER_DEFINED"}]},
            {"toObjectId": 78, "associationTypes": [{"category": "INTEGRATOR_DEFINED"}]},
            {"toObjectId": 79, "associationTypes": []}]},
        {"from": {"id": "32"}, "to": []},
        {"from": {"id": ""}, "to": [{"toObjectId": 1, "associationTypes": [{"typeId": 3}]}]},
        {"to": [{"toObjectId": 2, "associationTypes": [{"typeId": 3}]}]},
    ]
    feed = G.explode_results(G.read_pages(spark, land(tmp_path / "links", {"results": batch}), G.LINK_BATCH))
    assert rows(E.flatten_links(feed, "meters")) == [
        (31, "meters", 77, "280", "HUBSPOT_DEFINED"), (31, "meters", 77, "9", "USER_DEFINED"),
        (31, "meters", 78, "", "INTEGRATOR_DEFINED"),
    ]


def edge_frame(spark, *cells):
    return spark.createDataFrame([(f, "companies", t, k, c, n) for n, (f, t, k, c) in enumerate(cells)], "from_id bigint, to_type string, to_id bigint, type_id string, category string, _ord int")


def test_dedupe_keeps_the_last(spark):
    edges = edge_frame(spark, (101, 201, "1", "A"), (102, 202, "1", "A"), (101, 201, "1", "B"), (103, 203, "1", "A"), (101, 201, "2", "C"))
    assert rows(E.dedupe_edges(edges), "from_id", "to_id", "type_id", "category") == [
        (101, 201, "1", "B"), (101, 201, "2", "C"), (102, 202, "1", "A"), (103, 203, "1", "A")]


def test_attach_drops_edges_of_unknown_records(spark):
    edges = edge_frame(spark, (1, 2, "1", "A"), (9, 2, "1", "A"))
    known = spark.createDataFrame([(1,), (1,), (3,)], "id bigint")
    assert rows(E.attach_edges(edges, known, "id"), "from_id") == [(1,)]


def test_modes_of_writing(spark):
    target = edge_frame(spark, (1, 10, "1", "old"), (1, 11, "1", "old"), (2, 20, "1", "old")).drop("_ord")
    load = edge_frame(spark, (1, 10, "1", "new"), (3, 30, "1", "new")).drop("_ord")
    fields = ("from_id", "to_id", "category")
    assert rows(E.merge_edges(target, load), *fields) == [(1, 10, "new"), (1, 11, "old"), (2, 20, "old"), (3, 30, "new")]
    assert rows(E.replace_edges_of(target, load, load), *fields) == [(1, 10, "new"), (2, 20, "old"), (3, 30, "new")]
    other = target.withColumn("to_type", F.lit("deals"))
    full = E.replace_edge_types(target.union(other), load, ["companies"])
    assert rows(full, "to_type", "from_id") == [("companies", 1), ("companies", 3), ("deals", 1), ("deals", 1), ("deals", 2)]
    emptied = E.replace_edge_types(target.union(other), load.limit(0), ["companies"])
    assert {r.to_type for r in emptied.collect()} == {"deals"}


def test_edge_table_names(spark):
    edges = edge_frame(spark, (1, 2, "1", "A")).drop("_ord")
    assert E.edge_table(edges, "contacts", "companies").columns == ["contacts_id", "companies_id", "type_id", "category"]
    assert E.edge_table(edges, "Companies", "companies").columns[:2] == ["from_companies_id", "to_companies_id"]


def test_names_come_from_three_places(spark):
    own = spark.sql("""
        SELECT '0-1' AS type_id, 'SERVICE' AS name, 1 AS _ord, from_json(
          '[{"fromObjectTypeId":"0-1","toObjectTypeId":"2-1","name":"SERVICE_TO_METERS"},
            {"fromObjectTypeId":"2-2","toObjectTypeId":"0-1","name":"contact_to_service"},
            {"fromObjectTypeId":"0-1","toObjectTypeId":"2-3","name":"SERVICE_TO_"},
            {"fromObjectTypeId":"0-1","toObjectTypeId":"2-1","name":"service_to_counters"},
            {"fromObjectTypeId":"0-1","toObjectTypeId":"2-5","name":null}]',
          'array<struct<fromObjectTypeId:string,toObjectTypeId:string,name:string>>') AS associations""")
    listed = spark.createDataFrame([("2-1", "LOSES", 1), ("2-3", "Project", 1), ("2-4", "", 1)], "type_id string, name string, _ord int")
    wanted = spark.createDataFrame([(f"2-{i}",) for i in (1, 2, 3, 4, 1)], "type_id string")
    names = R.resolve_names(wanted, R.names_from_associations(own), R.names_from_schemas(listed))
    assert {r.type_id: (r.name, r.resolved) for r in names.collect()} == {
        "2-1": ("counters", True), "2-2": ("contact", True), "2-3": ("project", True), "2-4": ("2_4", False)}
    assert tuple(R.name_coverage(names).first()) == (3, 4)


def test_association_targets(spark):
    df = spark.sql("SELECT from_json('[{\"toObjectTypeId\":\"a\"},{\"toObjectTypeId\":\"b\"},{\"toObjectTypeId\":\"a\"},{}]', 'array<struct<toObjectTypeId:string>>') AS associations")
    assert sorted(r[0] for r in G.association_targets(df).collect()) == ["a", "b"]
