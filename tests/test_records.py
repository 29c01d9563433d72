from datetime import datetime

from pyspark.sql import functions as F

from samples import CATALOG, PEOPLE, land, pages, record
from tidemark.functions.naming import plan_columns
from tidemark.meta import MetaColumns
from tidemark.operators import records as R
from tidemark.operators.merge import keep_last
from tidemark.sources import pages as G

MARK = datetime(2024, 7, 1)
COLUMNS = plan_columns([(c["name"], c.get("type")) for c in CATALOG])


def landed(spark, tmp_path, *documents, **options):
    return G.read_pages(spark, land(tmp_path / "records", *documents), **options)


def test_pages_to_records_in_arrival_order(spark, tmp_path):
    land(tmp_path / "records", *pages(PEOPLE[:2], PEOPLE[2:4], []))
    land(tmp_path / "records", *pages(PEOPLE[4:]))
    rows = G.explode_results(G.read_pages(spark, str(tmp_path / "records")))
    assert [r.id for r in rows.orderBy("_ord").collect()] == ["811", "824", "839", "852", "867", "878"]
    assert {r.id for r in G.active_records(rows).collect()} == {"811", "824", "839", "852"}


def test_absent_feed_is_empty(spark, tmp_path):
    assert G.explode_results(G.read_pages(spark, str(tmp_path / "nothing"))).count() == 0


def test_unreadable_pages_are_kept_beside_the_good_ones(spark, tmp_path):
    feed = landed(spark, tmp_path, *pages(PEOPLE[:1]), '{"results": [{"id": "1"', '{"results": 7}', '{"other": 1}')
    rows = G.explode_results(feed, keep_unreadable=True).collect()
    assert sorted(r.id or "-" for r in rows) == ["-", "-", "811"]
    assert sum(r._corrupt is not None for r in rows) == 2


def test_multi_line_documents(spark, tmp_path):
    import json

    text = json.dumps(pages(PEOPLE[:2])[0], indent=2)
    feed = landed(spark, tmp_path, text, multi_line=True)
    assert G.explode_results(feed).count() == 2


def test_flatten_types_every_declared_property(spark, tmp_path):
    extra = record("106", num_employees=12.5, **{"Es Activo": True}, firstname={"a": [1, 2]})
    feed = landed(spark, tmp_path, *pages([*PEOPLE, extra]))
    flat = R.flatten_records(G.explode_results(feed), COLUMNS, MARK)
    good, rejects = R.split_rejects(flat)
    rows = {r.hs_object_id: r for r in good.collect()}
    assert rejects.count() == 0 and sorted(rows) == [106, 811, 824, 839, 852, 867, 878]
    assert rows[811].lastname == "Ødegård"
    assert rows[811].fivetran_deleted is False and rows[867].fivetran_deleted is True
    assert rows[811].fivetran_synced == MARK
    assert rows[106].num_employees == 12.5 and rows[106].es_activo is True
    assert rows[106].firstname == '{"a":[1,2]}' and rows[106].lastname is None
    assert good.schema["es_activo"].metadata == {"source": "Es Activo"}


def test_bad_ids_become_rejects(spark, tmp_path):
    feed = landed(spark, tmp_path, *pages([record("x1"), record("1.5"), {"properties": {}}, record(7), record("8")]))
    good, rejects = R.split_rejects(R.flatten_records(G.explode_results(feed), COLUMNS, MARK))
    assert sorted(r.hs_object_id for r in good.collect()) == [7, 8]
    assert sorted(r._bad_id for r in rejects.collect()) == ["", "1.5", "x1"]


def test_property_named_like_the_id_takes_its_place(spark, tmp_path):
    feed = landed(spark, tmp_path, *pages([record("1", hs_object_id="900"), record("2", hs_object_id="bad"), record("3")]))
    good, rejects = R.split_rejects(R.flatten_records(G.explode_results(feed), COLUMNS, MARK))
    assert sorted(r.hs_object_id for r in good.collect()) == [3, 900]
    assert [r._bad_id for r in rejects.collect()] == ["2"]


def test_names_that_differ_only_in_case(spark, tmp_path):
    feed = landed(spark, tmp_path, *pages([record("1", Email="A", email="b")]))
    columns = plan_columns([("Email", "string"), ("email", "string")])
    row = R.flatten_records(G.explode_results(feed), columns, MARK).first()
    assert (row.email, row.email_2) == ("A", "b")


def test_map_and_struct_properties_read_the_same(spark):
    columns = plan_columns([("n", "number"), ("s", "string")])
    rows = spark.createDataFrame([("1", "5", "x")], "id string, n string, s string")
    archived = F.lit("false").alias("archived")
    as_map = rows.select("id", F.create_map(F.lit("n"), "n", F.lit("s"), "s").alias("properties"), archived)
    as_struct = rows.select("id", F.struct("n", "s").alias("properties"), archived)
    as_text = rows.select("id", F.to_json(F.struct("n", "s")).alias("properties"), archived)
    got = [R.flatten_records(df, columns, MARK).collect() for df in (as_map, as_struct, as_text)]
    assert got[0] == got[1] == got[2]


def test_present_properties(spark, tmp_path):
    feed = landed(spark, tmp_path, *pages([record("1", a="1"), record("2", b=None)]))
    assert R.present_properties(G.explode_results(feed)) == ["a", "b"]


def test_last_version_of_a_record_wins(spark, tmp_path):
    feed = landed(spark, tmp_path, *pages([record("1", firstname="old"), record("2", firstname="x")], [record("1", firstname="new")]))
    flat = R.flatten_records(G.explode_results(feed), COLUMNS, MARK, carry=("_ord",))
    last = keep_last(flat, ["hs_object_id"], ["_ord"])
    assert {r.hs_object_id: r.firstname for r in last.collect()} == {1: "new", 2: "x"}
    assert last.schema["es_activo"].metadata == {"source": "Es Activo"}


def test_property_catalog(spark, tmp_path):
    feed = landed(spark, tmp_path, *pages([{"name": "a"}, {"name": "b", "type": "date"}], [{"name": "a", "type": "number"}]), result=G.PROPERTY)
    rows = G.property_catalog(G.explode_results(feed)).orderBy("_first").collect()
    assert [(r.name, r.type) for r in rows] == [("a", "number"), ("b", "date")]


def test_error_classes(spark):
    rows = [
        ("DatetimeFieldOverflow", 'x "20240101999"', "data_type", "20240101999"),
        ("DataError", "date/time field value out of range", "data_type", "unknown"),
        ("IntegrityError", "column", "integrity", "unknown"),
        ("X", "Duplicate Key value", "integrity", "unknown"),
        ("ProgrammingError", "", "schema", "unknown"),
        ("X", 'COLUMN "12" missing', "schema", "12"),
        ("X", "boom", "unknown", "unknown"),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "k string, m string")
    got = df.select(R.classify_error(F.col("k"), F.col("m")), R.offending_digits(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [r[2:] for r in rows]


def test_reserved_names_of_other_meta(spark):
    meta = MetaColumns(id="id", synced="synced", deleted="gone")
    rows = spark.createDataFrame([("1", '{"gone":"x"}', None)], "id string, properties string, archived string")
    flat = R.flatten_records(rows, plan_columns([("Gone", "string")], meta=meta), MARK, meta)
    assert flat.columns == ["id", "gone_2", "synced", "gone", "_bad_id"]
