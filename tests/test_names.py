import random
import unicodedata
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import naming
from tidemark.functions.casts import parse_date, parse_number
from tidemark.operators import ordinal
from tidemark.functions.naming import (
    column_lineage,
    edge_columns,
    fit_names,
    fit_names_frame,
    normalize_expr,
    normalize_name,
    plan_columns,
    table_name,
)
from tidemark.meta import MetaColumns

NAMES = {
    "Fecha de Creación": "fecha_de_creacion",
    "_a__b_": "a_b",
    "日本": "",
    "Straße-X": "strae_x",
    "A - B": "a_b",
    "ñandú": "nandu",
    "": "",
}


@pytest.mark.parametrize("text, want", NAMES.items())
def test_normalize_name(text, want):
    assert normalize_name(text) == want


def test_normalize_name_of_other_types():
    assert normalize_name(None) == ""
    assert normalize_name(12) == "12"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x24FF, exclude_categories=["Cs", "Cn"])), min_size=40, max_size=40))
def test_column_form_agrees_with_driver_form(spark, texts):
    # Python's and Java's lower-casing differ on a few letters that grow when lowered.
    texts = [t for t in texts if len(t.lower()) == len(t) and "\x00" not in t]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", normalize_expr(F.col("t")).alias("n")).collect():
        assert row.n == normalize_name(unicodedata.normalize("NFC", row.t)) or row.n == normalize_name(row.t)


def test_fit_names_never_repeats():
    assert fit_names(["a", "a", "a_2", "a"]) == ["a", "a_2", "a_2_2", "a_3"]
    assert fit_names(["", "x", ""]) == ["col_1", "x", "col_3"]
    long = "y" * 70
    fitted = fit_names([long + "1", long + "2"])
    assert fitted == ["y" * 63, "y" * 61 + "_2"]
    assert all(len(n) <= 63 for n in fitted)


def test_fit_names_frame_numbers_by_position(spark):
    rows = [(i, n) for i, n in enumerate(["a", "b", "a", "z" * 70, "z" * 66, "a"])]
    df = spark.createDataFrame(rows, "position int, name string")
    got = {r.position: r.final for r in fit_names_frame(df, "name", "position").collect()}
    assert got == {0: "a", 1: "b", 2: "a_2", 3: "z" * 63, 4: "z" * 61 + "_2", 5: "a_3"}


def test_plan_columns_keeps_lineage_by_position():
    meta = MetaColumns()
    catalog = [
        ("Nombre", "string"),
        ("nombre", "number"),
        ("hs_date_entered_x_1", "datetime"),
        (meta.id, "number"),
        ("Fivetran Synced", "string"),
    ]
    plans = plan_columns(catalog, {"hs_date_entered_x_1": "hs_date_entered_x"}, meta)
    assert [(p.original, p.final) for p in plans] == [
        ("Nombre", "nombre"),
        ("nombre", "nombre_2"),
        ("hs_date_entered_x_1", "hs_date_entered_x"),
        ("Fivetran Synced", "fivetran_synced_2"),
    ]


def test_column_lineage_frame(spark):
    df = spark.createDataFrame([(1, "Ab", "Ab"), (2, "ab ", "ab "), (3, "日", "日")], "p int, o string, r string")
    got = {r.p: r.final for r in column_lineage(df, "o", F.col("r"), "p").collect()}
    assert got == {1: "ab", 2: "ab_2", 3: "col_3"}


def test_edge_columns():
    assert edge_columns("Contacts", "contacts") == ("from_contacts_id", "to_contacts_id")
    assert edge_columns("service", "meters") == ("service_id", "meters_id")


def test_table_name(spark):
    df = spark.createDataFrame([("SERVICE", "services"), (None, "x"), ("", "y")], "n string, o string")
    assert [r[0] for r in df.select(table_name(F.col("n"), F.col("o"))).collect()] == ["service", "x", "y"]


@pytest.mark.parametrize(
    "names",
    [
        ["a", "a", "a_2"],
        ["a_2", "a", "a", "a"],
        ["a", "a_2", "a", "a_2", "a_2_2", "a"],
        ["x" * 63, "x" * 70, "x" * 61 + "_2", "x" * 64],
        ["b", "b", "b", "b_3", "b_2", "b_3_2", "b_3"],
    ],
)
def test_both_forms_agree_and_never_clash(spark, names):
    df = spark.createDataFrame(list(enumerate(names, start=1)), "position int, name string")
    got = [r.final for r in fit_names_frame(df, "name", "position").orderBy("position").collect()]
    assert got == fit_names(names, reserve=True) and len(set(got)) == len(got)
    assert len(set(fit_names(names))) == len(names)


@pytest.mark.parametrize("seed", range(4))
def test_frame_form_agrees_on_invented_names(spark, seed):
    rng = random.Random(seed)
    heads = ["a", "a_2", "b_1", "x" * 7, "x" * 6, "x" * 5 + "_2", "x" * 6 + "_", "y" * 4 + "_10"]
    names = [rng.choice(heads) + rng.choice(["", "", "", f"_{rng.randint(0, 14)}", "z" * rng.randint(0, 6)]) for _ in range(160)]
    df = spark.createDataFrame(list(enumerate(names, start=1)), "position int, name string").repartition(3)
    got = [r.final for r in fit_names_frame(df, "name", "position", limit=8).orderBy("position").collect()]
    assert got == fit_names(names, limit=8, reserve=True) and len(set(got)) == len(got)


def test_passes_do_not_grow_with_repeats(spark, monkeypatch):
    written = []
    for module in (naming, ordinal):
        monkeypatch.setattr(module, "write_once", lambda df, name, write=ordinal.write_once: written.append(name) or write(df, name))
    counts = []
    for n in (5, 1000):
        written.clear()
        names = ["a_2", *["a"] * n, "a_7"]
        df = spark.createDataFrame(list(enumerate(names)), "position int, name string")
        got = [r.final for r in fit_names_frame(df, "name", "position").orderBy("position").collect()]
        assert got == fit_names(names, reserve=True)
        counts.append(len(written))
    # Three sorts: by name, the numbers that are held, both together.
    assert counts[0] == counts[1] and written.count("occurrences") == 3


@pytest.mark.parametrize("end", ["\n", "\r", "\r\n", "\x85", "\u2028", "\u2029"])
def test_line_ends_are_no_part_of_a_name_or_value(spark, end):
    df = spark.createDataFrame([(f"abc{end}", f"12{end}", f"2024-05-06{end}")], "n string, v string, d string")
    row = df.select(normalize_expr(F.col("n")), parse_number(F.col("v")), parse_date(F.col("d"))).first()
    assert row[0] == normalize_name(f"abc{end}") == "abc"
    plain = end in ("\n", "\r", "\r\n")
    assert row[1] == (12.0 if plain else None) and row[2] == (date(2024, 5, 6) if plain else None)
