from datetime import datetime

import pytest

from samples import land
from tidemark.meta import STAGE_PREFIXES
from tidemark.operators import hierarchy as H
from tidemark.sources import pages as G

MARK = datetime(2024, 7, 1)
TREES = [
    {"id": "p1", "label": "One", "displayOrder": 3, "createdAt": "2024-01-01T00:00:00Z", "archived": False, "stages": [
        {"id": "s1", "label": "New", "displayOrder": 2, "metadata": {"state": "OPEN", "leadState": "X"}},
        {"id": "s2", "label": "Old", "archived": True, "metadata": {"state": "", "leadState": "CLOSED"}},
        {"id": "s3", "label": "None"},
        {"id": "s4", "label": "Blank", "metadata": {}, "createdAt": "bad"}]},
    {"id": "p2", "label": "Two", "archived": True},
]


@pytest.fixture
def trees(spark, tmp_path):
    return G.explode_results(G.read_pages(spark, land(tmp_path / "pipelines", {"results": TREES}), G.PIPELINE))


def test_pipelines(trees):
    rows = {r.pipeline_id: r for r in H.flatten_pipelines(trees, MARK).collect()}
    assert (rows["p1"].display_order, rows["p2"].display_order) == (3, 1)
    assert (rows["p1"].archived, rows["p2"].archived, rows["p2"].fivetran_deleted) == (False, True, True)
    assert rows["p1"].created_at == datetime(2024, 1, 1) and rows["p2"].created_at is None
    assert rows["p1"].fivetran_synced == MARK


def test_stages(trees):
    rows = {r.stage_id: r for r in H.flatten_stages(trees, MARK).collect()}
    assert {k: (r.display_order, r.state, r.archived) for k, r in rows.items()} == {
        "s1": (2, "OPEN", False), "s2": (0, "CLOSED", True), "s3": (0, None, False), "s4": (0, None, False)}
    assert rows["s4"].created_at is None


def test_orphans_and_repeats(spark):
    stages = spark.createDataFrame([("p1", "s1"), ("p1", "s1"), ("p9", "s1")], "pipeline_id string, stage_id string")
    pipelines = spark.createDataFrame([("p1",)], "pipeline_id string")
    assert [r.pipeline_id for r in H.orphan_stages(stages, pipelines).collect()] == ["p9"]
    assert [tuple(r) for r in H.repeated_stages(stages).collect()] == [("p1", "s1", 2)]


def brute_force(names, stages, whole_parts=False):
    def inside(name, piece):
        if not whole_parts:
            return piece in name
        return f"_{piece}_" in f"_{name}_"

    found = {}
    for name in names:
        prefix = next((p for p in STAGE_PREFIXES if name.startswith(p)), None)
        for stage in stages:
            plain = stage.replace("-", "_")
            if prefix and (inside(name, stage) or inside(name, plain)):
                found[name] = f"{prefix}_{plain}"
    return found


@pytest.mark.parametrize("whole_parts", [False, True])
def test_stage_rename_against_brute_force(spark, whole_parts):
    stages = ["1", "12", "600b692d-a3fe-4052", "600b692d_a3fe_4052", "abc", "b", "9999999999999999999999999999999999999999999999999999"]
    names = [
        "hs_v2_date_entered_600b692d_a3fe_4052_2005647967", "hs_v2_date_entered_600b692d-a3fe-4052",
        "hs_time_in_12", "hs_time_in_121", "hs_date_exited_abc_1", "hs_date_entered", "created_12", "hs_v2_latest_time_in_zz",
        "x_hs_time_in_12", "hs_v2_cumulative_time_in_b", "hs_date_entered_b_abc", "hs_time_in_12",
    ]
    got = H.stage_rename_map(
        spark.createDataFrame([(n,) for n in names], "name string"),
        spark.createDataFrame(list(enumerate(stages)), "stage_ord int, stage_id string"),
        whole_parts,
    )
    assert {r.property: r.renamed for r in got.collect()} == brute_force(names, stages, whole_parts)


def test_no_stages_no_renames(spark):
    names = spark.createDataFrame([("hs_time_in_1",)], "name string")
    none = spark.createDataFrame([], "stage_ord int, stage_id string")
    assert H.stage_rename_map(names, none).count() == 0
