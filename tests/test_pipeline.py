"""Drawings from file to document."""

import json

import pytest

from planweave import storage
from planweave.config import Separation, load_config
from planweave.operators import relational as R
from planweave.operators import sinks
from planweave.plans import command, pipeline
from tests.test_svg import HEAD, path


def wall(pid, x1, y1, x2, y2):
    return path(f"M {x1},{y1} L {x2},{y2}", pid=pid, more='semanticId="33"')


def test_two_rooms_from_files(spark, tmp_path):
    box = lambda a, b, c, d: [(a, b, c, b), (c, b, c, d), (c, d, a, d), (a, d, a, b)]
    body = "".join(wall(i, *s) for i, s in enumerate([*box(20, 20, 120, 80), *box(22, 22, 69, 78), *box(71, 22, 118, 78), (69, 22, 71, 22), (69, 78, 71, 78)]))
    body += path("M 30,30 L 40,40", pid=90, more='semanticId="27" instanceId="4"')
    (tmp_path / "A_3KAT_x.svg").write_text(HEAD.format("0 0 140 140", body))
    plan, feats = pipeline.run_files(spark, [str(tmp_path / "*.svg")])
    rooms = {r.facil_type: r.area for r in plan.regions.filter("role = 'room'").collect()}
    assert rooms["WC"] == 47 * 56 and "Office" in rooms and "wall" in {r.role for r in plan.regions.collect()}
    sinks.write_geojson(feats, str(tmp_path / "out" / "plan.geojson"), "plan")
    doc = json.loads((tmp_path / "out" / "plan.geojson").read_text())
    kinds = [f["properties"]["facilType"] for f in doc["features"]]
    assert doc["name"] == "plan" and "WC" in kinds and all(f["properties"]["level_id"] == "3" for f in doc["features"])
    assert all(f["geometry"]["type"] == "MultiPolygon" for f in doc["features"])


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text(
        "cleaning: {snap_tolerance: 0.2, nonsense: 1}\nother: {x: 1}\nparsing: {boundary_semantic_ids: [33]}\ndoor_closing: {enabled: false}\n"
        "polygonization: {separator_manual_thickness: 4}\nclassification: {stair_ids: [40, 41]}\nexport: {floor_level: 3}\n"
    )
    c = load_config(str(tmp_path / "c.yaml"))
    assert c.cleaning.snap_tolerance == 0.2 and c.parsing.boundary_semantic_ids == (33,) and not c.door_closing.enabled and c.polygonization.separator_manual_thickness == 4
    assert dict(c.classification.priority())["Stairs"] == (40, 41) and c.export.floor_level == "3"
    assert load_config(str(tmp_path / "none.yaml")) == load_config(None)


def test_command_line(spark, tmp_path):
    """Several drawings with levels of their own, one of them missing."""
    box = "".join(wall(i, *s) for i, s in enumerate([(20, 20, 120, 20), (120, 20, 120, 80), (120, 80, 20, 80), (20, 80, 20, 20)]))
    for name in ("a.svg", "b_2KAT_.svg"):
        (tmp_path / name).write_text(HEAD.format("0 0 140 140", box))
    out = tmp_path / "out" / "plan.geojson"
    args = ["--input", f"{tmp_path}/a.svg=7", "--input", f"{tmp_path}/b_2KAT_.svg", "--input", f"{tmp_path}/none.svg=1", "--output", str(out), "--name", 'a "plan"']
    assert command.main(args, spark) == 0
    doc = json.loads(out.read_text())
    assert doc["name"] == 'a "plan"' and sorted({f["properties"]["level_id"] for f in doc["features"]}) == ["2", "7"] and len(doc["features"]) == 2 * sum(f["properties"]["level_id"] == "7" for f in doc["features"]) > 0
    assert command.main([*args[4:6], "--output", str(out)], spark) == 0 and json.loads(out.read_text())["features"] == []


@pytest.mark.parametrize("change, method", [({"separator_manual_thickness": 3.0}, "manual"), ({"separator_min_log_gap": 9.0, "separator_fallback_method": "median"}, "median"), ({"separator_min_log_gap": 9.0}, "otsu")])
def test_thresholds(spark, change, method):
    faces = spark.createDataFrame([(1, t, False) for t in (1.0, 1.1, 20.0, 21.0, 22.0)] + [(2, 5.0, False)], "floor_id long, thickness double, hatched boolean")
    found = {r.floor_id: r for r in R.thresholds(faces, Separation(**change)).collect()}
    assert found[1].method == method and found[2].method in ("none", "manual")
    assert {"manual": 3.0, "median": 20.0}.get(method, found[1].threshold) == found[1].threshold and 1.1 < found[1].threshold <= 20.0


def test_stored_tables_are_removed(spark):
    import os

    folder = storage.shared_dir(spark).removeprefix("file://")
    with storage.scope(spark):
        kept = storage.store(spark.range(3))
        assert kept.count() == 3 and os.path.exists(kept.stored_at.removeprefix("file://"))
    assert not os.path.exists(kept.stored_at.removeprefix("file://"))
    table = storage.store(spark.range(3))
    storage.discard(table)
    assert os.path.isdir(folder) and not os.path.exists(table.stored_at.removeprefix("file://"))
