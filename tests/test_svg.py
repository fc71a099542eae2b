"""Parser cases on hand-written drawings."""

import math

import pytest

from planweave.sources import generic, svg

HEAD = '<svg xmlns="http://www.w3.org/2000/svg" viewBox="{}">{}</svg>'


def parse(spark, body, box="0 0 140 140", head=HEAD):
    df = spark.createDataFrame([(1, head.format(box, body))], "floor_id long, content string")
    return {r.primitive_id: r for r in svg.primitives(svg.elements(df)).collect()}


def path(d, kind="segment", pid=1, more=""):
    return f'<path primitiveId="{pid}" originalType="{kind}" d="{d}" {more}/>'


def xy(row):
    return [(round(p.x, 6), round(p.y, 6)) for p in row.pts]


def test_segments(spark):
    r = parse(spark, path("M 10,0 L 20,0", pid=1) + path("M 5.8e+1 1 L 2 3", pid=2) + path("m 0,0 l 1,1", pid=3) + path("M9,9 L5,5 L2,2", pid=4))
    assert xy(r[1]) == [(10, 140), (20, 140)] and xy(r[2]) == [(58, 139), (2, 137)]
    assert 3 not in r and xy(r[4]) == [(9, 131), (5, 135)]


def test_missing_ids(spark):
    r = parse(spark, '<path originalType="segment" d="M 0,0 L 1,1"/>' + path("M 1,1 L 2,2", pid=7))
    assert set(r) == {7, *range(1_000_000, 1_000_004)} and r[7].role == "skipped"


def test_bad_semantic_id_fails(spark):
    with pytest.raises(Exception):
        parse(spark, path("M 0,0 L 1,1", more='semanticId="x"'))


def test_arcs(spark):
    r = parse(spark, path("M 50,50 A 5,5 0 0,1 60,50", "arc", 1) + path("M 0,0 A 0,5 0 0,1 10,0", "arc", 2) + path("M 3,3 A 5,5 0 0,1 3,3", "arc", 3) + path("M 50,50 A 1,1 0 0,1 60,50", "arc", 4))
    assert len(r[1].pts) == 22 and len(r[2].pts) == 2 and 3 not in r
    for k in (1, 4):
        assert all(math.hypot(p.x - 55, p.y - 90) == pytest.approx(5) for p in r[k].pts)


def test_circles(spark):
    r = parse(spark, '<circle primitiveId="1" cx="50" cy="50" r="2"/><circle primitiveId="2" cx="5" cy="5" r="0"/><circle primitiveId="3" cx="5" cy="5"/>' + path("M 1,1 L 9,9", pid=9))
    assert len(r[1].pts) == 65 and 2 not in r and 3 not in r and r[9].ord < r[1].ord


def test_translation_and_snapping(spark):
    r = parse(spark, path("M 850202,3924504 L 850212,3924504"), "850192 3924494 4200 4200")
    assert xy(r[1]) == [(10, 4190), (20, 4190)]
    r = parse(spark, path("M 0.3,70 L 20,70", pid=1) + path("M 0.5,70 L 20,70", pid=2))
    assert xy(r[1])[0] == (0, 70) and xy(r[2])[0] == (0.5, 70)


@pytest.mark.parametrize("box", ["0,0,1,1", "", "0 0 1"])
def test_bad_view_box(spark, box):
    with pytest.raises(Exception):
        parse(spark, path("M 0,0 L 1,1"), box)


def test_without_namespace_only_the_canvas(spark):
    assert set(parse(spark, path("M 0,0 L 1,1"), head='<svg viewBox="{}">{}</svg>')) == set(range(1_000_000, 1_000_004))


def test_declarations_are_refused():
    with pytest.raises(ValueError):
        svg.parse_xml('<!DOCTYPE svg [<!ENTITY a "b">]><svg/>')


def test_curves():
    assert generic.sample_path("M0 0 L10 0") == [0, 10]
    assert len(generic.sample_path("M0 0 C 50 0 50 50 0 50")) == 11  # a length between 90 and 100
    assert generic.sample_path("M1 1 l0 0") == []
    with pytest.raises(ValueError):
        generic.sample_path("M 0")
