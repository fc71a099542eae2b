"""Registered queries of the stages that need whole floors, of the spatial joins and of the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planweave.config import OPEN_EDGE, OPEN_FILL, TYPE_COLORS
from planweave.functions import geom as G
from planweave.operators import floors, sinks, stats
from planweave.operators import relational as R
from planweave.plans import pipeline
from planweave.queries import _M, _TYPE, SQL, lined, milli, opening_lines, query, rooms_of, svg_documents_of
from planweave.sources import generic, svg
from planweave.storage import store

NO_HOLES = f"array<{G.POINTS}>"


def grid_faces(cells: DataFrame) -> DataFrame:
    return rooms_of(cells).withColumn("face_id", F.col("ci") * 100 + F.col("cj")).withColumn("holes", F.array().cast(NO_HOLES))


def overhang(grid: DataFrame, dims: DataFrame) -> DataFrame:
    """Grid edges with one stroke that begins on a wall and ends in the open."""
    extra = dims.select("floor_id", F.lit(0.0).alias("x1"), (F.col("h") / 2.0).alias("y1"), (F.col("w") / 4.0).alias("x2"), (F.col("h") / 2.0).alias("y2"))
    return grid.unionByName(extra)


@query("geo1_noding", "dims", sql="SELECT floor_id, CAST((nc * (nr + 1)) + (nr * (nc + 1)) AS BIGINT) AS edges, CAST(1000 * (nc * (nr + 1) * w + nr * (nc + 1) * h) AS BIGINT) AS length FROM dims")
def geo1(spark, dims):
    # Whole lines across the plan, one of them twice and one in two overlapping parts.
    c, r, w, h = (F.col(x).cast("double") for x in ("nc", "nr", "w", "h"))
    across = dims.select("floor_id", F.explode(F.sequence(F.lit(0), "nr")).alias("j"), "nc", "nr", "w", "h").select("floor_id", F.lit(0.0).alias("x1"), (F.col("j") * h).alias("y1"), (c * w).alias("x2"), (F.col("j") * h).alias("y2"))
    down = dims.select("floor_id", F.explode(F.sequence(F.lit(0), "nc")).alias("i"), "nc", "nr", "w", "h").select("floor_id", (F.col("i") * w).alias("x1"), (r * h).alias("y1"), (F.col("i") * w).alias("x2"), F.lit(0.0).alias("y2"))
    twice = dims.select("floor_id", F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), (c * w).alias("x2"), F.lit(0.0).alias("y2"))
    part = dims.select("floor_id", w.alias("x1"), F.lit(0.0).alias("y1"), F.lit(0.0).alias("x2"), F.lit(0.0).alias("y2"))
    e = floors.node_edges(across.unionAll(down).unionAll(twice).unionAll(part))
    return e.groupBy("floor_id").agg(F.count("*").alias("edges"), milli(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))), "length"))


@query("geo2_polygonize", "grid_edges", of=("cells",), sql=f"SELECT floor_id, {_M('minx', 'minx')}, {_M('miny', 'miny')}, {_M('maxx', 'maxx')}, {_M('maxy', 'maxy')}, {_M('area', 'area')} FROM cells")
def geo2(spark, grid):
    f = floors.faces(floors.node_edges(grid)).filter("kind = 'face'")
    return f.select("floor_id", milli("minx", "minx"), milli("miny", "miny"), milli("maxx", "maxx"), milli("maxy", "maxy"), milli("area", "area"))


@query("geo2_dangles", "grid_edges", "dims", sql=f"SELECT floor_id, CAST(nc * nr AS BIGINT) AS faces, CAST(1 AS BIGINT) AS dangles, {_M('w / 4.0', 'dangle_length')} FROM dims")
def geo2_dangles(spark, grid, dims):
    f = floors.faces(floors.node_edges(overhang(grid, dims)))
    return f.groupBy("floor_id").agg(F.count_if(F.col("kind") == "face").alias("faces"), F.count_if(F.col("kind") == "dangle").alias("dangles"), milli(F.sum("length"), "dangle_length"))


@query("geo2_holes", "grid_edges", "dims", sql=f"SELECT floor_id, CAST(nc * nr + 1 AS BIGINT) AS faces, CAST(1 AS BIGINT) AS holes, {_M('nc * w * nr * h', 'area')}, {_M('w * h - 4', 'ring_area')} FROM dims")
def geo2_holes(spark, grid, dims):
    """An island inside the first cell makes a hole and a face."""
    ring = [(2, 2, 4, 2), (4, 2, 4, 4), (4, 4, 2, 4), (2, 4, 2, 2)]
    isle = dims.select("floor_id", F.explode(F.array(*(F.struct(*(F.lit(float(v)).alias(c) for v, c in zip(s, ("x1", "y1", "x2", "y2"), strict=True))) for s in ring))).alias("s")).select("floor_id", "s.*")
    f = floors.faces(floors.node_edges(grid.unionByName(isle))).filter("kind = 'face'")
    return f.groupBy("floor_id").agg(F.count("*").alias("faces"), F.sum("n_holes").alias("holes"), milli(F.sum("area"), "area"), milli(F.max(F.when(F.col("n_holes") > 0, F.col("area"))), "ring_area"))


@query("geo2_cut_edges", "grid_edges", "dims", sql="SELECT floor_id, CAST(nc * nr + 1 AS BIGINT) AS faces, CAST(1 AS BIGINT) AS cuts FROM dims")
def geo2_cuts(spark, grid, dims):
    """A second plan beside the first, joined to it by one stroke."""
    c, w = F.col("nc").cast("double"), F.col("w").cast("double")
    x, t = c * w, c * w + 5.0
    s = lambda a, b, d, e: F.struct(a.alias("x1"), b.alias("y1"), d.alias("x2"), e.alias("y2"))
    z, q = F.lit(0.0), F.lit(3.0)
    more = dims.select("floor_id", F.explode(F.array(s(x, z, t, z), s(t, z, t + 3, z), s(t + 3, z, t + 3, q), s(t + 3, q, t, q), s(t, q, t, z))).alias("s")).select("floor_id", "s.*")
    f = floors.faces(floors.node_edges(grid.unionByName(more)))
    return f.groupBy("floor_id").agg(F.count_if(F.col("kind") == "face").alias("faces"), F.count_if(F.col("kind") == "cut").alias("cuts"))


@query("geo3_components", "openings", sql="""
WITH RECURSIVE e AS (SELECT DISTINCT floor_id, instance_id AS i FROM openings),
p AS (SELECT a.floor_id, a.i, b.i AS j FROM e a JOIN e b ON a.floor_id = b.floor_id AND b.i - a.i IN (100, -100)),
w(floor_id, i, r) AS (SELECT floor_id, i, i FROM e UNION SELECT p.floor_id, p.j, w.r FROM w JOIN p ON w.floor_id = p.floor_id AND w.i = p.i)
SELECT floor_id, i, MIN(r) AS root FROM w GROUP BY floor_id, i
""")
def geo3(spark, openings):
    e = openings.select("floor_id", F.col("instance_id").alias("i")).distinct()
    return floors.components_of_pairs(e, hundred_apart(e))


def hundred_apart(points: DataFrame) -> DataFrame:
    """Pairs (floor_id, i, j = i + 100) of a floor's points: an equi-join on both, since floors have any number of points."""
    return points.withColumn("j", F.col("i") + 100).join(points.select("floor_id", F.col("i").alias("j")), ["floor_id", "j"])


@query("geo4_snap_endpoints", "grid_edges", "dims", sql=f"SELECT floor_id, CAST(nc * nr AS BIGINT) AS faces, {_M('nc * w * nr * h', 'area', 1)} FROM dims")
def geo4(spark, grid, dims):
    """One end of each edge at the first cell's inner corner is moved by 0.05, so that cells close only after snapping."""
    d = grid.join(dims.select("floor_id", "w", "h"), "floor_id")
    off = F.when((F.col("x1") == F.col("w")) & (F.col("y1") == F.col("h")) & (F.col("x2") > F.col("x1")), 0.05).otherwise(0.0)
    lines = d.select("floor_id", G.line(F.col("x1") + off, "y1", "x2", "y2").alias("pts"))
    f = floors.faces(floors.clean_lines(lines)).filter("kind = 'face'")
    return f.groupBy("floor_id").agg(F.count("*").alias("faces"), milli(F.sum("area"), "area", 1))


@query("jn4_close_endpoints", "openings", sql="""
WITH e AS (SELECT floor_id, instance_id AS i, x0 AS x, y0 AS y FROM openings)
SELECT a.floor_id, a.i, b.i AS j FROM e a JOIN e b ON a.floor_id = b.floor_id AND a.i < b.i AND SQRT((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 2.55
""")
def jn4(spark, openings):
    return R.close_endpoints(openings.select("floor_id", F.col("instance_id").alias("i"), F.col("x0").alias("x"), F.col("y0").alias("y")), 2.55)


@query("agg9_snap_groups", "openings", sql=f"SELECT floor_id, instance_id, {_M('10 * instance_id + 0.03', 'x')}, {_M('y0 + 0.01', 'y')}, CAST(1 AS BIGINT) AS places, CAST(3 AS BIGINT) AS kept FROM openings")
def agg9(spark, openings):
    """Three ends in a chain of 0.03 and 0.06 move to their mean; the other ends stay."""
    x, y = F.col("instance_id") * 10.0, F.col("y0")
    lines = F.array(*(F.struct(F.lit(k).alias("k"), G.line(x + 0.03 * k, y + dy, x + 2.0 + k, y + 3.0).alias("pts")) for k, dy in enumerate((0.0, 0.02, 0.01))))
    e = openings.select("floor_id", "instance_id", F.explode(lines).alias("l")).select("floor_id", "instance_id", (F.col("instance_id") * 3 + F.col("l.k")).cast("long").alias("line_id"), "l.*")
    moved = floors.snap_ends(e.select("floor_id", "line_id", "pts"), 0.05).join(e.select("floor_id", "line_id", "instance_id", F.col("pts").alias("old")), ["floor_id", "line_id"])
    p = F.col("pts")[0]
    return moved.groupBy("floor_id", "instance_id").agg(milli(F.avg(p["x"]), "x"), milli(F.avg(p["y"]), "y"), F.count_distinct(p).alias("places"), F.count_if(F.col("pts")[1] == F.col("old")[1]).alias("kept"))


@query("geo5_dissolve", "cells", sql=f"SELECT floor_id, CAST(1 AS BIGINT) AS pieces, {_M('SUM(area)', 'area')}, CAST(COUNT(*) AS BIGINT) AS members FROM cells GROUP BY floor_id")
def geo5(spark, cells):
    """All cells of a plan as walls: one dissolved piece with all members."""
    f = grid_faces(cells).withColumn("role", F.lit("wall"))
    no_lines = f.select("floor_id", G.line("minx", "miny", "minx", "miny").alias("pts")).filter("false")
    w = floors.walls_and_outline(f, no_lines).filter("role = 'wall'")
    return w.groupBy("floor_id").agg(F.count("*").alias("pieces"), milli(F.sum("area"), "area"), F.max(F.size("members")).cast("long").alias("members"))


@query("geo15_wall_components", "cells", sql=f"SELECT floor_id, CAST(COUNT(*) AS BIGINT) AS pieces, {_M('SUM(area)', 'area')}, CAST(COUNT(*) AS BIGINT) AS members FROM cells WHERE (ci + cj) % 2 = 0 GROUP BY floor_id")
def geo15(spark, cells):
    """Cells of a chessboard touch at corners: one component, as many pieces as cells, each with all members."""
    f = grid_faces(cells).filter((F.col("ci") + F.col("cj")) % 2 == 0).withColumn("role", F.lit("wall"))
    w = floors.walls_and_outline(f, f.select("floor_id", G.line("minx", "miny", "minx", "miny").alias("pts")).filter("false")).filter("role = 'wall'")
    return w.groupBy("floor_id").agg(F.count("*").alias("pieces"), milli(F.sum("area"), "area"), F.max(F.size("members")).cast("long").alias("members"))


@query("win6_outline", "dims", "cells", of=("dims",), sql=f"SELECT floor_id, {_M('nc * w * nr * h', 'area')} FROM dims")
def win6(spark, dims, cells):
    f = grid_faces(cells).withColumn("role", F.when((F.col("ci") + F.col("cj")) % 2 == 0, "wall").otherwise("room"))
    w = floors.walls_and_outline(f, f.select("floor_id", G.line("minx", "miny", "minx", "miny").alias("pts")).filter("false"))
    return w.filter("role = 'outline'").select("floor_id", milli("area", "area"))


@query("geo6_clip", "openings", sql=f"""
SELECT floor_id, instance_id, {_M('GREATEST(LEAST(x0 + w, 40) - GREATEST(x0, 20), 0) * GREATEST(LEAST(y0 + w, 60) - GREATEST(y0, 10), 0)', 'area')} FROM openings
""")
def geo6(spark, openings):
    o = openings.withColumn("ring", G.box("x0", "y0", F.col("x0") + F.col("w"), F.col("y0") + F.col("w"))).withColumns({"a": F.lit(20.0), "b": F.lit(10.0), "c": F.lit(40.0), "d": F.lit(60.0)})
    return o.select("floor_id", "instance_id", milli(R.clip_area("ring", "a", "b", "c", "d"), "area"))


@query("geo7_geo8_geo9_measures", "cells", sql=f"SELECT floor_id, ci, cj, {_M('LEAST(maxx - minx, maxy - miny)', 'thickness')}, {_M('LEAST(maxx - minx, maxy - miny) / GREATEST(maxx - minx, maxy - miny)', 'aspect')}, {_M('area', 'hull_area')} FROM cells")
def geo789(spark, cells):
    m = floors.measure(grid_faces(cells).select("floor_id", "ci", "cj", "shell", "holes"))
    return m.select("floor_id", "ci", "cj", milli("thickness", "thickness"), milli("aspect", "aspect"), milli("hull_area", "hull_area"))


@query("geo18_measures", "cells", sql=f"SELECT floor_id, ci, cj, {_M('2 * (maxx - minx + maxy - miny)', 'length')}, {_M('area', 'area')}, {_M('(minx + maxx) / 2', 'cx')}, {_M('(miny + maxy) / 2', 'cy')}, {_M('maxx', 'hx')}, {_M('maxy', 'hy')} FROM cells")
def geo18(spark, cells):
    r = G.box("minx", "miny", "maxx", "maxy")
    c = cells.withColumn("r", r).withColumn("c", G.ring_centroid("r")).withColumn("m", G.half_way("r"))
    return c.select("floor_id", "ci", "cj", milli(G.length("r"), "length"), milli(G.area("r"), "area"), milli("c.x", "cx"), milli("c.y", "cy"), milli("m.x", "hx"), milli("m.y", "hy"))


@query("geo11_geo12_geo13_window_split", "openings", sql="""
SELECT floor_id, instance_id, CAST(CASE instance_id % 4 WHEN 0 THEN 2 ELSE 1 END AS BIGINT) AS parts, CAST(CASE instance_id % 4 WHEN 2 THEN 4 ELSE 9 END AS BIGINT) AS lines,
  CAST(CASE instance_id % 4 WHEN 0 THEN CASE WHEN instance_id % 8 = 0 THEN 4 ELSE 5 END WHEN 2 THEN 4 ELSE 9 END AS BIGINT) AS with_first FROM openings
""")
def geo13(spark, openings):
    """Lines of an L of two legs with four strokes each, whose arc goes to the nearer leg; of a rectangle; of three strokes; and of one stroke far from the rest: only the first has parts."""
    x, y = F.col("x0"), F.col("y0")
    stroke = lambda x1, y1, x2, y2: F.struct(F.lit("segment").alias("original_type"), G.line(x + float(x1), y + float(y1), x + float(x2), y + float(y2)).alias("pts"))
    far = F.when(F.col("instance_id") % 8 == 0, 0.0).otherwise(50.0)
    arc = F.struct(F.lit("arc").alias("original_type"), F.array(G.point(x + far, y + 50.0 - far), G.point(x + far + 2.0, y + 50.0 - far), G.point(x + far + 2.0, y + 52.0 - far)).alias("pts"))
    legs = [stroke(30 + i, 0, 60 + i, 0.5) for i in range(4)] + [stroke(0, 30 + i, 0.5, 60 + i) for i in range(4)]
    box = [stroke(0, i, 40, i) for i in range(4)] + [stroke(0, 20 + i, 40, 20 + i) for i in range(4)]
    lone = [stroke(0, 30 + i, 0.5, 60 + i) for i in range(7)] + [stroke(60, 0, 63, 0.5)]
    kinds = [F.array(*legs, arc), F.array(*box, arc), F.array(*legs[:3], arc), F.array(*lone, arc)]
    shape = F.element_at(F.array(*kinds), (F.col("instance_id") % 4 + 1).cast("int"))
    lines = openings.select("floor_id", "instance_id", F.posexplode(shape).alias("ord", "l")).select("floor_id", "instance_id", F.col("ord").cast("long").alias("ord"), "l.*")
    p = floors.split_openings(lines)
    n = p.groupBy("floor_id", "instance_id", "part").agg(F.count("*").alias("n"), F.min("ord").alias("ord"))
    return n.groupBy("floor_id", "instance_id").agg(F.count("*").alias("parts"), F.sum("n").alias("lines"), F.min_by("n", "ord").alias("with_first"))


@query("jn1_faces_in_boxes", "cells", sql="""
SELECT floor_id, ci, cj, (ci + cj) % 2 = 1 AS is_window FROM cells WHERE (ci + 2 * cj) % 3 <> 0
""")
def jn1(spark, cells):
    """Boxes shifted by a tenth of a cell hold most of it; of those shifted by most of it no cell is held."""
    f = grid_faces(cells)
    w, h = F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")
    shift = F.when((F.col("ci") + 2 * F.col("cj")) % 3 != 0, 0.1).otherwise(40.0)
    b = f.select("floor_id", F.col("face_id").alias("box_id"), ((F.col("ci") + F.col("cj")) % 2 == 1).alias("is_window"), (F.col("minx") + shift * w).alias("minx"), (F.col("miny") + 0.1 * h).alias("miny"), (F.col("maxx") + shift * w).alias("maxx"), (F.col("maxy") + 0.1 * h).alias("maxy"))
    return R.faces_in_boxes(f, b).join(f.select("floor_id", "face_id", "ci", "cj"), ["floor_id", "face_id"]).select("floor_id", "ci", "cj", "is_window")


_POINTS = "SELECT floor_id, primitive_id, (x1 + x2) / 2 + 0.037 AS x, (y1 + y2) / 2 + 0.041 AS y FROM prims"


@query("jn2_hatched_faces", "prims", "cells", sql=f"""
WITH p AS (SELECT floor_id, (x1 + x2) / 2 + 0.037 AS x, (y1 + y2) / 2 + 0.041 AS y FROM prims WHERE ABS(x2 - x1 - 3) < 1e-9 AND ABS(y2 - y1 - 3) < 1e-9)
SELECT DISTINCT c.floor_id, c.ci, c.cj FROM cells c JOIN p ON p.floor_id = c.floor_id AND p.x > minx AND p.x < maxx AND p.y > miny AND p.y < maxy
""")
def jn2(spark, prims, cells):
    f = grid_faces(cells)
    p = lined(prims).filter(R.is_hatching()).withColumn("m", G.half_way("pts")).select("floor_id", "primitive_id", (F.col("m.x") + 0.037).alias("x"), (F.col("m.y") + 0.041).alias("y"))
    return R.points_in_faces(f, p).select("floor_id", "face_id").distinct().join(f.select("floor_id", "face_id", "ci", "cj"), ["floor_id", "face_id"]).select("floor_id", "ci", "cj")


@query("jn3_objects_in_faces", "prims", "cells", sql="""
WITH p AS (SELECT floor_id, semantic_id, (x1 + x2) / 2 + 0.037 AS x, (y1 + y2) / 2 + 0.041 AS y FROM prims WHERE semantic_id IN (28, 29, 30, 25, 26, 27, 19))
SELECT c.floor_id, c.ci, c.cj, semantic_id, CAST(COUNT(*) AS BIGINT) AS n FROM cells c JOIN p ON p.floor_id = c.floor_id AND p.x > minx AND p.x < maxx AND p.y > miny AND p.y < maxy GROUP BY 1, 2, 3, 4
""")
def jn3(spark, prims, cells):
    f = grid_faces(cells)
    p = prims.filter("semantic_id in (28, 29, 30, 25, 26, 27, 19)").select("floor_id", "primitive_id", "semantic_id", ((F.col("x1") + F.col("x2")) / 2 + 0.037).alias("x"), ((F.col("y1") + F.col("y2")) / 2 + 0.041).alias("y"))
    hit = R.points_in_faces(f, p).join(f.select("floor_id", "face_id", "ci", "cj"), ["floor_id", "face_id"])
    return hit.groupBy("floor_id", "ci", "cj", "semantic_id").agg(F.count("*").alias("n"))


@query("flt3_flt4_area_gates", "openings", sql="""
SELECT floor_id, instance_id, CASE WHEN s * s < 1 THEN 'dropped' WHEN s * s < 25 THEN 'wall:small' WHEN s * s <= 100 THEN 'wall:column' ELSE 'other' END AS gate FROM (SELECT *, w + 0.25 AS s FROM openings) t
""")
def flt34(spark, openings):
    s = F.col("w") + 0.25
    o = openings.withColumn("shell", G.box("x0", "y0", F.col("x0") + s, F.col("y0") + s)).withColumn("holes", F.array().cast(NO_HOLES))
    m = floors.measure(o.select("floor_id", "instance_id", "shell", "holes")).withColumn("area", G.area("shell")).withColumn("locked", F.lit(False)).withColumn("threshold", F.lit(0.0))
    role = R.final_role()
    return m.select("floor_id", "instance_id", F.when(F.col("area") < 1.0, "dropped").when(role.startswith("wall"), role).otherwise("other").alias("gate"))


@query("prj14_box_edges", "openings", sql=f"""
SELECT floor_id, instance_id, CAST(4 AS BIGINT) AS edges, {_M('2 * (w + h)', 'length')} FROM openings
""")
def prj14(spark, openings):
    e = R.box_edges(R.instance_boxes(opening_lines(openings)))
    return e.groupBy("floor_id", "instance_id").agg(F.count("*").alias("edges"), milli(F.sum(G.length("pts")), "length"))


@query("jn8_geo10_geo14_thin_walls", "dims", sql=f"""
SELECT floor_id, CAST(1 AS BIGINT) AS strokes, CAST(0 AS BIGINT) AS walls, {_M('1.2 * h', 'area')} FROM dims UNION ALL
SELECT floor_id, CAST(2 AS BIGINT), CAST(3 AS BIGINT), {_M('9 * h + 60 * 1.2 + 5 * 1.2', 'area')} FROM dims
""")
def geo14(spark, dims):
    """Strokes beside walls 3 thick: one between two rooms; one from wall to wall with its middle in a third; one half in a wall; one in a wall, one far off and one with a bend in a wall, which give nothing."""
    w, h = F.col("w").cast("double"), F.col("h").cast("double")
    at = lambda v: F.lit(float(v))
    face = lambda i, role, x1, x2: F.struct(F.lit(i).cast("long").alias("face_id"), F.lit(role).alias("role"), G.box(x1, at(0), x2, h).alias("shell"))
    first = 2 * w
    shapes = dims.select("floor_id", F.explode(F.array(face(0, "room", at(0), w), face(1, "room", w, first), face(2, "wall", first, first + 3), face(3, "wall", first + 33, first + 36), face(4, "wall", first + 66, first + 69))).alias("s"))
    f = shapes.select("floor_id", "s.*", F.lit("Office").alias("facil_type"), F.array().cast(NO_HOLES).alias("holes"))
    inside = first + 1.5
    strokes = [
        G.line(w, at(0), w, h), G.line(first + 1, at(2), first + 68, at(2)), G.line(inside, h / 2, inside, h + 5), G.line(inside, at(1), inside, h - 1), G.line(first + 200, at(0), first + 200, h),
        F.array(G.point(first + 1, at(1)), G.point(first + 2, at(3)), G.point(first + 1, at(5))),
    ]
    r = floors.walls_and_outline(f, dims.select("floor_id", F.explode(F.array(*strokes)).alias("pts"))).filter("role = 'wall'")
    return r.select("floor_id", F.size(F.filter("members", lambda m: m < 0)).cast("long").alias("strokes"), F.size(F.filter("members", lambda m: m >= 0)).cast("long").alias("walls"), milli("area", "area"))


def door_plan(dims: DataFrame) -> DataFrame:
    """A room, a wall 3 thick on one of its sides by floor_id % 4 (above, below, left, right), and a door of 4 by 3 in it; by floor_id / 4 % 4 with its hinge beyond the door's middle, before it, without a hinge, or without an arc."""
    w, h = F.col("w").cast("double"), F.col("h").cast("double")
    side, how = F.col("floor_id") % 4, F.floor(F.col("floor_id") / 4) % 4
    # Along the wall (u) and away from the room (v): boxes and points of the wall above the room, turned to the other sides.
    turn = lambda u, v: F.when(side == 0, G.point(u, h + v)).when(side == 1, G.point(u, -v)).when(side == 2, G.point(-v, u)).otherwise(G.point(w + v, u))
    ring = lambda u1, u2: F.array(*(turn(F.lit(u) if isinstance(u, float) else u, F.lit(v)) for u, v in ((u1, 0.0), (u2, 0.0), (u2, 3.0), (u1, 3.0), (u1, 0.0))))
    none, no = F.array().cast(NO_HOLES), F.lit(None).cast("struct<x:double,y:double>")
    region = lambda i, role, kind, arc, hinge, shell: F.struct(F.lit(i).cast("long").alias("region_id"), F.lit(role).alias("role"), F.lit(kind).alias("facil_type"), F.array(F.lit(i).cast("long")).alias("members"), arc.alias("has_arc"), hinge.alias("hinge"), shell.alias("shell"), none.alias("holes"))
    hinge = F.when(how == 0, turn(F.lit(2.0), F.lit(3.0))).when(how == 1, turn(F.lit(2.0), F.lit(0.0))).otherwise(no)
    parts = [
        region(0, "room", "Office", F.lit(False), no, G.box(F.lit(0.0), F.lit(0.0), w, h)),
        region(1, "wall", "Wall", F.lit(False), no, ring(0.0, F.when(side < 2, w).otherwise(h))),
        region(2, "door", "Door", how < 3, hinge, ring(2.0, 6.0)),
    ]
    return dims.select("floor_id", F.explode(F.array(*parts)).alias("r")).select("floor_id", "r.*")


_SIDE, _HOW = "floor_id % 4", "(floor_id // 4) % 4"


@query("geo16_geo17_jn7_absorb_doors", "dims", sql=f"""
WITH d AS (SELECT floor_id, w, h, {_SIDE} AS side, {_HOW} AS how, CASE WHEN {_SIDE} < 2 THEN w ELSE h END AS along FROM dims),
v AS (SELECT *, CASE how WHEN 1 THEN 0.375 WHEN 3 THEN 1.5 ELSE 2.625 END AS v FROM d)
SELECT floor_id, 'room' AS role, CAST(CASE how WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS pieces, {_M('w * h + CASE how WHEN 3 THEN 0 ELSE 9 END', 'area')}, CAST(NULL AS BIGINT) AS x, CAST(NULL AS BIGINT) AS y FROM d UNION ALL
SELECT floor_id, 'door', CAST(1 AS BIGINT), {_M('CASE how WHEN 3 THEN 12 ELSE 3 END', 'area')}, {_M('CASE side WHEN 2 THEN -v WHEN 3 THEN w + v ELSE 4 END', 'x')}, {_M('CASE side WHEN 0 THEN h + v WHEN 1 THEN -v ELSE 4 END', 'y')} FROM v UNION ALL
SELECT floor_id, 'wall', CAST(2 AS BIGINT), {_M('3 * along - 12', 'area')}, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM d
""")
def geo17(spark, dims):
    """Pieces and areas by role, and the middle of what is left of the door."""
    a = floors.absorb_doors(door_plan(dims)).withColumn("c", F.when(F.col("role") == "door", G.ring_centroid("shell")))
    return a.groupBy("floor_id", "role").agg(F.count("*").alias("pieces"), milli(F.sum("area"), "area"), milli(F.avg("c.x"), "x"), milli(F.avg("c.y"), "y"))


@query("snk3_features", "cells", sql=f"""
SELECT floor_id, CAST(ROW_NUMBER() OVER (PARTITION BY floor_id ORDER BY ci * 100 + cj) - 1 AS BIGINT) AS seq, {_TYPE} AS facil_type FROM cells WHERE object_sem IS NOT NULL
""")
def snk3(spark, cells):
    f = feature_rows(cells)
    return f.select("floor_id", "seq", "facil_type")


def feature_rows(cells: DataFrame) -> DataFrame:
    levels = cells.groupBy("floor_id").agg((F.max("maxx")).alias("w"), F.max("maxy").alias("h")).withColumn("m", sinks.placeholder_affine("w", "h"))
    levels = levels.select("floor_id", F.lit("0").alias("level_id"), *(F.col("m")[i].alias(c) for i, c in enumerate(("a", "b", "d", "e", "tx", "ty"))))
    return sinks.features(rooms_of(cells), levels, stable_ids=True)


@query("snk2_properties", "cells", sql=f"""
SELECT floor_id, CAST(ROW_NUMBER() OVER (PARTITION BY floor_id ORDER BY ci * 100 + cj) - 1 AS BIGINT) AS seq, {_TYPE} AS kind, CASE WHEN object_sem IN (28, 29, 30, 35) THEN 'FALSE' ELSE 'TRUE' END AS clickable, '0' AS level, CAST(64 AS BIGINT) AS id_length, TRUE AS braces FROM cells WHERE object_sem IS NOT NULL
""")
def snk2(spark, cells):
    g = lambda p: F.get_json_object("feature", f"$.properties.{p}")
    return feature_rows(cells).select("floor_id", "seq", g("facilType").alias("kind"), g("isClickable").alias("clickable"), g("floorLevel").alias("level"), F.length(g("id")).cast("long").alias("id_length"), g("clickId").rlike(r"^\{.*\}$").alias("braces"))


@query("snk1_feature_collection", "cells", sql="SELECT CAST(COUNT(*) AS BIGINT) AS features, 'FeatureCollection' AS kind, 'plan' AS name, 'urn:ogc:def:crs:OGC:1.3:CRS84' AS crs FROM cells WHERE object_sem IS NOT NULL")
def snk1(spark, cells):
    d = sinks.feature_collection(feature_rows(cells), "plan")
    g = lambda p: F.get_json_object("document", p)
    return d.select(F.size(F.from_json(g("$.features"), "array<string>")).cast("long").alias("features"), g("$.type").alias("kind"), g("$.name").alias("name"), g("$.crs.properties.name").alias("crs"))


_COLOR = f"CASE facil_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_COLORS.items())} ELSE '{OPEN_FILL}' END"


@query("snk4_svg_documents", "cells", sql=f"""
WITH t AS (SELECT *, {_TYPE} AS facil_type FROM cells),
p AS (SELECT floor_id, ci, cj, minx, miny, maxx, maxy, {_COLOR} AS color, {_COLOR} <> '{OPEN_FILL}' AS typed FROM t),
e AS (SELECT floor_id, ci, cj, maxx, maxy, printf('  <path d="M %.3f %.3f L %.3f %.3f L %.3f %.3f L %.3f %.3f L %.3f %.3f Z" fill="%s" fill-opacity="%s" stroke="%s" stroke-width="0.40"/>',
  minx, miny, maxx, miny, maxx, maxy, minx, maxy, minx, miny, color, CASE WHEN typed THEN '0.65' ELSE '0.50' END, CASE WHEN typed THEN color ELSE '{OPEN_EDGE}' END) AS e FROM p)
SELECT floor_id, md5(printf('<?xml version="1.0" encoding="UTF-8"?>%s<svg xmlns="http://www.w3.org/2000/svg" viewBox="0.000 0.000 %.3f %.3f">%s<g transform="scale(1 -1) translate(0 %.3f)" fill-rule="evenodd">%s%s%s</g>%s</svg>',
  chr(10), MAX(maxx), MAX(maxy), chr(10), -MAX(maxy), chr(10), string_agg(e, chr(10) ORDER BY ci * 100 + cj), chr(10), chr(10))) AS svg FROM e GROUP BY floor_id
""")
def snk4(spark, cells):
    """Whole drawings, by their digest."""
    b = cells.groupBy("floor_id").agg(*(f(c).alias(c) for f, c in ((F.min, "minx"), (F.min, "miny"), (F.max, "maxx"), (F.max, "maxy"))))
    return sinks.svg_documents(rooms_of(cells), b).select("floor_id", F.md5(F.col("svg").cast("binary")).alias("svg"))


def geojson_of(cells: DataFrame) -> DataFrame:
    coords = F.to_json(F.array(F.transform(G.box("minx", "miny", "maxx", "maxy"), lambda p: F.array(p["x"], p["y"]))))
    one = F.concat(F.lit('{"type":"Feature","properties":{},"geometry":{"type":"Polygon","coordinates":'), coords, F.lit("}}"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ci", "cj", one.alias("f")))), lambda s: s["f"]), ",")
    return cells.groupBy(F.col("floor_id").alias("doc_id")).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}")).alias("content"))


@query("src12_geojson_scan", "cells", sql=f"SELECT floor_id AS doc_id, CAST(ROW_NUMBER() OVER (PARTITION BY floor_id ORDER BY ci, cj) - 1 AS BIGINT) AS feature, {_M('minx', 'minx')}, {_M('maxy', 'maxy')}, CAST(5 AS BIGINT) AS n FROM cells")
def src12(spark, cells):
    r = generic.read_rings(geojson_of(cells)).withColumn("b", G.bounds("pts"))
    return r.select("doc_id", "feature", milli("b.minx", "minx"), milli("b.maxy", "maxy"), F.size("pts").cast("long").alias("n"))


@query("snk7_fit_to_square", "cells", sql=f"""
WITH b AS (SELECT floor_id, MAX(maxx) AS w, MAX(maxy) AS h FROM cells GROUP BY floor_id)
SELECT c.floor_id AS doc_id, CAST(ROW_NUMBER() OVER (PARTITION BY c.floor_id ORDER BY ci, cj) - 1 AS BIGINT) AS feature, {_M('minx * 500 / w', 'x')}, {_M('500 - miny * 500 / h', 'y')} FROM cells c JOIN b ON c.floor_id = b.floor_id
""")
def snk7(spark, cells):
    s = sinks.fit_to_square(generic.read_rings(geojson_of(cells)))
    return s.select("doc_id", "feature", milli(F.col("pts")[0]["x"], "x"), milli(F.col("pts")[0]["y"], "y"))


def shapes_of(dims: DataFrame) -> DataFrame:
    """One drawing for each floor with every kind of shape, one of them broken."""
    body = F.format_string(
        '<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 200 100"><line x1="0" y1="0" x2="%d" y2="%d"/><polyline points="0,0 1,1 2,0"/><polygon points="0 0 %d 0 0 %d"/>'
        '<rect x="1" y="2" width="%d" height="%d"/><circle cx="5" cy="5" r="%d"/><ellipse cx="5" cy="5" rx="%d" ry="2"/><path d="M 0 0 L %d 0 C 20 0 20 %d 0 9"/><path d="M 0 0 l 4 0 l 0 4 z"/><path d="M 0"/></svg>',
        "w", "h", "w", "h", "w", "h", "w", "h", "w", "h",
    )
    return dims.select(F.col("floor_id").alias("doc_id"), body.alias("content"))


@query("src11_generic_svg", "dims", sql="""
WITH k(seq, kind, n) AS (VALUES (0, 'LineString', 2), (1, 'LineString', 3), (2, 'Polygon', 4), (3, 'Polygon', 5), (4, 'Polygon', 65), (5, 'Polygon', 65), (6, 'LineString', 9), (7, 'Polygon', 4), (8, NULL, NULL))
SELECT floor_id AS doc_id, CAST(seq AS BIGINT) AS seq, kind, CAST(n AS BIGINT) AS n, kind IS NULL AS failed FROM dims CROSS JOIN k
""")
def src11(spark, dims):
    s = generic.read_shapes(shapes_of(dims))
    return s.select("doc_id", "seq", "kind", F.when(F.col("points").isNotNull(), F.size("points").cast("long")).alias("n"), F.col("error").isNotNull().alias("failed"))


@query("prj17_curve_points", "dims", of=("dims", "steps"), sql=f"""
WITH t AS (SELECT floor_id, w, h, i + 1 AS i, (i + 1) / 7.0 AS t FROM dims CROSS JOIN steps)
SELECT floor_id AS doc_id, CAST(i AS BIGINT) AS i, {_M('(1 - t) * (1 - t) * (1 - t) * w + 60 * (1 - t) * t', 'x')}, {_M('3 * (1 - t) * t * t * h + 9 * t * t * t', 'y')} FROM t
UNION ALL SELECT floor_id, CAST(0 AS BIGINT), {_M('w', 'x')}, CAST(0 AS BIGINT) FROM dims
""")
def prj17_curve(spark, dims):
    """The points of the path's curve, from its start: a cubic at eight even steps."""
    s = generic.read_shapes(shapes_of(dims)).filter("seq = 6").select("doc_id", F.posexplode("points").alias("i", "p")).filter("i > 0")
    return s.select("doc_id", (F.col("i") - 1).cast("long").alias("i"), milli(F.col("p")[0], "x"), milli(F.col("p")[1], "y"))


@query("prj17_prj18_shape_points", "dims", sql=f"""
SELECT floor_id AS doc_id, {_M('w * h', 'rect_area')}, {_M('32 * w * w * SIN(PI() / 32)', 'circle_area', 100)}, {_M('100 - 2.0', 'rect_top')} FROM dims
""")
def prj17(spark, dims):
    s = generic.read_shapes(shapes_of(dims), flip=True).withColumn("pts", F.transform("points", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    pick = lambda seq, c: F.max(F.when(F.col("seq") == seq, c))
    return s.groupBy("doc_id").agg(milli(pick(3, G.area("pts")), "rect_area"), milli(pick(4, G.area("pts")), "circle_area", 100), milli(pick(3, F.col("pts")[0]["y"]), "rect_top"))


@query("snk8_generic_geojson", "dims", sql=f"""
SELECT floor_id AS doc_id, CAST(9 AS BIGINT) AS features, CAST(1 AS BIGINT) AS failed, TRUE AS bare, {_M('w + 1', 'x')}, {_M('h + 2', 'y')}, 'Polygon' AS kind, CAST(w AS VARCHAR) AS width, 'LineString' AS curve, TRUE AS no_shape FROM dims
""")
def snk8(spark, dims):
    """Counts, a rectangle's far corner, kind and attributes, the curve's kind, and the failed shape's missing geometry."""
    d = generic.shapes_to_geojson(generic.read_shapes(shapes_of(dims)))
    g = lambda p: F.get_json_object("document", f"$.{p}")
    f = F.from_json(g("features"), "array<string>")
    return d.select(
        "doc_id", F.size(f).cast("long").alias("features"), F.regexp_count("document", F.lit("conversion_error")).cast("long").alias("failed"), g("name").isNull().alias("bare"),
        milli(g("features[3].geometry.coordinates[0][2][0]").cast("double"), "x"), milli(g("features[3].geometry.coordinates[0][2][1]").cast("double"), "y"), g("features[3].geometry.type").alias("kind"),
        g("features[3].properties.width").alias("width"), g("features[6].geometry.type").alias("curve"), g("features[8].geometry").isNull().alias("no_shape"),
    )


_ROOMS = f"""
WITH t AS (SELECT *, {_TYPE} AS facil_type FROM cells WHERE object_sem IS NOT NULL),
u AS (SELECT k.*, CASE WHEN k.facil_type = 'Kitchen' AND EXISTS (SELECT 1 FROM t w WHERE w.floor_id = k.floor_id AND w.facil_type = 'WC' AND ABS(w.ci - k.ci) <= 1 AND ABS(w.cj - k.cj) <= 1) THEN 'WC' ELSE k.facil_type END AS kind FROM t k)
SELECT floor_id, kind AS facil_type, CAST(COUNT(*) AS BIGINT) AS rooms, {_M('SUM(area)', 'area')} FROM u GROUP BY 1, 2
"""


def rooms_by_type(spark, grid: DataFrame, cells: DataFrame) -> DataFrame:
    """From strokes and objects to typed rooms: node, polygonize, place objects, classify."""
    f = floors.faces(floors.node_edges(grid)).filter("kind = 'face' and area >= 1.0")
    objects = cells.filter("object_sem is not null").select("floor_id", F.col("object_sem").alias("semantic_id"), ((F.col("minx") + F.col("maxx")) / 2).alias("x"), ((F.col("miny") + F.col("maxy")) / 2).alias("y"))
    hit = R.points_in_faces(f, objects).groupBy("floor_id", "face_id", "semantic_id").agg(F.count("*").cast("int").alias("n")).groupBy("floor_id", "face_id").agg(F.map_from_entries(F.collect_list(F.struct("semantic_id", "n"))).alias("contained_semantics"))
    rooms = f.join(hit, ["floor_id", "face_id"]).withColumn("facil_type", R.type_by_objects()).withColumn("region_id", F.col("face_id"))
    return R.kitchens_near_wc(rooms).groupBy("floor_id", "facil_type").agg(F.count("*").alias("rooms"), milli(F.sum("area"), "area"))


query("orc_rooms_by_type", "grid_edges", "cells", sql=_ROOMS)(rooms_by_type)


def whole_plan(strokes: DataFrame, sheets: DataFrame) -> pipeline.Plan:
    """The run over whole plans, from their SVG texts on."""
    box = F.format_string("0 0 %.1f %.1f", F.col("wide") + 20, F.col("high") + 20)
    documents = svg_documents_of(strokes.join(sheets.select("floor_id", "wide", "high"), "floor_id"), box)
    return pipeline.run_floors(svg.primitives(store(svg.elements(documents), "elements")))


#: What stands in a room decides its type, kitchens near a WC are WCs, small square rooms without objects are taken for columns, others are judged by their shape.
_PLAN = f"""
WITH t AS (SELECT *, {_TYPE} AS kind, object_sem IS NULL AND w * h <= 100 AND LEAST(w, h) / GREATEST(w, h) >= 0.6 AS is_column FROM rooms),
u AS (SELECT k.*, CASE WHEN k.kind = 'Kitchen' AND EXISTS (SELECT 1 FROM t o WHERE o.floor_id = k.floor_id AND o.kind = 'WC' AND ABS(o.ci - k.ci) <= 1 AND ABS(o.cj - k.cj) <= 1) THEN 'WC'
  WHEN k.kind IS NOT NULL THEN k.kind WHEN LEAST(w, h) < 14 THEN 'Walkways' ELSE 'Office' END AS facil_type FROM t k),
c AS (SELECT floor_id, SUM(CASE WHEN is_column THEN w * h ELSE 0 END) AS columns, CAST(SUM(CASE WHEN is_column THEN 1 ELSE 0 END) AS BIGINT) AS n_columns, CAST(COUNT(object_sem) AS BIGINT) AS n_locked FROM t GROUP BY floor_id),
s AS (SELECT d.*, columns, n_columns, n_locked, (wide + 20) * (high + 20) AS canvas FROM sheets d JOIN c ON c.floor_id = d.floor_id),
r AS (SELECT floor_id, facil_type, w * h AS area FROM u WHERE NOT is_column UNION ALL SELECT floor_id, 'Walkways', canvas - wide * high FROM s)
"""


@query("orc1_run_floors", "strokes", "sheets", of=("sheets", "rooms"), sql=_PLAN + f"""
SELECT floor_id, 'room' AS role, facil_type, CAST(COUNT(*) AS BIGINT) AS regions, {_M('SUM(area)', 'area')} FROM r GROUP BY floor_id, facil_type UNION ALL
SELECT floor_id, 'wall', 'Wall', CAST(1 AS BIGINT), {_M('wide * high - nc * nr * w * h + columns - 16', 'area')} FROM s UNION ALL
SELECT floor_id, 'outline', NULL, CAST(1 AS BIGINT), {_M('canvas', 'area')} FROM s UNION ALL
SELECT floor_id, 'door', 'Door', CAST(1 AS BIGINT), CAST(8000 AS BIGINT) FROM s UNION ALL
SELECT floor_id, 'window', 'Window', CAST(1 AS BIGINT), CAST(8000 AS BIGINT) FROM s
""")
def orc1(spark, strokes, sheets):
    """All stages on whole plans: regions by role and type of each floor."""
    return whole_plan(strokes, sheets).regions.groupBy("floor_id", "role", "facil_type").agg(F.count("*").alias("regions"), milli(F.sum("area"), "area"))


@query("orc4_agg7_separation", "strokes", "sheets", of=("sheets", "rooms"), sql=_PLAN + """
SELECT floor_id, nc * nr - n_columns + 1 AS room_count, 1 + n_columns AS wall_count, n_columns AS column_count, CAST(0 AS BIGINT) AS small_wall_count, CAST(1 AS BIGINT) AS merged_wall_count, CAST(0 AS BIGINT) AS synth_wall_count,
  CAST(1 AS BIGINT) AS door_count, CAST(1 AS BIGINT) AS window_count, CAST(1 AS BIGINT) AS hatched_wall_count, n_locked AS locked_room_count, 'largest_gap' AS method, FALSE AS hatching_calibrated FROM s
""")
def orc4(spark, strokes, sheets):
    """The counts of a run."""
    names = "room_count wall_count column_count small_wall_count merged_wall_count synth_wall_count door_count window_count hatched_wall_count locked_room_count method hatching_calibrated".split()
    return whole_plan(strokes, sheets).statistics().select("floor_id", *names)


@query("orc1_derived_drawings", "prims")
def orc1_derived(spark, prims):
    """All stages on crowded drawings without analytic answers: regions by role and type of each floor."""
    plan = pipeline.run_floors(svg.primitives(svg.elements(svg_documents_of(prims))))
    return plan.regions.groupBy("floor_id", "role", "facil_type").agg(F.count("*").alias("regions"), milli(F.sum("area"), "area"))


@query("orc2_close_openings", "strokes", of=("rooms",), sql=f"""
SELECT floor_id, FALSE AS is_window, {_M('x + w', 'minx')}, {_M('y + 2', 'miny')}, {_M('x + w + 2', 'maxx')}, {_M('y + 6', 'maxy')} FROM rooms WHERE left_of_door UNION ALL
SELECT floor_id, TRUE, {_M('x + 2', 'minx')}, {_M('10', 'miny')}, {_M('x + 6', 'maxx')}, {_M('12', 'maxy')} FROM rooms WHERE right_of_door
""")
def orc2(spark, strokes):
    b = pipeline.close_openings(lined(strokes))
    return b.select("floor_id", "is_window", *(milli(c, c) for c in ("minx", "miny", "maxx", "maxy")))


@query("orc3_clean_geometry", "strokes", of=("sheets",), sql=f"SELECT floor_id, CAST(4 * nc * nr + 9 AS BIGINT) AS edges, {_M('2 * (w + h) * nc * nr + 2 * (wide + high) - 16 + 0.4 * SQRT(2)', 'length')} FROM sheets")
def orc3(spark, strokes):
    e = floors.clean_lines(lined(strokes).filter("role = 'boundary'"))
    return e.groupBy("floor_id").agg(F.count("*").alias("edges"), milli(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))), "length"))


@query("agg7_polygonize_stats", "grid_edges", "dims", sql=f"""
SELECT floor_id, nc * nr AS raw_polygon_count, CASE WHEN w * h >= 100 THEN nc * nr ELSE 0 END AS filtered_polygon_count, CASE WHEN w * h >= 100 THEN 0 ELSE nc * nr END AS removed_small_count, CAST(1 AS BIGINT) AS dangle_count, CAST(0 AS BIGINT) AS cut_edge_count,
  {_M('w / 4.0', 'total_dangle_length')}, {_M('CASE WHEN w * h >= 100 THEN nc * nr * w * h ELSE 0 END', 'total_area')}, {_M('CASE WHEN w * h >= 100 THEN w * h ELSE 0 END', 'max_area')} FROM dims
""")
def agg7_polygonize(spark, grid, dims):
    s = stats.polygonize_stats(floors.faces(floors.node_edges(overhang(grid, dims))), min_room_area=100.0)
    return s.select("floor_id", "raw_polygon_count", "filtered_polygon_count", "removed_small_count", "dangle_count", "cut_edge_count", *(milli(c, c) for c in ("total_dangle_length", "total_area", "max_area")))
