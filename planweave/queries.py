"""The registered queries of the floor-plan engine, each with SQL for DuckDB where SQL can express it.

Lengths are returned as whole thousandths, since the two engines print doubles differently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave import fixtures
from planweave.functions import geom as G
from planweave.operators import floors, sinks, stats
from planweave.operators import relational as R
from planweave.sources import svg
from planweave.storage import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
CANVAS = 140.0


def query(name: str, *tables: str, sql: str | None = None, of: tuple[str, ...] | None = None):
    """Registers a function of (spark, *derived tables), with SQL over the same tables, or over those named by ``of``."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, *(fixtures.load(spark, sf_dir, t) for t in tables))

        QUERIES[name] = run
        if sql:
            SQL[name] = fixtures.sql(sql, *(of or tables))
        return f

    return add


def milli(c, alias: str | None = None, by: int = 1000) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    out = F.round(c * by).cast("long")
    return out.alias(alias) if alias else out


def lined(prims: DataFrame) -> DataFrame:
    """The derived segments as primitives with points, in order of their ids."""
    return prims.withColumn("pts", G.line("x1", "y1", "x2", "y2")).withColumn("ord", F.col("primitive_id")).withColumn("kind", F.lit("line")).withColumn("original_type", F.lit("segment")).withColumn("stroke", F.lit("")).withColumn("role", svg.role())


def svg_documents_of(prims: DataFrame, box=None) -> DataFrame:
    """Derived segments of each floor as one SVG text; ``box``: an expression of its view box."""
    attr = lambda n, c: F.when(c.isNotNull(), F.concat(F.lit(f' {n}="'), c.cast("string"), F.lit('"'))).otherwise("")
    d = F.format_string("M %.1f,%.1f L %.1f,%.1f", "x1", "y1", "x2", "y2")
    element = F.concat(F.lit("<path"), attr("primitiveId", F.col("primitive_id")), attr("semanticId", F.col("semantic_id")), attr("instanceId", F.col("instance_id")), F.lit(' originalType="segment" d="'), d, F.lit('"/>'))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("primitive_id", element.alias("e")))), lambda s: s["e"]), "")
    prims = spread(prims, "floor_id")
    return prims.groupBy("floor_id").agg(F.concat(F.lit('<svg xmlns="http://www.w3.org/2000/svg" viewBox="'), F.lit("0 0 140 140") if box is None else F.first(box), F.lit('">'), body, F.lit("</svg>")).alias("content"))


_M = lambda e, n, by=1000: f"CAST(ROUND(({e}) * {by}) AS BIGINT) AS {n}"
_ROLE = "CASE WHEN semantic_id IS NULL THEN 'skipped' WHEN semantic_id IN (33, 34) THEN 'boundary' WHEN semantic_id IN (1, 2, 3, 5) THEN 'door' WHEN semantic_id IN (7) THEN 'window' ELSE 'classification' END"
_SNAP = lambda v: f"CASE WHEN ABS({v}) < 0.5 THEN 0.0 WHEN ABS({v} - 140) < 0.5 THEN 140.0 ELSE {v} END"


@query("src1_svg_scan", "prims", sql=f"""
WITH f AS (SELECT floor_id, primitive_id, semantic_id, instance_id, x1, 140 - y1 AS y1, x2, 140 - y2 AS y2 FROM prims),
s AS (SELECT floor_id, primitive_id, semantic_id, instance_id, x1, y1, x2, y2, {_SNAP('x1')} AS a, {_SNAP('y1')} AS b, {_SNAP('x2')} AS c, {_SNAP('y2')} AS d FROM f),
e AS (SELECT DISTINCT floor_id FROM prims),
r AS (
SELECT floor_id, primitive_id, semantic_id, instance_id, CASE WHEN a = c AND b = d THEN x1 ELSE a END AS x1, CASE WHEN a = c AND b = d THEN y1 ELSE b END AS y1,
  CASE WHEN a = c AND b = d THEN x2 ELSE c END AS x2, CASE WHEN a = c AND b = d THEN y2 ELSE d END AS y2 FROM s
UNION ALL SELECT floor_id, 1000000, NULL, NULL, 0, 0, 140, 0 FROM e UNION ALL SELECT floor_id, 1000001, NULL, NULL, 140, 0, 140, 140 FROM e
UNION ALL SELECT floor_id, 1000002, NULL, NULL, 140, 140, 0, 140 FROM e UNION ALL SELECT floor_id, 1000003, NULL, NULL, 0, 140, 0, 0 FROM e)
SELECT floor_id, CAST(primitive_id AS BIGINT) AS primitive_id, semantic_id, instance_id, {_ROLE} AS role, {_M('x1', 'x1')}, {_M('y1', 'y1')}, {_M('x2', 'x2')}, {_M('y2', 'y2')} FROM r
""")
def src1(spark, prims):
    p = svg.primitives(svg.elements(svg_documents_of(prims)))
    return p.select("floor_id", "primitive_id", "semantic_id", "instance_id", "role", *(milli(F.col("pts")[i][k], f"{k}{i + 1}") for i in (0, 1) for k in "xy"))


@query("src2_viewbox", "dims", sql=f"SELECT floor_id, {_M('CAST(floor_id AS DOUBLE)', 'x')}, {_M('nc / 2.0', 'y')}, {_M('w', 'w')}, {_M('h', 'h')} FROM dims")
def src2(spark, dims):
    text = F.concat_ws("  ", F.concat(F.lit(" "), "floor_id"), F.format_string("%.1f", F.col("nc") / 2.0), F.col("w").cast("string"), F.concat(F.col("h").cast("string"), F.lit(" ")))
    return dims.withColumn("vb", svg.view_box(text)).select("floor_id", *(milli(f"vb.{c}", c) for c in "xywh"))


@query("src3_attributes", "prims", sql="""
SELECT floor_id, CAST(COUNT(*) AS BIGINT) AS n, CAST(COUNT(semantic_id) AS BIGINT) AS n_semantic, CAST(COUNT(instance_id) AS BIGINT) AS n_instance, CAST(SUM(primitive_id) AS BIGINT) AS ids FROM prims GROUP BY floor_id
""")
def src3(spark, prims):
    e = svg.elements(svg_documents_of(prims)).filter("primitive_id is not null")
    return e.groupBy("floor_id").agg(F.count("*").alias("n"), F.count("semantic_id").alias("n_semantic"), F.count("instance_id").alias("n_instance"), F.sum(F.col("primitive_id").cast("long")).alias("ids"))


@query("src4_path_dispatch", "prims", sql="""
SELECT floor_id, primitive_id, CASE primitive_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 22 ELSE NULL END AS n_points FROM prims
""")
def src4(spark, prims):
    kind = F.element_at(F.array(F.lit("segment"), F.lit("arc"), F.lit("spline")), (F.col("primitive_id") % 3 + 1).cast("int"))
    d = F.when(F.col("primitive_id") % 3 == 1, "M 0,0 A 5,5 0 0,1 10,0").otherwise("M 0,0 L 10,0")
    none = {c: F.lit(None).cast("string") for c in ("cx", "cy", "r", "rx", "ry")}
    e = svg.with_points(prims.withColumns({"tag": F.lit("path"), "original_type": kind, "d": d, **none}))
    return e.select("floor_id", "primitive_id", F.when(F.col("pts").isNotNull(), F.size("pts")).alias("n_points"))


@query("src5_segment_parse", "prims", sql=f"SELECT floor_id, primitive_id, {_M('x1', 'x1')}, {_M('y1', 'y1')}, {_M('x2', 'x2')}, {_M('y2', 'y2')} FROM prims")
def src5(spark, prims):
    d = F.concat_ws(" ", F.lit("M"), F.format_string("%.2e", "x1"), F.format_string("%.2e", "y1"), F.lit("L"), F.format_string("%.1f,%.1f", "x2", "y2"), F.lit("L 1,1"))
    none = {c: F.lit(None).cast("string") for c in ("cx", "cy", "r", "rx", "ry")}
    d = F.when(F.col("x1") < 1e4, F.concat_ws(" ", F.lit("M"), F.format_string("%.4e", "x1"), F.format_string("%.4e", "y1"), F.lit("L"), F.format_string("%.1f,%.1f", "x2", "y2"), F.lit("L 1,1"))).otherwise(d)
    e = svg.with_points(prims.withColumns({"tag": F.lit("path"), "original_type": F.lit("segment"), "d": d, **none}))
    return e.select("floor_id", "primitive_id", *(milli(F.col("pts")[i][k], f"{k}{i + 1}") for i in (0, 1) for k in "xy"))


_ARC = """
WITH a AS (SELECT instance_id, w, x0, y0, CASE WHEN instance_id % 2 = 0 THEN 0 ELSE 1 END AS sweep FROM openings),
i AS (SELECT CAST(n_nationkey AS BIGINT) AS i FROM nation WHERE n_nationkey < 22)
"""


@query("src6_arc_points", "openings", sql=_ARC + f"""
SELECT instance_id, i, {_M("x0 - w * COS((1 - 2 * (1 - sweep)) * PI() * i / 21.0) + w", 'x')}, {_M("y0 - (1 - 2 * (1 - sweep)) * w * SIN(PI() * i / 21.0)", 'y')} FROM a CROSS JOIN i
""")
def src6(spark, openings):
    sweep = F.when(F.col("instance_id") % 2 == 0, 0).otherwise(1)
    pts = G.arc("x0", "y0", "w", "w", F.lit(0.0), F.lit(0), sweep, F.col("x0") + 2 * F.col("w"), "y0")
    return openings.select("instance_id", F.posexplode(pts).alias("i", "p")).select("instance_id", F.col("i").cast("long").alias("i"), milli("p.x", "x"), milli("p.y", "y"))


@query("src7_arc_center", "openings", sql=f"""
SELECT instance_id, {_M('x0 + w', 'cx')}, {_M('y0', 'cy')}, {_M('w', 'r')} FROM openings
""")
def src7(spark, openings):
    # Radii too small for the chord are scaled up, so the centre is the chord's middle.
    pts = G.arc("x0", "y0", F.col("w") / 2, F.col("w") / 2, F.lit(0.0), F.lit(0), F.lit(1), F.col("x0") + 2 * F.col("w"), "y0")
    o = openings.withColumn("p", pts).withColumn("c", G.circumcenter(F.col("p")[0], F.col("p")[10], F.col("p")[21]))
    return o.select("instance_id", milli("c.x", "cx"), milli("c.y", "cy"), milli(F.hypot(F.col("c.x") - F.col("x0"), F.col("c.y") - F.col("y0")), "r"))


@query("src8_circle", "openings", sql=f"""
SELECT instance_id, CAST(65 AS BIGINT) AS n, {_M('32 * w * w * SIN(PI() / 32)', 'area', 100)}, {_M('x0 - w', 'minx')}, {_M('y0 + w', 'maxy')} FROM openings
""")
def src8(spark, openings):
    o = openings.withColumn("p", G.ellipse("x0", "y0", "w", "w")).withColumn("b", G.bounds("p"))
    return o.select("instance_id", F.size("p").cast("long").alias("n"), milli(G.area("p"), "area", 100), milli("b.minx", "minx"), milli("b.maxy", "maxy"))


@query("src9_ellipse", "openings", sql=f"""
SELECT instance_id, {_M('32 * w * h * SIN(PI() / 32)', 'area', 100)} FROM openings WHERE h > 0
""")
def src9(spark, openings):
    none = {c: F.lit(None).cast("string") for c in ("d", "r", "original_type")}
    e = openings.withColumns({"tag": F.lit("ellipse"), "cx": F.col("x0").cast("string"), "cy": F.col("y0").cast("string"), "rx": F.col("w").cast("string"), "ry": F.col("h").cast("string"), **none})
    return svg.with_points(e).filter("pts is not null").select("instance_id", milli(G.area("pts"), "area", 100))


@query("src13_input_spec", "names", sql="SELECT floor_id, file_name AS path, CASE WHEN floor_id % 2 = 0 THEN CAST(floor_id AS VARCHAR) END AS level FROM names")
def src13(spark, names):
    spec = F.when(F.col("floor_id") % 2 == 0, F.concat_ws("=", "file_name", F.col("floor_id").cast("string"))).otherwise(F.col("file_name"))
    return names.withColumn("s", svg.input_spec(spec)).select("floor_id", "s.path", "s.level")


@query("prj1_translate", "prims", sql=f"SELECT floor_id, primitive_id, {_M('x1 - 5', 'x1')}, {_M('y2 - 7', 'y2')} FROM prims")
def prj1(spark, prims):
    p = lined(prims).withColumn("pts", G.move("pts", -5.0, -7.0))
    return p.select("floor_id", "primitive_id", milli(F.col("pts")[0]["x"], "x1"), milli(F.col("pts")[1]["y"], "y2"))


@query("prj2_flip_y", "prims", sql=f"SELECT floor_id, primitive_id, {_M('140 - y1', 'y1')}, {_M('140 - y2', 'y2')} FROM prims")
def prj2(spark, prims):
    p = lined(prims).withColumn("pts", G.flip_y("pts", CANVAS))
    return p.select("floor_id", "primitive_id", milli(F.col("pts")[0]["y"], "y1"), milli(F.col("pts")[1]["y"], "y2"))


@query("prj3_snap_to_canvas", "prims", sql=f"""
WITH s AS (SELECT *, {_SNAP('x1')} AS a, {_SNAP('y1')} AS b, {_SNAP('x2')} AS c, {_SNAP('y2')} AS d FROM prims)
SELECT floor_id, primitive_id, {_M('CASE WHEN a = c AND b = d THEN x1 ELSE a END', 'x1')}, {_M('CASE WHEN a = c AND b = d THEN y1 ELSE b END', 'y1')},
  {_M('CASE WHEN a = c AND b = d THEN x2 ELSE c END', 'x2')}, {_M('CASE WHEN a = c AND b = d THEN y2 ELSE d END', 'y2')} FROM s
""")
def prj3(spark, prims):
    p = lined(prims).withColumn("pts", G.snap_to_canvas("pts", CANVAS, CANVAS, 0.5))
    return p.select("floor_id", "primitive_id", *(milli(F.col("pts")[i][k], f"{k}{i + 1}") for i in (0, 1) for k in "xy"))


@query("prj4_canvas_edges", "dims", of=("dims", "steps"), sql="""
SELECT floor_id, CAST(1000000 + k AS BIGINT) AS primitive_id, 'boundary' AS original_type, CAST(CASE WHEN k IN (0, 2) THEN w ELSE h END * 1000 AS BIGINT) AS length FROM dims CROSS JOIN (SELECT i AS k FROM steps WHERE i < 4) q
""")
def prj4(spark, dims):
    e = svg.canvas_edges(dims.withColumn("vb", F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.col("w").cast("double").alias("w"), F.col("h").cast("double").alias("h"))))
    return e.select("floor_id", "primitive_id", "original_type", milli(G.length("pts"), "length"))


@query("prj5_roles", "prims", sql=f"SELECT {_ROLE} AS role, CAST(COUNT(*) AS BIGINT) AS n FROM prims GROUP BY 1")
def prj5(spark, prims):
    return lined(prims).groupBy("role").agg(F.count("*").alias("n"))


@query("prj6_angle", "prims", sql=f"SELECT floor_id, primitive_id, {_M('CASE WHEN x1 = x2 AND y1 = y2 THEN 0 ELSE DEGREES(ATAN2(ABS(y2 - y1), ABS(x2 - x1))) END', 'angle')} FROM prims")
def prj6(spark, prims):
    return lined(prims).select("floor_id", "primitive_id", milli(G.angle("pts"), "angle"))


@query("prj7_circumcenter", "openings", sql=f"SELECT instance_id, {_M('x0 + w / 2', 'x')}, {_M('y0 + h / 2', 'y')} FROM openings WHERE h > 0")
def prj7(spark, openings):
    c = G.circumcenter(G.point("x0", "y0"), G.point(F.col("x0") + F.col("w"), "y0"), G.point("x0", F.col("y0") + F.col("h")))
    return openings.withColumn("c", c).filter("c is not null").select("instance_id", milli("c.x", "x"), milli("c.y", "y"))


@query("prj8_affine", "prims", sql=f"SELECT floor_id, primitive_id, {_M('2 * x1 + 3 * y1 + 5', 'x')}, {_M('7 * x1 - y1 + 1', 'y')} FROM prims")
def prj8(spark, prims):
    p = lined(prims).withColumn("q", G.affine("pts", 2.0, 3.0, 7.0, -1.0, 5.0, 1.0)[0])
    return p.select("floor_id", "primitive_id", milli("q.x", "x"), milli("q.y", "y"))


@query("prj9_placeholder_affine", "dims", sql=f"SELECT floor_id, {_M('0.0075 / w', 'a', 1000000000)}, {_M('0.0010 / h', 'e', 1000000000)}, {_M('29.0301', 'tx', 10000)}, {_M('41.1083', 'ty', 10000)} FROM dims")
def prj9(spark, dims):
    m = dims.withColumn("m", sinks.placeholder_affine(F.col("w").cast("double"), F.col("h").cast("double")))
    return m.select("floor_id", milli(F.col("m")[0], "a", 10**9), milli(F.col("m")[3], "e", 10**9), milli(F.col("m")[4], "tx", 10**4), milli(F.col("m")[5], "ty", 10**4))


@query("prj11_level", "names", sql="""
SELECT floor_id, CASE WHEN file_name LIKE '%\\_12KAT%' ESCAPE '\\' THEN '12' WHEN file_name LIKE '%1.kat%' THEN '1' WHEN file_name LIKE '%2BODRUM%' THEN '-2' WHEN file_name LIKE '%BodrumKat%' THEN '-1' ELSE '0' END AS level FROM names
""")
def prj11(spark, names):
    return names.select("floor_id", svg.level_of("file_name").alias("level"))


@query("prj12_round_lines", "prims", sql=f"""
SELECT floor_id, primitive_id, CAST(2 AS BIGINT) AS n, {_M('x1', 'x1')}, {_M('y2', 'y2')} FROM prims WHERE x1 <> x2 OR y1 <> y2
""")
def prj12(spark, prims):
    p = lined(prims).withColumn("pts", G.drop_repeats(G.round_points(F.concat("pts", F.slice("pts", 2, 1)), 3))).filter((F.size("pts") > 1) & (G.length("pts") >= 0.01))
    return p.select("floor_id", "primitive_id", F.size("pts").cast("long").alias("n"), milli(F.col("pts")[0]["x"], "x1"), milli(F.col("pts")[1]["y"], "y2"))


@query("prj13_ring_to_line", "cells", sql=f"SELECT floor_id, ci, cj, {_M('2 * (maxx - minx + maxy - miny)', 'length')} FROM cells")
def prj13(spark, cells):
    return cells.select("floor_id", "ci", "cj", milli(G.length(G.box("minx", "miny", "maxx", "maxy")), "length"))


@query("prj15_clickable", "cells", sql="""
SELECT facil_type, CASE WHEN facil_type IN ('Stairs', 'Escalator', 'Elevator', 'Deadzone') THEN 'FALSE' ELSE 'TRUE' END AS clickable, CAST(COUNT(*) AS BIGINT) AS n
FROM (SELECT CASE object_sem WHEN 28 THEN 'Stairs' WHEN 30 THEN 'Escalator' WHEN 29 THEN 'Elevator' WHEN 27 THEN 'WC' WHEN 19 THEN 'Kitchen' WHEN 31 THEN 'Auditorium' WHEN 11 THEN 'Office' WHEN 32 THEN 'Parking' WHEN 35 THEN 'Deadzone' END AS facil_type FROM cells WHERE object_sem IS NOT NULL) t GROUP BY 1, 2
""")
def prj15(spark, cells):
    c = cells.filter("object_sem is not null").withColumn("contained_semantics", F.create_map("object_sem", F.lit(1))).withColumn("facil_type", R.type_by_objects())
    return c.groupBy("facil_type", sinks.clickable().alias("clickable")).agg(F.count("*").alias("n"))


@query("prj16_colors", "cells", sql="""
SELECT floor_id, ci, cj, CASE object_sem WHEN 28 THEN '#f7ce4b' WHEN 30 THEN '#f7ce4b' WHEN 29 THEN '#ed702d' WHEN 27 THEN '#ee7ca2' WHEN 19 THEN '#719752' WHEN 31 THEN '#426b51' WHEN 11 THEN '#7ab591' WHEN 32 THEN '#66433e' WHEN 35 THEN '#cbd5e1' ELSE '#ffffff' END AS color FROM cells
""")
def prj16(spark, cells):
    m = F.when(F.col("object_sem").isNotNull(), F.create_map(F.coalesce("object_sem", F.lit(0)), F.lit(1)))
    return cells.withColumn("contained_semantics", m).withColumn("facil_type", R.type_by_objects()).select("floor_id", "ci", "cj", sinks.type_color().alias("color"))


@query("prj10_multipolygon", "cells", sql="SELECT floor_id, ci, cj, CAST(1 AS BIGINT) AS polygons, CAST(5 AS BIGINT) AS points FROM cells WHERE (ci + cj) % 3 <> 0")
def prj10(spark, cells):
    poly = F.when((F.col("ci") + F.col("cj")) % 3 != 0, F.array(F.array(G.box("minx", "miny", "maxx", "maxy"))))
    return cells.withColumn("g", poly).filter("g is not null").select("floor_id", "ci", "cj", F.size("g").cast("long").alias("polygons"), F.size(F.col("g")[0][0]).cast("long").alias("points"))


@query("flt1_hatching", "prims", sql="""
SELECT floor_id, CAST(SUM(CASE WHEN x2 - x1 = 3 AND y2 - y1 = 3 OR (x2 - x1 < 10 AND ABS(x2 - x1 - 3) < 1e-9 AND ABS(y2 - y1 - 3) < 1e-9) THEN 1 ELSE 0 END) AS BIGINT) AS removed, CAST(COUNT(*) AS BIGINT) AS n FROM prims GROUP BY floor_id
""")
def flt1(spark, prims):
    return lined(prims).groupBy("floor_id").agg(F.count_if(R.is_hatching()).alias("removed"), F.count("*").alias("n"))


@query("flt2_countable", "prims", sql="SELECT floor_id, CAST(COUNT(*) AS BIGINT) AS n FROM prims WHERE instance_id IS NOT NULL AND instance_id <> -1 GROUP BY floor_id")
def flt2(spark, prims):
    return prims.filter(R.countable()).groupBy("floor_id").agg(F.count("*").alias("n"))


_BOX = "SELECT floor_id, instance_id, semantic_id, x0 AS minx, y0 AS miny, x0 + w AS maxx, y0 + h AS maxy FROM openings"
_GATE = """CASE WHEN maxx - minx < 1 AND maxy - miny < 1 THEN 'small' WHEN (maxx - minx) * (maxy - miny) / 19600 > 0.05 THEN 'mega' WHEN (maxx - minx) * (maxy - miny) < 0.01 THEN 'area' WHEN LEAST(maxx - minx, maxy - miny) < 0.1 THEN 'thin' END"""


def opening_lines(openings: DataFrame) -> DataFrame:
    a = openings.withColumn("pts", G.line("x0", "y0", F.col("x0") + F.col("w"), "y0")).withColumn("ord", F.lit(0))
    b = openings.withColumn("pts", G.line("x0", F.col("y0") + F.col("h"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h"))).withColumn("ord", F.lit(1))
    return a.unionAll(b).withColumn("original_type", F.lit("segment")).withColumn("kind", F.lit("line")).withColumn("stroke", F.lit("rgb(1,2,3)"))


def gated(openings: DataFrame) -> DataFrame:
    return R.instance_boxes(opening_lines(openings)).withColumn("total_area", F.lit(CANVAS * CANVAS)).withColumn("reason", R.rect_gate())


@query("flt7_rect_gates", "openings", sql=f"WITH b AS ({_BOX}) SELECT COALESCE({_GATE}, 'kept') AS reason, CAST(COUNT(*) AS BIGINT) AS n, {_M('SUM((maxx - minx) * (maxy - miny))', 'area')} FROM b GROUP BY 1")
def flt7(spark, openings):
    g = gated(openings)
    return g.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"), milli(F.sum((F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))), "area"))


@query("agg1_instance_boxes", "openings", sql=f"WITH b AS ({_BOX}) SELECT floor_id, instance_id, semantic_id, {_M('minx', 'minx')}, {_M('miny', 'miny')}, {_M('maxx', 'maxx')}, {_M('maxy', 'maxy')} FROM b")
def agg1(spark, openings):
    b = R.instance_boxes(opening_lines(openings))
    return b.select("floor_id", "instance_id", "semantic_id", *(milli(c, c) for c in ("minx", "miny", "maxx", "maxy")))


@query("agg2_extent_area", "prims", sql=f"SELECT floor_id, {_M('(MAX(GREATEST(x1, x2)) - MIN(LEAST(x1, x2))) * (MAX(GREATEST(y1, y2)) - MIN(LEAST(y1, y2)))', 'area')} FROM prims WHERE semantic_id IN (33, 34) GROUP BY floor_id")
def agg2(spark, prims):
    return R.extent_area(lined(prims).filter("role = 'boundary'")).select("floor_id", milli("total_area", "area"))


@query("agg3_instance_centroids", "prims", sql=f"""
WITH o AS (SELECT floor_id, CASE WHEN COALESCE(instance_id, -1) < 0 THEN -primitive_id - 2 ELSE CAST(instance_id AS BIGINT) END AS object, semantic_id, x1, y1, x2, y2, SQRT((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS l FROM prims WHERE {_ROLE} = 'classification')
SELECT floor_id, object, semantic_id, {_M('SUM(l * (x1 + x2) / 2) / SUM(l)', 'x')}, {_M('SUM(l * (y1 + y2) / 2) / SUM(l)', 'y')} FROM o GROUP BY 1, 2, 3
""")
def agg3(spark, prims):
    return R.instance_centroids(lined(prims).filter("role = 'classification'")).select("floor_id", "object", "semantic_id", milli("x", "x"), milli("y", "y"))


@query("agg4_door_hinge", "openings", sql=f"SELECT floor_id, instance_id, {_M('x0 + w', 'x')}, {_M('y0', 'y')} FROM openings")
def agg4(spark, openings):
    a = openings.withColumn("pts", G.arc("x0", "y0", "w", "w", F.lit(0.0), F.lit(0), F.lit(1), F.col("x0") + 2 * F.col("w"), "y0")).withColumn("ord", F.lit(0))
    b = openings.withColumn("pts", G.arc("x0", "y0", F.lit(0.2), F.lit(0.2), F.lit(0.0), F.lit(0), F.lit(1), F.col("x0") + 0.4, "y0")).withColumn("ord", F.lit(1))
    h = R.hinges(a.unionAll(b).withColumn("original_type", F.lit("arc")))
    return h.select("floor_id", "instance_id", milli("hinge.x", "x"), milli("hinge.y", "y"))


@query("agg5_percentiles", "thick", sql=f"SELECT floor_id, {_M('QUANTILE_CONT(thickness, 0.1)', 'p10')}, {_M('QUANTILE_CONT(thickness, 0.5)', 'p50')}, {_M('QUANTILE_CONT(thickness, 0.9)', 'p90')} FROM thick WHERE face_id % 7 <> 0 GROUP BY floor_id")
def agg5(spark, thick):
    """Faces that weren't measured don't count."""
    p = stats.percentiles(thick.withColumn("thickness", F.when(F.col("face_id") % 7 != 0, F.col("thickness"))))
    return p.select("floor_id", *(milli(f"thickness_p{k}", f"p{k}") for k in (10, 50, 90)))


@query("agg6_synth_radius", "dims", sql=f"SELECT floor_id, {_M('CASE WHEN floor_id % 5 = 0 THEN 0.5 ELSE (3 + floor_id % 3) * 0.2 END', 'radius')} FROM dims")
def agg6(spark, dims):
    """Half the width that a stroke between two rooms is given: a fifth of the median of three walls' thicknesses, or the default where there are none."""
    h, t = F.col("h").cast("double"), (3 + F.col("floor_id") % 3).cast("double")
    face = lambda i, role, x, y, w, h: F.struct(F.lit(i).cast("long").alias("face_id"), F.lit(role).alias("role"), G.box(x, y, x + w, y + h).alias("shell"))
    at = lambda x: F.lit(float(x))
    rooms = [face(0, "room", at(0), at(0), at(10), h), face(1, "room", at(10), at(0), at(10), h)]
    walls = [face(2, "wall", at(40), at(0), at(2), at(50)), face(3, "wall", at(60), at(0), t, at(50)), face(4, "wall", at(80), at(0), at(8), at(50))]
    shapes = dims.withColumn("t", t).select("floor_id", F.explode(F.when(F.col("floor_id") % 5 == 0, F.array(*rooms)).otherwise(F.array(*rooms, *walls))).alias("f")).select("floor_id", "f.*")
    shapes = shapes.withColumn("facil_type", F.lit("Office")).withColumn("holes", F.array().cast(f"array<{G.POINTS}>"))
    w = floors.walls_and_outline(shapes, dims.select("floor_id", G.line(at(10), at(0), at(10), h).alias("pts"))).filter("role = 'wall' and members[0] < 0")
    return w.join(dims.select("floor_id", "h"), "floor_id").select("floor_id", milli(F.col("area") / (2 * F.col("h")), "radius"))


@query("agg8_otsu", "thick", sql=f"""
WITH g AS (SELECT floor_id, LOG10(thickness) AS g FROM thick),
lim AS (SELECT floor_id, MIN(g) AS lo, MAX(g) AS hi FROM g GROUP BY floor_id),
b AS (SELECT g.floor_id, lo, hi, LEAST(CAST(FLOOR((g - lo) / (hi - lo) * 64) AS INT), 63) AS bin FROM g JOIN lim ON g.floor_id = lim.floor_id),
h AS (SELECT floor_id, lo, hi, bin, COUNT(*) AS c, COUNT(*) * (lo + (bin + 0.5) * (hi - lo) / 64) AS s FROM b GROUP BY 1, 2, 3, 4),
c AS (SELECT *, SUM(c) OVER w AS wb, SUM(s) OVER w AS sb, SUM(c) OVER (PARTITION BY floor_id) AS wt, SUM(s) OVER (PARTITION BY floor_id) AS st FROM h WINDOW w AS (PARTITION BY floor_id ORDER BY bin)),
v AS (SELECT *, wb * (wt - wb) * (sb / wb - (st - sb) / (wt - wb)) * (sb / wb - (st - sb) / (wt - wb)) AS v FROM c WHERE wb < wt),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY floor_id ORDER BY v DESC, bin) AS k FROM v)
SELECT floor_id, {_M('lo + (bin + 1) * (hi - lo) / 64', 'log_cut')} FROM k WHERE k = 1
""")
def agg8(spark, thick):
    return R.otsu(thick).select("floor_id", milli("log_cut", "log_cut"))


@query("win1_largest_gap", "thick", sql=f"""
WITH s AS (SELECT floor_id, LOG10(thickness) AS g, ROW_NUMBER() OVER w AS i, LEAD(LOG10(thickness)) OVER w AS nxt, COUNT(*) OVER (PARTITION BY floor_id) AS n FROM thick WINDOW w AS (PARTITION BY floor_id ORDER BY thickness)),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY floor_id ORDER BY (nxt - g) * LEAST(i, n - i) DESC, i) AS k FROM s WHERE nxt > g)
SELECT floor_id, {_M('POWER(10, (g + nxt) / 2)', 'threshold')}, {_M('nxt - g', 'gap')} FROM k WHERE k = 1
""")
def win1(spark, thick):
    return R.largest_gap(thick).select("floor_id", milli(F.pow(F.lit(10.0), "log_mid"), "threshold"), milli("gap", "gap"))


@query("win2_win3_thresholds", "thick", sql=f"""
WITH s AS (SELECT floor_id, LOG10(thickness) AS g, ROW_NUMBER() OVER w AS i, LEAD(LOG10(thickness)) OVER w AS nxt, COUNT(*) OVER (PARTITION BY floor_id) AS n FROM thick WINDOW w AS (PARTITION BY floor_id ORDER BY thickness)),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY floor_id ORDER BY (nxt - g) * LEAST(i, n - i) DESC, i) AS k FROM s WHERE nxt > g),
t AS (SELECT floor_id, POWER(10, (g + nxt) / 2) AS t, nxt - g AS gap FROM k WHERE k = 1),
m AS (SELECT floor_id, MAX(CASE WHEN hatched THEN thickness END) + 1e-6 AS needed FROM thick GROUP BY floor_id)
SELECT t.floor_id, {_M('CASE WHEN needed > t THEN needed ELSE t END', 'threshold')}, CASE WHEN needed > t THEN 'largest_gap+hatching_calibrated' ELSE 'largest_gap' END AS method FROM t JOIN m ON t.floor_id = m.floor_id
""")
def win2(spark, thick):
    return R.thresholds(thick).select("floor_id", milli("threshold", "threshold"), "method")


@query("win4_drop_repeats", "prims", sql="SELECT floor_id, primitive_id, CAST(CASE WHEN x1 = x2 AND y1 = y2 THEN 1 ELSE 3 END AS BIGINT) AS n FROM prims")
def win4(spark, prims):
    p = G.drop_repeats(F.concat("pts", F.slice("pts", 2, 1), F.slice("pts", 1, 1)))
    return lined(prims).select("floor_id", "primitive_id", F.size(p).cast("long").alias("n"))


@query("win5_paint_order", "cells", sql="SELECT floor_id, ci, cj, CAST(ROW_NUMBER() OVER (PARTITION BY floor_id ORDER BY area * (ci + 1) DESC, ci, cj) - 1 AS BIGINT) AS seq FROM cells")
def win5(spark, cells):
    r = rooms_of(cells).withColumn("area", F.col("area") * (F.col("ci") + 1)).withColumn("region_id", F.col("ci") * 100 + F.col("cj"))
    seq = sinks.svg_elements(r.withColumn("element_key", F.col("region_id")))
    # The element's path begins with its cell's corner, which names the cell.
    corner = F.split(F.regexp_extract("element", r'd="M ([-\d.]+ [-\d.]+)', 1), " ")
    cell = cells.select("floor_id", "ci", "cj", F.format_string("%.3f", "minx").alias("x"), F.format_string("%.3f", "miny").alias("y"))
    return seq.select("floor_id", "seq", corner[0].alias("x"), corner[1].alias("y")).join(cell, ["floor_id", "x", "y"]).select("floor_id", "ci", "cj", "seq")


def rooms_of(cells: DataFrame) -> DataFrame:
    """Grid cells as regions with objects and types."""
    m = F.when(F.col("object_sem").isNotNull(), F.create_map(F.coalesce("object_sem", F.lit(0)), F.lit(1))).otherwise(F.create_map().cast("map<int,int>"))
    c = cells.withColumn("contained_semantics", m).withColumn("facil_type", R.type_by_objects()).withColumn("shell", G.box("minx", "miny", "maxx", "maxy"))
    return c.withColumn("polygons", F.array(F.array("shell"))).withColumn("role", F.lit("room")).withColumn("region_id", F.col("ci") * 100 + F.col("cj")).withColumn("stroke", F.lit("")).withColumn("facil_name", F.lit(None).cast("string"))


_TYPE = "CASE object_sem WHEN 28 THEN 'Stairs' WHEN 30 THEN 'Escalator' WHEN 29 THEN 'Elevator' WHEN 27 THEN 'WC' WHEN 19 THEN 'Kitchen' WHEN 31 THEN 'Auditorium' WHEN 11 THEN 'Office' WHEN 32 THEN 'Parking' WHEN 35 THEN 'Deadzone' END"


@query("cls1_type_by_objects", "cells", sql=f"SELECT floor_id, ci, cj, {_TYPE} AS facil_type FROM cells")
def cls1(spark, cells):
    return rooms_of(cells).select("floor_id", "ci", "cj", "facil_type")


@query("cls2_kitchen_near_wc", "cells", sql=f"""
WITH t AS (SELECT *, {_TYPE} AS facil_type FROM cells)
SELECT k.floor_id, k.ci, k.cj, CASE WHEN k.facil_type = 'Kitchen' AND EXISTS (SELECT 1 FROM t w WHERE w.floor_id = k.floor_id AND w.facil_type = 'WC' AND ABS(w.ci - k.ci) <= 1 AND ABS(w.cj - k.cj) <= 1) THEN 'WC' ELSE k.facil_type END AS facil_type FROM t k
""")
def cls2(spark, cells):
    return R.kitchens_near_wc(rooms_of(cells)).select("floor_id", "ci", "cj", "facil_type")


@query("cls3_type_by_shape", "cells", sql=f"SELECT floor_id, ci, cj, COALESCE({_TYPE}, CASE WHEN LEAST(maxx - minx, maxy - miny) * 1.5 < 14 THEN 'Walkways' ELSE 'Office' END) AS facil_type FROM cells")
def cls3(spark, cells):
    wide = rooms_of(cells).withColumn("shell", F.transform("shell", lambda p: G.point(p["x"] * 1.5, p["y"] * 1.5))).withColumn("area", G.area("shell")).withColumn("holes", F.array().cast(f"array<{G.POINTS}>"))
    m = floors.measure(wide.select("floor_id", "ci", "cj", "facil_type", "shell", "holes", "area"))
    return m.select("floor_id", "ci", "cj", R.type_by_shape().alias("facil_type"))


@query("cls4_final_role", "thick", sql="""
WITH f AS (SELECT floor_id, face_id, thickness, CAST(face_id % 200 + 1 AS DOUBLE) AS area, CAST(face_id % 10 AS DOUBLE) / 10 AS aspect, face_id % 13 = 0 AS locked FROM thick)
SELECT floor_id, face_id, CASE WHEN locked THEN 'room:locked' WHEN area < 25 THEN 'wall:small' WHEN area <= 100 AND aspect >= 0.6 THEN 'wall:column' WHEN thickness < 0.7 THEN 'wall:sliver' WHEN thickness < 5 THEN 'wall:thin' ELSE 'room:thick' END AS role FROM f
""")
def cls4(spark, thick):
    f = thick.withColumns({"area": (F.col("face_id") % 200 + 1).cast("double"), "aspect": (F.col("face_id") % 10).cast("double") / 10.0, "locked": F.col("face_id") % 13 == 0, "threshold": F.lit(5.0)})
    return f.select("floor_id", "face_id", R.final_role().alias("role"))


@query("agg11_affine", "controls", sql=f"""
WITH s AS (SELECT floor_id, REGR_AVGX(gx, sx) AS mx, AVG(sy) AS my, AVG(gx) AS mg, AVG(gy) AS mh FROM controls GROUP BY floor_id),
d AS (SELECT c.floor_id, sx - mx AS u, sy - my AS v, gx - mg AS p, gy - mh AS q, mx, my, mg, mh FROM controls c JOIN s ON c.floor_id = s.floor_id),
t AS (SELECT floor_id, mx, my, mg, mh, SUM(u * u) AS uu, SUM(u * v) AS uv, SUM(v * v) AS vv, SUM(u * p) AS up, SUM(v * p) AS vp, SUM(u * q) AS uq, SUM(v * q) AS vq FROM d GROUP BY 1, 2, 3, 4, 5),
r AS (SELECT floor_id, mx, my, mg, mh, (up * vv - vp * uv) / (uu * vv - uv * uv) AS a, (vp * uu - up * uv) / (uu * vv - uv * uv) AS b, (uq * vv - vq * uv) / (uu * vv - uv * uv) AS c, (vq * uu - uq * uv) / (uu * vv - uv * uv) AS e FROM t)
SELECT floor_id, {_M('a', 'a', 10**8)}, {_M('b', 'b', 10**8)}, {_M('c', 'd', 10**8)}, {_M('e', 'e', 10**8)}, {_M('mg - a * mx - b * my', 'tx', 10**5)}, {_M('mh - c * mx - e * my', 'ty', 10**5)} FROM r
""")
def agg11(spark, controls):
    return R.fit_affine(controls).select("floor_id", *(milli(c, c, 10**8) for c in "abde"), milli("tx", "tx", 10**5), milli("ty", "ty", 10**5))


@query("agg7_stats", "prims", sql=f"SELECT floor_id, {_ROLE} AS role, CAST(COUNT(*) AS BIGINT) AS n, {_M('SUM(SQRT((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))', 'length')} FROM prims GROUP BY 1, 2")
def agg7(spark, prims):
    return lined(prims).groupBy("floor_id", "role").agg(F.count("*").alias("n"), milli(F.sum(G.length("pts")), "length"))


@query("agg10_bounds", "prims", sql=f"SELECT floor_id, {_M('MIN(LEAST(x1, x2))', 'minx')}, {_M('MIN(LEAST(y1, y2))', 'miny')}, {_M('MAX(GREATEST(x1, x2))', 'maxx')}, {_M('MAX(GREATEST(y1, y2))', 'maxy')} FROM prims GROUP BY floor_id")
def agg10(spark, prims):
    b = lined(prims).withColumn("b", G.bounds("pts"))
    return b.groupBy("floor_id").agg(milli(F.min("b.minx"), "minx"), milli(F.min("b.miny"), "miny"), milli(F.max("b.maxx"), "maxx"), milli(F.max("b.maxy"), "maxy"))


@query("snk5_path_data", "cells", sql="""
SELECT floor_id, ci, cj, printf('M %.3f %.3f L %.3f %.3f L %.3f %.3f L %.3f %.3f L %.3f %.3f Z', minx, miny, maxx, miny, maxx, maxy, minx, maxy, minx, miny) AS d FROM cells
""")
def snk5(spark, cells):
    return cells.select("floor_id", "ci", "cj", G.path_data(G.box("minx", "miny", "maxx", "maxy")).alias("d"))


@query("snk6_rgb_hex", "dims", sql="SELECT floor_id, CASE WHEN floor_id % 5 = 0 THEN '#888888' ELSE printf('#%02x%02x%02x', CAST(floor_id % 256 AS INT), CAST(nc * 16 AS INT), CAST(h AS INT)) END AS color FROM dims")
def snk6(spark, dims):
    text = F.when(F.col("floor_id") % 5 == 0, "none").otherwise(F.format_string("rgb( %d,%d , %d)", F.col("floor_id") % 256, F.col("nc") * 16, F.col("h")))
    return dims.select("floor_id", G.rgb_hex(text).alias("color"))


from planweave import queries_floors  # noqa: E402, F401  more queries register themselves
