"""Georeferencing and the GeoJSON and SVG sinks."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planweave.config import DOOR_COLOR, NOT_CLICKABLE, OPEN_EDGE, OPEN_FILL, TYPE_COLORS, WALL_EDGE, WALL_FILL, WINDOW_COLOR
from planweave.functions import geom as G

# Where drawings without control points are put, and over what span of degrees.
PLACE_LON, PLACE_LAT, SPAN_LON, SPAN_LAT = 29.0301, 41.1083, 0.0075, 0.0010


def placeholder_affine(width, height) -> Column:
    """[a, b, d, e, tx, ty] that puts a canvas on the fixed place; raises unless both sizes are positive."""
    w, h = F.col(width) if isinstance(width, str) else width, F.col(height) if isinstance(height, str) else height
    ok = lambda v: F.when((w > 0) & (h > 0), v).otherwise(F.raise_error("canvas sizes must be positive").cast("double"))
    return F.array(ok(F.lit(SPAN_LON) / w), F.lit(0.0), F.lit(0.0), ok(F.lit(SPAN_LAT) / h), F.lit(PLACE_LON), F.lit(PLACE_LAT))


def clickable(facil_type="facil_type") -> Column:
    return F.when(F.col(facil_type).isin(*NOT_CLICKABLE), "FALSE").otherwise("TRUE")


def type_color(facil_type="facil_type", default: str = OPEN_FILL) -> Column:
    pairs = F.create_map(*(F.lit(x) for kv in TYPE_COLORS.items() for x in kv))
    return F.coalesce(pairs[F.col(facil_type)], F.lit(default))


# Fixed values in what follows: names and order of properties, colours, opacities and widths of the formats.
def features(regions: DataFrame, levels: DataFrame, window_as: str = "Window", stable_ids: bool = False) -> DataFrame:
    """floor_id, seq and a GeoJSON feature string for each region: walls, doors, windows, then typed rooms.

    ``regions``: floor_id, region_id, role, facil_type, facil_name, polygons (array<array<ring>>); ``levels``: floor_id, level_id and the six numbers a, b, d, e, tx, ty.
    """
    kind = F.when(F.col("role") == "wall", "Wall").when(F.col("role") == "door", F.coalesce("facil_type", F.lit("Door"))).when(F.col("role") == "window", window_as).otherwise(F.col("facil_type"))
    rank = F.when(F.col("role") == "wall", 0).when(F.col("role") == "door", 1).when(F.col("role") == "window", 2).otherwise(3)
    own = regions.filter("role in ('wall', 'door', 'window', 'room') and size(polygons) > 0").withColumn("kind", kind).filter("kind is not null").join(levels, "floor_id")
    move = lambda p: F.array(F.col("a") * p["x"] + F.col("b") * p["y"] + F.col("tx"), F.col("d") * p["x"] + F.col("e") * p["y"] + F.col("ty"))
    coords = F.transform("polygons", lambda poly: F.transform(poly, lambda ring: F.transform(ring, move)))
    new_id = lambda salt: F.sha2(F.concat_ws("/", F.lit(salt), "floor_id", "region_id"), 256) if stable_ids else F.expr("uuid()")
    props = F.struct(
        new_id("id").alias("id"), F.concat(F.lit("{"), new_id("click"), F.lit("}")).alias("clickId"), F.when(F.col("kind").isin(*NOT_CLICKABLE), "FALSE").otherwise("TRUE").alias("isClickable"),
        F.col("kind").alias("facilType"), F.coalesce("facil_name", F.lit("")).alias("facilName"), F.col("level_id").alias("level_id"), F.col("level_id").alias("floorLevel"),
    )
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), props.alias("properties"), F.struct(F.lit("MultiPolygon").alias("type"), coords.alias("coordinates")).alias("geometry")))
    w = Window.partitionBy("floor_id").orderBy("rank", "region_id")
    return own.withColumn("rank", rank).select("floor_id", (F.row_number().over(w) - 1).cast("long").alias("seq"), F.col("kind").alias("facil_type"), feature.alias("feature"))


# The head of a document.
HEAD = '{"type":"FeatureCollection","name":%s,"crs":{"type":"name","properties":{"name":"urn:ogc:def:crs:OGC:1.3:CRS84"}},"features":['


def feature_collection(feats: DataFrame, name: str, *by: str) -> DataFrame:
    """A document of all features in order of floor and seq, or one for each ``by`` (such as floor_id), which many floors need: one document is one row."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("floor_id", "seq", "feature"))), lambda f: f["feature"]), ",")
    return feats.groupBy(*by).agg(F.concat(F.lit(HEAD % json.dumps(name, ensure_ascii=False)), body, F.lit("]}")).alias("document"))


def no_features(spark) -> DataFrame:
    return spark.createDataFrame([], "floor_id long, seq long, facil_type string, feature string")


def write_geojson(feats: DataFrame, path: str, name: str) -> None:
    """The one document of an export, a feature on each line, folders made. The driver writes it from one partition at a time, in order of floor and seq."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(HEAD % json.dumps(name, ensure_ascii=False))
        mark = "\n"
        for row in feats.select("floor_id", "seq", "feature").orderBy("floor_id", "seq").toLocalIterator():
            out.write(mark + row.feature)
            mark = ",\n"
        out.write("\n]}\n")


def write_lines(feats: DataFrame, path: str) -> None:
    """Line-delimited features in shards, written by the executors, for exports of any size."""
    feats.select("feature").write.text(path)


def svg_elements(regions: DataFrame) -> DataFrame:
    """floor_id, seq, element: a path for each region, rooms by falling area, then walls, doors, windows."""
    rank = F.when(F.col("role") == "room", 0).when(F.col("role") == "wall", 1).when(F.col("role") == "door", 2).when(F.col("role") == "window", 3)
    own = regions.withColumn("rank", rank).filter("rank is not null")
    d = F.array_join(F.filter(F.transform(F.flatten("polygons"), lambda r: G.path_data(r)), lambda s: s != ""), " ")
    typed = F.col("facil_type").isin(*TYPE_COLORS)
    door = G.rgb_hex(F.coalesce("stroke", F.lit("")), DOOR_COLOR)
    fill = F.when(F.col("rank") == 0, type_color()).when(F.col("rank") == 1, WALL_FILL).when(F.col("rank") == 2, door).otherwise(WINDOW_COLOR)
    edge = F.when(F.col("rank") == 0, F.when(typed, type_color()).otherwise(OPEN_EDGE)).when(F.col("rank") == 1, WALL_EDGE).otherwise(fill)
    opacity = F.when(F.col("rank") == 0, F.when(typed, "0.65").otherwise("0.50")).otherwise("0.85")
    width = F.when(F.col("rank") == 0, "0.40").otherwise("0.60")
    w = Window.partitionBy("floor_id").orderBy("rank", F.when(F.col("rank") == 0, -F.col("area")).otherwise(0.0), "region_id")
    return own.withColumn("d", d).filter("d <> ''").select("floor_id", (F.row_number().over(w) - 1).cast("long").alias("seq"), F.format_string('  <path d="%s" fill="%s" fill-opacity="%s" stroke="%s" stroke-width="%s"/>', "d", fill, opacity, edge, width).alias("element"))


def svg_documents(regions: DataFrame, bounds: DataFrame) -> DataFrame:
    """floor_id and a whole SVG drawing with its view box on ``bounds`` and the y axis up."""
    body = svg_elements(regions).groupBy("floor_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "element"))), lambda e: e["element"]), "\n").alias("body"))
    head = F.format_string(
        '<?xml version="1.0" encoding="UTF-8"?>\n<svg xmlns="http://www.w3.org/2000/svg" viewBox="%.3f %.3f %.3f %.3f">\n<g transform="scale(1 -1) translate(0 %.3f)" fill-rule="evenodd">\n',
        "minx", "miny", F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"), -(F.col("miny") + F.col("maxy")),
    )
    return bounds.join(body, "floor_id", "left").select("floor_id", F.concat(head, F.coalesce("body", F.lit("")), F.lit("\n</g>\n</svg>")).alias("svg"))


def fit_to_square(rings: DataFrame, size: float = 500.0) -> DataFrame:
    """Path data of rings (doc_id, feature, ring, pts) stretched over a square, y down."""
    lim = rings.withColumn("b", G.bounds("pts")).groupBy("doc_id").agg(F.min("b.minx").alias("x0"), F.min("b.miny").alias("y0"), F.max("b.maxx").alias("x1"), F.max("b.maxy").alias("y1"))
    move = lambda p: G.point((p["x"] - F.col("x0")) * size / (F.col("x1") - F.col("x0")), size - (p["y"] - F.col("y0")) * size / (F.col("y1") - F.col("y0")))
    return rings.join(lim, "doc_id").select("doc_id", "feature", "ring", F.transform("pts", move).alias("pts"))
