"""SVG drawings as rows. One pass over the XML in Python gives elements; everything after it is Column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.config import Parsing
from planweave.functions import geom as G

ELEMENTS = (
    "floor_id long, ord long, tag string, primitive_id string, semantic_id string, instance_id string, original_type string, layer string, "
    "stroke string, d string, cx string, cy string, r string, rx string, ry string, view_box string"
)
_ATTRIBUTES = ("primitiveId", "semanticId", "instanceId", "originalType", "layer", "stroke", "d", "cx", "cy", "r", "rx", "ry")
_SVG = "{http://www.w3.org/2000/svg}"
_NUMBER = r"[-\d.eE+]+"
CANVAS_IDS = 1_000_000


def parse_xml(text: str | bytes):
    """The root of a document without a document type: drawings are untrusted, and declarations could expand without end."""
    from xml.etree import ElementTree

    raw = text.encode() if isinstance(text, str) else bytes(text)
    if re.search(rb"<!(DOCTYPE|ENTITY)", raw, re.I):
        raise ValueError("document type declarations are refused")
    return ElementTree.fromstring(raw)


def read_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """floor_id, path, content of SVG files; missing files are the caller's to skip. Each file is one floor."""
    df = spark.read.format("binaryFile").load(paths)
    return df.select(F.xxhash64("path").alias("floor_id"), "path", F.col("content").cast("string").alias("content"))


def elements(documents: DataFrame) -> DataFrame:
    """Elements of (floor_id, content): all paths in document order, then circles, then ellipses; a drawing without any has one row with its view box."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for floor, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                root = parse_xml(text)
                rows = [(t, e) for t in ("path", "circle", "ellipse") for e in root.iter(_SVG + t)]
                n, box = max(1, len(rows)), root.get("viewBox")
                cols = {a: [e.get(a) for _, e in rows] or [None] for a in _ATTRIBUTES}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([floor] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array([t for t, _ in rows] or [None], pa.string()), *(pa.array(cols[a], pa.string()) for a in _ATTRIBUTES), pa.array([box] * n, pa.string())], names
                )

    names = [c.split()[0] for c in ELEMENTS.split(", ")]
    return documents.select("floor_id", "content").mapInArrow(run, ELEMENTS)


def view_box(text):
    """Four doubles; raises unless the text has exactly four numbers between white space."""
    names = ("x", "y", "w", "h")

    def numbers(parts):
        bad = F.raise_error(F.concat(F.lit("bad viewBox: "), F.array_join(parts, " "))).cast("double")
        return F.struct(*(F.when(F.size(parts) == 4, F.get(parts, F.lit(i)).cast("double")).otherwise(bad).alias(n) for i, n in enumerate(names)))

    return G.let(F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), " "), numbers)


def with_points(rows: DataFrame, resolution: int = 20) -> DataFrame:
    """Elements with ``pts``: their points before translation, null where the element is skipped."""
    numbered = rows.withColumn("numbers", F.regexp_extract_all("d", F.lit(rf"({_NUMBER})"), F.lit(1)))
    return numbered.withColumn("pts", _geometry(resolution)).drop("numbers")


def _geometry(resolution: int):
    # What a segment and an arc look like. One pass over the text gives all its numbers, in order.
    seg = rf"^M\s*({_NUMBER})[\s,]+({_NUMBER})\s*L\s*({_NUMBER})[\s,]+({_NUMBER})"
    arc = rf"^M\s*({_NUMBER})[\s,]+({_NUMBER})\s*A\s*({_NUMBER})[\s,]+({_NUMBER})\s+({_NUMBER})\s+([01])[\s,]+([01])\s+({_NUMBER})[\s,]+({_NUMBER})"
    d = F.trim("d")
    n = lambda i: F.get("numbers", F.lit(i)).cast("double")
    num = lambda c: F.col(c).cast("double")
    return (
        F.when((F.col("tag") == "path") & (F.col("original_type") == "segment") & d.rlike(seg), G.line(n(0), n(1), n(2), n(3)))
        .when((F.col("tag") == "path") & (F.col("original_type") == "arc") & d.rlike(arc), G.arc(n(0), n(1), n(2), n(3), n(4), n(5), n(6), n(7), n(8), resolution))
        .when((F.col("tag") == "circle") & (num("r") > 0) & num("cx").isNotNull() & num("cy").isNotNull(), G.ellipse(num("cx"), num("cy"), num("r"), num("r")))
        .when((F.col("tag") == "ellipse") & (num("rx") > 0) & (num("ry") > 0) & num("cx").isNotNull() & num("cy").isNotNull(), G.ellipse(num("cx"), num("cy"), num("rx"), num("ry")))
    )


def role(semantic="semantic_id", config: Parsing = Parsing()):
    s = F.col(semantic)
    return F.when(s.isNull(), "skipped").when(s.isin(*config.boundary_semantic_ids), "boundary").when(s.isin(*config.door_semantic_ids), "door").when(s.isin(*config.window_semantic_ids), "window").otherwise("classification")


def primitives(rows: DataFrame, config: Parsing = Parsing()) -> DataFrame:
    """Primitives of elements, in floor coordinates, with the four canvas edges, and their roles."""
    own = rows.withColumn("vb", view_box(F.col("view_box")))
    parsed = (
        with_points(own.filter("primitive_id is not null"), config.arc_resolution).filter("pts is not null")
        .withColumn("pts", F.when((F.col("vb.x") != 0) | (F.col("vb.y") != 0), G.move("pts", -F.col("vb.x"), -F.col("vb.y"))).otherwise(F.col("pts")))
    )
    if config.y_flip:
        parsed = parsed.withColumn("pts", G.flip_y("pts", F.col("vb.h")))
    kind = F.when(F.col("tag") == "path", "line").otherwise("polygon")
    parsed = parsed.withColumn("pts", F.when(kind == "line", G.snap_to_canvas("pts", F.col("vb.w"), F.col("vb.h"), config.boundary_snap_tolerance)).otherwise(F.col("pts")))
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    parsed = parsed.select("floor_id", "ord", F.col("primitive_id").cast("long").alias("primitive_id"), F.col("semantic_id").cast("int").alias("semantic_id"), F.col("instance_id").cast("int").alias("instance_id"), text("original_type"), text("layer"), text("stroke"), kind.alias("kind"), "pts")
    return parsed.unionByName(canvas_edges(own)).withColumn("role", role("semantic_id", config))


def canvas_edges(own: DataFrame) -> DataFrame:
    """The four edges of each floor's canvas; their semantic id is null, so that they count as skipped."""
    w, h = F.col("vb.w"), F.col("vb.h")
    edges = F.array(G.line(0.0, 0.0, w, 0.0), G.line(w, 0.0, w, h), G.line(w, h, 0.0, h), G.line(0.0, h, 0.0, 0.0))
    floors = own.groupBy("floor_id").agg(F.first("vb").alias("vb"))
    return floors.select("floor_id", F.posexplode(edges).alias("k", "pts")).select(
        "floor_id", (F.lit(1 << 40) + F.col("k")).cast("long").alias("ord"), (F.lit(CANVAS_IDS) + F.col("k")).cast("long").alias("primitive_id"), F.lit(None).cast("int").alias("semantic_id"), F.lit(None).cast("int").alias("instance_id"),
        F.lit("boundary").alias("original_type"), F.lit("").alias("layer"), F.lit("").alias("stroke"), F.lit("line").alias("kind"), "pts",
    )


def level_of(name):
    """Floor level from a file name of the Turkish kind: basements negative, ground and unknown 0."""
    n = F.col(name) if isinstance(name, str) else name
    # How names say the level.
    basement, bare, ground, floor = r"(?iu)_(\d+)\s*BODRUM", r"(?iu)_BODRUM(?:KAT)?[_.]", r"(?iu)_ZEM[İI]N(?:KAT)?[_.]", r"(?iu)_(\d+)\s*\.?\s*KAT"
    return F.when(n.rlike(basement), F.concat(F.lit("-"), F.regexp_extract(n, basement, 1))).when(n.rlike(bare), "-1").when(n.rlike(ground), "0").when(n.rlike(floor), F.regexp_extract(n, floor, 1)).otherwise("0")


def input_spec(spec):
    """``path[=level]``, parted at the last equals sign."""
    s = F.col(spec) if isinstance(spec, str) else spec
    has = F.instr(s, "=") > 0
    level = F.substring_index(s, "=", -1)
    return F.struct(F.when(has, F.left(s, F.length(s) - F.length(level) - 1)).otherwise(s).alias("path"), F.when(has, level).alias("level"))
