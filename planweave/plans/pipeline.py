"""The whole pipeline as stages over all floors at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from planweave.config import Config
from planweave.functions import geom as G
from planweave.operators import floors, sinks, stats
from planweave.operators import relational as R
from planweave.sources import svg
from planweave.storage import store


@dataclass
class Plan:
    """What a run gives, each for all floors."""

    primitives: DataFrame
    openings: DataFrame
    edges: DataFrame
    faces: DataFrame
    thresholds: DataFrame
    typed: DataFrame
    regions: DataFrame

    def statistics(self) -> DataFrame:
        """Counts, threshold and percentiles of each floor."""
        return stats.separation_stats(self.typed, self.thresholds, self.regions)


def close_openings(prims: DataFrame, config: Config = Config()) -> DataFrame:
    """Boxes of doors and windows that pass all gates: floor_id, box_id, is_window, minx .. maxy, stroke, has_arc, hinge; windows with several legs give several."""
    lines = prims.filter("role in ('door', 'window') and kind = 'line'").filter(R.countable())
    windows = lines.filter("role = 'window'").withColumn("instance_id", F.col("instance_id").cast("long"))
    parts = floors.split_openings(windows, config.door_closing)
    parts = parts.withColumn("instance_id", F.col("instance_id").cast("int")).withColumn("role", F.lit("window"))
    named = lines.join(parts, ["floor_id", "instance_id", "ord", "role"], "left")
    # Doors and windows may share instance numbers; a part is its own box.
    named = named.withColumn("is_window", F.col("role") == "window").withColumn("instance_id", F.struct("is_window", "instance_id", F.coalesce("part", F.lit(0)).alias("part")))
    boxes = _boxes(named)
    total = R.extent_area(prims.filter("role = 'boundary' and kind = 'line'"))
    kept = boxes.join(total, "floor_id", "left").withColumn("total_area", F.coalesce("total_area", F.lit(1.0))).filter(R.rect_gate(config=config.door_closing).isNull())
    hinge = R.hinges(named.withColumn("key", F.col("instance_id")).withColumn("instance_id", F.xxhash64("key")))
    kept = kept.withColumn("key", F.xxhash64("instance_id")).join(hinge.withColumnRenamed("instance_id", "key"), ["floor_id", "key"], "left")
    return kept.select("floor_id", F.col("key").alias("box_id"), F.col("instance_id.is_window").alias("is_window"), "minx", "miny", "maxx", "maxy", "stroke", "has_arc", "hinge")


def _boxes(named: DataFrame) -> DataFrame:
    b = named.withColumn("i", F.col("instance_id")).withColumn("instance_id", F.xxhash64("i"))
    return R.instance_boxes(b).join(b.select("floor_id", "instance_id", "i").distinct(), ["floor_id", "instance_id"]).drop("instance_id").withColumnRenamed("i", "instance_id")


def run_floors(prims: DataFrame, config: Config = Config()) -> Plan:
    """Primitives (floor_id, ord, primitive_id, semantic_id, instance_id, original_type, stroke, role, kind, pts) to regions."""
    prims = store(prims, "primitives")  # read by seven stages
    lines = prims.filter("kind = 'line'").withColumn("hatching", R.is_hatching("pts", config.hatching) & (F.col("role") == "boundary"))
    walls = lines.filter("role = 'boundary' and not hatching")
    boxes = store(close_openings(prims, config), "openings") if config.door_closing.enabled else None
    canvas = lines.filter("original_type = 'boundary'")
    drawn = walls.select("floor_id", "pts").unionAll(canvas.select("floor_id", "pts"))
    if boxes is not None:
        drawn = drawn.unionAll(R.box_edges(boxes.withColumnRenamed("box_id", "instance_id")).select("floor_id", "pts"))
    edges = store(floors.clean_lines(drawn, config.cleaning), "edges")
    pieces = store(floors.faces(edges), "faces")
    faces = pieces.filter(F.col("kind") == "face").filter(F.col("area") >= config.polygonization.min_room_area)
    if boxes is not None:
        hit = store(R.faces_in_boxes(faces, boxes), "hit")
        free = faces.join(hit.select("floor_id", "face_id"), ["floor_id", "face_id"], "left_anti")
    else:
        hit, free = None, faces
    middles = lines.filter("hatching").withColumn("m", G.half_way("pts")).select("floor_id", F.col("ord").alias("stroke_id"), F.col("m.x").alias("x"), F.col("m.y").alias("y"))
    hatched = R.points_in_faces(free, middles).select("floor_id", "face_id").distinct().withColumn("hatched", F.lit(True))
    objects = R.points_in_faces(free, R.instance_centroids(prims.filter("role = 'classification'")))
    semantics = objects.groupBy("floor_id", "face_id", "semantic_id").agg(F.count("*").cast("int").alias("n")).groupBy("floor_id", "face_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("semantic_id", "n")))).alias("contained_semantics"))
    known = free.join(hatched, ["floor_id", "face_id"], "left").join(semantics, ["floor_id", "face_id"], "left").withColumn("hatched", F.coalesce("hatched", F.lit(False)))
    known = known.withColumn("objects", F.col("contained_semantics").isNotNull()).withColumn("locked", F.col("objects") & ~F.col("hatched"))
    known = known.withColumn("sized", ~F.col("locked") & (F.col("area") >= config.polygonization.separator_min_area))
    measured = store(floors.measure(known, wanted="sized"), "measured")
    column = (F.col("area") <= config.polygonization.separator_column_max_area) & (F.col("aspect") >= config.polygonization.separator_column_min_aspect)
    sized = measured.filter(F.col("sized") & ~column & (F.col("thickness") >= config.polygonization.separator_min_thickness))
    cuts = R.thresholds(sized, config.polygonization)
    decided = measured.join(cuts.select("floor_id", "threshold"), "floor_id", "left").withColumn("threshold", F.coalesce("threshold", F.lit(0.0))).withColumn("why", R.final_role(config.polygonization))
    decided = decided.withColumn("role", F.split("why", ":")[0]).withColumn("contained_semantics", F.when(F.col("locked"), F.col("contained_semantics")).otherwise(F.create_map().cast("map<int,int>")))
    rooms = decided.filter("role = 'room'").withColumn("facil_type", R.type_by_objects(config=config.classification)).withColumn("region_id", F.col("face_id"))
    rooms = R.kitchens_near_wc(rooms, config.classification).withColumn("facil_type", R.type_by_shape(config.classification))
    typed = decided.join(rooms.select("floor_id", "face_id", "facil_type"), ["floor_id", "face_id"], "left")
    typed = store(typed.withColumn("facil_type", F.when(F.col("role") == "room", F.coalesce("facil_type", F.lit(config.export.default_facil_type)))), "typed")
    regions = store(floors.walls_and_outline(typed, walls, config.polygonization), "regions")
    if hit is not None:
        doors = hit.join(faces.select("floor_id", "face_id", "shell", "holes", "area"), ["floor_id", "face_id"]).join(boxes.select("floor_id", "box_id", "has_arc"), ["floor_id", "box_id"])
        doors = doors.select("floor_id", (F.col("face_id") + (1 << 32)).alias("region_id"), F.when(F.col("is_window"), "window").otherwise("door").alias("role"), F.when(F.col("is_window"), "Window").otherwise("Door").alias("facil_type"), F.array("face_id").alias("members"), "has_arc", "shell", "holes", "area")
        regions = regions.unionByName(doors)
    return Plan(prims, boxes, edges, pieces, cuts, typed, regions)


def export(plan: Plan, levels: DataFrame, stable_ids: bool = False, window_as: str = "Window") -> DataFrame:
    """GeoJSON features of all floors; ``levels``: floor_id, level_id, w, h of the canvas. Both sizes given to the affine are the height, as published results have it."""
    m = sinks.placeholder_affine(F.col("h"), F.col("h"))
    own = levels.withColumn("m", m).select("floor_id", "level_id", *(F.col("m")[i].alias(c) for i, c in enumerate(("a", "b", "d", "e", "tx", "ty"))))
    r = plan.regions.withColumn("polygons", F.array(F.concat(F.array("shell"), "holes"))).withColumn("facil_name", F.lit(None).cast("string"))
    return sinks.features(r, own, window_as=window_as, stable_ids=stable_ids)


def run_files(spark: SparkSession, inputs: list[str | tuple[str, str | None]], config: Config = Config(), window_as: str = "Window") -> tuple[Plan, DataFrame]:
    """Read SVG files (paths, or paths with a level), run all stages, and return the plan and its features.

    A level that isn't given is the configuration's, or is read from the file's name. Of several inputs that name one
    file the first counts."""
    named = []
    for path, level in ((x, None) if isinstance(x, str) else x for x in inputs):
        found = svg.read_files(spark, path).withColumn("given", F.lit(level if level is not None else config.export.floor_level).cast("string")).withColumn("rank", F.lit(len(named)))
        named.append(found)
    files = reduce(DataFrame.unionAll, named)
    if len(named) > 1:
        first = Window.partitionBy("floor_id").orderBy("rank")
        files = files.withColumn("k", F.row_number().over(first)).filter("k = 1").drop("k")
    files = files.withColumn("level_id", F.coalesce("given", svg.level_of(F.element_at(F.split("path", "/"), -1)))).drop("given", "rank")
    rows = store(svg.elements(files), "elements")
    plan = run_floors(svg.primitives(rows, config.parsing), config)
    size = rows.groupBy("floor_id").agg(F.first("view_box").alias("vb")).withColumn("vb", svg.view_box(F.col("vb"))).select("floor_id", F.col("vb.w").alias("w"), F.col("vb.h").alias("h"))
    return plan, export(plan, files.select("floor_id", "level_id").join(size, "floor_id"), window_as=window_as)
