"""Diagnostic counts of a run, per floor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def percentiles(faces: DataFrame, at: tuple[int, ...] = (10, 50, 90)) -> DataFrame:
    """floor_id and ``thickness_p10`` and so on, between neighbours in proportion, of faces with a thickness."""
    return faces.filter("thickness is not null").groupBy("floor_id").agg(*(F.percentile("thickness", p / 100).alias(f"thickness_p{p}") for p in at))


def polygonize_stats(pieces: DataFrame, min_room_area: float = 1.0) -> DataFrame:
    """Counts, lengths and areas of faces, cut edges and dangles (as ``floors.faces`` gives them)."""
    face, kept = F.col("kind") == "face", (F.col("kind") == "face") & (F.col("area") >= min_room_area)
    return pieces.groupBy("floor_id").agg(
        F.count_if(face).alias("raw_polygon_count"), F.count_if(kept).alias("filtered_polygon_count"), F.count_if(face & ~kept).alias("removed_small_count"),
        F.count_if(F.col("kind") == "dangle").alias("dangle_count"), F.count_if(F.col("kind") == "cut").alias("cut_edge_count"),
        F.sum(F.when(F.col("kind") == "dangle", F.col("length")).otherwise(0.0)).alias("total_dangle_length"),
        F.coalesce(F.sum(F.when(kept, F.col("area"))), F.lit(0.0)).alias("total_area"), F.coalesce(F.min(F.when(kept, F.col("area"))), F.lit(0.0)).alias("min_area"), F.coalesce(F.max(F.when(kept, F.col("area"))), F.lit(0.0)).alias("max_area"),
    )


def separation_stats(typed: DataFrame, thresholds: DataFrame, regions: DataFrame) -> DataFrame:
    """Counts of faces by what they were taken for (``why``), of regions, the threshold and the thickness percentiles."""
    why = lambda v: F.count_if(F.col("why") == v)
    faces = typed.groupBy("floor_id").agg(
        F.count_if(F.col("role") == "room").alias("room_count"), F.count_if(F.col("role") == "wall").alias("face_wall_count"), why("wall:small").alias("small_wall_count"), why("wall:column").alias("column_count"),
        why("wall:sliver").alias("sliver_wall_count"), why("room:locked").alias("locked_room_count"), F.count_if(F.col("hatched")).alias("hatched_wall_count"),
        F.count_if(F.col("hatched") & F.col("objects")).alias("locked_overruled_by_hatching_count"),
    )
    role = lambda r: F.count_if(F.col("role") == r)
    synth = F.size(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("role") == "wall", F.filter("members", lambda m: m < 0))))))
    # Regions of one floor; pieces of one merged wall count each, as they are separate polygons.
    parts = regions.groupBy("floor_id").agg(role("wall").alias("merged_wall_count"), role("door").alias("door_count"), role("window").alias("window_count"), synth.cast("long").alias("synth_wall_count"))
    measured = typed.filter(F.col("why").isin("wall:sliver", "wall:thin", "room:thick"))
    out = faces.join(parts, "floor_id", "left").join(thresholds, "floor_id", "left").join(percentiles(measured), "floor_id", "left")
    out = out.withColumn("wall_count", F.col("face_wall_count") + F.coalesce("synth_wall_count", F.lit(0))).drop("face_wall_count")
    return out.withColumn("method", F.coalesce("method", F.lit("none"))).withColumn("hatching_calibrated", F.col("method").endswith("+hatching_calibrated"))


def classification_summary(regions: DataFrame) -> DataFrame:
    """floor_id, facil_type, rooms: how many rooms there are of each type."""
    return regions.filter("role = 'room'").groupBy("floor_id", F.coalesce("facil_type", F.lit("Unclassified")).alias("facil_type")).agg(F.count("*").alias("rooms"))
