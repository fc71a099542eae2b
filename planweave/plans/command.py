"""The command line: several drawings, each with a level of its own, to one GeoJSON document."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from planweave.config import load_config
from planweave.operators import sinks, stats
from planweave.plans import pipeline

log = logging.getLogger("planweave")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="planweave", description="Annotated floor-plan drawings (SVG) to GeoJSON.")
    p.add_argument("--input", action="append", required=True, help="path[=level]; may be given several times")
    p.add_argument("--output", required=True, help="the GeoJSON document, or with --lines a folder of shards with a feature on each line")
    p.add_argument("--name", default="svg2geojson_export", help="name of the document")
    p.add_argument("--window-as", default="Wall", choices=("Wall", "Window"), help="what windows are written as")
    p.add_argument("--config", help="YAML file that overrides parameters")
    p.add_argument("--lines", action="store_true", help="write line-delimited features, for exports of many floors")
    return p.parse_args(argv)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything that a pattern names, is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def split(spec: str) -> tuple[str, str | None]:
    """``path[=level]``, parted at the last equals sign."""
    path, mark, level = spec.rpartition("=")
    return (path, level) if mark else (spec, None)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse(argv)
    spark, config = spark or SparkSession.builder.appName("planweave").getOrCreate(), load_config(args.config)
    inputs = []
    for path, level in map(split, args.input):
        if exists(spark, path):
            inputs.append((path, level))
        else:
            log.error("skipping missing file: %s", path)
    if not inputs:
        log.error("no drawing to read")
        sinks.write_geojson(sinks.no_features(spark), args.output, args.name)
        return 0
    plan, features = pipeline.run_files(spark, inputs, config, window_as=args.window_as)
    if args.lines:
        sinks.write_lines(features, args.output)
    else:
        sinks.write_geojson(features, args.output, args.name)
    for row in stats.classification_summary(plan.regions).groupBy("facil_type").sum("rooms").orderBy("facil_type").collect():  # a row for each type
        log.info("%s: %d", *row)
    return 0
