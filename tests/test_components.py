"""Connected components of long chains, of stars and of pairs of points on floors."""

import random
import re

from pyspark.sql import functions as F

from planweave import queries_floors
from planweave.operators import floors
from planweave.operators.components import components


def test_long_chain(spark):
    """10,000 points in a row, in a random order of names."""
    n = 10_000
    names = list(range(n))
    random.Random(3).shuffle(names)
    pairs = spark.createDataFrame(list(zip(names, names[1:])), "a long, b long")
    found = components(pairs).groupBy("root").count().collect()
    assert [(r.root, r["count"]) for r in found] == [(0, n - 1)]


def test_against_search(spark):
    r = random.Random(5)
    pairs = [(r.randrange(400), r.randrange(400)) for _ in range(300)] + [(0, i) for i in range(600, 700)] + [(7, 7)]
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        if start not in want:
            queue = [start]
            while queue:
                x = queue.pop()
                if x not in want:
                    want[x] = start
                    queue += near[x]
    got = {x.node: x.root for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in want.items() if k != v}


def test_points_of_floors(spark):
    points = spark.range(0, 400).select((F.col("id") % 2).alias("floor_id"), F.floor(F.col("id") / 2).alias("i"))
    pairs = points.filter("i % 100 < 99 and floor_id = 0").withColumn("j", F.col("i") + 1)
    got = {(r.floor_id, r.i): r.root for r in floors.components_of_pairs(points, pairs).collect()}
    assert got == {(f, i): i // 100 * 100 if f == 0 else i for f in (0, 1) for i in range(200)}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pairs_of_a_crowded_floor(spark):
    """200,000 points of one floor: the join has the number as a key, so no row meets its whole floor."""
    points = spark.range(0, 200_000).select(F.lit(1).cast("long").alias("floor_id"), F.col("id").alias("i"))
    pairs = queries_floors.hundred_apart(points)
    assert re.search(r"Join Inner, .*\bj#\d+L = j#\d+L", pairs._jdf.queryExecution().optimizedPlan().toString())
    assert pairs.agg(F.count("*"), F.min(F.col("j") - F.col("i")), F.max(F.col("j") - F.col("i"))).first() == (199_900, 100, 100)
