"""Objects and openings: centres do not depend on the order of lines, windows are split in batches."""

import itertools

from pyspark.sql import functions as F

from planweave.operators import floors
from planweave.operators import relational as R
from planweave.queries import lined, milli


def test_centre_between_two_thousandths(spark):
    """One object's five lines in all orders: its y is 91.7875, whose sums came out lower in some orders."""
    lines = [(66.2, 105.3, 86.2, 125.3), (4.7, 27.0, 7.7, 30.0), (86.6, 102.1, 89.6, 105.1), (117.8, 49.8, 120.8, 52.8), (32.3, 25.5, 35.3, 28.5)]
    rows = [(f, 10 * f + k, 35, 2, *line) for f, order in enumerate(itertools.permutations(lines)) for k, line in enumerate(order)]
    prims = spark.createDataFrame(rows, "floor_id long, primitive_id long, semantic_id int, instance_id int, x1 double, y1 double, x2 double, y2 double")
    got = R.instance_centroids(lined(prims)).select("floor_id", milli("x", "x"), milli("y", "y"))
    assert got.groupBy("x", "y").agg(F.count("*")).collect() == [(70819, 91788, 120)]


def test_windows_split_in_batches(spark):
    """Instances that lie across batches stay whole, and no instance is a call of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    leg = lambda k, x, y: [(k + i, "segment", [(30.0 * x + i * y, 30.0 * y + i * x), (30.0 * x + 30 * x + i * y, 30.0 * y + 30 * y + i * x)]) for i in range(4)]
    one = [*leg(0, 1, 0), *leg(4, 0, 1), (8, "arc", [(50.0, 0.0), (52.0, 0.0), (52.0, 2.0)]), (9, None, []), (10, "segment", None)]
    rows = [(f, i, *x) for f in range(3) for i in (None, 5, 6, 7, 8) for x in (one if i != 6 else one[:3])]
    lines = spark.createDataFrame(rows, f"floor_id long, instance_id int, ord int, original_type string, pts {floors.RING}")
    p = floors.split_openings(lines.repartition(2), at_once=5)
    assert "FlatMapGroups" not in p._jdf.queryExecution().executedPlan().toString()
    got = {}
    found = p.collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for r in found:
        got.setdefault((r.floor_id, r.instance_id), {})[r.ord] = r.part
    assert len(got) == 15 and sum(map(len, got.values())) == len(rows)
    for (_, i), own in got.items():
        assert [own[k] for k in sorted(own)] == ([0] * 3 if i == 6 else [own[0]] * 4 + [1 - own[0]] * 4 + [own[0], 0, 0])
