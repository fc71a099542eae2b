"""Stages that are plain relational expressions: filters, groups, thresholds, classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planweave.config import Classification, Hatching, Openings, Separation
from planweave.functions import geom as G


def is_hatching(pts="pts", config: Hatching = Hatching()) -> Column:
    """Short strokes at about 45 degrees."""
    a = G.angle(pts)
    tilt = config.max_diagonal_angle_deg
    return F.lit(config.enabled) & (G.length(pts) < config.min_length) & (a >= 45 - tilt) & (a <= 45 + tilt)


def countable(instance="instance_id") -> Column:
    c = F.col(instance)
    return c.isNotNull() & (c != -1)


def extent_area(lines: DataFrame) -> DataFrame:
    """Box area of each floor's lines."""
    b = G.bounds("pts")
    return lines.withColumn("b", b).groupBy("floor_id").agg(((F.max("b.maxx") - F.min("b.minx")) * (F.max("b.maxy") - F.min("b.miny"))).alias("total_area"))


def instance_boxes(prims: DataFrame) -> DataFrame:
    """Box of each opening: of its segments, or of all its lines where segments give fewer than two points."""
    seg = F.col("original_type") == "segment"
    b = prims.filter(countable() & (F.col("kind") == "line")).withColumn("b", G.bounds("pts")).withColumn("n", F.size("pts"))
    least = lambda c: F.coalesce(F.min(F.when(seg, F.col(c))), F.min(c))
    most = lambda c: F.coalesce(F.max(F.when(seg, F.col(c))), F.max(c))
    return b.groupBy("floor_id", "instance_id").agg(
        least("b.minx").alias("minx"), least("b.miny").alias("miny"), most("b.maxx").alias("maxx"), most("b.maxy").alias("maxy"),
        F.min_by("semantic_id", "ord").alias("semantic_id"), F.min_by("stroke", "ord").alias("stroke"), F.max((F.col("original_type") == "arc")).alias("has_arc"),
    )


def rect_gate(total="total_area", config: Openings = Openings()) -> Column:
    """Why a box is no opening, null if it is one; first reason that holds."""
    w, h = F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")
    return (
        F.when((w < config.min_rect_opening) & (h < config.min_rect_opening), "small")
        .when((F.col(total) > 0) & (w * h / F.when(F.col(total) > 0, F.col(total)) > config.max_area_ratio), "mega")
        .when(w * h < 0.01, "area")
        .when(F.least(w, h) < config.min_rect_thickness, "thin")
    )


def box_edges(boxes: DataFrame) -> DataFrame:
    """The four edges of boxes as primitives without id."""
    ring = G.box("minx", "miny", "maxx", "maxy")
    edges = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.array(F.get(F.col("ring"), i), F.get(F.col("ring"), i + 1)))
    return boxes.withColumn("ring", ring).select("floor_id", "instance_id", F.posexplode(edges).alias("k", "pts")).withColumn("primitive_id", F.lit(-1)).withColumn("original_type", F.lit("synthetic_closing"))


def hinges(prims: DataFrame) -> DataFrame:
    """Circle centre of each opening's longest arc."""
    arcs = prims.filter(countable() & (F.col("original_type") == "arc") & (F.size("pts") >= 3)).withColumn("len", G.length("pts"))
    w = Window.partitionBy("floor_id", "instance_id").orderBy(F.desc("len"), "ord")
    p = F.col("pts")
    return arcs.withColumn("k", F.row_number().over(w)).filter("k = 1").select("floor_id", "instance_id", G.circumcenter(p[0], F.get(p, F.floor(F.size(p) / 2).cast("int")), F.element_at(p, -1)).alias("hinge"))


def exact_sum(c: Column) -> Column:
    """A sum of doubles that doesn't depend on the rows' order: sorted, and what each addition loses is added at the end (Neumaier)."""

    def step(acc, v):
        t = acc["s"] + v
        lost = F.when(F.abs(acc["s"]) >= F.abs(v), (acc["s"] - t) + v).otherwise((v - t) + acc["s"])
        return F.struct(t.alias("s"), (acc["e"] + lost).alias("e"))

    return F.aggregate(F.array_sort(F.collect_list(F.when(c != 0, c))), F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("e")), step, lambda acc: acc["s"] + acc["e"])


def instance_centroids(prims: DataFrame) -> DataFrame:
    """One centre for each object: its lines' middles weighted by length, the polygons' alone where it has any; rows without instance are their own objects.

    Sums are exact to a rounding, so that centres that lie between two thousandths don't depend on the rows' order."""
    area = F.when(F.col("kind") == "polygon", G.area("pts")).otherwise(0.0)
    own = prims.withColumn("object", F.when(F.coalesce(F.col("instance_id"), F.lit(-1)) < 0, -F.col("ord") - 2).otherwise(F.col("instance_id").cast("long")))
    own = own.withColumn("semantic_id", F.coalesce("semantic_id", F.lit(-1))).withColumn("a", area).withColumn("c", F.when(F.col("a") > 0, G.ring_centroid("pts")).otherwise(G.line_centroid("pts")))
    own = own.withColumn("l", F.when(F.col("kind") == "line", G.length("pts")).otherwise(0.0)).withColumn("m", F.when(F.col("kind") == "line", G.line_moment("pts")))
    sums = [exact_sum(F.col(c)).alias(c) for c in ("a", "l")] + [exact_sum(v).alias(n + k) for k in "xy" for n, v in (("a", F.col("a") * F.col(f"c.{k}")), ("m", F.col(f"m.{k}")))] + [F.avg(f"c.{k}").alias(f"c{k}") for k in "xy"]
    mean = lambda k: F.when(F.col("a") > 0, F.col(f"a{k}") / F.col("a")).when(F.col("l") > 0, F.col(f"m{k}") / F.col("l")).otherwise(F.col(f"c{k}"))
    return own.groupBy("floor_id", "object", "semantic_id").agg(*sums).select("floor_id", "object", "semantic_id", mean("x").alias("x"), mean("y").alias("y"))


def _cells(df: DataFrame, names: tuple[str, str, str, str], cell: float) -> DataFrame:
    """A row for each grid cell (gx, gy) that a box meets; boxes only, so that no shape is copied."""
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    return df.withColumn("gx", F.explode(span(names[0], names[2]))).withColumn("gy", F.explode(span(names[1], names[3])))


def points_in_faces(faces: DataFrame, points: DataFrame, cell: float = 16.0) -> DataFrame:
    """points joined to the face (smallest face_id) that strictly contains them: boxes meet points on grid cells, then shapes are fetched for the exact test."""
    boxes = _cells(faces.select("floor_id", "face_id", "minx", "miny", "maxx", "maxy"), ("minx", "miny", "maxx", "maxy"), cell)
    p = points.withColumn("gx", F.floor(F.col("x") / cell)).withColumn("gy", F.floor(F.col("y") / cell))
    near = p.join(boxes, ["floor_id", "gx", "gy"]).filter("x >= minx and x <= maxx and y >= miny and y <= maxy").select(*points.columns, "face_id")
    hit = near.join(faces.select("floor_id", "face_id", "shell", "holes"), ["floor_id", "face_id"])
    inside = G.contains("shell", "x", "y") & ~F.exists("holes", lambda h: G.contains(h, F.col("x"), F.col("y")))
    return hit.filter(inside).groupBy(*points.columns).agg(F.min("face_id").alias("face_id"))


def faces_in_boxes(faces: DataFrame, boxes: DataFrame, cell: float = 16.0) -> DataFrame:
    """Faces of which over half lies in an opening's box: the first box, doors before windows. Boxes meet on grid cells; shapes are fetched for pairs of which one can hold half of the other."""
    f = faces.filter("area > 0")
    b = boxes.select("floor_id", "box_id", "is_window", *(F.col(c).alias(f"b_{c}") for c in ("minx", "miny", "maxx", "maxy")))
    own = _cells(f.select("floor_id", "face_id", "area", "minx", "miny", "maxx", "maxy"), ("minx", "miny", "maxx", "maxy"), cell)
    other = _cells(b, ("b_minx", "b_miny", "b_maxx", "b_maxy"), cell)
    both = lambda lo, hi: F.greatest(F.lit(0.0), F.least(hi, f"b_{hi}") - F.greatest(lo, f"b_{lo}"))
    near = own.join(other, ["floor_id", "gx", "gy"]).filter(both("minx", "maxx") * both("miny", "maxy") > 0.5 * F.col("area")).select("floor_id", "face_id", *b.columns[1:]).distinct()
    pairs = near.join(f.select("floor_id", "face_id", "area", "shell", "holes"), ["floor_id", "face_id"])
    hit = pairs.filter(clip_area("shell", "b_minx", "b_miny", "b_maxx", "b_maxy") - F.aggregate("holes", F.lit(0.0), lambda a, h: a + clip_area(h, "b_minx", "b_miny", "b_maxx", "b_maxy")) > 0.5 * F.col("area"))
    w = Window.partitionBy("floor_id", "face_id").orderBy("is_window", "box_id")
    return hit.withColumn("k", F.row_number().over(w)).filter("k = 1").select("floor_id", "face_id", "box_id", "is_window")


def clip_area(ring, minx, miny, maxx, maxy) -> Column:
    """Area of a ring within a box: the ring cut by the four half-planes in turn (Sutherland and Hodgman)."""
    out = F.col(ring) if isinstance(ring, str) else ring
    for key, bound, sign in (("x", minx, 1.0), ("x", maxx, -1.0), ("y", miny, 1.0), ("y", maxy, -1.0)):
        out = G.let(out, _half_plane(key, F.col(bound), sign))
    return G.let(out, lambda p: G.area(F.when(F.size(p) > 2, F.concat(p, F.slice(p, 1, 1))).otherwise(p)))


def _half_plane(key: str, bound: Column, sign: float):
    return lambda ring: _cut(ring, key, bound, sign)


def _cut(ring: Column, key: str, bound: Column, sign: float) -> Column:
    side = lambda p: (p[key] - bound) * sign
    other = "y" if key == "x" else "x"

    def step(s):
        a, b = s["a"], s["b"]
        t = side(a) / (side(a) - side(b))
        at = a[other] + t * (b[other] - a[other])
        cross = F.when((side(a) >= 0) != (side(b) >= 0), F.array(G.point(bound, at) if key == "x" else G.point(at, bound))).otherwise(F.array().cast(G.POINTS))
        return F.concat(F.when(side(a) >= 0, F.array(G.point(a["x"], a["y"]))).otherwise(F.array().cast(G.POINTS)), cross)

    closed = F.when(F.size(ring) > 0, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)
    return F.flatten(F.transform(G._pairs(closed), step))


def largest_gap(faces: DataFrame, by=("floor_id",)) -> DataFrame:
    """Per floor: the cut in log10(thickness) whose gap times its smaller side is largest."""
    pos = faces.filter("thickness > 0").withColumn("g", F.log10("thickness"))
    w = Window.partitionBy(*by).orderBy("g")
    pos = pos.withColumn("i", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy(*by))).withColumn("nxt", F.lead("g").over(w))
    gaps = pos.filter("nxt > g").withColumn("score", (F.col("nxt") - F.col("g")) * F.least("i", F.col("n") - F.col("i")))
    best = Window.partitionBy(*by).orderBy(F.desc("score"), "i")
    return gaps.withColumn("k", F.row_number().over(best)).filter("k = 1").select(*by, ((F.col("g") + F.col("nxt")) / 2).alias("log_mid"), (F.col("nxt") - F.col("g")).alias("gap"))


def otsu(faces: DataFrame, by=("floor_id",), bins: int = 64) -> DataFrame:
    """Per floor: Otsu's cut of a histogram over log10(thickness)."""
    pos = faces.filter("thickness > 0").withColumn("g", F.log10("thickness"))
    lim = pos.groupBy(*by).agg(F.min("g").alias("lo"), F.max("g").alias("hi")).withColumn("wide", F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(1.0)).withColumn("base", F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5))
    hist = pos.join(lim, list(by)).withColumn("bin", F.least(F.floor((F.col("g") - F.col("base")) / F.col("wide") * bins), F.lit(bins - 1)).cast("int")).groupBy(*by, "base", "wide", "bin").agg(F.count("*").alias("c"))
    mid = F.col("base") + (F.col("bin") + 0.5) * F.col("wide") / bins
    upto = Window.partitionBy(*by).orderBy("bin")
    whole = Window.partitionBy(*by)
    h = hist.withColumn("s", F.col("c") * mid).withColumn("wb", F.sum("c").over(upto)).withColumn("sb", F.sum("s").over(upto)).withColumn("wt", F.sum("c").over(whole)).withColumn("st", F.sum("s").over(whole)).filter("wb < wt")
    diff = F.col("sb") / F.col("wb") - (F.col("st") - F.col("sb")) / (F.col("wt") - F.col("wb"))
    h = h.withColumn("v", F.col("wb") * (F.col("wt") - F.col("wb")) * diff * diff)
    best = Window.partitionBy(*by).orderBy(F.desc("v"), "bin")
    return h.withColumn("k", F.row_number().over(best)).filter("k = 1").select(*by, (F.col("base") + (F.col("bin") + 1) * F.col("wide") / bins).alias("log_cut"))


def thresholds(faces: DataFrame, config: Separation = Separation()) -> DataFrame:
    """floor_id, threshold, method, gap: manual, or the largest gap, or the fallback; raised over the thickest hatched face."""
    stats = faces.groupBy("floor_id").agg(F.count_if(F.col("thickness") > 0).alias("n"), F.max(F.when(F.col("hatched"), F.col("thickness"))).alias("hatched_max"), F.expr("median(case when thickness > 0 then thickness end)").alias("med"))
    all_ = stats.join(largest_gap(faces), "floor_id", "left").join(otsu(faces), "floor_id", "left")
    wide = F.coalesce(F.col("gap") >= config.separator_min_log_gap, F.lit(False))
    use_median = config.separator_fallback_method == "median"
    fallback = F.col("med") if use_median else F.pow(F.lit(10.0), F.col("log_cut"))
    if config.separator_manual_thickness is not None:
        t, m, gap = F.lit(float(config.separator_manual_thickness)), F.lit("manual"), F.lit(0.0)
    else:
        few = F.col("n") < 2
        t = F.when(few, 0.0).when(wide, F.pow(F.lit(10.0), F.col("log_mid"))).otherwise(F.coalesce(fallback, F.col("med")))
        m = F.when(few, "none").when(wide, "largest_gap").otherwise("median" if use_median else "otsu")
        gap = F.when(few, 0.0).otherwise(F.coalesce("gap", F.lit(0.0)))
    out = all_.select("floor_id", t.alias("t"), m.alias("m"), gap.alias("gap"), (F.col("hatched_max") + 1e-6).alias("needed"))
    raise_ = F.coalesce(F.col("needed") > F.col("t"), F.lit(False))
    return out.select("floor_id", F.when(raise_, F.col("needed")).otherwise(F.col("t")).alias("threshold"), F.when(raise_, F.concat("m", F.lit("+hatching_calibrated"))).otherwise(F.col("m")).alias("method"), "gap")


def final_role(config: Separation = Separation()) -> Column:
    """room or wall, and why."""
    column = (F.col("area") > 0) & (F.col("area") <= config.separator_column_max_area) & (F.col("aspect") >= config.separator_column_min_aspect)
    return (
        F.when(F.col("locked"), "room:locked").when(F.col("area") < config.separator_min_area, "wall:small").when(column, "wall:column")
        .when(F.col("thickness") < config.separator_min_thickness, "wall:sliver").when(F.col("thickness") < F.col("threshold"), "wall:thin").otherwise("room:thick")
    )


def type_by_objects(semantics="contained_semantics", config: Classification = Classification()) -> Column:
    """Room type from the objects inside, null if there are none."""
    keys = F.map_keys(F.col(semantics))
    out = F.when(F.size(keys) == 0, None)
    for name, ids in config.priority():
        out = out.when(F.arrays_overlap(keys, F.array(*map(F.lit, ids))), name)
    return out.when(keys.isNotNull(), "Deadzone")


def type_by_shape(config: Classification = Classification()) -> Column:
    solidity = F.col("area") / F.col("hull_area")
    return F.when(F.col("facil_type").isNotNull() | (F.col("thickness") <= 0), F.col("facil_type")).when((F.col("thickness") < config.walkway_max_thickness) | (solidity < config.walkway_max_solidity), "Walkways").otherwise("Office")


def kitchens_near_wc(rooms: DataFrame, config: Classification = Classification()) -> DataFrame:
    """Kitchens within reach of a WC become WCs; the WCs are those of before, so that it doesn't spread. Cells as wide as the reach keep the join local."""
    reach = config.kitchen_wc_distance
    segs = lambda d: d.select("floor_id", "region_id", F.explode(G._pairs(F.col("shell"))).alias("s"))
    lo = lambda k, pad: F.floor((F.least(F.col(f"s.a.{k}"), F.col(f"s.b.{k}")) - pad) / reach)
    hi = lambda k, pad: F.floor((F.greatest(F.col(f"s.a.{k}"), F.col(f"s.b.{k}")) + pad) / reach)
    cells = lambda d, pad: d.withColumn("gx", F.explode(F.sequence(lo("x", pad), hi("x", pad)))).withColumn("gy", F.explode(F.sequence(lo("y", pad), hi("y", pad))))
    k = cells(segs(rooms.filter("facil_type = 'Kitchen'")), 0.0).withColumnRenamed("s", "ks")
    w = cells(segs(rooms.filter("facil_type = 'WC'")), reach).select("floor_id", "gx", "gy", F.col("s").alias("ws"))
    near = k.join(w, ["floor_id", "gx", "gy"]).filter(segment_distance(F.col("ks"), F.col("ws")) <= reach).select("floor_id", "region_id").distinct().withColumn("near", F.lit(True))
    return rooms.join(near, ["floor_id", "region_id"], "left").withColumn("facil_type", F.when(F.col("near"), "WC").otherwise(F.col("facil_type"))).drop("near")


def segment_distance(s: Column, t: Column) -> Column:
    """Distance of two segments (struct<a,b>); 0 where they cross."""

    def to(p, q):
        dx, dy = q["b"]["x"] - q["a"]["x"], q["b"]["y"] - q["a"]["y"]
        size = dx * dx + dy * dy
        u = F.when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((p["x"] - q["a"]["x"]) * dx + (p["y"] - q["a"]["y"]) * dy) / F.when(size > 0, size)))).otherwise(0.0)
        return F.hypot(p["x"] - q["a"]["x"] - u * dx, p["y"] - q["a"]["y"] - u * dy)

    side = lambda q, p: (q["b"]["x"] - q["a"]["x"]) * (p["y"] - q["a"]["y"]) - (q["b"]["y"] - q["a"]["y"]) * (p["x"] - q["a"]["x"])
    cross = (side(s, t["a"]) * side(s, t["b"]) < 0) & (side(t, s["a"]) * side(t, s["b"]) < 0)
    return F.when(cross, 0.0).otherwise(F.least(to(s["a"], t), to(s["b"], t), to(t["a"], s), to(t["b"], s)))


def close_endpoints(ends: DataFrame, tolerance: float) -> DataFrame:
    """Pairs i < j of points (floor_id, i, x, y) within ``tolerance``: each point meets its own and the neighbouring cells once."""
    p = ends.withColumn("gx", F.floor(F.col("x") / tolerance)).withColumn("gy", F.floor(F.col("y") / tolerance))
    near = F.array(*(F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a in (-1, 0, 1) for b in (-1, 0, 1)))
    q = p.withColumn("n", F.explode(near)).select("floor_id", (F.col("gx") + F.col("n.dx")).alias("gx"), (F.col("gy") + F.col("n.dy")).alias("gy"), F.col("i").alias("j"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return p.join(q, ["floor_id", "gx", "gy"]).filter((F.col("i") < F.col("j")) & (F.hypot(F.col("x") - F.col("x2"), F.col("y") - F.col("y2")) <= tolerance)).select("floor_id", "i", "j")


def fit_affine(points: DataFrame) -> DataFrame:
    """Least squares [a, b, d, e, tx, ty] per floor from at least three control points (sx, sy) to (gx, gy), by normal equations about the mean."""
    s = points.groupBy("floor_id").agg(F.count("*").alias("n"), *(F.avg(c).alias(f"m{c}") for c in ("sx", "sy", "gx", "gy")))
    d = points.join(s, "floor_id")
    u, v, p, q = (F.col(c) - F.col(f"m{c}") for c in ("sx", "sy", "gx", "gy"))
    t = d.groupBy("floor_id", "n", "msx", "msy", "mgx", "mgy").agg(F.sum(u * u).alias("uu"), F.sum(u * v).alias("uv"), F.sum(v * v).alias("vv"), F.sum(u * p).alias("up"), F.sum(v * p).alias("vp"), F.sum(u * q).alias("uq"), F.sum(v * q).alias("vq"))
    det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    bad = F.raise_error("three or more control points that aren't on one line are needed").cast("double")
    safe = F.when((F.col("n") >= 3) & (F.abs(det) > 1e-12 * F.col("uu") * F.col("vv")), det).otherwise(bad)
    t = t.withColumn("det", safe)
    solve = lambda x, y: ((F.col(x) * F.col("vv") - F.col(y) * F.col("uv")) / F.col("det"), (F.col(y) * F.col("uu") - F.col(x) * F.col("uv")) / F.col("det"))
    (a, b), (c, e) = solve("up", "vp"), solve("uq", "vq")
    return t.select("floor_id", a.alias("a"), b.alias("b"), c.alias("d"), e.alias("e"), (F.col("mgx") - a * F.col("msx") - b * F.col("msy")).alias("tx"), (F.col("mgy") - c * F.col("msx") - e * F.col("msy")).alias("ty"))
