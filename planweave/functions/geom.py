"""Geometry as Column expressions: points are struct<x,y>, lines and rings array<struct<x,y>>. All run inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POINTS = "array<struct<x:double,y:double>>"


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v)) if isinstance(v, (int, float)) else F.col(v)


def let(value: Column, f) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def point(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def line(x1, y1, x2, y2) -> Column:
    return F.array(point(x1, y1), point(x2, y2))


def box(minx, miny, maxx, maxy) -> Column:
    """Closed ring of a rectangle."""
    return F.array(point(minx, miny), point(maxx, miny), point(maxx, maxy), point(minx, maxy), point(minx, miny))


def _pairs(pts: Column) -> Column:
    """Each point with its successor."""

    def pairs(p):
        n = F.greatest(F.size(p) - 1, F.lit(0))
        return F.zip_with(F.slice(p, 1, n), F.slice(p, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    return let(pts, pairs)


def _sum(arr: Column, f) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, e: acc + f(e))


def length(pts) -> Column:
    return _sum(_pairs(_c(pts)), lambda e: F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]))


def signed_area(ring) -> Column:
    return _sum(_pairs(_c(ring)), lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]) / 2.0


def area(ring) -> Column:
    return F.abs(signed_area(ring))


def ring_centroid(ring) -> Column:
    cross = lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]

    def centroid(e):
        a6 = _sum(e, cross) * 3.0
        return point(_sum(e, lambda s: (s["a"]["x"] + s["b"]["x"]) * cross(s)) / a6, _sum(e, lambda s: (s["a"]["y"] + s["b"]["y"]) * cross(s)) / a6)

    return let(_pairs(_c(ring)), centroid)


def line_moment(pts) -> Column:
    """Of a line: its segments' middles times their lengths, summed."""
    part = lambda s: F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]) / 2.0
    return let(_c(pts), lambda p: point(*(_sum(_pairs(p), lambda s, k=k: (s["a"][k] + s["b"][k]) * part(s)) for k in "xy")))


def line_centroid(pts) -> Column:
    """Of a line: its segments' middles, weighted by length; of a line without length its first point."""

    def centroid(p):
        mean = lambda k: let(F.struct(line_moment(p)[k].alias("n"), length(p).alias("d")), lambda v: F.when(v["d"] > 0, v["n"] / v["d"]).otherwise(p[0][k]))
        return point(mean("x"), mean("y"))

    return let(_c(pts), centroid)


def half_way(pts) -> Column:
    """The point at half the arc length of a line."""

    def walk(v):
        p, half = v["p"], v["half"]
        start = F.struct(F.lit(0.0).alias("d"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))

        def step(acc, s):
            size = F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"])
            here = acc["x"].isNull() & (acc["d"] + size >= half)
            t = F.when(size > 0, (half - acc["d"]) / size).otherwise(0.0)
            at = lambda k: F.when(here, s["a"][k] + t * (s["b"][k] - s["a"][k])).otherwise(acc[k])
            return F.struct((acc["d"] + size).alias("d"), at("x").alias("x"), at("y").alias("y"))

        return F.aggregate(_pairs(p), start, step, lambda a: point(F.coalesce(a["x"], F.element_at(p, -1)["x"]), F.coalesce(a["y"], F.element_at(p, -1)["y"])))

    return let(F.struct(_c(pts).alias("p"), (length(pts) / 2.0).alias("half")), walk)


def angle(pts) -> Column:
    """Degrees from the horizontal, 0 to 90, of the line from the first to the last point."""

    def tilt(p):
        a, b = p[0], F.element_at(p, -1)
        dx, dy = F.abs(b["x"] - a["x"]), F.abs(b["y"] - a["y"])
        return F.when((dx == 0) & (dy == 0), 0.0).otherwise(F.degrees(F.atan2(dy, dx)))

    return let(_c(pts), tilt)


def bounds(pts) -> Column:
    def box_of(p):
        xs, ys = F.transform(p, lambda q: q["x"]), F.transform(p, lambda q: q["y"])
        return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))

    return let(_c(pts), box_of)


def contains(ring, x, y) -> Column:
    """Whether a point lies strictly inside a closed ring, by counting crossings of a ray."""
    px, py = _c(x), _c(y)
    e = _pairs(_c(ring))
    on = F.exists(e, lambda s: ((s["b"]["x"] - s["a"]["x"]) * (py - s["a"]["y"]) == (s["b"]["y"] - s["a"]["y"]) * (px - s["a"]["x"])) & px.between(F.least(s["a"]["x"], s["b"]["x"]), F.greatest(s["a"]["x"], s["b"]["x"])) & py.between(F.least(s["a"]["y"], s["b"]["y"]), F.greatest(s["a"]["y"], s["b"]["y"])))
    crossed = F.filter(e, lambda s: ((s["a"]["y"] > py) != (s["b"]["y"] > py)) & (px < (s["b"]["x"] - s["a"]["x"]) * (py - s["a"]["y"]) / (s["b"]["y"] - s["a"]["y"]) + s["a"]["x"]))
    return ~on & (F.size(crossed) % 2 == 1)


def move(pts, dx, dy) -> Column:
    return F.transform(_c(pts), lambda p: point(p["x"] + _c(dx), p["y"] + _c(dy)))


def flip_y(pts, height) -> Column:
    return F.transform(_c(pts), lambda p: point(p["x"], _c(height) - p["y"]))


def affine(pts, a, b, d, e, tx, ty) -> Column:
    return F.transform(_c(pts), lambda p: point(_c(a) * p["x"] + _c(b) * p["y"] + _c(tx), _c(d) * p["x"] + _c(e) * p["y"] + _c(ty)))


def snap_to_canvas(pts, width, height, tolerance: float) -> Column:
    """Every vertex nearer than ``tolerance`` to a canvas edge moves onto it; lines that would shrink to a point stay."""
    p = _c(pts)
    if tolerance <= 0:
        return p
    near = lambda v, top: F.when(F.abs(v) < tolerance, 0.0).when(F.abs(v - _c(top)) < tolerance, _c(top)).otherwise(v)
    moved = lambda p: F.transform(p, lambda q: point(near(q["x"], width), near(q["y"], height)))
    return let(p, lambda p: let(moved(p), lambda m: F.when(F.size(F.array_distinct(m)) >= 2, m).otherwise(p)))


def drop_repeats(pts) -> Column:
    """Without points equal to the one before."""
    return let(_c(pts), lambda p: F.filter(p, lambda q, i: (i == 0) | (q != F.get(p, F.when(i > 0, i - 1).otherwise(0)))))


def round_points(pts, digits: int) -> Column:
    return F.transform(_c(pts), lambda p: point(F.round(p["x"], digits), F.round(p["y"], digits)))


def ellipse(cx, cy, rx, ry, sides: int = 64) -> Column:
    """Closed polygon of ``sides`` sides with its vertices on an ellipse."""
    t = F.sequence(F.lit(0), F.lit(sides))
    a = lambda i: (i % sides) * (2 * math.pi / sides)
    return F.transform(t, lambda i: point(_c(cx) + _c(rx) * F.cos(a(i)), _c(cy) - _c(ry) * F.sin(a(i))))


def circumcenter(a: Column, b: Column, c: Column) -> Column:
    """Centre of the circle through three points, null where they are (nearly) on a line."""

    def centre(v):
        a, b, c = v["a"], v["b"], v["c"]
        d = 2.0 * (a["x"] * (b["y"] - c["y"]) + b["x"] * (c["y"] - a["y"]) + c["x"] * (a["y"] - b["y"]))
        sq = lambda p: p["x"] * p["x"] + p["y"] * p["y"]
        x = sq(a) * (b["y"] - c["y"]) + sq(b) * (c["y"] - a["y"]) + sq(c) * (a["y"] - b["y"])
        y = sq(a) * (c["x"] - b["x"]) + sq(b) * (a["x"] - c["x"]) + sq(c) * (b["x"] - a["x"])
        safe = lambda d: F.when(F.abs(d) >= 1e-9, d)
        return let(d, lambda d: F.when(F.abs(d) >= 1e-9, point(x / safe(d), y / safe(d))))

    return let(F.struct(a.alias("a"), b.alias("b"), c.alias("c")), centre)


def arc(x1, y1, rx, ry, rotation, large, sweep, x2, y2, resolution: int = 20) -> Column:
    """``resolution + 2`` points on an SVG endpoint arc, by the centre form of the SVG standard (F.6.5).

    Two points if a radius is zero; null if the arc has no extent."""
    names = ("x1", "y1", "rx", "ry", "rotation", "large", "sweep", "x2", "y2")
    given = F.struct(*(_c(v).cast("double").alias(n) for n, v in zip(names, (x1, y1, rx, ry, rotation, large, sweep, x2, y2), strict=True)))
    struct = lambda **k: F.struct(*(v.alias(n) for n, v in k.items()))

    def turned(g):
        phi = F.radians(g["rotation"])
        dx, dy = (g["x1"] - g["x2"]) / 2.0, (g["y1"] - g["y2"]) / 2.0
        return let(struct(cos=F.cos(phi), sin=F.sin(phi)), lambda r: let(struct(g=g, cos=r["cos"], sin=r["sin"], u=r["cos"] * dx + r["sin"] * dy, v=r["cos"] * dy - r["sin"] * dx), grown))

    def grown(s):
        r1, r2 = F.abs(s["g"]["rx"]), F.abs(s["g"]["ry"])
        lam = s["u"] * s["u"] / (r1 * r1) + s["v"] * s["v"] / (r2 * r2)
        return let(F.sqrt(F.greatest(lam, F.lit(1.0))), lambda k: let(struct(s=s, r1=r1 * k, r2=r2 * k), centred))

    def centred(t):
        s, r1, r2 = t["s"], t["r1"], t["r2"]
        den = r1 * r1 * s["v"] * s["v"] + r2 * r2 * s["u"] * s["u"]
        num = F.greatest(r1 * r1 * r2 * r2 - den, F.lit(0.0))
        k = F.sqrt(num / F.when(den != 0, den)) * F.when(s["g"]["large"] == s["g"]["sweep"], -1.0).otherwise(1.0)
        return let(k, lambda k: let(struct(t=t, cu=k * r1 * s["v"] / r2, cv=-k * r2 * s["u"] / r1), swept))

    def swept(c):
        t, s = c["t"], c["t"]["s"]
        first = F.atan2((s["v"] - c["cv"]) / t["r2"], (s["u"] - c["cu"]) / t["r1"])
        last = F.atan2((-s["v"] - c["cv"]) / t["r2"], (-s["u"] - c["cu"]) / t["r1"])
        wrap = lambda d: F.when((s["g"]["sweep"] == 0) & (d > 0), d - 2 * math.pi).when((s["g"]["sweep"] == 1) & (d < 0), d + 2 * math.pi).otherwise(d)
        cx = s["cos"] * c["cu"] - s["sin"] * c["cv"] + (s["g"]["x1"] + s["g"]["x2"]) / 2.0
        cy = s["sin"] * c["cu"] + s["cos"] * c["cv"] + (s["g"]["y1"] + s["g"]["y2"]) / 2.0
        return let(struct(first=first, turn=last - first, cx=cx, cy=cy, r1=t["r1"], r2=t["r2"], cos=s["cos"], sin=s["sin"]), lambda a: let(wrap(a["turn"]), lambda d: F.transform(F.sequence(F.lit(0), F.lit(resolution + 1)), lambda i: on(a, a["first"] + d * i / float(resolution + 1)))))

    def on(a, t):
        return let(struct(c=F.cos(t), s=F.sin(t)), lambda q: point(a["cx"] + a["r1"] * q["c"] * a["cos"] - a["r2"] * q["s"] * a["sin"], a["cy"] + a["r1"] * q["c"] * a["sin"] + a["r2"] * q["s"] * a["cos"]))

    def choose(g):
        flat, none = (g["rx"] == 0) | (g["ry"] == 0), (g["x1"] == g["x2"]) & (g["y1"] == g["y2"])
        return F.when(flat, line(g["x1"], g["y1"], g["x2"], g["y2"])).when(~none, turned(g))

    return let(given, choose)


def path_data(ring) -> Column:
    """SVG path data of a ring, three decimals; empty for fewer than three points."""
    p = _c(ring)
    text = F.array_join(F.transform(p, lambda q: F.format_string("%.3f %.3f", q["x"], q["y"])), " L ")
    return F.when(F.size(p) >= 3, F.concat(F.lit("M "), text, F.lit(" Z"))).otherwise("")


def _hex2(n: Column) -> Column:
    """Lower-case hexadecimal of at least two digits."""
    h = F.lower(F.hex(n))
    return F.when(F.length(h) < 2, F.concat(F.lit("0"), h)).otherwise(h)


def rgb_hex(color, fallback: str = "#888888") -> Column:
    """``rgb(r,g,b)`` as ``#rrggbb``."""
    c = _c(color)
    part = lambda i: _hex2(F.regexp_extract(c, pattern, i).try_cast("long"))
    pattern = r"^rgb\(\s*(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*\)"
    return F.when(c.rlike(pattern), F.concat(F.lit("#"), part(1), part(2), part(3))).otherwise(fallback)
