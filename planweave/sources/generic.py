"""Any SVG to GeoJSON-like features (lines, polylines, polygons, rectangles, circles, ellipses, paths), and GeoJSON back to rows."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planweave.sources.svg import parse_xml

FEATURES = "doc_id long, seq long, kind string, points array<array<double>>, properties map<string,string>, error string"
GEOJSON = "struct<features:array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>>"
_NUMBER = re.compile(r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?")
_TOKEN = re.compile(r"([MmLlHhVvCcSsQqTtAaZz])|" + _NUMBER.pattern)


def _numbers(text: str | None) -> list[float]:
    return [float(x) for x in _NUMBER.findall(text or "")]


def _curve(ctrl: list[complex], t: float) -> complex:
    pts = ctrl
    while len(pts) > 1:
        pts = [a + (b - a) * t for a, b in zip(pts[:-1], pts[1:], strict=True)]
    return pts[0]


def _arc(a: complex, rx: float, ry: float, turn: float, large: bool, sweep: bool, b: complex):
    """A function of t along an endpoint arc."""
    if not rx or not ry or a == b:
        return lambda t: a + (b - a) * t
    rot = complex(math.cos(math.radians(turn)), math.sin(math.radians(turn)))
    q = (a - b) / 2 / rot
    rx, ry = abs(rx), abs(ry)
    grow = math.sqrt(max(1.0, (q.real / rx) ** 2 + (q.imag / ry) ** 2))
    rx, ry = rx * grow, ry * grow
    den = (rx * q.imag) ** 2 + (ry * q.real) ** 2
    k = math.sqrt(max(0.0, (rx * ry) ** 2 - den) / den) * (-1 if large == sweep else 1)
    c = complex(k * rx * q.imag / ry, -k * ry * q.real / rx)
    t0 = math.atan2((q - c).imag / ry, (q - c).real / rx)
    d = math.atan2((-q - c).imag / ry, (-q - c).real / rx) - t0
    d += 2 * math.pi if sweep and d < 0 else -2 * math.pi if not sweep and d > 0 else 0
    mid = c * rot + (a + b) / 2
    return lambda t: mid + complex(rx * math.cos(t0 + t * d), ry * math.sin(t0 + t * d)) * rot


def _segments(d: str) -> Iterator[tuple[str, object]]:
    """(line | curve, function of t) for each drawn segment of path data."""
    tokens = [m[0] for m in _TOKEN.finditer(d)]
    at, here, start, cmd, last = 0, 0j, 0j, "", None

    def take(n: int) -> list[float]:
        nonlocal at
        out = [float(x) for x in tokens[at : at + n]]
        if len(out) < n:
            raise ValueError("path data ends early")
        at += n
        return out

    while at < len(tokens):
        if tokens[at].isalpha():
            cmd = tokens[at]
            at += 1
        elif not cmd or cmd in "Zz":
            raise ValueError("path data has numbers without a command")
        base, up = (here if cmd.islower() else 0j), cmd.upper()
        to = lambda x, y: base + complex(x, y)  # noqa: B023, E731
        if up == "Z":
            b, a = start, here
            yield "line", lambda t, a=a, b=b: a + (b - a) * t
            here, last = start, None
            continue
        if up == "M":
            here = start = to(*take(2))
            cmd, last = ("l" if cmd.islower() else "L"), None
            continue
        if up in "LHV":
            x = take(2 if up == "L" else 1)
            b = to(*x) if up == "L" else complex(x[0] + base.real, here.imag) if up == "H" else complex(here.real, x[0] + base.imag)
            yield "line", lambda t, a=here, b=b: a + (b - a) * t
            here, last = b, None
        elif up == "A":
            rx, ry, turn, large, sweep, x, y = take(7)
            b = to(x, y)
            yield "curve", _arc(here, rx, ry, turn, bool(large), bool(sweep), b)
            here, last = b, None
        else:
            n = {"C": 3, "S": 2, "Q": 2, "T": 1}[up]
            x = take(2 * n)
            pts = [to(x[2 * i], x[2 * i + 1]) for i in range(n)]
            if up in "ST":
                smooth = last and last[0] == ("C" if up == "S" else "Q")
                pts.insert(0, 2 * here - last[1] if smooth else here)
            last = ("C" if up in "CS" else "Q", pts[-2])
            yield "curve", lambda t, c=[here, *pts]: _curve(c, t)
            here = pts[-1]


def sample_path(d: str, most: int = 20) -> list[complex]:
    """Points along path data: two on a line, 8 to ``most`` on a curve by its length; equal neighbours once."""
    out: list[complex] = []
    for kind, f in _segments(d):
        size = abs(f(1.0) - f(0.0)) if kind == "line" else sum(abs(f((i + 1) / 64) - f(i / 64)) for i in range(64))
        if size < 1e-9:
            continue
        n = 2 if kind == "line" else max(8, min(most, int(size / 10) + 2))
        for p in (f(i / (n - 1)) for i in range(n)):
            if not out or out[-1] != p:
                out.append(p)
    return out


def _shape(tag: str, a: dict[str, str]) -> tuple[str, list[complex]] | None:
    num = lambda k, base=0.0: float(a.get(k, base))
    if tag == "line":
        return "LineString", [complex(num("x1"), num("y1")), complex(num("x2"), num("y2"))]
    if tag in ("polyline", "polygon"):
        v = _numbers(a.get("points"))
        p = [complex(x, y) for x, y in zip(v[::2], v[1::2], strict=False)]
        if tag == "polyline":
            return ("LineString", p) if len(p) > 1 else None
        p = _close(p)
        return ("Polygon", p) if len(p) > 3 else None
    if tag == "rect":
        x, y, w, h = num("x"), num("y"), num("width"), num("height")
        return "Polygon", _close([complex(x, y), complex(x + w, y), complex(x + w, y + h), complex(x, y + h)])
    if tag in ("circle", "ellipse"):
        rx, ry = (num("r"), num("r")) if tag == "circle" else (num("rx"), num("ry"))
        return "Polygon", _close([complex(num("cx") + rx * math.cos(2 * math.pi * i / 64), num("cy") + ry * math.sin(2 * math.pi * i / 64)) for i in range(64)])
    p = sample_path(a.get("d", ""))
    if len(p) < 2:
        return None
    return ("Polygon", _close(p)) if len(p) > 3 and abs(p[0] - p[-1]) <= 1e-9 else ("LineString", p)


def _close(p: list[complex]) -> list[complex]:
    return p if not p or p[0] == p[-1] else [*p, p[0]]


def read_shapes(documents: DataFrame, flip: bool = False) -> DataFrame:
    """Shapes of (doc_id, content) in document order; a failing element has no kind, and its error."""
    shapes = {"line", "polyline", "polygon", "rect", "circle", "ellipse", "path"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                root, seq = parse_xml(text), 0
                size = _numbers(root.get("height")) or (_numbers(root.get("viewBox")) + [None] * 4)[3:4]
                height = size[0] if size else None
                for e in root.iter():
                    tag = e.tag.rsplit("}", 1)[-1] if isinstance(e.tag, str) else ""
                    if tag not in shapes:
                        continue
                    props = [*e.attrib.items()]
                    try:
                        got = _shape(tag, e.attrib)
                    except (ValueError, ZeroDivisionError) as x:
                        rows.append((doc, seq, None, None, props, str(x)))
                        seq += 1
                        continue
                    if got:
                        y = (lambda v: height - v) if flip and height is not None else (lambda v: v)
                        rows.append((doc, seq, got[0], [[p.real, y(p.imag)] for p in got[1]], props, None))
                        seq += 1
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.float64())), pa.map_(pa.string(), pa.string()), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in ("doc_id", "seq", "kind", "points", "properties", "error")])

    return documents.select("doc_id", "content").mapInArrow(run, FEATURES)


def shapes_to_geojson(shapes: DataFrame) -> DataFrame:
    """doc_id and a FeatureCollection without name and reference system."""
    poly = F.col("kind") == "Polygon"
    geo = F.when(poly, F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array("points").alias("coordinates")))).when(F.col("kind").isNotNull(), F.to_json(F.struct(F.col("kind").alias("type"), F.col("points").alias("coordinates")))).otherwise("null")
    props = F.when(F.col("error").isNotNull(), F.map_concat("properties", F.create_map(F.lit("conversion_error"), F.col("error")))).otherwise(F.col("properties"))
    feature = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(props), F.lit(',"geometry":'), geo, F.lit("}"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", feature.alias("f")))), lambda s: s["f"]), ",")
    return shapes.groupBy("doc_id").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}")).alias("document"))


def read_rings(documents: DataFrame) -> DataFrame:
    """Rings of the Polygon and MultiPolygon features of GeoJSON (doc_id, content): doc_id, feature, ring, pts."""
    f = documents.select("doc_id", F.posexplode(F.from_json("content", GEOJSON)["features"]).alias("feature", "f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    polys = F.when(kind == "MultiPolygon", F.from_json(text, "array<array<array<array<double>>>>")).when(kind == "Polygon", F.array(F.from_json(text, "array<array<array<double>>>")))
    r = f.withColumn("rings", F.flatten(polys)).select("doc_id", F.col("feature").cast("long").alias("feature"), F.posexplode("rings").alias("ring", "r"))
    return r.select("doc_id", "feature", F.col("ring").cast("long").alias("ring"), F.transform("r", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("pts"))
