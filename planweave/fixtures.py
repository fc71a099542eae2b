"""Floor-plan shaped inputs derived from the driver's tables, in SQL that Spark and DuckDB evaluate alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Table names are written {name}, so that Spark puts a DataFrame there and DuckDB a table or an earlier part.
PARTS = {
    "prims": """
WITH k AS (
  SELECT l_orderkey AS ok, CAST(l_linenumber AS BIGINT) AS ln, MIN(l_partkey) AS pk, MIN(l_suppkey) AS sk, MIN(CAST(l_quantity AS BIGINT)) AS q
  FROM {lineitem} GROUP BY l_orderkey, l_linenumber),
g AS (
  SELECT sk AS floor_id, ok * 8 + ln AS primitive_id, pk, ok, q,
    CAST((pk * 7 + ok * 3) % 1200 AS DOUBLE) / CAST(10 AS DOUBLE) AS x1, CAST((ok * 11 + ln * 17) % 1200 AS DOUBLE) / CAST(10 AS DOUBLE) AS y1
  FROM k)
SELECT floor_id, primitive_id,
  CAST(CASE pk % 24 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 5 WHEN 4 THEN 7 WHEN 5 THEN 28 WHEN 6 THEN 29
    WHEN 7 THEN 30 WHEN 8 THEN 25 WHEN 9 THEN 26 WHEN 10 THEN 27 WHEN 11 THEN 19 WHEN 12 THEN 11 WHEN 13 THEN 13
    WHEN 14 THEN 35 WHEN 15 THEN 31 WHEN 16 THEN 32 WHEN 17 THEN NULL WHEN 18 THEN 34 ELSE 33 END AS INT) AS semantic_id,
  CAST(CASE WHEN pk % 10 = 0 THEN NULL WHEN pk % 10 = 1 THEN -1 ELSE ok % 7 END AS INT) AS instance_id,
  x1, y1,
  x1 + CAST(CASE q % 5 WHEN 0 THEN 12 WHEN 1 THEN 0 WHEN 2 THEN 3 WHEN 3 THEN 20 ELSE 3 END AS DOUBLE) AS x2,
  y1 + CAST(CASE q % 5 WHEN 0 THEN 0 WHEN 1 THEN 12 WHEN 2 THEN 3 WHEN 3 THEN 20 ELSE 4 END AS DOUBLE) AS y2
FROM g""",
    "dims": """
SELECT s_suppkey AS floor_id, 2 + s_suppkey % 4 AS nc, 2 + s_suppkey % 3 AS nr, 10 + s_suppkey % 5 AS w, 8 + s_suppkey % 7 AS h FROM {supplier}""",
    "steps": "SELECT CAST(n_nationkey AS BIGINT) AS i FROM {nation} WHERE n_nationkey < 7",
    "grid_edges": """
SELECT floor_id, CAST(a.i * w AS DOUBLE) AS x1, CAST(b.i * h AS DOUBLE) AS y1, CAST((a.i + 1) * w AS DOUBLE) AS x2, CAST(b.i * h AS DOUBLE) AS y2
FROM {dims} JOIN {steps} a ON a.i < nc JOIN {steps} b ON b.i <= nr
UNION ALL
SELECT floor_id, CAST(a.i * w AS DOUBLE), CAST(b.i * h AS DOUBLE), CAST(a.i * w AS DOUBLE), CAST((b.i + 1) * h AS DOUBLE)
FROM {dims} JOIN {steps} a ON a.i <= nc JOIN {steps} b ON b.i < nr""",
    "cells": """
SELECT floor_id, a.i AS ci, b.i AS cj, CAST(a.i * w AS DOUBLE) AS minx, CAST(b.i * h AS DOUBLE) AS miny,
  CAST((a.i + 1) * w AS DOUBLE) AS maxx, CAST((b.i + 1) * h AS DOUBLE) AS maxy, CAST(w * h AS DOUBLE) AS area,
  CAST(CASE (a.i + 2 * b.i + floor_id) % 11 WHEN 0 THEN 28 WHEN 1 THEN 30 WHEN 2 THEN 29 WHEN 3 THEN 27 WHEN 4 THEN 19
    WHEN 5 THEN 31 WHEN 6 THEN 11 WHEN 7 THEN 32 WHEN 8 THEN 35 ELSE NULL END AS INT) AS object_sem
FROM {dims} JOIN {steps} a ON a.i < nc JOIN {steps} b ON b.i < nr""",
    # Whole plans: rooms of w by h in walls 2 thick, a canvas 10 wider on all sides, a door between the first two rooms, a
    # window below the second, a hatching stroke in the outer wall, and objects in the middle of rooms.
    "sheets": """
SELECT floor_id, nc, nr, w, h, CAST(nc * (w + 2) + 2 AS DOUBLE) AS wide, CAST(nr * (h + 2) + 2 AS DOUBLE) AS high FROM {dims}""",
    "rooms": """
SELECT floor_id, a.i AS ci, b.i AS cj, CAST(12 + a.i * (w + 2) AS DOUBLE) AS x, CAST(12 + b.i * (h + 2) AS DOUBLE) AS y, CAST(w AS DOUBLE) AS w, CAST(h AS DOUBLE) AS h,
  a.i = 0 AND b.i = 0 AS left_of_door, a.i = 1 AND b.i = 0 AS right_of_door,
  CAST(CASE (a.i + 2 * b.i + floor_id) % 11 WHEN 0 THEN 28 WHEN 1 THEN 30 WHEN 2 THEN 29 WHEN 3 THEN 27 WHEN 4 THEN 19
    WHEN 5 THEN 31 WHEN 6 THEN 11 WHEN 7 THEN 32 WHEN 8 THEN 35 ELSE NULL END AS INT) AS object_sem
FROM {sheets} JOIN {steps} a ON a.i < nc JOIN {steps} b ON b.i < nr""",
    "strokes": """
WITH s AS (
  SELECT floor_id, 33 AS semantic_id, CAST(NULL AS INT) AS instance_id, x AS x1, y AS y1, CASE WHEN right_of_door THEN x + 2 ELSE x + w END AS x2, y AS y2 FROM {rooms}
  UNION ALL SELECT floor_id, 33, NULL, x + 6, y, x + w, y FROM {rooms} WHERE right_of_door
  UNION ALL SELECT floor_id, 33, NULL, x, y + h, x + w, y + h FROM {rooms}
  UNION ALL SELECT floor_id, 33, NULL, x, y, x, CASE WHEN right_of_door THEN y + 2 ELSE y + h END FROM {rooms}
  UNION ALL SELECT floor_id, 33, NULL, x, y + 6, x, y + h FROM {rooms} WHERE right_of_door
  UNION ALL SELECT floor_id, 33, NULL, x + w, y, x + w, CASE WHEN left_of_door THEN y + 2 ELSE y + h END FROM {rooms}
  UNION ALL SELECT floor_id, 33, NULL, x + w, y + 6, x + w, y + h FROM {rooms} WHERE left_of_door
  UNION ALL SELECT floor_id, 34, NULL, 10, 10, x + 2, 10 FROM {rooms} WHERE right_of_door
  UNION ALL SELECT r.floor_id, 34, NULL, x + 6, 10, 10 + wide, 10 FROM {rooms} r JOIN {sheets} d ON r.floor_id = d.floor_id WHERE right_of_door
  UNION ALL SELECT floor_id, 34, NULL, 10, 10 + high, 10 + wide, 10 + high FROM {sheets}
  UNION ALL SELECT floor_id, 34, NULL, 10, 10, 10, 10 + high FROM {sheets}
  UNION ALL SELECT floor_id, 34, NULL, 10 + wide, 10, 10 + wide, 10 + high FROM {sheets}
  UNION ALL SELECT floor_id, 33, NULL, CAST(105 AS DOUBLE) / 10, CAST(105 AS DOUBLE) / 10, CAST(109 AS DOUBLE) / 10, CAST(109 AS DOUBLE) / 10 FROM {sheets}
  UNION ALL SELECT floor_id, 1, 1, x + w, y + 2, x + w + 2, y + 6 FROM {rooms} WHERE left_of_door
  UNION ALL SELECT floor_id, 7, 2, x + 2, 10, x + 6, 12 FROM {rooms} WHERE right_of_door
  UNION ALL SELECT floor_id, object_sem, CAST(100 + ci * 10 + cj AS INT), x + w / 2 - 1, y + h / 2, x + w / 2 + 1, y + h / 2 FROM {rooms} WHERE object_sem IS NOT NULL)
SELECT floor_id, ROW_NUMBER() OVER (PARTITION BY floor_id ORDER BY semantic_id, x1, y1, x2, y2) AS primitive_id, CAST(semantic_id AS INT) AS semantic_id, instance_id,
  CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM s""",
    "openings": """
SELECT o_orderkey AS instance_id, o_custkey % 100 AS floor_id,
  CAST((o_orderkey * 7) % 800 AS DOUBLE) / CAST(10 AS DOUBLE) AS x0, CAST((o_orderkey * 13) % 800 AS DOUBLE) / CAST(10 AS DOUBLE) AS y0,
  CASE WHEN o_orderkey % 50 = 0 THEN CAST(60 AS DOUBLE) WHEN o_orderkey % 7 = 0 THEN CAST(1 AS DOUBLE) / CAST(2 AS DOUBLE) ELSE CAST(1 + o_orderkey % 9 AS DOUBLE) END AS w,
  CASE WHEN o_orderkey % 50 = 0 THEN CAST(60 AS DOUBLE) ELSE CAST(o_orderkey % 4 AS DOUBLE) / CAST(4 AS DOUBLE) END AS h,
  CAST(CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE 1 END AS INT) AS semantic_id
FROM {orders}""",
    "thick": """
SELECT p_partkey % 40 AS floor_id, p_partkey AS face_id,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(15 AS DOUBLE) + CAST(p_size AS DOUBLE) / CAST(2 AS DOUBLE) ELSE CAST(8 + p_size % 20 AS DOUBLE) / CAST(10 AS DOUBLE) END AS thickness,
  p_partkey % 17 = 1 AS hatched
FROM {part}""",
    "controls": """
SELECT CAST(c_nationkey AS BIGINT) AS floor_id, CAST(c_custkey % 140 AS DOUBLE) AS sx, CAST((c_custkey * 3) % 97 AS DOUBLE) AS sy,
  CAST(29 AS DOUBLE) + CAST(c_custkey % 140 AS DOUBLE) / CAST(20000 AS DOUBLE) + c_acctbal / CAST(1000000000 AS DOUBLE) AS gx,
  CAST(41 AS DOUBLE) + CAST((c_custkey * 3) % 97 AS DOUBLE) / CAST(90000 AS DOUBLE) - c_acctbal / CAST(1000000000 AS DOUBLE) AS gy
FROM {customer}""",
    "names": """
SELECT CAST(n_nationkey AS BIGINT) AS floor_id, CONCAT('PLAN', CASE n_nationkey % 6 WHEN 0 THEN '_12KAT_a.svg' WHEN 1 THEN '_1.kat_a.svg' WHEN 2 THEN '_2BODRUM_a.svg'
  WHEN 3 THEN '_BodrumKat_a.svg' WHEN 4 THEN '_ZeminKat_a.svg' ELSE '_other.svg' END) AS file_name
FROM {nation}""",
}
_TABLES = ("lineitem", "supplier", "nation", "orders", "part", "customer")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a DataFrame; only the columns it needs reach the scan."""
    text = PARTS[name]
    own = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES if "{%s}" % t in text}
    own |= {p: load(spark, sf_dir, p) for p in PARTS if "{%s}" % p in text}
    return spark.sql(text, **own)


def sql(body: str, *names: str) -> str:
    """DuckDB SQL: the named derived tables, with those they need, before ``body``."""
    done: list[str] = []

    def add(name: str) -> None:
        for p in PARTS:
            if "{%s}" % p in PARTS[name] and p not in done:
                add(p)
        if name not in done:
            done.append(name)

    for n in names:
        add(n)
    plain = {k: k for k in (*_TABLES, *PARTS)}
    rest = body.strip()
    ctes = ",\n".join(f"{n} AS ({PARTS[n].format(**plain).strip()})" for n in done)
    start = next((w for w in ("WITH RECURSIVE ", "WITH ") if rest.upper().startswith(w)), "")
    return f"{start or 'WITH '}{ctes}{', ' + rest[len(start):] if start else chr(10) + rest}"
