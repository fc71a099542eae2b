"""The results of operators 2, 6 and 8 as SQL for DuckDB."""

from __future__ import annotations

from planweave.llm.licenses import CONTAINMENT, PHRASES, TEMPLATES, block_words

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TEXT = f"translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}')"

NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_TEXT}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM w),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
u AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(d, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.d)
SELECT n.doc_id, n.n AS n_shingles, MIN(r.root) AS component_id FROM n JOIN r ON r.d = n.doc_id GROUP BY 1, 2
"""

REPEATS = """
WITH h AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS i FROM h WHERE length(h) >= 100) q),
least AS (SELECT s, MIN(doc_id) AS d FROM win GROUP BY s),
hit AS (SELECT win.doc_id, i FROM win JOIN least ON win.s = least.s AND win.doc_id > least.d),
isle AS (SELECT doc_id, i, SUM(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM (SELECT doc_id, i, LAG(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit) q),
span AS (SELECT doc_id, MIN(i) AS lo, MAX(i) + 50 AS hi FROM isle GROUP BY doc_id, k),
edge AS (SELECT doc_id, lo, hi, LEAD(lo) OVER (PARTITION BY doc_id ORDER BY lo) AS nxt FROM span),
cut AS (
  SELECT h.doc_id, SUM(e.hi - e.lo) AS n_removed, COUNT(*) AS n_spans,
    substring(h.h, 1, 2 * MIN(e.lo)) || string_agg(substring(h.h, 2 * e.hi + 1, CASE WHEN e.nxt IS NULL THEN length(h.h) ELSE 2 * (e.nxt - e.hi) END), '' ORDER BY e.lo) AS kept
  FROM h JOIN edge e ON e.doc_id = h.doc_id GROUP BY h.doc_id, h.h)
SELECT h.doc_id, CAST(length(h.h) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, CAST(COALESCE(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(COALESCE(kept, h.h))) AS kept_sha256
FROM h LEFT JOIN cut ON cut.doc_id = h.doc_id
"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


LICENSES = rf"""
WITH w AS (SELECT doc_id, {_TEXT} AS t, regexp_extract_all({_TEXT}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
phrase(label, p) AS (SELECT label, string_split(p, ' ') FROM (VALUES {_values((label, p) for p, label in PHRASES.items())}) v(label, p)),
place AS (SELECT doc_id, label, i - 1 AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w) q JOIN phrase ON w[i:i + len(p) - 1] = p),
base AS (SELECT doc_id, COUNT(*) AS n_base, MIN(word) AS first_word, MAX(word) AS last_word, list_distinct(list(label)) AS labels FROM place GROUP BY doc_id),
template(label, t, own, size) AS (SELECT label, list_distinct(string_split(t, ' ')), list_filter(string_split(own, ' '), lambda x: x <> ''), size FROM (VALUES {_values((label, t, own, block_words(t)) for label, t, own in TEMPLATES)}) v(label, t, own, size)),
near AS (SELECT doc_id, w.w, label, template.t, own, size FROM w JOIN template ON len(list_intersect(list_distinct(w.w), template.t)) >= {CONTAINMENT} * len(template.t)),
part AS (SELECT label, t, own, doc_id, list_distinct(w[i:i + size - 1]) AS s FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM near) q WHERE list_contains(t, w[i])),
block AS (SELECT doc_id, label, CAST(len(list_intersect(s, t)) AS DOUBLE) / len(t) AS c FROM part WHERE len(list_intersect(s, t)) >= {CONTAINMENT} * len(t) AND len(list_intersect(s, own)) = len(own)),
own AS (SELECT doc_id, MAX(c) AS c, list_distinct(list(label)) AS labels FROM block GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(COALESCE(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  COALESCE(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  COALESCE(array_to_string(list_sort(list_distinct(list_concat(COALESCE(base.labels, []), COALESCE(own.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE COALESCE(c, 0.0) END AS score
FROM w LEFT JOIN base ON base.doc_id = w.doc_id LEFT JOIN own ON own.doc_id = w.doc_id
"""
