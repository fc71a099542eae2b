"""Suffix-array removal of repeated passages (operator 6).

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller doc_id.

1. Winnowing names the places to compare: of every LENGTH bytes, the k-gram with the least hash is an anchor, so that
   equal strings have equal anchors at the same place. An anchor's segment is all that strings around it can cover.
   Each task keeps one row of the same anchor and segment, of the smallest doc_id; the others are removed at once.
2. Rows meet by anchor. Again all but the smallest doc_id of equal segments are removed whole. What is left are anchors
   with several different segments; only these segments are compared byte by byte.
3. Segments of the same anchors are sorted as one suffix array in two stages: suffixes smaller than their successors
   are sorted directly, the others are induced from their successors' ranks by a scan over the buckets of first bytes.
   Neighbours with a common prefix of LENGTH bytes form runs; in each run all but the smallest doc_id are removed.
4. The removed spans meet each document once more, and are cut out of its bytes.

Hot anchors, such as that at the edge of a passage which a third of all documents hold, would bring all these documents'
segments to one task in steps 2 and 3. They are known by counts in ``BUCKETS`` buckets of anchors of a part of the
documents, which decide on the way alone and not on results. Their segments are sorted where they are found: each task
removes repeats among its own, and passes one place of each string of LENGTH bytes on, to meet by that string. A group of
step 3 that is still larger than ``TILE_BYTES`` is sorted in parts, which meet in the same way.

Anchors, equal segments and strings of different sorts are named by 64-bit hashes; within a sort bytes are compared.

Defined cases: a null text is empty; texts of under LENGTH bytes lose nothing; rows with a null doc_id are neither
compared nor changed; rows of one doc_id don't remove each other's bytes, each is judged by its own text, and all are
returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bits_of, ids_and_text, read, released, store, with_bit
from .ngram_join import _groups
from .scan import EXACT_TABLE, Chunk, U, mix, per_chunk

LENGTH, GRAM = 50, 20
REACH = LENGTH - GRAM
#: Anchors that a task gathers before it looks for equal ones among them, and bytes of segments sorted at once.
GATHER, TILE_BYTES = 1_000_000, 1 << 20
CHUNK_BYTES = 1 << 20
SHAPE = 16
#: Hot anchors: buckets of anchors, the part of documents that is counted (one in so many), and how many times the mean, and rows at least, are hot.
BUCKETS, COUNT_ONE_IN, HOT_TIMES, HOT_LEAST = 1 << 16, 16, 8, 1000


def _grams(b: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-grams, by doubling."""
    step = lambda h, d, c: h[:-d] * U(c) + h[d:]
    h1 = EXACT_TABLE[b]
    h2 = step(h1, 1, 0x9E3779B97F4A7C15)
    h4 = step(h2, 2, 0xC2B2AE3D27D4EB4F)
    h8 = step(h4, 4, 0x165667B19E3779F9)
    h16 = step(h8, 8, 0x27D4EB2F165667C5)
    n = len(b) - GRAM + 1
    return h16[:n] * U(0xD6E8FEB86659FD93) + h4[16 : 16 + n]


def anchors(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor: its hash, its segment's hash, its document, and (place in the document << SHAPE | bytes before << 8 | bytes from it on)."""
    none = np.zeros(0, np.int64)
    if len(chunk.buf) < LENGTH:
        return none.view(np.uint64), none.view(np.uint64), none, none
    h = mix(_grams(chunk.buf))
    m = (h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH + 1:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    rest = REACH + 1 - width
    if rest:
        m = np.minimum(m[:-rest], m[rest:])
    sizes = np.diff(chunk.offs)
    whole = np.ones(len(m), bool)
    short = sizes < LENGTH
    # Starts of strings that would run over their document's end.
    for e, s in zip(chunk.offs[1:].tolist(), sizes.tolist(), strict=True):
        whole[max(0, e - min(s, LENGTH - 1)) : e] = False
    at = (m[whole] & U(0xFFFFFFFF)).astype(np.int64)
    if not len(at):
        return none.view(np.uint64), none.view(np.uint64), none, none
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    doc = np.searchsorted(chunk.offs, at, "right") - 1
    assert not short[doc].any()
    lo, hi = np.maximum(chunk.offs[doc], at - REACH), np.minimum(chunk.offs[doc + 1], at + LENGTH)
    before, after = at - lo, hi - at
    return h[at], chunk.hashes(lo, hi) + mix((before << 8 | after).astype(np.uint64)), doc, (at - chunk.offs[doc]) << SHAPE | before << 8 | after


def spans_of(doc: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same spans, overlapping and touching ones of a row of a document joined."""
    if not len(doc):
        return doc, row, lo, hi
    order = np.lexsort((lo, row, doc))
    doc, row, lo, hi = doc[order], row[order], lo[order], hi[order]
    first = np.concatenate([[True], (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])])
    # Ends so far within a row: lifted by row, so that one running maximum serves all.
    lift = np.cumsum(first) * (int(hi.max()) + 1)
    reach = np.maximum.accumulate(hi + lift) - lift
    begin = first.copy()
    begin[1:] |= lo[1:] > reach[:-1]
    at = np.flatnonzero(begin)
    return doc[at], row[at], lo[at], np.maximum.reduceat(hi, at)


def two_stage_order(b: np.ndarray, ends: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """All suffixes of the segments of ``b`` in order of their first ``depth`` bytes at least; ``ends``: each byte's segment end."""
    n = len(b)
    at = np.arange(n)
    last = at + 1 == ends
    follow = np.where(last, -1, np.append(b[1:], 0).astype(np.int16))
    differ = follow != b
    nxt = np.where(differ, at, n)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]  # end of the run of equal bytes
    smaller = follow[nxt] > b  # than the successor: sorted directly
    direct = np.flatnonzero(smaller)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    counts = np.bincount(b, minlength=256)
    base = np.cumsum(counts) - counts
    induced = np.bincount(b[~smaller], minlength=256)
    padded = np.concatenate([b, np.zeros(depth, np.uint8)])
    keys = padded[direct[:, None] + np.arange(depth)]
    keys[np.arange(depth) >= (ends[direct] - direct)[:, None]] = 0
    order = direct[np.argsort(keys.view(f"S{depth}").ravel(), kind="stable")]
    first = b[order]
    offset = np.arange(len(order)) - (np.cumsum(np.bincount(first, minlength=256)) - np.bincount(first, minlength=256))[first]
    rank[order] = base[first] + induced[first] + offset
    rest = np.flatnonzero(~smaller)
    rest = rest[np.argsort(b[rest], kind="stable")]
    bounds = np.concatenate([[0], np.cumsum(induced)])
    for c in np.flatnonzero(induced).tolist():
        own = rest[bounds[c] : bounds[c + 1]]
        run = nxt[own] - own
        succ = np.where(last[nxt[own]], n, nxt[own] + 1)
        own = own[np.lexsort((rank[succ], run))]
        rank[own] = base[c] + np.arange(len(own))
    out = np.empty(n, np.int64)
    out[rank[:n]] = at
    return out


def runs(segments: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The places of all strings of LENGTH bytes in order of their bytes: segment, start in it, whether a new string begins, the string's smallest doc, and its hash."""
    offs = np.cumsum([0, *map(len, segments)])
    b = np.frombuffer(b"".join(segments), np.uint8)
    seg = np.repeat(np.arange(len(segments)), np.diff(offs))
    ends = offs[1:][seg]
    order = two_stage_order(b, ends)
    order = order[ends[order] - order >= LENGTH]
    if not len(order):
        return order, order, order.astype(bool), order, order.astype(np.uint64)
    padded = np.concatenate([b, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(b) + 1, 8), (1, 1)).copy().view("<u8").ravel()
    same = np.ones(len(order) - 1, bool)  # whether the common prefix of neighbours reaches LENGTH
    for shift in (*range(0, LENGTH - 7, 8), LENGTH - 8):
        w = words[order + shift]
        same &= w[1:] == w[:-1]
    new = np.concatenate([[True], ~same])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(order)))
    least = np.repeat(np.minimum.reduceat(docs[seg[order]], begin), size)
    names = Chunk(b, np.array([0, len(b)]), slice(0, 1)).hashes(order[begin], order[begin] + LENGTH)
    return seg[order], order - offs[seg[order]], new, least, np.repeat(names, size)


def repeated(segments: list[bytes], docs: np.ndarray, limit: int = TILE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(segment, start in it) of each LENGTH bytes that also stand in a segment of a smaller doc; more than ``limit`` bytes are sorted in parts."""
    size = np.cumsum([len(x) for x in segments])
    parts, begin, kept = [], 0, []
    while begin < len(segments):
        end = max(begin + 1, int(np.searchsorted(size, (size[begin - 1] if begin else 0) + limit, "right")))
        seg, start, _, least, names = runs(segments[begin:end], docs[begin:end])
        seg += begin
        hit = docs[seg] > least
        parts.append((seg[hit], start[hit]))
        if begin or end < len(segments):
            kept.append((names[~hit], seg[~hit], start[~hit]))
        begin = end
    if kept:
        names, seg, start = (np.concatenate(x) for x in zip(*kept, strict=True))
        order = np.lexsort((docs[seg], names))
        names, seg, start = names[order], seg[order], start[order]
        first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else names.astype(int)
        least = np.repeat(docs[seg[first]], np.diff(np.append(first, len(names))))
        parts.append((seg[docs[seg] > least], start[docs[seg] > least]))
    if not parts:
        return np.zeros(0, int), np.zeros(0, int)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


MARKS = "h long, s long, doc_id long, row long, place long"
_MARKS = ["h", "s", "doc_id", "row", "place"]


def _marks(h, s, doc, row, place) -> pa.RecordBatch:
    as_long = lambda x: pa.array(x.view(np.int64) if x.dtype == np.uint64 else x)
    return pa.RecordBatch.from_arrays([as_long(x) for x in (h, s, doc, row, place)], _MARKS)


def _spans(doc: np.ndarray, row: np.ndarray, place: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Spans to remove, as (null, start, doc_id, row, end)."""
    at = place >> SHAPE
    doc, row, lo, hi = spans_of(doc, row, at - (place >> 8 & 0xFF), at + (place & 0xFF))
    if len(doc):
        yield pa.RecordBatch.from_arrays([pa.nulls(len(doc), pa.int64()), pa.array(lo), pa.array(doc), pa.array(row), pa.array(hi)], _MARKS)


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


class _Gather:
    """What a task has found and not yet passed on: anchors with their segments' hashes, and the segments of hot anchors."""

    def __init__(self, hot: np.ndarray):
        self.hot, self.cold, self.warm, self.size = hot, [], [], 0

    def add(self, rows: pa.RecordBatch, chunk: Chunk) -> Iterator[pa.RecordBatch]:
        ids, own = rows.column(0), rows.column(2).to_numpy()
        valid, ids = np.asarray(ids.is_valid()), ids.fill_null(0).to_numpy()
        h, s, doc, place = anchors(chunk)
        ok = valid[doc]
        warm = ok & self.hot[(h % U(BUCKETS)).astype(np.int64)] if self.hot.any() else np.zeros(len(h), bool)
        at = np.flatnonzero(ok & ~warm)
        self.cold.append((h[at], s[at], ids[doc[at]], own[doc[at]], place[at]))
        if sum(len(x[0]) for x in self.cold) >= GATHER:
            yield from self.pass_cold()
        for i in np.flatnonzero(warm).tolist():
            p, d = int(place[i]), int(doc[i])
            lo, hi = (p >> SHAPE) - (p >> 8 & 0xFF), (p >> SHAPE) + (p & 0xFF)
            base = int(chunk.offs[d])
            self.warm.append((chunk.buf[base + lo : base + hi].tobytes(), int(ids[d]), int(own[d]), lo))
            self.size += hi - lo
            if self.size >= TILE_BYTES:
                yield from self.pass_warm()

    def pass_cold(self) -> Iterator[pa.RecordBatch]:
        """A row (anchor, segment, doc_id, row, place) for the smallest doc_id of each segment, and the others' spans."""
        h, s, doc, row, place = (np.concatenate(x) for x in zip(*self.cold, strict=True))
        self.cold = []
        if not len(h):
            return
        both = h ^ mix(s)
        order = np.lexsort((place, row, doc, both))
        both, h, s, doc, row, place = both[order], h[order], s[order], doc[order], row[order], place[order]
        begin = np.flatnonzero(_new(both))
        least = np.repeat(doc[begin], np.diff(np.append(begin, len(doc))))
        keep = np.flatnonzero((doc == least) & _new(both, doc, row, place))
        for at in range(0, len(keep), 200_000):
            part = keep[at : at + 200_000]
            yield _marks(h[part], s[part], doc[part], row[part], place[part])
        yield from _spans(doc[doc > least], row[doc > least], place[doc > least])

    def pass_warm(self) -> Iterator[pa.RecordBatch]:
        """The same for each string of LENGTH bytes of the hot anchors' segments: (string, 0, doc_id, row, place)."""
        if not self.warm:
            return
        segments, doc, row, lo = zip(*self.warm, strict=True)
        self.warm, self.size = [], 0
        doc, row, lo = (np.array(x, np.int64) for x in (doc, row, lo))
        seg, start, _, least, names = runs(list(segments), doc)
        d, r, at = doc[seg], row[seg], lo[seg] + start
        place = at << SHAPE | LENGTH
        yield from _spans(d[d > least], r[d > least], place[d > least])
        order = np.flatnonzero(d == least)
        order = order[np.lexsort((at[order], r[order], d[order], names[order]))]
        order = order[_new(names[order], d[order], r[order], at[order])]
        for k in range(0, len(order), 200_000):
            part = order[k : k + 200_000]
            yield _marks(names[part], np.zeros(len(part), np.int64), d[part], r[part], place[part])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole groups of equal anchors: spans to remove, and rows (anchor, 0, doc_id, row, place) whose bytes must be compared."""
    for batch in _split_marks(batches):
        if isinstance(batch, pa.RecordBatch):
            yield batch
            continue
        h, s, doc, row, place = (batch.column(c).to_numpy() for c in _MARKS)
        order = np.lexsort((place, row, doc, s, h))
        order = order[_new(*(x[order] for x in (h, s, doc, row, place)))]
        h, s, doc, row, place = h[order], s[order], doc[order], row[order], place[order]
        new = _new(h)
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(h)))
        many = np.repeat(np.minimum.reduceat(doc, begin) != np.maximum.reduceat(doc, begin), size)
        variant = _new(h, s)
        first = np.flatnonzero(variant)
        least = np.repeat(doc[first], np.diff(np.append(first, len(doc))))
        several = np.repeat(np.add.reduceat(variant.astype(np.int64), begin) > 1, size)
        gone = many & (doc > least)
        yield from _spans(doc[gone], row[gone], place[gone])
        need = many & several & (doc == least)
        if need.any():
            yield _marks(h[need], np.zeros(int(need.sum()), np.int64), doc[need], row[need], place[need])


def _split_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | pa.Table]:
    """Spans as they come (they sort first), anchors in whole groups."""

    def anchors_only() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("h").null_count
            if n:
                marks.append(batch.slice(0, n))
            if n < batch.num_rows:
                yield batch.slice(n)

    marks: list[pa.RecordBatch] = []
    for table in _groups(anchors_only(), "h"):
        yield from marks
        marks.clear()
        yield table
    yield from marks


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text, row: with doc_id, ``row`` tells texts apart; 0 but where a doc_id has different texts, and for few others.

    What is sent to the executors is a bitmap of fixed size, whatever the number of such ids."""
    docs = ids_and_text(docs)
    texts = docs.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("t")).groupBy("doc_id").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    data = bits_of(texts.filter("a <> b"), "doc_id")
    if not any(data):
        return docs.withColumn("row", F.lit(0).cast("long"))
    table, hit = with_bit(docs, "doc_id", data)
    return docs.join(table, hit, "left").select("doc_id", "text", F.when(F.col("bitmap").isNotNull(), F.xxhash64("text")).otherwise(0).alias("row"))


def hot_buckets(docs: DataFrame, one_in: int = COUNT_ONE_IN, least: int = HOT_LEAST) -> np.ndarray:
    """Flags of the buckets of anchors with many segments, counted over a part of the documents; BUCKETS counts at most reach the driver.

    Equal segments that a task holds at a time count once, as they are passed on once. Buckets are of an anchor's low bits: the high ones are small, since the least hash is taken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = np.zeros(BUCKETS, np.int64), []

        def count() -> None:
            h, both = (np.concatenate(x) for x in zip(*held, strict=True))
            _, once = np.unique(both, return_index=True)
            counts[:] += np.bincount((h[once] % U(BUCKETS)).astype(np.int64), minlength=BUCKETS)
            held.clear()

        for _, chunk in per_chunk(batches, CHUNK_BYTES):
            h, s, _, _ = anchors(chunk)
            held.append((h, h ^ mix(s)))
            if sum(len(x[0]) for x in held) >= GATHER:
                count()
        if held:
            count()
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])

    part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0)
    counts = part.mapInArrow(released(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    mean = F.sum("n").over(Window.partitionBy()) / BUCKETS
    hot = np.zeros(BUCKETS, bool)
    hot[[r.bucket for r in counts.withColumn("mean", mean).filter((F.col("n") * one_in > least) & (F.col("n") > HOT_TIMES * F.col("mean"))).select("bucket").collect()]] = True
    return hot


def removed_spans(docs: DataFrame, one_in: int = COUNT_ONE_IN, least: int = HOT_LEAST) -> DataFrame:
    """``doc_id, row, lo, hi``: byte spans to remove, for rows of ``numbered``; they may overlap."""
    docs = docs.filter("doc_id is not null")
    hot = hot_buckets(docs, one_in, least)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Gather(hot)
        for rows, chunk in per_chunk(batches, CHUNK_BYTES):
            yield from held.add(rows, chunk)
        if held.cold:
            yield from held.pass_cold()
        yield from held.pass_warm()

    # Spans go along under a key of their own document, so that they are spread, and sort before anchors as nulls.
    met = docs.mapInArrow(released(candidates), MARKS).repartition(F.coalesce("h", F.xxhash64("doc_id", "s"))).sortWithinPartitions("h").mapInArrow(released(_meet), MARKS)
    met = store(met, "anchors")
    done = met.filter("h is null").select("doc_id", "row", F.col("s").alias("lo"), F.col("place").alias("hi"))
    places = met.filter("h is not null").groupBy("doc_id", "row").agg(F.collect_list(F.struct("h", "place")).alias("places"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, row, text, places in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), batch.column("text").to_pylist(), batch.column("places"), strict=True):
                raw = text.encode()
                for h, p in zip(places.values.field("h").to_pylist(), places.values.field("place").to_pylist(), strict=True):
                    at = p >> SHAPE
                    out.append((h, doc, row, at - (p >> 8 & 0xFF), raw[at - (p >> 8 & 0xFF) : at + (p & 0xFF)]))
            if out:
                *longs, seg = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in longs), pa.array(seg, pa.binary())], ["h", "doc_id", "row", "lo", "segment"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "h"):
            h, doc, row, lo = (table.column(c).to_numpy() for c in ("h", "doc_id", "row", "lo"))
            segments = table.column("segment").to_pylist()
            upto, begin = np.cumsum([len(x) for x in segments]), 0
            for end in [*(np.flatnonzero(h[1:] != h[:-1]) + 1).tolist(), len(h)]:
                if end < len(h) and upto[end - 1] - (upto[begin - 1] if begin else 0) < TILE_BYTES:
                    continue
                seg, start = repeated(segments[begin:end], doc[begin:end])
                at = lo[begin:end][seg] + start
                spans = spans_of(doc[begin:end][seg], row[begin:end][seg], at, at + LENGTH)
                if len(spans[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in spans], ["doc_id", "row", "lo", "hi"])
                begin = end

    segments = docs.join(places, ["doc_id", "row"]).select("doc_id", "row", "text", "places").mapInArrow(released(fetch), "h long, doc_id long, row long, lo long, segment binary")
    more = segments.repartition("h").sortWithinPartitions("h").mapInArrow(released(compare), "doc_id long, row long, lo long, hi long")
    return done.unionAll(store(more, "spans"))


def remove_repeats(docs: DataFrame, one_in: int = COUNT_ONE_IN, least: int = HOT_LEAST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left), kept_sha256 for every row of ``docs``.

    ``one_in`` and ``least`` say when anchors count as hot; results don't depend on them."""
    docs = numbered(docs)
    spans = removed_spans(docs, one_in, least).groupBy("doc_id", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
                raw = (text or "").encode()
                if not spans.is_valid:
                    out.append((len(raw), 0, 0, raw, hashlib.sha256(raw).hexdigest()))
                    continue
                lo, hi = (spans.values.field(c).to_numpy() for c in ("lo", "hi"))
                none = np.zeros(len(lo), np.int64)
                *_, lo, hi = spans_of(none, none, lo, hi)
                parts, at = [], 0
                for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
                    parts.append(raw[at:a])
                    at = b
                kept = b"".join([*parts, raw[at:]])
                out.append((len(raw), len(raw) - len(kept), len(lo), kept, hashlib.sha256(kept).hexdigest()))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary()), pa.array(cols[4])], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    return docs.join(spans, ["doc_id", "row"], "left").select("doc_id", "text", "spans").mapInArrow(released(cut), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")
