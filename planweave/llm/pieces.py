"""SentencePiece encoding and decoding with distinct sampled segmentations (operator 5).

A text's segmentations are the paths of a lattice over the model's pieces, with a probability by the pieces' weights: a
tempered power of a piece's rank, as word frequencies have. ``k`` of them are drawn without replacement by the Gumbel
top-k trick. Every set of segmentations has a perturbed value, the largest of its members' log probabilities with
independent Gumbel noise. A best-first search pops the set with the largest value; the value is a bound that is met, so
what is popped is the next sample. The set then splits into the sample and, for each unit of the text, the segmentations
that part from the sample there; their values are Gumbel variables cut at the parent's value. The search ends with the
value that the next sample would have had, the threshold kappa; a sample's inclusion score is the probability
``1 - exp(-exp(log_prob - kappa))`` that it exceeds kappa.

Units are the parts of a text that no piece crosses, such as a space with the word behind it, or a line feed. Lattices are solved
once for each distinct unit of a chunk; sampling runs over all units of a chunk at once. Random numbers come from a hash
of the row key (doc_id), the seed, the sample's number and the place, so results don't depend on partitions or order.

Bytes of characters without a piece are byte pieces, so decoding gives back every text exactly.

Defined cases: a null or empty text has one segmentation, of no pieces; a text with fewer than k segmentations gives
all; a null doc_id is a row key of its own; rows of one doc_id draw alike, so that repeated rows give repeated results;
an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ids_and_text, read, released
from .scan import Chunk, U, chunks, mix

MODEL = "piece_bpe_32k.model"
SAMPLES, SEED = 2, 11
#: Weight of the piece of rank r: (r + FLAT) ** -POWER.
POWER, FLAT = 0.6, 50
#: Bytes of text whose lattices are solved at once: equal units are solved once, a worker needs about 140 MB for each MB.
CHUNK_BYTES = 1 << 20
_WORD = (1 << 64) - 1


class Pieces:
    """The model's pieces: their bytes (spaces for the word mark), log weights, and a hash index."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.raw: dict[int, bytes] = {i: bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids}
        plain = [i for i in ids if not sp.is_byte(i)]
        rank = np.empty(len(plain))
        rank[np.lexsort((plain, [-sp.get_score(i) for i in plain]))] = np.arange(len(plain))
        self.weight = np.zeros(sp.vocab_size())
        self.weight[plain] = -POWER * np.log(rank + FLAT)
        self.byte_id = np.zeros(256, np.int64)
        for i in ids:
            if sp.is_byte(i):
                self.byte_id[self.raw[i][0]] = i
                self.weight[i] = -POWER * np.log(len(plain) + FLAT)
        data = [self.raw[i] for i in plain]
        self.lengths = sorted({len(x) for x in data})
        # Hashes of the pieces and of what they begin with at these lengths, which have no id.
        named = {x[:n]: -1 for x in data for n in self.lengths if n < len(x)} | dict(zip(data, plain, strict=True))
        offs = np.cumsum([0, *map(len, named)])
        h = Chunk(np.frombuffer(b"".join(named), np.uint8), offs, slice(0, len(named))).hashes(offs[:-1], offs[1:])
        order = np.argsort(h)
        self.hashes, self.ids = np.append(h[order], U(0)), np.append(np.array(list(named.values()))[order], -1)
        #: The first of the sorted hashes with these leading bits, or the sentinel behind them all.
        self.near = np.full(1 << 20, len(h), np.int32)
        lead = (h[order] >> U(44)).astype(np.int64)
        self.near[lead[::-1]] = np.arange(len(h), dtype=np.int32)[::-1]
        self.chain = int(np.bincount(lead).max())
        self.inside = np.zeros(1 << 16, bool)  # which two bytes are neighbours in a piece
        for x in data:
            self.inside[[a << 8 | b for a, b in zip(x[:-1], x[1:], strict=True)]] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are of a piece or of its beginning, and the piece's id or -1."""
        at = self.near[(h >> U(44)).view(np.int64)]
        ok = self.hashes[at] == h
        other = np.flatnonzero(~ok & (at < len(self.hashes) - 1))
        for _ in range(self.chain - 1):
            at[other] += 1
            here = self.hashes[at[other]] == h[other]
            ok[other[here]] = True
            other = other[~here & (at[other] < len(self.hashes) - 1)]
        hit = np.flatnonzero(ok)
        return hit, self.ids[at[hit]]

    def decode(self, ids) -> str:
        return b"".join([self.raw[i] for i in ids])[1:].decode()

    def texts(self, ids: pa.ListArray) -> list[str | None]:
        """What each list of ids spells."""
        table = np.empty(max(self.raw) + 1, object)
        table[list(self.raw)] = list(self.raw.values())
        flat, at, none = ids.values.to_numpy(), ids.offsets.to_numpy(), np.asarray(ids.is_null())
        return [None if gone else b"".join(table[flat[a:b]].tolist())[1:].decode() for a, b, gone in zip(at[:-1].tolist(), at[1:].tolist(), none.tolist(), strict=True)]


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _scatter(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """x[i] at place[i]."""
    out = np.empty_like(x)
    out[place] = x
    return out


class Lattice:
    """Lattices of distinct units. Nodes are byte places; edges are sorted by node, with conditional log probabilities."""

    def __init__(self, model: Pieces, chunk: Chunk):
        buf, offs = chunk.buf, chunk.offs
        n = len(buf)
        size = np.diff(offs)
        end = np.repeat(offs[1:], size)
        head = (buf & 0xC0) != 0x80  # characters begin here
        at_head = np.flatnonzero(head)
        char = np.cumsum(head) - 1  # of each byte
        node, to, piece = [], [], []
        has_single = np.zeros(n, bool)
        nxt = np.append(at_head[1:], n)
        open_ = at_head  # where a piece may go on
        for length in model.lengths:
            open_ = open_[open_ + length <= end[open_]]
            hit, ids = model.find(chunk.hashes(open_, open_ + length))
            open_ = open_[hit]
            at, ids = open_[ids >= 0], ids[ids >= 0]
            node.append(at)
            to.append(at + length)
            piece.append(ids)
            has_single[at[nxt[char[at]] == at + length]] = True
        bare = np.flatnonzero(~has_single[at_head[char]]) if n else np.zeros(0, np.int64)
        node, to, piece = [bare, *node], [bare + 1, *to], [model.byte_id[buf[bare]], *piece]
        count, rank = np.zeros(n, np.int32), []  # of a node's edges, and each edge's place among them: shorter ones first
        for at in node:
            rank.append(count[at])
            count[at] += 1
        node, to, piece = (np.concatenate([x.astype(np.int32) for x in part]) for part in (node, to, piece))
        end = end.astype(np.int32)
        # Nodes by what is left behind them: all that an edge leads to is solved before. Every edge has one place, so that sums don't depend on the chunk.
        nodes = np.flatnonzero(count).astype(np.int32)
        left = end[nodes] - nodes
        order = np.argsort(left.astype(np.uint16) if (left < 1 << 16).all() else left, kind="stable")  # by radix where 16 bits do
        nodes, left = nodes[order], left[order]
        size = count[nodes]
        begin = np.concatenate([[0], np.cumsum(size)])
        place = np.zeros(n, np.int64)
        place[nodes] = begin[:-1]
        place = place[node] + np.concatenate(rank)
        node, to, piece = np.repeat(nodes, size), _scatter(to, place), _scatter(piece, place)
        logw = model.weight[piece]
        beta = np.zeros(n + 1)
        total = np.full(n, -np.inf)
        done = to == end[node]
        levels = np.concatenate([[0], np.flatnonzero(np.diff(left)) + 1, [len(left)]]) if len(left) else [0]
        for lo, hi in zip(levels[:-1], levels[1:], strict=True):
            a, b = begin[lo], begin[hi]
            value = logw[a:b] + np.where(done[a:b], 0.0, beta[to[a:b]])
            first = begin[lo:hi] - a
            top = np.maximum.reduceat(value, first)
            value = np.exp(value - np.repeat(top, size[lo:hi]))
            total[nodes[lo:hi]] = beta[nodes[lo:hi]] = top + np.log(np.add.reduceat(value, first))
        logp = np.minimum(logw + np.where(done, 0.0, beta[to]) - total[node], 0.0)
        p = (np.exp(logp) * 2.0**32).astype(np.int64)
        # By node, and likely edges first.
        order = np.argsort((node.astype(np.int64) << 27 | ((1 << 32) - p) >> 12) << 6 | (to - node))
        self.node, self.piece, self.logp = node[order], piece[order], logp[order]
        self.to = np.where(done, -1, to)[order]
        first = np.flatnonzero(np.concatenate([[True], self.node[1:] != self.node[:-1]])) if len(node) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(node)))
        # Cumulative probabilities within a node in whole units of 2**-32, exact whatever stands before it.
        p = p[order]
        run = np.cumsum(p)
        run -= np.repeat(run[first] - p[first], count)
        run[first + count - 1] = 1 << 32
        self.upto = run
        self.starts = offs[:-1]
        lone = np.zeros(len(self.node), bool)
        lone[first] = count == 1
        self.logp[lone] = 0.0
        self.first = np.full(n + 1, len(node), np.int64)
        self.first[self.node[first]] = first
        self.count = np.zeros(n + 1, np.int64)
        self.count[self.node[first]] = count

    def sample(self, unit: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A segmentation for each of ``unit``: piece ids one behind the other, where each begins (and the end), log probabilities."""
        active, v, rounds = np.arange(len(unit)), self.starts[unit], []
        logp, counts = np.zeros(len(unit)), np.zeros(len(unit), np.int64)
        step = 0
        while len(active):
            x = (key[active] ^ U(step * 0x9E3779B97F4A7C15 % (1 << 64))) * U(0xD6E8FEB86659FD93)
            x ^= x >> U(32)
            x *= U(0xC2B2AE3D27D4EB4F)
            x >>= U(32)
            x = x.view(np.int64)
            e = self.first[v]
            behind = np.flatnonzero(self.upto[e] <= x)
            while len(behind):
                e[behind] += 1
                behind = behind[self.upto[e[behind]] <= x[behind]]
            logp[active] += self.logp[e]
            counts[active] += 1
            rounds.append((active, self.piece[e]))
            v = self.to[e]
            more = v >= 0
            active, v, step = active[more], v[more], step + 1
        begin = np.concatenate([[0], np.cumsum(counts)])
        flat = np.empty(begin[-1], np.int32)
        for step, (who, piece) in enumerate(rounds):
            flat[begin[who] + step] = piece
        return flat, begin, logp

    def sample_without(self, unit: int, taken: list[tuple[int, ...]], draw) -> tuple[tuple[int, ...], float]:
        """A segmentation of a unit that is none of ``taken``, by exact masses, and its log probability; each node on the way is looked at once."""
        known = Taken(self, int(self.starts[unit]), taken)
        v, path, logp, live = int(self.starts[unit]), [], 0.0, list(range(len(taken)))
        while v >= 0:
            lo = int(self.first[v])
            hi, depth = lo + int(self.count[v]), len(path)
            piece, to, edge = self.piece[lo:hi].tolist(), self.to[lo:hi].tolist(), self.logp[lo:hi].tolist()
            ahead = [[i for i in live if taken[i][depth] == x] for x in piece] if live else [[]] * len(piece)
            spent = [bool(own) and known.all_ways(own, depth + 1) for own in ahead]
            masses = [0.0 if gone else max(math.exp(e) - sum(math.exp(known.rest[i][depth]) for i in own), 0.0) for own, gone, e in zip(ahead, spent, edge, strict=True)]
            if sum(masses) <= 0:  # what is left is below the precision of floats: any edge that isn't exhausted
                masses = [0.0 if gone else 1.0 for gone in spent]
            u, at = draw() * sum(masses), 0
            while at < len(masses) - 1 and (u >= masses[at] or masses[at] == 0.0):
                u -= masses[at]
                at += 1
            while masses[at] == 0.0:
                at -= 1
            path.append(piece[at])
            logp, v, live = logp + edge[at], to[at], ahead[at]
        return tuple(path), logp

    def mass(self, unit: int, taken: list[tuple[int, ...]]) -> tuple[float, bool]:
        """The probability of some segmentations of a unit, and whether there are no others."""
        known = Taken(self, int(self.starts[unit]), taken)
        return sum(math.exp(x[0]) for x in known.rest), known.all_ways(list(range(len(taken))), 0)


class Taken:
    """Segmentations of a unit from node v on: log probabilities of what follows each step, and where the ways part."""

    def __init__(self, lattice: Lattice, v: int, taken: list[tuple[int, ...]]):
        self.taken, self.counts, self.rest, self.lone, self.known = taken, [], [], [], {}
        for t in taken:
            at, counts, logp = v, [], []
            for x in t:
                lo, n = int(lattice.first[at]), int(lattice.count[at])
                e = lo + lattice.piece[lo : lo + n].tolist().index(x)
                counts.append(n)
                logp.append(float(lattice.logp[e]))
                at = int(lattice.to[e])
            self.counts.append(counts)
            rest, lone = [0.0], [len(t)]
            for n, w in zip(reversed(counts), reversed(logp), strict=True):
                rest.append(rest[-1] + w)
                lone.append(lone[-1] if n == 1 else len(t) - len(lone))
            self.rest.append(rest[::-1])
            #: The first step from here on at which there are other ways; the length if there is none.
            self.lone.append(lone[::-1])

    def all_ways(self, live: list[int], depth: int) -> bool:
        """Whether the segmentations ``live``, which agree before ``depth``, are all there are from there on."""
        if len(live) == 1:
            return self.lone[live[0]][depth] == len(self.taken[live[0]])
        name = tuple(live)
        if name not in self.known:
            first, part = self.taken[live[0]], depth
            while all(self.taken[i][part] == first[part] for i in live):
                part += 1
            groups: dict[int, list[int]] = {}
            for i in live:
                groups.setdefault(self.taken[i][part], []).append(i)
            full = len(groups) == self.counts[live[0]][part] and all(self.all_ways(g, part + 1) for g in groups.values())
            self.known[name] = part, full
        part, full = self.known[name]
        return full and self.lone[live[0]][depth] >= part


def _log1mexp(x: np.ndarray) -> np.ndarray:
    """log(1 - exp(x)) for x <= 0."""
    with np.errstate(divide="ignore"):
        return np.where(x > -0.69, np.log(-np.expm1(x)), np.log1p(-np.exp(x)))


def _draws(row: int):
    """A function that gives the row's next uniform number, in (0, 1)."""
    state = row

    def draw() -> float:
        nonlocal state
        state = (state + 0x9E3779B97F4A7C15) & _WORD
        x = state ^ state >> 32
        x = x * 0xD6E8FEB86659FD93 & _WORD
        x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & _WORD
        return ((x ^ x >> 32) >> 11) * 2.0**-53 + 2.0**-54

    return draw


def units_of(model: Pieces, texts: list[bytes]) -> tuple[Chunk, np.ndarray, np.ndarray]:
    """All units of texts, each text with a space before it: bytes, unit starts, and the first unit of each text.

    A unit begins where a character's first byte follows a byte that it follows in no piece."""
    data = [b" " + t if t else b"" for t in texts]
    offs = np.cumsum([0, *map(len, data)])
    buf = np.frombuffer(b"".join(data), np.uint8)
    begin = np.ones(len(buf), bool)
    begin[1:] = ~model.inside[buf[:-1].astype(np.uint16) << 8 | buf[1:]] & ((buf[1:] & 0xC0) != 0x80)
    begin[offs[:-1][offs[:-1] < len(buf)]] = True
    starts = np.flatnonzero(begin)
    return Chunk(buf, offs, slice(0, len(data))), starts, np.searchsorted(starts, offs)


def segment(model: Pieces, keys: np.ndarray, texts: list[bytes], k: int = SAMPLES, seed: int = SEED) -> Iterator[list[tuple[np.ndarray, float, float, float]]]:
    """For each text its samples (ids, log probability, perturbed value, inclusion score), best first; ``keys``: row keys."""
    chunk, starts, first = units_of(model, texts)
    ends = np.append(starts[1:], len(chunk.buf)) if len(starts) else starts
    h = chunk.hashes(starts, ends)
    _, place, unit = np.unique(h, return_index=True, return_inverse=True)
    size = ends[place] - starts[place]
    offs = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts[place] - offs[:-1], size) + np.arange(offs[-1])
    lattice = Lattice(model, Chunk(chunk.buf[at], offs, slice(0, len(place))))
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    number = np.arange(len(starts)) - first[doc]
    row = mix(keys.astype(np.uint64) + U(seed * 0xC2B2AE3D27D4EB4F % (1 << 64)))
    passes = [lattice.sample(unit, mix(row[doc] + number.astype(np.uint64) * U(0xD6E8FEB86659FD93) + U(p + 1))) for p in range(k)]
    leaves = [_log1mexp(p[2]) for p in passes]
    noise = [-np.log(-np.log((mix(row[doc] ^ mix(number.astype(np.uint64) + U((p + 1) << 40))) >> U(11)) * 2.0**-53 + 2.0**-54)) for p in range(k)]
    for i in range(len(texts)):
        lo, hi = int(first[i]), int(first[i + 1])
        draw = _draws(int(row[i]))
        if lo == hi:
            yield [(np.zeros(0, np.int32), 0.0, -math.log(-math.log(draw())), 1.0)]
            continue
        units = unit[lo:hi]
        samples, heap = [], []

        def add(ids, begin, logp, value, since, taken, p, lo=lo, hi=hi, samples=samples, heap=heap):
            """A new sample, and the values of the sets that part from it at units from ``since`` on."""
            upto = logp.cumsum()
            away = leaves[p][lo:hi].copy()
            if taken is not None:
                away[since] = taken[1]
            x = upto - logp
            x += away
            x += noise[p][lo:hi]
            v = -np.logaddexp(-value, -x)  # -inf where nothing else is left
            v[:since] = -np.inf
            samples.append((ids, begin, logp, float(upto[-1]), value, taken, since))
            heap.append(v)

        flat, begin, logp = passes[0]
        add(flat[begin[lo] : begin[hi]], begin[lo : hi + 1] - begin[lo], logp[lo:hi], -math.log(-math.log(draw())), 0, None, 0)
        kappa = -np.inf
        while True:
            best = max(range(len(heap)), key=lambda s: heap[s].max())
            j = int(heap[best].argmax())
            value = float(heap[best][j])
            if value == -np.inf or len(samples) == k:
                kappa = value
                break
            heap[best][j] = -np.inf
            ids, begin, logp, _, _, taken, since = samples[best]
            known = taken[0] if taken is not None and since == j else []
            known = [*known, tuple(ids[begin[j] : begin[j + 1]].tolist())]
            own, own_logp = lattice.sample_without(int(units[j]), known, draw)
            p = len(samples)
            flat, fresh, fresh_logp = passes[p]
            a, b = lo + j + 1, hi
            new_ids = np.concatenate([ids[: begin[j]], np.array(own, np.int32), flat[fresh[a] : fresh[b]]])
            new_begin = np.concatenate([begin[: j + 1], fresh[a : b + 1] - fresh[a] + begin[j] + len(own)])
            new_logp = np.concatenate([logp[:j], [own_logp], fresh_logp[a:b]])
            gone, every = lattice.mass(int(units[j]), [*known, own])
            add(new_ids, new_begin, new_logp, value, j, (known, -np.inf if every else float(np.log(max(1 - gone, 1e-300)))), p)
        yield [(s[0], s[3], s[4], float(-np.expm1(-np.exp(min(s[3] - kappa, 700.0)))) if kappa > -np.inf else 1.0) for s in samples]


def encode(docs: DataFrame, k: int = SAMPLES, seed: int = SEED, path: str | None = None, digests: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, sample (from 0), n_pieces, log_prob, perturbed, inclusion and ids; with ``digests``, also ids_crc32 and whether decoding these ids gives the text."""
    import public_tokenizers

    path = path or str(public_tokenizers.path(MODEL))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for chunk in chunks(batch.column("text"), chunk_bytes):
                rows = batch.slice(chunk.rows.start, chunk.n)
                ids = rows.column(0)
                keys = mix(ids.fill_null(0).to_numpy().astype(np.uint64)) ^ np.asarray(ids.is_null()).astype(np.uint64)
                texts = [chunk.text(i) for i in range(chunk.n)]
                out, whose = [], []
                for i, (doc_id, samples) in enumerate(zip(ids.to_pylist(), segment(model, keys, texts, k, seed), strict=True)):
                    out += [(doc_id, s, len(x), logp, value, inclusion, x) for s, (x, logp, value, inclusion) in enumerate(samples)]
                    whose += [i] * len(samples)
                cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=False)]
                if digests:
                    cols.append(pa.array([zlib.crc32(x[-1].astype("<u4").tobytes()) for x in out], pa.int64()))
                    cols.append(pa.array([text.encode() == texts[i] for text, i in zip(model.texts(cols[-2]), whose, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(cols, names)

    ints, reals = [pa.int64()] * 3, [pa.float64()] * 3
    kinds = [*ints, *reals, pa.list_(pa.int32())]
    names = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "ids", *(["ids_crc32", "decoded"] if digests else [])]
    ddl = "doc_id long, sample long, n_pieces long, log_prob double, perturbed double, inclusion double, ids array<int>" + (", ids_crc32 long, decoded boolean" if digests else "")
    return ids_and_text(docs).mapInArrow(released(run), ddl)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (with ids) with the text that its pieces spell."""
    import public_tokenizers

    path = path or str(public_tokenizers.path(MODEL))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("sample"), pa.array(model.texts(batch.column("ids")), pa.string())], ["doc_id", "sample", "text"])

    return encoded.select("doc_id", "sample", "ids").mapInArrow(released(run), "doc_id long, sample long, text string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"), digests=True)
