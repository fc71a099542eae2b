"""N-gram Jaccard join (operator 2): documents whose sets of word n-grams are alike, and the classes they form.

1. Every text becomes the set of its hashed word n-grams, its size, and a parity bitmap: each n-gram flips one bit.
   Equal sets are one class at once, by a digest of the set, with partial aggregation. All sets are put in one order:
   by hash, n-grams of common slots last (a passage that many documents share names no tile that way).
2. Large families of near copies are taken together first. A few members of the families whose n-grams are heaviest are
   pivots; every set is compared with the pivots where it is, and those alike by an exact check are absorbed. The
   Jaccard distance is a metric, so a set linked to an absorbed one is at most twice as far from its pivot: only such
   sets, the pivot's ring, are compared with the absorbed sets, in blocks, if they are not in one class already.
3. Two sets with a Jaccard similarity of at least p/q share one of the ``size - ceil(size * p / q) + 1`` first hashes
   of each, and l of them if both take l - 1 hashes more. Sets that are not absorbed and share such a hash, in falling
   bands of size (a neighbour is at least p/q as large), form a tile; tiles with the same members are one. A set that
   stands in fewer tiles than the l that a partner would give it leaves all of them, which parts texts that share a
   passage only.
4. In a tile, bit counts bound each overlap from above: sets a and b differ in at least as many n-grams as their
   bitmaps differ in bits. A search from pivots finds the classes of the graph of all pairs that pass this bound and
   gives a spanning forest of it, never all pairs of a group.
5. Each edge of the forest is checked by intersecting the two sorted arrays. Tiles in which an edge fails are searched
   once more, with the arrays: pairs between different classes are checked if they pass the bound, until the classes are
   one or no pair is left.
6. Classes are the connected components of the edges that passed.

N-grams are named by 64-bit hashes. What is sampled (common slots, pivots) decides on the way alone, not on results.

Defined cases: texts without words, and null texts, have an empty set and are linked with nothing; texts of fewer words
than n have one n-gram, the whole sequence; repeated rows are copies of each other; rows of one doc_id are one node; an
empty table gives no rows; other columns are ignored. A null doc_id takes part as its own class and is never a
component's name unless all of the class's ids are null.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from planweave.operators.components import components

from .common import bits_of, discard, free_name, ids_and_text, read, released, store, with_bit
from .scan import LOWER_TABLE, PLAIN_WORD, Chunk, U, mix, per_chunk, windows

#: Least and most bits of a bitmap, and bits for each n-gram between.
LEAST_BITS, MOST_BITS, BITS_EACH = 2048, 1 << 17, 4
#: Slots of n-grams by their low bits; the part of documents that is counted (one in so many); and how many times the mean, and sets at least, make a slot common or an n-gram heavy.
SLOTS, COUNT_ONE_IN, HOT_TIMES, HOT_LEAST = 1 << 18, 16, 8, 1000
#: Heavy n-grams looked at, members taken of each, and pivots at most; absorbed sets in a block.
HEAVY, TAKEN, PIVOTS, BLOCK = 512, 4, 64, 2000


def shingles(chunk: Chunk, k: int) -> Iterator[np.ndarray]:
    """The sorted set of each document."""
    starts, ends, first = chunk.spans(PLAIN_WORD)
    h = chunk.hashes(starts, ends, LOWER_TABLE)
    whole = windows(h, k)
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = hi - lo
        if n >= k:
            yield np.unique(whole[lo : hi - k + 1])
        elif n:
            yield windows(h[lo:hi] ^ mix(np.full(n, n, np.uint64)), n)
        else:
            yield h[:0]


def bitmap(hashes: np.ndarray) -> bytes:
    bits = 1 << max(LEAST_BITS.bit_length() - 1, min(MOST_BITS.bit_length() - 1, int(BITS_EACH * len(hashes)).bit_length()))
    at = (hashes * U(0x9E3779B97F4A7C15)) >> U(64 - (bits.bit_length() - 1))
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _plain(n: int, percent: int) -> int:
    """How many smallest hashes hold one that any partner has."""
    return n - -(-percent * n // 100) + 1


def _more(n: int, percent: int) -> int:
    """How many hashes a partner has of the first ``_plain + _more - 1``; rises with n."""
    return min(1 + _plain(n, percent) // 2, -(-percent * n // 100))


def common_slots(docs: DataFrame, k: int, one_in: int = COUNT_ONE_IN, least: int = HOT_LEAST) -> np.ndarray:
    """Flags of the slots whose n-grams stand in many sets, counted over a part of the documents; SLOTS counts at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for _, chunk in per_chunk(batches):
            own = [s % U(SLOTS) for s in shingles(chunk, k)]
            if own:
                counts += np.bincount(np.concatenate(own).astype(np.int64), minlength=SLOTS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["slot", "n"])

    part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0)
    counts = part.mapInArrow(released(run), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    mean = F.sum("n").over(Window.partitionBy()) / SLOTS
    common = np.zeros(SLOTS, bool)
    common[[r.slot for r in counts.withColumn("mean", mean).filter((F.col("n") * one_in > least) & (F.col("n") > HOT_TIMES * F.col("mean"))).select("slot").collect()]] = True
    return common


def sets(docs: DataFrame, k: int, percent: int, common: np.ndarray) -> DataFrame:
    """doc_id, size, digest of the set (null if empty), its first hashes, how many of them are its plain prefix, its bitmap, and the tiles that a partner makes it stand in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for rows, chunk in per_chunk(batches):
            n, digest, prefix, bits, plain, least = [], [], [], [], [], []
            for s in shingles(chunk, k):
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                plain.append(_plain(len(s), percent))
                late = common[(s % U(SLOTS)).astype(np.int64)]
                order = np.concatenate([s[~late], s[late]])
                prefix.append(order[: plain[-1] + _more(len(s), percent) - 1].view(np.int64) if len(s) else [])
                least.append(_more(-(-percent * len(s) // 100), percent))
                bits.append(bitmap(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary()), pa.array(plain, pa.int64()), pa.array(least, pa.int64())], ["doc_id", "n", "digest", "prefix", "bits", "plain", "least"])

    return docs.mapInArrow(released(run), "doc_id long, n long, digest binary, prefix array<long>, bits binary, plain long, least long")


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of one or more whole groups of a stream that is sorted by ``key``; holds one group at a time, and one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[-1])
        if held and keys[0] != held[-1].column(key)[-1].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def tiles(reps: DataFrame, percent: int) -> DataFrame:
    """``plain, tile, members, times``: sets that share one of their smallest hashes, in one chain of sizes, two members at least, and how many hashes give this tile; with ``plain``, of plain prefixes alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "token"):
            token, n, rep, plain = (table.column(c).to_numpy() for c in ("token", "n", "rep", "plain"))
            for kind in (False, True):
                if kind:
                    token, n, rep = token[plain], n[plain], rep[plain]
                if not len(rep):
                    continue
                apart = (token[1:] != token[:-1]) | (100 * n[:-1] < percent * n[1:])
                begin = np.flatnonzero(np.concatenate([[True], apart]))
                size = np.diff(np.append(begin, len(rep)))
                many = size > 1
                if not many.any():
                    continue
                name = np.add.reduceat(mix(rep.astype(np.uint64) + U(0x51ED270B)), begin)[many]
                begin, size = begin[many], size[many]
                _, once, times = np.unique(name, return_index=True, return_counts=True)
                name, begin, size = mix(name[once] + size[once].astype(np.uint64)), begin[once], size[once]
                total = int(size.sum())
                at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)
                offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(name)), pa.array(name.view(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(rep[at])), pa.array(times)], ["plain", "tile", "members", "times"])

    tokens = reps.select(F.posexplode("prefix").alias("at", "token"), "n", "rep", "plain").select("token", F.col("n").cast("int").alias("n"), "rep", (F.col("at") < F.col("plain")).alias("plain"))
    dealt = tokens.repartition("token").sortWithinPartitions("token", "n")
    return dealt.mapInArrow(released(run), "plain boolean, tile long, members array<long>, times long").groupBy("plain", "tile").agg(F.any_value("members").alias("members"), F.sum("times").alias("times"))


class Tile:
    """The bitmaps of a tile, with rising sizes ``n``."""

    def __init__(self, n: np.ndarray, bits: list[bytes], percent: int):
        self.n, self.percent = n, percent
        width = np.array([len(b) for b in bits])
        self.bits = bits
        self.blocks = {int(w): np.flatnonzero(width == w) for w in np.unique(width)}
        self.data = {w: np.frombuffer(b"".join([bits[i] for i in at]), np.uint64).reshape(len(at), -1) for w, at in self.blocks.items()}

    def near(self, i: int, wanted: np.ndarray) -> list[int]:
        """Those of ``wanted`` (flags) that pass the size and bit count bounds with i."""
        return self.near_to(int(self.n[i]), self.bits[i], wanted, self.percent)[0].tolist()

    def near_to(self, size: int, bits: bytes, wanted: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``wanted`` that pass the bounds of ``percent`` with another set, and the most that their similarity can be."""
        out, most = [np.zeros(0, np.int64)], [np.zeros(0)]
        lo, hi = np.searchsorted(self.n, -(-percent * size // 100)), np.searchsorted(self.n, 100 * size // percent, "right") if percent else len(self.n)
        own = np.frombuffer(bits, np.uint64)
        for w, at in self.blocks.items():
            a, b = np.searchsorted(at, [lo, hi])
            other = at[a:b]
            pick = np.flatnonzero(wanted[other])
            if not len(pick):
                continue
            other, words, mine = other[pick], self.data[w][a:b][pick], own
            while len(mine) > words.shape[1]:  # the last bit of a place falls away: neighbours fold
                mine = _fold(mine[None, :])[0]
            while words.shape[1] > len(mine):
                words = _fold(words)
            differ = np.bitwise_count(words ^ mine).sum(axis=1, dtype=np.int64)
            both = size + self.n[other]
            shared = (both - differ) // 2
            ok = (100 + percent) * shared >= percent * both
            out.append(other[ok])
            most.append(shared[ok] / (both - shared)[ok])
        return np.concatenate(out), np.concatenate(most)


def forest(rep: np.ndarray, n: np.ndarray, bits: list[bytes], percent: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of all pairs in a tile that pass the bounds."""
    tile, free = Tile(n, bits, percent), np.ones(len(rep), bool)
    for first in range(len(rep)):
        if not free[first]:
            continue
        free[first] = False
        queue = deque([first])
        while queue and free.any():
            i = queue.popleft()
            for j in tile.near(i, free):
                free[j] = False
                queue.append(j)
                yield int(rep[i]), int(rep[j])


def alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted arrays are as alike as asked."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def crossing(rep: np.ndarray, grams: list[np.ndarray], group: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links of a tile that join different groups, one for each two groups that become one."""
    order = np.argsort([len(g) for g in grams], kind="stable")
    rep, grams, group = rep[order], [grams[i] for i in order], group[order]
    tile, later = Tile(np.array([len(g) for g in grams]), [bitmap(g) for g in grams], percent), np.ones(len(rep), bool)
    for i in range(len(rep)):
        later[i] = False
        for j in tile.near(i, later & (group != group[i])):
            if group[i] != group[j] and alike(grams[i], grams[j], percent):
                yield int(rep[i]), int(rep[j])
                group[group == group[j]] = group[i]


def _fold(words: np.ndarray) -> np.ndarray:
    """Bitmaps of half as many bits: places are the hash's top bits, so neighbouring bits become one."""
    bits = np.unpackbits(words.view(np.uint8).reshape(len(words), -1), axis=1)
    return np.packbits(bits[:, 0::2] ^ bits[:, 1::2], axis=1).view(np.uint64)


def edges(members: DataFrame, percent: int) -> DataFrame:
    """``tile, a, b`` for rows (tile, rep, n, bits): a forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "tile"):
            tile, n, rep = (table.column(c).to_numpy() for c in ("tile", "n", "rep"))
            begin = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
            out = []
            for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(tile)], strict=True):
                if hi - lo > 1:
                    out += [(int(tile[lo]), a, b) for a, b in forest(rep[lo:hi], n[lo:hi], table.slice(lo, hi - lo).column("bits").to_pylist(), percent)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["tile", "a", "b"])

    return members.repartition("tile").sortWithinPartitions("tile", "n", "rep").mapInArrow(released(run), "tile long, a long, b long")


def undecided(members: DataFrame, percent: int) -> DataFrame:
    """``tile, rep, n, root`` of those rows (tile, rep, n, bits, root) that pass the bounds with a set of another root in their tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "tile"):
            tile, n, root = (table.column(c).to_numpy() for c in ("tile", "n", "root"))
            begin, flags = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])), np.zeros(len(tile), bool)
            for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(tile)], strict=True):
                if (root[lo:hi] == root[lo]).all():
                    continue
                own, later, group = Tile(n[lo:hi], table.slice(lo, hi - lo).column("bits").to_pylist(), percent), np.ones(hi - lo, bool), root[lo:hi]
                for i in range(hi - lo):
                    later[i] = False
                    if close := own.near(i, later & (group != group[i])):
                        flags[[lo + i, *(lo + j for j in close)]] = True
            if flags.any():
                yield from table.filter(pa.array(flags)).select(["tile", "rep", "n", "root"]).combine_chunks().to_batches()

    return members.repartition("tile").sortWithinPartitions("tile", "n", "rep").select("tile", "rep", "n", "root", "bits").mapInArrow(released(run), "tile long, rep long, n long, root long")


def rest_of_tiles(members: DataFrame, percent: int) -> DataFrame:
    """``a, b`` for rows (tile, rep, n, root, grams): links between sets of different roots, as few as join them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "tile"):
            tile, rep, root = (table.column(c).to_numpy() for c in ("tile", "rep", "root"))
            begin, out = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])), []
            for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(tile)], strict=True):
                if (root[lo:hi] != root[lo]).any():
                    out += crossing(rep[lo:hi], [np.frombuffer(g, np.uint64) for g in table.slice(lo, hi - lo).column("grams").to_pylist()], root[lo:hi], percent)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    return members.repartition("tile").sortWithinPartitions("tile", "n", "rep").mapInArrow(released(run), "a long, b long")


def arrays(docs: DataFrame, needed: DataFrame, k: int) -> DataFrame:
    """doc_id, grams (the sorted set) of the documents in ``needed`` (doc_id); one row for each text of a doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, chunk in per_chunk(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([s.tobytes() for s in shingles(chunk, k)], pa.binary())], ["doc_id", "grams"])

    needed = store(needed.distinct(), "needed")
    own = among(docs, needed).join(needed, "doc_id", "left_semi").withColumn("t", F.xxhash64("text")).dropDuplicates(["doc_id", "t"])
    own = own.select("doc_id", "text").mapInArrow(released(run), "doc_id long, grams binary")
    return store(own, "grams")


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``a, b, ok``: whether the sets of documents a and b are as alike as asked, by intersecting their arrays."""

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], ["a", "b", "ok"])

    own = arrays(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), k)
    x, y = own.select(F.col("doc_id").alias("a"), F.col("grams").alias("x")), own.select(F.col("doc_id").alias("b"), F.col("grams").alias("y"))
    checked = store(pairs.join(x, "a").join(y, "b").mapInArrow(released(intersect), "a long, b long, ok boolean").groupBy("a", "b").agg(F.max("ok").alias("ok")), "checked")
    discard(own)
    return checked


def among(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """Rows of ``docs`` but for most of those whose doc_id isn't in ``needed``, so that few texts are shuffled for the join that decides.

    What is sent to the executors is a bitmap of fixed size, whatever the number of ids."""
    table, hit = with_bit(docs, "doc_id", bits_of(needed, "doc_id"))
    return docs.join(table, hit, "left_semi")


def links(reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified edges (a, b) that connect the same representatives as all links between them."""
    own = store(tiles(reps, percent), "tiles")
    stands = own.filter("not plain").select(F.explode("members").alias("rep"), "times").groupBy("rep").agg(F.sum("times").alias("stands"))
    sized = reps.join(stands, "rep").filter("stands >= least").select("rep", "n", "bits")
    members = own.filter("plain").select("tile", F.explode("members").alias("rep")).join(sized, "rep")
    found = store(edges(members, percent), "edges")
    checked = verified(found.select("a", "b").distinct(), docs, k, percent)
    passed, failed = checked.filter("ok").select("a", "b"), checked.filter("not ok").select("a", "b")
    open_tiles = store(found.join(failed, ["a", "b"]).select("tile").distinct(), "open")
    discard(found)
    if open_tiles.isEmpty():
        return passed
    roots = components(passed).withColumnRenamed("node", "rep")
    again = members.join(open_tiles, "tile", "left_semi").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    again = store(undecided(again, percent), "again")
    discard(own, open_tiles)
    if again.isEmpty():
        return passed
    grams = arrays(docs, again.select(F.col("rep").alias("doc_id")), k)
    more = store(rest_of_tiles(again.join(grams.withColumnRenamed("doc_id", "rep"), "rep"), percent), "checked")
    discard(again, grams)
    return passed.unionAll(more)


def pivots(reps: DataFrame, percent: int, one_in: int = COUNT_ONE_IN, least: int = HOT_LEAST) -> list[tuple[int, int, bytes]]:
    """(rep, size, bitmap) of PIVOTS sets at most that stand for the families whose n-grams are heavy in a part of ``reps``.

    At most HEAVY n-grams with TAKEN members of each reach the driver; a member is a pivot if the ones before it leave sets that it is near to."""
    part = reps.filter(F.pmod(F.xxhash64("rep"), F.lit(one_in)) == 0)
    total = part.agg(F.sum(F.size("prefix"))).first()[0] or 0
    tokens = part.select("rep", F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("sets"), *(F.min_by("rep", F.xxhash64("rep", F.lit(i))).alias(f"r{i}") for i in range(TAKEN)))
    heavy = tokens.filter((F.col("sets") * one_in > least) & (F.col("sets") > HOT_TIMES * total / SLOTS)).orderBy(F.desc("sets"), "token").limit(HEAVY)
    chosen = store(heavy.select(F.explode(F.array(*(f"r{i}" for i in range(TAKEN)))).alias("rep")).distinct(), "heavy")
    rows = [] if chosen.isEmpty() else reps.join(F.broadcast(chosen), "rep", "left_semi").select("rep", "n", "bits").orderBy("n", "rep").collect()
    discard(chosen)
    if len(rows) < 2:
        return []
    tile, free, out = Tile(np.array([r.n for r in rows]), [bytes(r.bits) for r in rows], percent), np.ones(len(rows), bool), []
    every = np.ones(len(rows), bool)
    close = [tile.near(i, every) for i in range(len(rows))]
    while len(out) < PIVOTS:
        gain = [int(free[c].sum()) for c in close]
        i = int(np.argmax(gain))
        if gain[i] < 2:
            break
        free[close[i]] = False
        out.append((rows[i].rep, int(rows[i].n), bytes(rows[i].bits)))
    return out


def around(reps: DataFrame, chosen: list[tuple[int, int, bytes]], percent: int) -> DataFrame:
    """``pivot, rep, near`` for sets that pass the bounds of twice the distance of a pivot; ``near``: it passes those of the distance itself, and is the nearest of those, as far as the bounds tell."""
    wide = max(0, 2 * percent - 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(batch.column("n").to_numpy(), kind="stable")
            batch = batch.take(pa.array(order))
            rep, n = batch.column("rep").to_numpy(), batch.column("n").to_numpy()
            tile, every = Tile(n, batch.column("bits").to_pylist(), percent), np.ones(len(rep), bool)
            best, of = np.zeros(len(rep)), np.zeros(len(rep), np.int64)
            found = []
            for pivot, size, bits in chosen:
                at, most = tile.near_to(size, bits, every, wide)
                keep = rep[at] != pivot
                at, most = at[keep], most[keep]
                found.append((np.full(len(at), pivot), at))
                better = (100 * most >= percent) & (most > best[at])
                best[at[better]], of[at[better]] = most[better], pivot
            pivot, at = (np.concatenate(x) for x in zip(*found, strict=True))
            near = (best[at] > 0) & (of[at] == pivot)
            yield pa.RecordBatch.from_arrays([pa.array(pivot, pa.int64()), pa.array(rep[at]), pa.array(near)], ["pivot", "rep", "near"])

    return reps.select("rep", "n", "bits").mapInArrow(released(run), "pivot long, rep long, near boolean")


def ring_links(ring: DataFrame, absorbed: DataFrame, grams: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """``a, b``: for each set of a pivot's ring (pivot, rep) one link in each block of the sets that the pivot absorbed (pivot, rep), if there is any.

    A task holds a block, and passes the ring's sets by it one by one."""
    parts = {r.pivot: -(-r.n // block) for r in absorbed.groupBy("pivot").agg(F.count("*").alias("n")).collect()}  # a row for each pivot
    count = F.create_map(*(F.lit(x).cast("long") for kv in parts.items() for x in kv))[F.col("pivot")]
    inner = absorbed.withColumn("block", F.pmod(F.xxhash64("rep"), count)).withColumn("side", F.lit(0))
    outer = ring.filter(F.col("pivot").isin(list(parts))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).withColumn("side", F.lit(1))
    both = inner.unionByName(outer).join(grams.withColumnRenamed("doc_id", "rep"), "rep").withColumn("key", F.xxhash64("pivot", "block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rep, held, tile = None, [], [], None
        for batch in batches:
            out = []
            for own, side, name, g in zip(*(batch.column(c).to_pylist() for c in ("key", "side", "rep", "grams")), strict=True):
                if own != key:
                    key, rep, held, tile = own, [], [], None
                g = np.frombuffer(g, np.uint64)
                if side == 0:
                    rep.append(name)
                    held.append(g)
                    continue
                if tile is None:
                    order = sorted(range(len(held)), key=lambda i: len(held[i]))
                    rep, held = [rep[i] for i in order], [held[i] for i in order]
                    tile, every = Tile(np.array([len(x) for x in held], np.int64), [bitmap(x) for x in held], percent), np.ones(len(held), bool)
                for i in tile.near_to(len(g), bitmap(g), every, percent)[0].tolist() if held else ():
                    if rep[i] != name and alike(held[i], g, percent):
                        out.append((rep[i], name))
                        break
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    dealt = both.select("key", "side", "rep", "grams").repartition("key").sortWithinPartitions("key", "side")
    return dealt.mapInArrow(released(run), "a long, b long")


def ngram_components(docs: DataFrame, k: int = 5, percent: int = 80, one_in: int = COUNT_ONE_IN, least: int = HOT_LEAST) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``; two texts link from ``percent`` % Jaccard similarity.

    ``one_in`` and ``least`` say when n-grams count as common or heavy; results don't depend on them."""
    docs = ids_and_text(docs)
    own = store(sets(docs, k, percent, common_slots(docs, k, one_in, least)), "sets")
    first = ("n", "prefix", "bits", "plain", "least")
    reps = store(own.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), *(F.any_value(c).alias(c) for c in first)), "reps")
    own = own.select("doc_id", "n", "digest")
    named, texts = reps.filter("rep is not null"), docs.filter("doc_id is not null")
    # Documents of one doc_id with different sets are one node, which has no one place to measure distances from.
    several = store(own.filter("doc_id is not null and digest is not null").groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b").select("doc_id"), "several")
    twice = own.join(several, "doc_id").join(reps.select("digest", "rep"), "digest").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    single = named.join(several.withColumnRenamed("doc_id", "rep"), "rep", "left_anti")
    chosen = pivots(single, percent, one_in, least)
    if not chosen:
        roots = components(links(named, texts, k, percent).unionAll(twice))
    else:
        close = store(around(named, chosen, percent), "around")
        checked = verified(close.filter("near").select(F.col("pivot").alias("a"), F.col("rep").alias("b")), texts, k, percent)
        absorbed = checked.filter("ok").select(F.col("a").alias("pivot"), F.col("b").alias("rep")).join(several.withColumnRenamed("doc_id", "rep"), "rep", "left_anti").select("pivot", "rep")
        rest = named.join(absorbed.select("rep"), "rep", "left_anti")
        sure = store(links(rest, texts, k, percent).unionAll(absorbed.toDF("a", "b")).unionAll(twice), "links")
        roots = components(sure)
        known = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
        ring = close.select("pivot", "rep").join(known("rep"), "rep", "left").join(known("pivot"), "pivot", "left")
        ring = store(ring.filter(F.coalesce("rep_root", "rep") != F.coalesce("pivot_root", "pivot")).select("pivot", "rep"), "ring")
        if not ring.isEmpty():
            inner = absorbed.join(ring.select("pivot").distinct(), "pivot", "left_semi")
            grams = arrays(texts, inner.select(F.col("rep").alias("doc_id")).unionAll(ring.select(F.col("rep").alias("doc_id"))), k)
            roots = components(sure.unionAll(store(ring_links(ring, inner, grams, percent), "links")))
    classes = reps.select("digest", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("root", "rep").alias("component"))
    return own.join(classes, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document (the smallest doc_id) of each class; rows without doc_id and texts without words stay.

    Rows are told apart by doc_id: repeated rows of a kept doc_id stay as they are."""
    found = ngram_components(docs, k, percent)
    name = free_name("gone", docs.columns)
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read(spark, sf_dir, "documents"), k=3, percent=90)
