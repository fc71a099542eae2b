"""Benchmark decontamination by template canonicalisation (operator 3).

Texts become tokens (runs of letters and digits, lower-cased). Numbers, a unit behind a number, and names become typed
placeholders, so that a question with other numbers or names has the same template. Names are words with a capital of any
script; but not nouns behind a German article, and of words that begin a sentence only those that the benchmark never
writes in lower case (``Anna has``, not ``The boy has``). Every window of ``window`` tokens of every text is looked up among the hashed template windows of the
benchmark; hits on one alignment of a text and an item are then checked token by token: what fills the slots of the
item must correspond one way to what fills those of the text (the same name stays the same name), else the window
doesn't count. Windows of plain words (lower-cased, without placeholders) are looked up beside them, so that items with
few literal words and short ones are found as they stand. Every pair of a text and an item with consistent windows of enough literal words is reported, with the
item's share that matched. Rows are dropped by ``holds``: by what of the item they hold as it stands, or, with other
numbers and names, by more of it and more literal words; so a common phrase or form drops nothing.

The benchmark is the stated query set: its windows are sent to the executors in blocks of about ``BLOCK_WINDOWS`` (a few
ten MB), each block against all rows. The driver holds one block at a time; a larger benchmark takes more blocks, and the
results of each are stored before the next is read.

Defined cases: null or empty texts and items match nothing; items of under ``window`` tokens match as a whole, and
those of under ``LEAST_TOKENS`` tokens as they stand only. Items of under ``LEAST_TOKENS`` words are reported but drop no
row, since a word or two say nothing of where they come from; repeated rows or items are all reported; empty tables give no hits; other
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, ids_and_text, read, released, store
from .scan import ALNUM_WORD, LOWER_TABLE, Chunk, U, chunks, per_chunk, starts_of_windows, windows

WINDOW, LEAST_LITERALS, LEAST_TOKENS = 8, 4, 4
#: What drops a row, in tokens of the item: see ``holds``.
EXACT_RUN, WHOLE_LITERALS, FORM_LITERALS, FORM_RUN = 13, 6, 12, 20
BLOCK_WINDOWS = 1_000_000
UNITS = (
    "km m cm mm mi mile miles ft foot feet inch inches yard yards kg g mg lb lbs oz ton tons tonne tonnes l ml litre litres liter liters gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents "
    "kmh mph hz khz mhz ghz w kw kwh v kv a j kj cal kcal pa kpa bar c f k degrees degree"
).split()

#: Behind these a capital is a noun's, as German writes it; an adjective may stand between.
ARTICLES = (
    "der die das den dem des ein eine einen einem einer eines kein keine keinen keinem keiner im am zum zur vom beim ins ans "
    "mein meine meinen meinem meiner dein deine sein seine seinen seinem seiner ihr ihre ihren ihrem ihrer unser unsere dieser diese dieses diesen diesem jeder jede jedes jeden jedem"
).split()

_DIGIT, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
#: Which characters of up to three bytes are capitals.
_CAPITAL = np.array([chr(c).isupper() for c in range(1 << 16)])
_STOP[list(b".!?:;\n\"")] = True
NUMBER, UNIT, NAME = U(11), U(22), U(33)


def _word_hashes(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    offs = np.cumsum([0, *map(len, data)])
    return Chunk(np.frombuffer(b"".join(data), np.uint8), offs, slice(0, len(data))).hashes(offs[:-1], offs[1:], LOWER_TABLE)


_UNIT_HASHES, _ARTICLE_HASHES = np.sort(_word_hashes(UNITS)), np.sort(_word_hashes(ARTICLES))


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``h`` are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def _capital(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether the characters that begin at ``starts`` are capitals; those of four bytes count as none."""
    at = lambda k: buf[np.minimum(starts + k, len(buf) - 1)].astype(np.int64)
    one, two = at(0), (at(0) & 0x1F) << 6 | at(1) & 0x3F
    three = (at(0) & 0x0F) << 12 | (at(1) & 0x3F) << 6 | at(2) & 0x3F
    return _CAPITAL[np.select([one < 0x80, one >> 5 == 6, one >> 4 == 14], [one, two, three], 0)]


@dataclass
class Tokens:
    """Canonical tokens of a chunk: template hash, hash of what stands there, whether it is a literal word, document bounds.

    Also its plain words: their hashes, document bounds, and the token that each is of."""

    template: np.ndarray
    value: np.ndarray
    literal: np.ndarray
    first: np.ndarray
    plain: np.ndarray
    plain_first: np.ndarray
    of: np.ndarray


def lower_words(chunk: Chunk) -> np.ndarray:
    """Sorted hashes of the words that stand somewhere without a capital."""
    starts, ends, _ = chunk.spans(ALNUM_WORD)
    low = ~_capital(chunk.buf, starts) if len(starts) else np.zeros(0, bool)
    return np.unique(chunk.hashes(starts, ends, LOWER_TABLE)[low])


def canonical(chunk: Chunk, common: np.ndarray) -> Tokens:
    """Tokens; ``common``: sorted hashes of the words that are no names where they begin a sentence."""
    buf = chunk.buf
    starts, ends, first = chunk.spans(ALNUM_WORD)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return Tokens(none, none, np.zeros(0, bool), first, none, first, np.zeros(0, np.int64))
    sums = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(_DIGIT[buf], out=sums[1:], dtype=np.int32)
    number = sums[ends] > sums[starts]
    np.cumsum(_STOP[buf], out=sums[1:], dtype=np.int32)
    doc_first = np.zeros(len(starts), bool)
    doc_first[first[:-1][first[:-1] < first[1:]]] = True
    gap = np.empty(len(starts), np.int64)
    gap[0], gap[1:] = 0, starts[1:] - ends[:-1]
    opens = doc_first.copy()
    opens[1:] |= sums[starts[1:]] > sums[ends[:-1]]
    plain = value = chunk.hashes(starts, ends, LOWER_TABLE)
    upper = _capital(buf, starts)
    # Nouns behind an article, or behind an article and a word without a capital.
    article, noun = _among(value, _ARTICLE_HASHES), np.zeros(len(starts), bool)
    noun[1:] = article[:-1]
    noun[2:] |= article[:-2] & ~upper[1:-1] & ~opens[1:-1] & ~doc_first[1:-1]
    name = upper & ~number & np.where(opens, ~_among(value, common), ~noun)
    unit = np.zeros(len(starts), bool)
    after = np.flatnonzero(number[:-1] & ~doc_first[1:]) + 1
    if len(after):
        unit[after] = _among(value[after], _UNIT_HASHES) & ~number[after]
    name &= ~unit
    # Parts of one number (1,000.5) and of one name (Ada King) are one token.
    joined = np.zeros(len(starts), bool)
    joined[1:] = ((number[1:] & number[:-1]) | (name[1:] & name[:-1])) & (gap[1:] == 1) & ~doc_first[1:]
    keep = np.flatnonzero(~joined)
    last = np.append(keep[1:], len(starts)) - 1
    many = last > keep
    value = np.where(many, chunk.hashes(starts[keep], ends[last], LOWER_TABLE), value[keep])
    number, unit, name = number[keep], unit[keep], name[keep]
    template = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, value)))
    return Tokens(template, value, ~(number | unit | name), np.searchsorted(keep, first), plain, first, np.cumsum(~joined) - 1)


@dataclass
class Index:
    """Hashed template windows of one length: sorted hashes, and item and position of each."""

    size: int
    hashes: np.ndarray
    item: np.ndarray
    at: np.ndarray
    near: np.ndarray

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Positions in ``h`` that have a hit."""
        maybe = np.flatnonzero(self.near[(h >> U(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        return maybe[self.hashes[at] == h[maybe]]


@dataclass
class Benchmark:
    ids: list
    common: np.ndarray
    tokens: Tokens
    indexes: list[Index]
    plain: list[Index]

    @staticmethod
    def of(ids: list, texts: list[str | None], window: int = WINDOW, literals: int = LEAST_LITERALS) -> Benchmark:
        (chunk,) = chunks(pa.array(texts, pa.string()), 1 << 40)
        common = lower_words(chunk)
        t = canonical(chunk, common)
        return Benchmark(ids, common, t, _indexes(t.template, t.first, window, LEAST_TOKENS, t.literal, literals), _indexes(t.plain, t.plain_first, window))


def _indexes(h: np.ndarray, first: np.ndarray, window: int, least: int = 1, literal: np.ndarray | None = None, literals: int = 0) -> list[Index]:
    """Windows of ``h`` by their length: ``window``, or all of a shorter item; with ``literal``, those with enough literal words."""
    sizes = np.diff(first)
    items = np.repeat(np.arange(len(sizes)), sizes)
    indexes = []
    for k in sorted({min(int(n), window) for n in sizes if n >= least}):
        at = np.flatnonzero(starts_of_windows(first, k) & (np.minimum(sizes, window)[items] == k))
        if literal is not None:
            at = at[_count(literal, at, k) >= min(literals, k)]
        own = windows(h, k)[at] if len(at) else h[:0]
        if len(own):
            order = np.argsort(own, kind="stable")
            near = np.zeros(1 << 20, bool)
            near[(own >> U(44)).astype(np.int64)] = True
            indexes.append(Index(k, own[order], items[at][order], at[order], near))
    return indexes


def _count(flags: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at + k] - sums[at]


def _run(spots: set[int]) -> int:
    """The most neighbours among positions."""
    longest = n = 0
    for i in sorted(spots):
        n = n + 1 if i - 1 in spots and n else 1
        longest = max(longest, n)
    return longest


def holds(matched: set[int], exact: set[int], literal: set[int], size: int) -> bool:
    """Whether a text that has these positions of an item of ``size`` tokens holds the item.

    As it stands (``exact``): over half of the item, or a run of ``EXACT_RUN``. With other numbers and names: nearly all of
    the item, literal words for half of it; or over half of it or a run of ``FORM_RUN``, with ``FORM_LITERALS`` literal words."""
    if 2 * len(exact) > size or _run(exact) >= EXACT_RUN:
        return True
    words = len(matched & literal)
    if 5 * len(matched) >= 4 * size and words >= WHOLE_LITERALS and 2 * words >= len(matched):
        return True
    return words >= FORM_LITERALS and (2 * len(matched) > size or _run(matched) >= FORM_RUN)


def _matches(indexes: list[Index], own: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, position, item, its position, length) of the windows of a chunk's hashes that stand in an item."""
    for index in indexes:
        h = windows(own, index.size)
        if not len(h):
            continue
        at = index.look_up(h)
        at = at[starts_of_windows(first, index.size)[at]]
        rows = np.searchsorted(first, at, "right") - 1
        for p, row in zip(at.tolist(), rows.tolist(), strict=True):
            lo = int(np.searchsorted(index.hashes, h[p]))
            while lo < len(index.hashes) and index.hashes[lo] == h[p]:
                yield row, p, int(index.item[lo]), int(index.at[lo]), index.size
                lo += 1


def hits(chunk: Chunk, bench: Benchmark) -> Iterator[tuple[int, int, int, int, bool, bool]]:
    """(row in the chunk, index of the item, item tokens matched, item tokens, whether all slots have the item's own values, ``holds``)."""
    t, b = canonical(chunk, bench.common), bench.tokens
    found = defaultdict(set)  # (row, item, alignment) -> matched item positions
    for row, p, item, at, k in _matches(bench.indexes, t.template, t.first):
        found[row, item, p - at].add((at, k))
    plain = defaultdict(set)  # (row, item) -> plain words of the item that stand there
    for row, _, item, at, k in _matches(bench.plain, t.plain, t.plain_first):
        plain[row, item].update(range(at, at + k))
    best: dict[tuple[int, int], tuple[set, set, bool]] = {}
    for (row, item, shift), spots in found.items():
        matched, exact, same, there, back = set(), set(), True, {}, {}
        for at, k in sorted(spots):
            new_there, new_back, equal, good = {}, {}, True, True
            for j in range(at, at + k):
                if not b.literal[j]:
                    x, y = int(b.value[j]), int(t.value[j + shift])
                    kind = int(b.template[j])
                    equal &= x == y
                    good &= new_there.get((kind, x), there.get((kind, x), y)) == y and (kind == int(NUMBER) or new_back.get((kind, y), back.get((kind, y), x)) == x)
                    new_there[kind, x], new_back[kind, y] = y, x
            if good:
                there |= new_there
                back |= new_back
                same &= equal
                matched.update(range(at, at + k))
                if equal:
                    exact.update(range(at, at + k))
        if matched:
            old, old_exact, was = best.get((row, item), (set(), set(), True))
            best[row, item] = (old | matched, old_exact | exact, was and same)
    for row, item in sorted(best.keys() | plain.keys()):
        matched, exact, same = best.get((row, item), (set(), set(), True))
        if words := plain.get((row, item)):
            lo, hi = int(b.plain_first[item]), int(b.plain_first[item + 1])
            whole = {int(x) for x in b.of[sorted(words)]} - {int(x) for x in b.of[sorted(set(range(lo, hi)) - words)]}  # tokens with all their words
            exact = exact | whole
            matched = matched | whole
            same = same or matched <= exact
        if matched:
            size = int(b.first[item + 1] - b.first[item])
            held = b.plain_first[item + 1] - b.plain_first[item] >= LEAST_TOKENS and holds(matched, exact, {j for j in matched if b.literal[j]}, size)
            yield row, item, len(matched), size, same, bool(held)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LEAST_LITERALS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row for each text and item that match: doc_id, item_id, n_tokens matched, coverage of the item, kind."""
    docs = ids_and_text(docs)

    def against(ids: list, texts: list) -> DataFrame:
        bench = None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal bench
            if not ids:
                return
            bench = bench or Benchmark.of(ids, texts, window, literals)
            for rows, chunk in per_chunk(batches):
                own = rows.column(0).to_pylist()
                out = [(own[r], bench.ids[i], n, n / of, "exact" if same else "reparameterised") for r, i, n, of, same, _ in hits(chunk, bench)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["doc_id", "item_id", "n_tokens", "coverage", "kind"])

        return docs.mapInArrow(released(run), "doc_id long, item_id long, n_tokens long, coverage double, kind string")

    blocks = _blocks(benchmark, block_windows)
    first, second = next(blocks, ([], [])), next(blocks, None)
    if second is None:
        return against(*first)
    return reduce(DataFrame.unionAll, [store(against(*x), "hits") for x in chain([first, second], blocks)])


def _blocks(benchmark: DataFrame, block_windows: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of the items, in blocks of about ``block_windows`` windows."""
    items = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    ids, texts, size = [], [], 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        ids.append(r.item_id)
        texts.append(r.text)
        size += len(r.text) // 2 + 1
        if size >= block_windows:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` whose text ``holds`` no benchmark item, with all their columns; each row is judged by its own text."""
    at, schema = docs.columns.index("text"), docs.schema

    def without(docs: DataFrame, ids: list, texts: list) -> DataFrame:
        bench = None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal bench
            bench = bench or Benchmark.of(ids, texts)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for chunk in chunks(batch.column(at)):
                    keep[[chunk.rows.start + r for r, *_, held in hits(chunk, bench) if held]] = False
                yield batch.filter(pa.array(keep))

        return docs.mapInArrow(released(run), schema)

    blocks, left, stored = _blocks(benchmark, block_windows), docs, None
    block = next(blocks, None)
    while block is not None:
        following = next(blocks, None)
        left = without(left, *block)
        if following is not None:
            left, before = store(left, "kept"), stored
            stored = left
            if before is not None:
                discard(before)
        block = following
    return left


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
