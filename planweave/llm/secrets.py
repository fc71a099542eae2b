"""Secret scans with recursive decoding (operator 9).

Each text is a first layer. A layer is scanned for the three base kinds, and for regions that hold an encoded layer:
URL escapes, Unicode escapes, base64 and, inside base64, zlib, gzip or raw deflate data. Every decoded layer is opened
in turn. Equal layers (by digest) are opened once, and their secrets count at every place where the layer stands; a
layer that stands in itself is not opened again there, so cycles end. A secret found in an inner layer is reported with
the span of the text that it was decoded from and its path, such as ``base64/zlib``. Base64 that is wrapped, indented or
not, is decoded as a whole and has the span of the whole run.

Defined cases: a null or empty text has no secrets; repeated rows give repeated results; an empty table gives none;
other columns are ignored. A compressed layer is opened whole; one that grows more than ``MAX_RATIO`` times is inflated
as a stream and scanned in pieces of ``PIECE`` characters that overlap by ``OVERLAP``, however long it is. Data that
isn't UTF-8 text, or that is cut short, is left closed.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ids_and_text, read, released

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
#: Maximal runs: the same matches as of [A-Z0-9]+ and [0-9a-f]+ with the shorter ones dropped.
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
#: A text without any of these has no assignment; one pass over lower-case text decides.
HINT = re.compile(r"passw|secret|token|api_?key", re.A)
URL, UNICODE = re.compile(r"%[0-9A-Fa-f]{2}"), re.compile(r"\\u\{?[0-9A-Fa-f]{4}\}?|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{2,5};|&#[0-9]{2,6};")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{4}){4,}[A-Za-z0-9+/_-]{0,3}={0,2}")
#: Base64 in lines, with what may stand between them; a line's first and last run may have other words before or behind it.
LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++={0,2}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++={0,2}+)++")
RUN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
LEAST_BASE64 = 16
MAX_RATIO = 200
PIECE, OVERLAP, STEP = 1 << 22, 1 << 20, 1 << 18
HEADS = (("zlib", b"\x78", 15), ("gzip", b"\x1f\x8b", 31))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base secrets of one layer."""
    out = []
    if HINT.search(text.lower()):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


class Places:
    """Where the characters of a decoded text stood: ``at``: starts of the decoded parts; ``old``: old start and end, and new length of each."""

    def __init__(self, at: list[int], old: list[tuple[int, int, int]]):
        self.at, self.old = at, old

    def __getitem__(self, i: int) -> tuple[int, int]:
        k = bisect_right(self.at, i) - 1
        if k < 0:
            return i, i + 1
        start, end, size = self.old[k]
        past = i - self.at[k] - size
        return (start, end) if past < 0 else (end + past, end + past + 1)


def _escapes(text: str, pattern: re.Pattern, decode) -> tuple[str, Places] | None:
    """The text with its escapes decoded, and the places of its characters."""
    parts, at, size, new_at, old = [], 0, 0, [], []
    for start, end, new in decode(text, pattern):
        parts += [text[at:start], new]
        size += start - at
        new_at.append(size)
        old.append((start, end, len(new)))
        size += len(new)
        at = end
    if not at:
        return None
    return "".join([*parts, text[at:]]), Places(new_at, old)


def _url(text: str, pattern: re.Pattern):
    """Runs of %XX as UTF-8."""
    for m in re.finditer(r"(?:%[0-9A-Fa-f]{2})+", text):
        try:
            yield m.start(), m.end(), bytes.fromhex(m[0].replace("%", "")).decode()
        except UnicodeDecodeError:
            continue


def _unicode(text: str, pattern: re.Pattern):
    for m in pattern.finditer(text):
        digits = m[0].strip("\\ux{}&#;")
        code = int(digits, 10 if m[0].startswith("&#") and not m[0].startswith("&#x") else 16)
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            yield m.start(), m.end(), chr(code)


def _inflated(chunks: Iterable[bytes], bits: int) -> Iterator[bytes]:
    """What compressed data becomes, part by part; all members of gzip data. Raises zlib.error if it is none, or cut short."""
    d = zlib.decompressobj(bits)
    for data in chunks:
        while True:
            out = d.decompress(data, STEP)
            if out:
                yield out
            if d.eof:
                data = d.unused_data
                if bits != 31 or not data.startswith(b"\x1f\x8b"):
                    return
                d = zlib.decompressobj(bits)
            else:
                data = d.unconsumed_tail
                if not data and len(out) < STEP:
                    break
    raise zlib.error("cut short")


def _inflate(raw: bytes, kinds) -> tuple[str, bytes | None, int] | None:
    """The kind, the data, or None if it grows more than ``MAX_RATIO`` times, and the window bits."""
    for name, head, bits in kinds:
        if raw.startswith(head):
            parts, size = [], 0
            try:
                for out in _inflated([raw], bits):
                    parts.append(out)
                    size += len(out)
                    if size > MAX_RATIO * len(raw) + 4096:
                        return name, None, bits
                return name, b"".join(parts), bits
            except zlib.error:
                continue
    return None


def _odd(text: str) -> int:
    """How many characters aren't printed."""
    text = text.replace("\n", "").replace("\r", "").replace("\t", "")
    return 0 if text.isprintable() else sum(not c.isprintable() for c in text)


def _text_of(raw: bytes) -> str | None:
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return text if text and len(text) - _odd(text) >= 0.95 * len(text) else None


def _pieces(chunks: Iterable[bytes]) -> Iterator[tuple[str, str]]:
    """Texts of a stream in overlapping pieces, each with how more layers of compression were opened; raises an error if it is no text."""
    chunks = iter(chunks)
    head = next(chunks, b"")
    kinds = [(name, bits) for name, start, bits in HEADS if head.startswith(start)]
    try:
        codecs.getincrementaldecoder("utf-8")().decode(head)
    except UnicodeDecodeError:
        kinds.append(("deflate", -15))
    for name, bits in kinds:
        try:
            next(_inflated([head], bits), None)
        except zlib.error:
            continue
        for how, text in _pieces(_inflated(chain([head], chunks), bits)):
            yield f"/{name}{how}", text
        return
    decoder, parts, held, odd, size = codecs.getincrementaldecoder("utf-8")(), [], 0, 0, 0
    for data in chain([head], chunks):
        part = decoder.decode(data)
        odd, size = odd + _odd(part), size + len(part)
        parts.append(part)
        held += len(part)
        if held >= PIECE:
            text = "".join(parts)
            yield "", text
            parts, held = [text[-OVERLAP:]], OVERLAP
    decoder.decode(b"", True)
    yield "", "".join(parts)
    if size - odd < 0.95 * size:
        raise ValueError("no text")


def _decoded(s: str) -> tuple[str, str | Callable] | None:
    """How base64 is decoded to a text, and the text, or a function that gives its pieces if it is too long."""
    s = s.rstrip("=").replace("-", "+").replace("_", "/")
    if s.isalpha() and (s.islower() or s[1:].islower()) or len(s) % 4 == 1:
        return None  # a long word
    try:
        raw = base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None
    how = "base64"
    seen = set()
    while raw not in seen:
        seen.add(raw)
        x = _inflate(raw, HEADS)
        if not x and (inner := _text_of(raw)):
            return how, inner
        if not x and not (x := _inflate(raw, (("deflate", b"", -15),))):
            return None
        how = f"{how}/{x[0]}"
        if x[1] is None:
            return how, partial(lambda raw, bits: _pieces(_inflated([raw], bits)), raw, x[2])
        raw = x[1]
    return None


def _ranges(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Which neighbouring lines may be one wrapped run, longest first: all, all but the outer ones (words that are no part of
    it), and lines of one width with a shorter one behind or any before them."""
    n = len(sizes)
    found, i = {(0, n), (1, n), (0, n - 1), (1, n - 1)}, 0
    while i < n:
        j = i + 1
        while j < n and sizes[j] == sizes[i]:
            j += 1
        found |= {(lo, hi) for lo in (max(i - 1, 0), i) for hi in (j, min(j + 1, n))}
        i = j
    yield from sorted((x for x in found if x[1] - x[0] > 1), key=lambda x: (x[0] - x[1], x))


def _wrapped(text: str) -> Iterator[tuple[str, str | Callable, tuple[int, int]]]:
    """Layers in base64 that runs over line ends: how, text, span."""
    for m in LINES.finditer(text):
        if m.end() - m.start() < LEAST_BASE64:
            continue
        runs = [(x.start(), x.end()) for x in RUN.finditer(text, m.start(), m.end())]
        ends = [k + 1 for k, (_, b) in enumerate(runs) if text[b - 1] == "="]  # padding ends a run
        for first, last in zip([0, *ends], [*ends, len(runs)], strict=True):
            part = runs[first:last]
            taken: list[tuple[int, int]] = []
            for lo, hi in _ranges([b - a for a, b in part]) if len(part) > 1 else ():
                if any(a < hi and lo < b for a, b in taken):
                    continue
                joined = "".join([text[a:b] for a, b in part[lo:hi]])
                if len(joined) >= LEAST_BASE64 and (x := _decoded(joined)):
                    taken.append((lo, hi))
                    yield *x, (part[lo][0], part[hi - 1][1])


def _layers(text: str) -> Iterator[tuple[str, str | Callable, Places | tuple[int, int], tuple[int, int] | None]]:
    """Layers that stand in this one: how, text, the places of its characters (or one span for all), and the span of the
    wrapped run that it is a line of."""
    if "%" in text and URL.search(text) and (x := _escapes(text, URL, _url)):
        yield "url", *x, None
    if ("\\" in text or "&#" in text) and UNICODE.search(text) and (x := _escapes(text, UNICODE, _unicode)):
        yield "unicode", *x, None
    runs = []
    if "\n" in text:
        for how, inner, span in _wrapped(text):
            runs.append(span)
            yield how, inner, span, None
    runs.sort()
    for m in BASE64.finditer(text):
        if x := _decoded(m[0]):
            k = bisect_right(runs, (m.start(), len(text))) - 1
            yield *x, m.span(), runs[k] if k >= 0 and m.end() <= runs[k][1] else None


def _digest(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


class _Layer:
    """A layer whose inner layers are being opened: what has been found in it, by its own places."""

    def __init__(self, text: str, digest: bytes, depth: int):
        self.digest, self.depth, self.layers = digest, depth, _layers(text)
        self.found = {s: "" for s in base_spans(text)}
        self.cut = depth  # the outermost layer that an inner one repeats
        self.now = None
        self.lines: list[tuple[str, tuple[int, int], tuple[int, int], dict]] = []
        self.counts: dict[tuple[int, int], Counter] = {}

    def take(self, how: str, spans: Places | tuple[int, int], within: tuple[int, int] | None, inner: dict) -> None:
        """Keeps the secrets of lines of a wrapped run for ``close``, and adds others at once."""
        if within:
            self.lines.append((how, spans, within, inner))
            return
        if isinstance(spans, tuple):
            self.counts[spans] = Counter(kind for *_, kind in inner)
        self.add(how, spans, inner)

    def close(self) -> None:
        """Adds the secrets of single lines, but for a kind of which the run that they are of holds as many: it has them whole."""
        alone = Counter((within, kind) for _, _, within, inner in self.lines for *_, kind in inner)
        for how, spans, within, inner in self.lines:
            self.add(how, spans, {s: path for s, path in inner.items() if self.counts.get(within, {}).get(s[2], 0) < alone[within, s[2]]})

    def add(self, how: str, spans: Places | tuple[int, int], inner: dict) -> None:
        """Secrets of an inner layer at the places that it was decoded from; of two paths to one span the shorter stays."""
        for (a, b, kind), path in inner.items():
            key = (*spans, kind) if isinstance(spans, tuple) else (spans[a][0], spans[b - 1][1], kind)
            name = f"{how}/{path}" if path else how
            old = self.found.get(key)
            if old is None or name.count("/") < old.count("/") and old:
                self.found[key] = name


def _secrets(text: str, known: dict[bytes, dict], path: dict[bytes, int]) -> tuple[dict, int]:
    """{(start, end, kind): path} of a layer and all inner ones, and the outermost of ``path`` that one of them repeats.

    ``known``: results by digest, so that equal layers are opened once and count at every place; ``path``: the layers
    that this one stands in, by digest, where cycles end. A result that was cut by a cycle is not kept for other places."""
    digest = _digest(text)
    if digest in known:
        return known[digest], len(path)
    if digest in path:
        return {}, path[digest]
    stack = [_Layer(text, digest, len(path))]
    path[digest] = len(path)
    while True:
        layer = stack[-1]
        for how, inner, spans, within in layer.layers:
            if not isinstance(inner, str):
                found, cut = _of_pieces(inner, known, path)
                layer.take(how, spans, within, found)
                layer.cut = min(layer.cut, cut)
                continue
            digest = _digest(inner)
            if digest in known:
                layer.take(how, spans, within, known[digest])
            elif digest in path:
                layer.cut = min(layer.cut, path[digest])
            else:
                layer.now = how, spans, within
                stack.append(_Layer(inner, digest, len(path)))
                path[digest] = len(path)
                break
        else:
            layer.close()
            stack.pop()
            del path[layer.digest]
            if layer.cut >= layer.depth:
                known[layer.digest] = layer.found
            if not stack:
                return layer.found, layer.cut
            stack[-1].take(*stack[-1].now, layer.found)
            stack[-1].cut = min(stack[-1].cut, layer.cut)


def _of_pieces(pieces: Callable, known: dict[bytes, dict], path: dict[bytes, int]) -> tuple[dict, int]:
    """As ``_secrets``, of a layer that comes in pieces: one secret of each kind, as all have the span of the whole layer."""
    found, cut = {}, len(path)
    try:
        for how, piece in pieces():
            inner, repeated = _secrets(piece, known, path)
            cut = min(cut, repeated)
            for (_, _, kind), name in inner.items():
                found.setdefault((0, 1, kind), f"{how[1:]}/{name}".strip("/"))
    except (zlib.error, ValueError):
        return {}, cut
    return found, cut


def scan(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, str]]]:
    """Base spans, and (start, end, kind, path) of secrets in decoded layers that no base span of that kind covers."""
    found, _ = _secrets(text or "", {}, {})
    base = sorted((s for s, path in found.items() if not path), key=lambda s: (s[0], KINDS.index(s[2])))
    more = [(*s, path) for s, path in found.items() if path and not any(k == s[2] and a <= s[0] and s[1] <= b for a, b, k in base)]
    return base, sorted(more)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and ``secrets``: array of (start, end, kind, path), code points, end exclusive; path is '' for base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in batch.column(1).to_pylist():
                base, more = scan(t)
                found.append([{"start": a, "end": b, "kind": k, "path": ""} for a, b, k in base] + [{"start": a, "end": b, "kind": k, "path": p} for a, b, k, p in more])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "secrets"])

    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("path", pa.string())]))
    return ids_and_text(docs).mapInArrow(released(run), "doc_id long, secrets array<struct<start:long,end:long,kind:string,path:string>>")


def redacted(text: str, mark: str) -> str:
    """The text with every secret's span replaced; overlapping spans by one mark."""
    base, more = scan(text)
    parts, last = [], 0
    for a, b, *_ in sorted([*base, *more]):
        if a >= last:
            parts += [text[last:a], mark]
        last = max(last, b)
    return "".join([*parts, text[last:]])


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every secret's span replaced; n_chars, where present, follows texts that change."""
    names, at = docs.columns, docs.columns.index("text")
    count = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(batch.columns)
            old = cols[at].to_pylist()
            new = [t and redacted(t, mark) for t in old]
            cols[at] = pa.array(new, pa.string())
            if count is not None:
                sizes = [n if t == was else len(t) for n, t, was in zip(cols[count].to_pylist(), new, old, strict=True)]
                cols[count] = pa.array(sizes).cast(cols[count].type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(released(run), docs.schema)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["path"] == "")
    order = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    by_place = lambda c: F.array_sort(F.transform(c, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    said = lambda c: F.array_join(F.transform(by_place(c), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("secrets", lambda s: (s["path"] == "") & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("secrets")).alias("spans"))
