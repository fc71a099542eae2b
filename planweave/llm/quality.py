"""Quality rules with tokeniser fertility (operator 4).

Each distinct word of a chunk is encoded once with two public vocabularies; a text's tokens are those of its words.

* characters per token: code points in words / tokens of the byte-level vocabulary,
* byte-fallback share: part of the piece vocabulary's tokens that are raw bytes, since no piece covers the character,
* token entropy: bits, of the byte-level tokens' distribution in the text, as a part of the log2(n) it could have.

``BANDS`` says, by the script that most letters of a text belong to, which values are kept. A text outside any band of
its script is rejected. The base rules reject texts of under 10 words, and those where over a fifth of the words stand
in 5-word windows that occur twice.

Defined cases: a null or empty text has no words and fails the base rules, as do texts without words (their measures
are null); repeated rows give repeated results; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import ids_and_text, read, released
from .scan import PLAIN_WORD, Chunk, U, mix, per_chunk, starts_of_windows, windows

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
#: Words whose tokens a worker remembers.
CACHE_WORDS = 300_000


@dataclass(frozen=True)
class Band:
    """What is kept: characters per token within, byte-fallback share up to, part of the possible entropy from."""

    least_chars: float
    most_chars: float
    most_fallback: float
    least_entropy: float


BANDS = {
    "latin": Band(1.88, 8.0, 0.10, 0.40),
    "greek": Band(0.5, 6.0, 0.30, 0.40),
    "cyrillic": Band(0.7, 7.0, 0.20, 0.40),
    "cjk": Band(0.3, 3.0, 0.60, 0.40),
    "other": Band(0.2, 8.0, 0.90, 0.35),
}
SCRIPTS = list(BANDS)
#: A short text's means scatter, so the lower bounds fall by this over the square root of its number of tokens.
ALLOWANCE = 2.0

#: Script of the letters that begin with a byte, as an index into SCRIPTS; -1: no letter begins with it.
_SCRIPT = np.full(256, -1, np.int8)
_SCRIPT[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)]] = 0
_SCRIPT[0xCE:0xD0], _SCRIPT[0xD0:0xD4], _SCRIPT[0xE3:0xEE] = 1, 2, 3
_SCRIPT[0xD4:0xE3] = _SCRIPT[0xEE:0xF5] = 4
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CHAR = np.ones(256, bool)
_CHAR[0x80:0xC0] = False


class Vocabularies:
    """Tokens of single words, remembered by the word's hash."""

    def __init__(self, byte_path: str, piece_path: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(byte_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.raw = np.array([self.pieces.is_byte(i) or self.pieces.is_unknown(i) for i in range(self.pieces.vocab_size())])
        self.known: dict[int, tuple[bytes, int, int]] = {}

    def look_up(self, keys: np.ndarray, word_of) -> list[tuple[bytes, int, int]]:
        """(byte-level ids, pieces, raw-byte pieces) for each key; ``word_of(i)`` gives the i-th word."""
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        keys = keys.tolist()
        new = [i for i, k in enumerate(keys) if k not in known]
        if new:
            words = [word_of(i).decode("utf-8", "replace") for i in new]
            for i, w, pieces in zip(new, words, self.pieces.encode(words, num_threads=1), strict=True):
                known[keys[i]] = (np.array(self.bytes.encode_ordinary(" " + w), "<u4").tobytes(), len(pieces), int(self.raw[pieces].sum()) if pieces else 0)
        return [known[k] for k in keys]


@lru_cache(2)
def vocabularies(byte_path: str, piece_path: str) -> Vocabularies:
    return Vocabularies(byte_path, piece_path)


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def _repeats(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice in their document, and which are not the first of theirs."""
    both = keys ^ mix(docs.astype(np.uint64) + U(1))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return twice, later


def measure(chunk: Chunk, vocab: Vocabularies) -> dict[str, np.ndarray]:
    """All measures of the chunk's documents."""
    offs, n = chunk.offs, chunk.n
    starts, ends, first = chunk.spans(PLAIN_WORD)
    n_words = np.diff(first)
    doc_of = np.repeat(np.arange(n), n_words)
    in_word = PLAIN_WORD[chunk.buf]
    out = {"n_words": n_words, "word_chars": _sums(in_word & _CHAR[chunk.buf], offs), "n_symbols": _sums(_SYMBOL[chunk.buf], offs)}

    a, b, line_first = chunk.lines()
    filled = np.zeros(len(in_word) + 1, np.int64)
    np.cumsum(in_word, out=filled[1:])
    has = filled[b] > filled[a]
    line_doc = np.repeat(np.arange(n), np.diff(line_first))[has]
    _, later = _repeats(chunk.hashes(a[has], b[has]), line_doc)
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=n)

    h = chunk.hashes(starts, ends)
    at = np.flatnonzero(starts_of_windows(first, WINDOW)[: max(0, len(h) - WINDOW + 1)])
    twice, _ = _repeats(windows(h, WINDOW)[at], doc_of[at])
    covered = np.zeros(len(h), bool)
    for j in range(WINDOW):
        covered[at[twice] + j] = True
    out["n_repeat_words"] = np.bincount(doc_of[covered], minlength=n)

    keys, place, which = np.unique(h, return_index=True, return_inverse=True)
    said = vocab.look_up(keys, lambda i: chunk.buf[starts[place[i]] : ends[place[i]]].tobytes())
    sizes = np.array([len(x[0]) // 4 for x in said], np.int64)
    begins = np.cumsum(sizes) - sizes
    ids = np.frombuffer(b"".join(x[0] for x in said), "<u4").astype(np.int64)
    per_word = sizes[which]
    total = int(per_word.sum())
    within = np.arange(total) - np.repeat(np.cumsum(per_word) - per_word, per_word)
    tokens = ids[np.repeat(begins[which], per_word) + within] if total else ids[:0]
    pairs = np.sort(np.repeat(doc_of, per_word) << 20 | tokens)
    edge = np.flatnonzero(np.diff(pairs, prepend=-1))
    counts = np.diff(np.append(edge, len(pairs))).astype(float)
    n_tokens = np.bincount(doc_of, weights=per_word, minlength=n)
    inner = np.bincount(pairs[edge] >> 20, weights=counts * np.log2(counts), minlength=n) if total else np.zeros(n)
    with np.errstate(divide="ignore", invalid="ignore"):
        entropy = np.log2(n_tokens) - inner / n_tokens
        out["n_tokens"] = n_tokens
        out["chars_per_token"] = out["word_chars"] / n_tokens
        pieces, raw = (np.bincount(doc_of, weights=np.array([x[j] for x in said], float)[which] if len(which) else None, minlength=n) for j in (1, 2))
        out["byte_fallback"] = raw / pieces
        out["token_entropy"] = entropy
        out["entropy_part"] = np.where(n_tokens > 1, entropy / np.log2(n_tokens), 0.0)
    script = _SCRIPT[chunk.buf]
    marks = np.flatnonzero(chunk.buf[:-1] == 0xE2)  # general punctuation and signs, up to U+2BFF
    script[marks[chunk.buf[marks + 1] < 0xB0]] = -1
    letters = np.stack([_sums(script == j, offs) for j in range(len(SCRIPTS))])
    out["script"] = np.argmax(letters, axis=0)
    return out


def judge(m: dict[str, np.ndarray], bands: dict[str, Band] = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """base_failed and kept."""
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    limit = lambda field: np.array([getattr(bands[s], field) for s in SCRIPTS])[m["script"]]
    with np.errstate(invalid="ignore", divide="ignore"):
        slack = ALLOWANCE / np.sqrt(m["n_tokens"])
        inside = (m["chars_per_token"] >= limit("least_chars") - slack) & (m["chars_per_token"] <= limit("most_chars"))
        inside &= (m["byte_fallback"] <= limit("most_fallback")) & (m["entropy_part"] >= limit("least_entropy") - slack)
    return base, ~base & inside


_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_DOUBLES = ("chars_per_token", "byte_fallback", "token_entropy", "entropy_part")


def quality(docs: DataFrame, bands: dict[str, Band] = BANDS, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """Measures and verdict of every document; the vocabularies' files must be at the same path on all machines."""
    import public_tokenizers

    paths = byte_path or str(public_tokenizers.path(BYTE_VOCABULARY)), piece_path or str(public_tokenizers.path(PIECE_VOCABULARY))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabularies(*paths)
        for rows, chunk in per_chunk(batches):
            m = measure(chunk, vocab)
            base, kept = judge(m, bands)
            cols = [pa.array(m[c].astype(np.int64)) for c in _LONGS] + [pa.array(m[c].astype(float), from_pandas=True) for c in _DOUBLES]
            yield pa.RecordBatch.from_arrays([rows.column(0), *cols, pa.array([SCRIPTS[i] for i in m["script"]], pa.string()), pa.array(base), pa.array(kept)], ["doc_id", *_LONGS, *_DOUBLES, "script", "base_failed", "kept"])

    ddl = ", ".join(["doc_id long", *(f"{c} long" for c in _LONGS), *(f"{c} double" for c in _DOUBLES), "script string, base_failed boolean, kept boolean"])
    return ids_and_text(docs).mapInArrow(released(run), ddl)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"))
