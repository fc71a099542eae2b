"""Token ids in a binary file format with a shared compression dictionary (operator 7).

Every document is encoded on its own, its ids are serialised as little-endian unsigned 32-bit integers and compressed
as one zstandard frame with a dictionary that was trained on serialised id arrays. A dataset is a folder with

* ``dictionary``: one row ``(dict_sha256, dictionary, tokenizer_sha256)``,
* ``segments``: rows ``(shard, segment, dict_sha256, doc_ids, offsets, n_tokens, starts, frames)`` in ascending doc_id
  order over shards and segments. ``frames`` holds the frames of a segment's documents one behind the other, and
  ``offsets`` (one more than documents) says where each begins, so that one document is read by one slice and one
  decompression. ``starts`` counts the ids before each document within the shard,
* ``shards``: ``(shard, base, first_doc_id, n_docs, n_tokens)``; ``base`` is the number of ids in all shards before it.

Spark's own writers commit these files, so lost executors leave no half-written output.

Defined cases: a null or empty text gives the end id alone; rows with a null doc_id stand before all others; repeated
doc_ids are all kept, next to each other; an empty table gives empty files; other columns are
ignored. The dictionary is trained on at most ``TRAIN_DOCS`` documents (the lowest hashes of doc_id), ``TRAIN_BYTES`` of
each from a hashed place in its text, and where these are too few to train on it is empty, which zstandard treats as plain
compression.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, ids_and_text, new_path, read, released, store

TOKENIZER, END_ID = "word_bpe_49k.json", 2
#: Documents the dictionary is trained on, at most, bytes of ids taken of each, and the dictionary's size.
TRAIN_DOCS, TRAIN_BYTES, DICT_BYTES = 1000, 8192, 32 << 10
LEVEL, SEGMENT_DOCS, SEGMENT_BYTES = 3, 512, 4 << 20
#: Words whose ids a worker remembers.
CACHE_WORDS = 1_200_000
#: Marks that the tokenizer parts from the letters before them.
MARKS = b".,;:!?)%$&#*"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Encoder:
    """Ids of whole texts, word by word.

    The tokenizer drops white space and never joins what stands on both sides of it, so a text's ids are those of its
    parts between ASCII white space; each distinct part is encoded once and then looked up. Letters with marks behind
    them are looked up as two parts. Parts of letters alone are one word of the tokenizer, whose last id is a word end,
    so many of them are encoded as one text and cut apart behind the word ends.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on each core
        from tokenizers import Tokenizer

        self.model, self.known = Tokenizer.from_file(path), {}
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        self.ends[[i for t, i in self.model.get_vocab().items() if t.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """Serialised ids of each text, without an end id."""
        words = [t.encode().split() for t in texts]
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        self._learn(set(chain.from_iterable(words)).difference(known))
        return [b"".join(map(known.__getitem__, ws)) for ws in words]

    def _learn(self, new: set[bytes]) -> None:
        known, plain, other, pairs = self.known, set(), [], []
        for w in new:
            core = w.rstrip(MARKS)
            if not core.isalpha():  # not ASCII letters alone
                s = core.decode()
                if not s or not unicodedata.is_normalized("NFC", s) or not s.lower().isalpha():
                    other.append(w)
                    continue
            if core == w:
                plain.add(w)
            else:
                pairs.append((w, core, w[len(core) :]))
        for _, core, marks in pairs:
            if core not in known:
                plain.add(core)
            if marks not in known and marks not in new:
                other.append(marks)
        plain = list(plain)
        parts = [plain[at : at + 256] for at in range(0, len(plain), 256)]
        for part, e in zip(parts, self.model.encode_batch_fast([b" ".join(x).decode() for x in parts], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part):
                raw, last = ids.tobytes(), 0
                for w, cut in zip(part, cuts.tolist(), strict=True):
                    known[w] = raw[4 * last : 4 * cut]
                    last = cut
            else:
                other += part
        other = list(dict.fromkeys(other))
        for w, e in zip(other, self.model.encode_batch_fast([w.decode() for w in other], add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, "<u4").tobytes()
        for w, core, marks in pairs:
            known[w] = known[core] + known[marks]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """A zstandard dictionary from serialised ids of at most TRAIN_DOCS documents."""
    import zstandard

    # Ids first: a top-k of texts would send as many texts from every task. A document of many ids gives a part of its text.
    ids = [r[0] for r in docs.filter("doc_id is not null").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS).collect()]
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.lit(1), F.length("text") - TRAIN_BYTES + 1)).cast("int")
    rows = docs.filter(F.col("doc_id").isin(ids) & F.col("text").isNotNull()).select("doc_id", F.substring("text", place + 1, F.lit(TRAIN_BYTES)).alias("text")).limit(TRAIN_DOCS).collect()
    rows.sort(key=tuple)
    samples = [x[:TRAIN_BYTES] for x in encoder(path).encode([r.text for r in rows])]
    try:
        return zstandard.train_dictionary(DICT_BYTES, [x for x in samples if x]).as_bytes()
    except zstandard.ZstdError:
        return b""


def compressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def decompressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) into a dataset at ``path``."""
    spark, model = docs.sparkSession, tokenizer or tokenizer_path()
    docs = ids_and_text(docs)
    dictionary = train_dictionary(docs, model)
    digest = hashlib.sha256(dictionary).hexdigest()
    end = np.array([end_id], "<u4").tobytes()

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, enc = compressor(dictionary), encoder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [x + end for x in enc.encode([t or "" for t in part.column(1).to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([squeeze.compress(x) for x in ids], pa.binary())], ["doc_id", "n_tokens", "frame"])

    # Written once before the range exchange, which reads its input twice: to find the bounds and to deal out the rows.
    framed = store(docs.mapInArrow(released(frames), "doc_id long, n_tokens long, frame binary"), "frames")
    ordered = framed.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("frame")).withColumn("shard", F.spark_partition_id())

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, at, start = [], 0, 0, 0

        def segment() -> pa.RecordBatch:
            nonlocal at, start
            counts = np.array([r[1] for r in held], np.int64)
            row = {
                "shard": [held[0][3]], "segment": [at], "dict_sha256": [digest], "doc_ids": [[r[0] for r in held]],
                "offsets": [np.cumsum([0, *(len(r[2]) for r in held)])], "n_tokens": [counts], "starts": [start + np.cumsum(counts) - counts],
                "frames": [b"".join(r[2] for r in held)],
            }
            at, start = at + 1, start + int(counts.sum())
            return pa.RecordBatch.from_pydict(row, schema)

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame", "shard")), strict=True):
                held.append(r)
                size += len(r[2])
                if len(held) >= SEGMENT_DOCS or size >= SEGMENT_BYTES:
                    yield segment()
                    held, size = [], 0
        if held:
            yield segment()

    longs = pa.list_(pa.int64())
    schema = pa.schema({"shard": pa.int32(), "segment": pa.int32(), "dict_sha256": pa.string(), "doc_ids": longs, "offsets": longs, "n_tokens": longs, "starts": longs, "frames": pa.binary()})
    ddl = "shard int, segment int, dict_sha256 string, doc_ids array<long>, offsets array<long>, n_tokens array<long>, starts array<long>, frames binary"
    ordered.mapInArrow(segments, ddl).write.option("compression", "none").parquet(f"{path}/segments")
    discard(framed)
    # As many rows as shards; the order of shards is the order of doc_ids.
    per = (
        spark.read.parquet(f"{path}/segments").groupBy("shard")
        .agg(F.min(F.col("doc_ids")[0]).alias("first_doc_id"), F.sum(F.size("doc_ids")).alias("n_docs"), F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n_tokens"))
        .orderBy("shard").collect()
    )
    rows, base = [], 0
    for r in per:
        rows.append((r.shard, base, r.first_doc_id, r.n_docs, r.n_tokens))
        base += r.n_tokens
    spark.createDataFrame(rows, "shard int, base long, first_doc_id long, n_docs long, n_tokens long").coalesce(1).write.parquet(f"{path}/shards")
    spark.createDataFrame([(digest, bytearray(dictionary), hashlib.sha256(Path(model).read_bytes()).hexdigest())], "dict_sha256 string, dictionary binary, tokenizer_sha256 string").coalesce(1).write.parquet(f"{path}/dictionary")


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None, digests: bool = False) -> DataFrame:
    """Documents of a dataset: doc_id, start, n_tokens and ids (or, with ``digests``, ids_crc32).

    ``doc_ids`` (a stated list) reads only segments that can hold them and decompresses only their frames.
    """
    head = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, digest = bytes(head.dictionary), head.dict_sha256
    segments = spark.read.parquet(f"{path}/segments")
    wanted = None if doc_ids is None else F.lit(sorted(set(doc_ids))).cast("array<long>")
    if wanted is not None:
        segments = segments.filter(F.arrays_overlap("doc_ids", wanted))
    # One row for each shard: as many as write tasks, a few bytes each.
    segments = segments.join(F.broadcast(spark.read.parquet(f"{path}/shards").select("shard", "base")), "shard")

    segments = segments.select("shard", "segment", "dict_sha256", "doc_ids", "offsets", "starts", "frames", "base")
    if wanted is not None:  # segments of one document, which hold its frame alone
        one = segments.withColumn("i", F.explode(F.sequence(F.lit(0), F.size("doc_ids") - 1))).filter(F.array_contains(wanted, F.get("doc_ids", "i")))
        lo, hi = F.get("offsets", "i"), F.get("offsets", F.col("i") + 1)
        frame = F.substring("frames", (lo + 1).cast("int"), (hi - lo).cast("int"))
        segments = one.select("shard", "segment", "dict_sha256", F.array(F.get("doc_ids", "i")).alias("doc_ids"), F.array(F.lit(0).cast("long"), hi - lo).alias("offsets"), F.array(F.get("starts", "i")).alias("starts"), frame.alias("frames"), "base")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = decompressor(dictionary)
        for batch in batches:
            for s in batch.to_pylist():
                if s["dict_sha256"] != digest:
                    raise ValueError(f"segment {s['segment']} of shard {s['shard']} was written with another dictionary")
                out = []
                for doc_id, lo, hi, start in zip(s["doc_ids"], s["offsets"][:-1], s["offsets"][1:], s["starts"], strict=True):
                    raw = expand.decompress(s["frames"][lo:hi])
                    out.append((doc_id, s["base"] + start, len(raw) // 4, zlib.crc32(raw) if digests else np.frombuffer(raw, "<u4").astype(np.int64)))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.int64() if digests else pa.list_(pa.int64()))], names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"]
    return segments.mapInArrow(released(unpack), f"doc_id long, start long, n_tokens long, {names[3]} {'long' if digests else 'array<long>'}")


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_tokens(read(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path, digests=True)
