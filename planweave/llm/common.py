"""Helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planweave.storage import discard, new_path, remove, scope, shared_dir, store, write  # noqa: F401  for the operators


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a function of Arrow batches is given at a time, since texts are long. Batches share their memory with the one they are cut from.
BATCH_ROWS = 2000


def released(f):
    """A function of Arrow batches, given at most ``BATCH_ROWS`` rows at a time, whose worker gives free memory back to the system when a task ends."""
    import functools

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batch.slice(at, BATCH_ROWS) for batch in batches for at in range(0, max(batch.num_rows, 1), BATCH_ROWS))
        finally:
            import ctypes
            import gc

            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library

    return run


def ids_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only the columns that an operator reads, so that others never reach Python."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def free_name(wanted: str, *taken: list[str]) -> str:
    """A column name that none of the lists holds, in any case."""
    used = {x.lower() for names in taken for x in names}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def bits_of(values: DataFrame, column: str, bits: int = 1 << 21) -> bytes:
    """A bitmap of ``bits`` bits (256 KB), whatever the number of rows, with the bit ``bit_place`` of every value set."""
    words = values.select(bit_place(column, bits).alias("p")).groupBy(F.floor(F.col("p") / 8).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1, cast(p % 8 as int))")).alias("b"))
    data = bytearray(bits // 8)
    # As many bytes as the bitmap has, in pages.
    for r in words.groupBy(F.floor(F.col("w") / 4096).alias("page")).agg(F.collect_list(F.struct("w", "b")).alias("own")).collect():
        for w, b in r.own:
            data[w] = b
    return bytes(data)


def bit_place(column: str, bits: int = 1 << 21):
    return F.pmod(F.xxhash64(column), F.lit(bits))


def with_bit(df: DataFrame, column: str, data: bytes):
    """``df`` beside a one-row table that holds a bitmap of ``bits_of``, and the condition that a value's bit is set.

    One row of a join, not a literal: plans with long literals are long to print and keep."""
    name = free_name("bitmap", df.columns)
    row = df.sparkSession.createDataFrame([(bytearray(data),)], f"`{name}` binary")
    place = bit_place(column, len(data) * 8)
    byte = F.conv(F.hex(F.substring(name, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.broadcast(row), byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0
