"""Results that several stages read are written once to a folder that all machines share.

Everything that an application stores lies in one folder of its own below ``spark.checkpoint.dir``. Tables that nothing
reads any more are removed at once by ``discard``; ``scope`` removes what was stored within it; what is left, such as the
tables that a returned DataFrame reads, goes with ``clean`` or when the driver ends.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_stored: list[str] = []
_settings: dict[str, object] = {}  # by folder: the file system settings, which are needed after the session has ended


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in spark.checkpoint.dir, or, in local sessions without the setting, in a folder of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file:///tmp/planweave-checkpoint"
    folder = f"{folder}/planweave-{spark.sparkContext.applicationId}"
    if folder not in _settings:
        _settings[folder] = spark._jsc.hadoopConfiguration()
        atexit.register(_remove, spark, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path that nothing has used, for one table or dataset."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _stored.append(path)
    return path


def store(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write and reread: computed once, and safe from lost executors."""
    path = new_path(df.sparkSession, name)
    write(df, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


#: Settings while a table is stored: shuffle files of its plan, which nothing else reads, are removed when it is done, and functions of Arrow batches get few rows at a time.
_WHILE_STORED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def write(df: DataFrame, path: str) -> None:
    """Writes a table as Parquet; the session has its own settings back afterwards."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k, None) for k in _WHILE_STORED}
    try:
        for k, v in _WHILE_STORED.items():
            conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def discard(*tables: DataFrame) -> None:
    """Removes stored tables; only for those that no DataFrame in use reads."""
    for df in tables:
        _remove(df.sparkSession, df.stored_at)


def remove(spark: SparkSession, *paths: str) -> None:
    """The same by paths, as ``new_path`` gives them."""
    for path in paths:
        _remove(spark, path)


@contextmanager
def scope(spark: SparkSession, *keep: str) -> Iterator[None]:
    """Removes, at its end, what was stored within it, but for the paths ``keep``."""
    before = {*_stored, *keep}
    try:
        yield
    finally:
        remove(spark, *(path for path in [*_stored] if path not in before))


def clean(spark: SparkSession) -> None:
    """Removes everything that this application has stored; DataFrames that read it can't be used any more."""
    _remove(spark, shared_dir(spark))


def _remove(spark: SparkSession, path: str) -> None:
    if path in _stored:
        _stored.remove(path)
    folder = next((f for f in _settings if path.startswith(f)), "")
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(_settings.get(folder) or spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001  what can't be removed is left, as when the driver's JVM has ended
        pass


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt out by keys over spark.sql.shuffle.partitions tasks, a number that adaptive execution keeps.

    Kernels are costly for few bytes, and partitions that are merged by their bytes would leave cores idle."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
