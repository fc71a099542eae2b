"""A training corpus in five stages over ``documents``: STAGES, run(spark, sf_dir), ORACLE_SQL.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is written
as Parquet and reread as the next one's documents. All but the last return the columns of documents.

Texts are long, so this job asks Spark for small Arrow batches, unless the session has a setting of its own.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from planweave.llm.common import new_path, read, remove, scope, write
from planweave.llm.decontaminate import drop_contaminated
from planweave.llm.language import keep_languages
from planweave.llm.ngram_join import drop_near_copies
from planweave.llm.pieces import encode
from planweave.llm.secrets import redact_secrets


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stage(f):
    """A stage under the job's settings."""

    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH, None) is None:
            spark.conf.set(BATCH, "2000")
        return f(spark, docs, sf_dir)

    return run


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows, by its probability; where ``lang`` is null it becomes the predicted one."""
    return keep_languages(docs)


@stage
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest doc_id, of each class of texts whose 5-word shingles are alike at 0.8 or more."""
    return drop_near_copies(docs)


@stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised ones included."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


@stage
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets, encoded ones too, replaced by a mark."""
    return redact_secrets(docs)


@stage
def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of every document, as piece ids with digests and inclusion scores.

    Smaller chunks than alone: the executors' heaps have grown in the stages before."""
    return encode(docs, digests=True, chunk_bytes=1 << 18)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece", sentencepiece),
]

#: SQL can express neither the network nor the sampled segmentations; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Tables that a stage stores on its way, and its input, are removed when it is done."""
    docs, before = read(spark, sf_dir, "documents"), []
    for name, work in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        with scope(spark, *before):
            write(work(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
        remove(spark, *before)
        before = [path]
    return docs
