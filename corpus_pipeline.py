"""A training corpus from ``documents``: toxicity, near duplicates, repeated passages, benchmark passages, then token ids.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and all but the last return the columns of ``documents``.

Defined cases of every stage: null and empty texts stay (stage 1 gives them the model's bias alone; stage 2 holds equal ones for copies of each other and keeps the
first, null like empty; stage 3 drops a document only if a cut leaves nothing of it); a very long text is worked off whole; repeated rows are judged alike, so
stages 1, 3 and 4 keep or drop all of them; in stage 2 equal rows with the least id stay, and of rows without an id one; an empty table gives an empty table; columns besides those of
``documents`` come back unchanged whatever their names, but for the last stage, which returns doc_id, n_tokens and ids; any other column than text and doc_id may be null.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import decontam, ngramjoin, pieces, queries, suffix, toxicity
from brindle.llm.shared import shared_folder
from brindle.operators.durable import remove


def _sized(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where a stage changed it."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model learns from the documents that this stage got."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a Jaccard similarity of 0.8 or more of 5-word shingles, that with the least id stays."""
    return ngramjoin.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes or more that an earlier document has are cut out; a document of which nothing is left goes."""
    return _sized(suffix.remove_repeats(docs, batch_mb=4))  # beside the heap that earlier stages have filled


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a 10-word window of a benchmark item go."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of what is left."""
    coded = pieces.encode(docs.select("doc_id", "text"), pieces.load(queries.PIECES))
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_benchmark),
    ("SentencePiece", to_ids),
]

#: Training a model and following links are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written below the shared folder and read again, and goes when the next one's is there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
