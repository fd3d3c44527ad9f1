"""Training-corpus pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; all but
the last have the columns of documents, and so has the last, with rows as often as
the mix takes them.  run() writes each stage's result as Parquet to the shared
checkpoint folder and reads it back for the next, so a lost executor costs one stage
at most and no stage is computed twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.llm import fm_index, line_dedup, minhash, mixing, toxicity
from txnwatch.llm.text import packed, unpacked
from txnwatch.session import checkpoint_path

#: Documents of at least this toxicity score are rejected.
TOXIC = 0.3


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars again counts the text's code points."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), length).otherwise(F.col("n_chars")))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(packed(docs, "text"), model, "_toxicity")
    return unpacked(scored.filter(F.col("_toxicity") < TOXIC), docs.columns, ("text",))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_length(line_dedup.drop_repeated_lines(docs, min_chars=40, min_docs=5))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_near_duplicates(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_length(fm_index.remove_benchmark(spark, docs, benchmark, window=10))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.draw(docs, weights=(5, 2, 1), cap=3.0)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

#: A fitted classifier and min-max hashing are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = checkpoint_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
