"""Training-data pipeline: quality, near-duplicates, repeated spans, leaks, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
its result is written as Parquet and read again before the next one starts.  All but
the last return the columns of ``documents``.

Defined cases: stages take null and empty texts (the base rules reject them), very long
texts (whole), repeated rows (one stays, any one where they tie) and extra columns of any
name: the first four stages carry them, the last returns doc_id and what it encodes, and
none of the other columns; an empty table gives an empty result.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.llm import decontaminate, minhash, pieces, quality, spans
from kinlink.llm.shared import recorded, remove, shared_path

#: Tables of the stage under way, by thread and data folder: runs side by side keep apart.
_used: dict[tuple[int, str], list[str]] = {}


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage's own tables go when the next stage starts: by then its result is written."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = threading.get_ident(), sf_dir
        remove(spark, _used.pop(key, []))
        with recorded() as paths:
            out = work(spark, docs, sf_dir)
        _used[key] = paths
        return out

    return run


@_stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


@_stage
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = spans.dedup_spans(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


@_stage
def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.default_model())


STAGES = [
    ("quality rules", keep_quality),
    ("minhash near-dedup", keep_distinct),
    ("substring dedup", drop_repeats),
    ("benchmark decontamination", drop_leaked),
    ("sentencepiece", tokenise),
]
#: No SQL: the first stage learns a classifier, the last one searches a lattice.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = shared_path(spark, name.replace(" ", "-"))
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
