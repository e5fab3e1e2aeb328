"""The record index: normalised records and token postings as Parquet tables.

A build is keyed by a fingerprint of its inputs and only counts once its marker is
written, so neither a crashed nor a stale build is ever reused.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinlink.functions.text import add_normalized_columns, blocking_tokens

from .tsv import delete, exists, read_tsv

#: num: a long in the order of the ids; tokens: those that blocking uses.
RECORD_COLUMNS = ["num", "tokens", "entity_id", "business_name", "business_address", "country", "name_norm", "name_core", "address_norm", "name_tokens", "address_tokens"]


def last_writes(rows: DataFrame, order: list[str], key: str = "entity_id") -> DataFrame:
    """Upsert: of rows with one key the last by ``order`` stays."""
    latest = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def ordered(records: DataFrame) -> DataFrame:
    """records + num, a long in the order of the ids; to be written before it is used, which fixes the numbers.

    Range partitions sorted within give it without a task that sees all rows.
    """
    spark = records.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return records.repartitionByRange(n, "entity_id").sortWithinPartitions("entity_id").withColumn("num", F.monotonically_increasing_id())


def with_numbers(records: DataFrame) -> DataFrame:
    """Normalised records + num and tokens; records are normalised after the exchange, whose sampling
    reads its input once more."""
    r = ordered(records)
    r = r if {"name_tokens", "address_tokens"} <= set(r.columns) else add_normalized_columns(r)
    return r.withColumn("tokens", blocking_tokens(F.col("name_tokens"), F.col("address_tokens")))


def postings(records: DataFrame) -> DataFrame:
    """(token, entity_id, country), each token once a record."""
    return records.select("entity_id", "country", F.explode(blocking_tokens(F.col("name_tokens"), F.col("address_tokens"))).alias("token")).select("token", "entity_id", "country")


def fetch_records(records: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of the ids (column entity_id); unknown ids give nothing."""
    return records.join(ids.select("entity_id").distinct(), "entity_id", "left_semi")


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Names, sizes and times of the inputs."""
    jvm, found = spark.sparkContext._jvm, []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        s = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
        found.append([p, s.getLen(), s.getModificationTime()])
    return hashlib.sha256(json.dumps(found).encode()).hexdigest()[:16]


class RecordIndex:
    """records and postings under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @property
    def records(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/records")

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/postings")


def build_index(spark: SparkSession, paths: list[str], folder: str, chunksize: int = 10_000) -> RecordIndex:
    """Build from TSV sources, later files winning over earlier ones, unless built already.

    chunksize is accepted for command-line parity; partitions bound memory here.
    """
    at = f"{folder}/{fingerprint(spark, paths)}"
    if not exists(spark, f"{at}/_BUILT"):
        delete(spark, at)
        rows = None
        for i, p in enumerate(paths):
            part = read_tsv(spark, p).select("entity_id", "business_name", "business_address", "country").withColumn("_file", F.lit(i)).withColumn("_row", F.monotonically_increasing_id())
            rows = part if rows is None else rows.union(part)
        kept = last_writes(rows, ["_file", "_row"]).drop("_file", "_row")
        with_numbers(kept).select(*RECORD_COLUMNS).write.parquet(f"{at}/records")
        postings(spark.read.parquet(f"{at}/records")).write.parquet(f"{at}/postings")
        spark.range(1).coalesce(1).write.parquet(f"{at}/_BUILT")
    return RecordIndex(spark, at)
