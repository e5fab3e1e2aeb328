"""Record-shaped views of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: source by id, name from the first six words, address from all others."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    d = d.select("doc_id", "lang", words.alias("w"))
    rest = F.slice("w", F.lit(7), F.greatest(F.size("w") - 6, F.lit(0)))
    return d.select(F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
                    F.array_join(F.slice("w", 1, 6), " ").alias("business_name"), F.array_join(rest, " ").alias("business_address"), F.col("lang").alias("country"))


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of document_records, the whole text as the address: blocking takes name and address together."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return d.select(F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
                    F.lit("").alias("business_name"), F.col("text").alias("business_address"), F.col("lang").alias("country"))


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as records with many ties."""
    return part_kinds(spark, sf_dir).drop("kind")


def part_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of part_records with the type, which the truth compares whatever the brand."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    return p.select(F.concat(F.lit("S"), (F.col("p_partkey") % 3 + 1).cast("string"), F.lit("-"), F.col("p_partkey").cast("string")).alias("entity_id"),
                    F.col("p_name").alias("business_name"), F.concat("p_brand", F.lit(" "), "p_type").alias("business_address"), F.col("p_size").cast("string").alias("country"), F.col("p_type").alias("kind"))


def source(records: DataFrame, *numbers: int) -> DataFrame:
    return records.where(F.substring("entity_id", 2, 1).isin([str(n) for n in numbers]))


def document_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source1_entity_id, matched_entity_ids): equal texts of the other sources, sorted."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    e = d.select(F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("id"), (F.col("doc_id") % 3).alias("m"), F.md5("text").alias("h"), F.length("text").alias("n"))
    one, other = e.where("m = 0").select("id", "h", "n"), e.where("m <> 0").select(F.col("id").alias("match"), "h", "n")
    lists = one.join(other, ["h", "n"], "left").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("match")), ",").alias("matched_entity_ids"))
    return lists.select(F.col("id").alias("source1_entity_id"), "matched_entity_ids")


def part_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1, cand): parts of other sources with equal name, type and size, whatever their brand."""
    same = ["p_name", "p_type", "p_size"]
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select(*same, "p_partkey")
    name = lambda i: F.concat(F.lit("S"), (F.col("p_partkey") % 3 + 1).cast("string"), F.lit("-"), F.col("p_partkey").cast("string")).alias(i)
    one, other = p.where("p_partkey % 3 = 0").select(*same, name("s1")), p.where("p_partkey % 3 <> 0").select(*same, name("cand"))
    return one.join(other, same).select("s1", "cand")
