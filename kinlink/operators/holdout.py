"""Seeded, order-free samples and splits by hash rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_key(seed: int, column: str = "entity_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(column)))


def sample_n(frame: DataFrame, n: int, seed: int, column: str = "entity_id") -> DataFrame:
    """n rows without replacement: a distributed top-n, no global window."""
    return frame.orderBy(shuffle_key(seed, column), column).limit(n)


def split_by_source1(source1: DataFrame, truth: DataFrame, validation_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """train and validation records, then their truth; disjoint in records.

    The cut is int(n * (1 - fraction)) rows in hash order. Ranks are counted within hash
    prefixes and offset by the prefixes before, so no task sees all rows.
    """
    key = shuffle_key(seed)
    cut = int(source1.count() * (1.0 - validation_fraction))
    keyed = source1.select("entity_id", key.alias("_h")).withColumn("_p", F.substring("_h", 1, 3))
    sizes = keyed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # at most 4096 rows
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy("_h", "entity_id"))
    part = keyed.withColumn("_r", rank).join(before.select("_p", "_before"), "_p").select("entity_id", (F.col("_r") + F.col("_before") <= cut).alias("_train"))
    train, valid = part.where("_train").select("entity_id"), part.where("not _train").select("entity_id")
    pick = lambda ids: (source1.join(ids, "entity_id", "left_semi"), truth.join(ids.withColumnRenamed("entity_id", "source1_entity_id"), "source1_entity_id", "left_semi"))
    (ts, tt), (vs, vt) = pick(train), pick(valid)
    return ts, vs, tt, vt
