"""Precision-weighted quality of match lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entity_f05(predicted: Column, truth: Column) -> Column:
    """F0.5 of one record's sets; 1 for nothing predicted where nothing is true."""
    p, t = F.array_distinct(predicted), F.array_distinct(truth)
    hit = F.size(F.array_intersect(p, t)).cast("double")
    precision, recall = F.try_divide(hit, F.size(p)), F.try_divide(hit, F.size(t))
    score = F.coalesce(F.try_divide(F.lit(1.25) * precision * recall, F.lit(0.25) * precision + recall), F.lit(0.0))
    return F.when(F.size(t) == 0, (F.size(p) == 0).cast("double")).when(F.size(p) == 0, 0.0).otherwise(score)


def entity_scores(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """(source1_entity_id, f05) of every truth record; other predictions are ignored.

    truth: (source1_entity_id, ids), predictions: (s1, matches).
    """
    j = truth.join(predictions, truth["source1_entity_id"] == predictions["s1"], "left")
    return j.select("source1_entity_id", entity_f05(F.coalesce("matches", F.array().cast("array<string>")), F.col("ids")).alias("f05"))


def macro_f05(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: the mean over truth records, 0 without any."""
    return entity_scores(truth, predictions).agg((F.coalesce(F.sum("f05"), F.lit(0.0)) / F.greatest(F.lit(1), F.count(F.lit(1)))).alias("macro_f05"))
