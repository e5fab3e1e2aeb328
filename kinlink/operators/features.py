"""Pair features: candidates joined to both records, arrays prepared once a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.functions.similarity import FEATURES, native_features, prepared, sequence_features

from .blocking import _normalized, class_candidates, classes


def attach(pairs: DataFrame, source1: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs with both sides' prepared columns; pairs with a missing record drop out."""
    l = _normalized(source1).select(F.col("entity_id").alias("s1"), *prepared("l"))
    r = _normalized(targets).select(F.col("entity_id").alias("cand"), *prepared("r"))
    return pairs.join(l, "s1").join(r, "cand")


def feature_frame(pairs: DataFrame, source1: DataFrame, targets: DataFrame, sequence: bool = True) -> DataFrame:
    """source1_entity_id, candidate_entity_id and the features in contract order."""
    made = native_features() | (sequence_features() if sequence else {})
    names = [f for f in FEATURES if f in made]
    both = attach(pairs.select("s1", "cand"), source1, targets)
    return both.select(F.col("s1").alias("source1_entity_id"), F.col("cand").alias("candidate_entity_id"), *[made[f].alias(f) for f in names])


def class_frame(source1: DataFrame, targets: DataFrame, k: int, columns: dict[str, Column]) -> DataFrame:
    """(s1, cand, columns) of the first k candidates of whole numbered records.

    columns: expressions over prepared columns.  They are computed once for two texts, however
    many copies have them; the copies join at the end and need no other exchange.
    """
    texts = ("name_norm", "name_core", "address_norm")
    own, other = classes(source1, texts), classes(targets, texts)
    ranked = class_candidates(own, other, k).select("class", "other", "cand")
    l = source1.select(F.col("num").alias("class"), *prepared("l"))
    r = targets.select(F.col("num").alias("other"), *prepared("r"))
    both = ranked.select("class", "other").distinct().join(l, "class").join(r, "other")
    made = both.select("class", "other", *[c.alias(n) for n, c in columns.items()])
    return own.select("class", F.col("entity_id").alias("s1")).join(ranked.join(made, ["class", "other"]).drop("other"), "class").drop("class")
