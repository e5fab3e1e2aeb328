"""The weighted rule: score, gate, and ordered match lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.functions.similarity import native_features, sequence_ratio

from .features import attach

# The rule's weights and gate.
WEIGHTS = (("name_core_jaccard", 0.45), ("name_sequence", 0.25), ("address_jaccard", 0.20), ("address_sequence", 0.10))
GATE = 0.5
RULE_THRESHOLD, MODEL_THRESHOLD = 0.78, 0.85


def weighted_score(value=F.col) -> Column:
    """The four weighted terms, added from left to right in double arithmetic."""
    terms = [F.lit(w) * value(name) for name, w in WEIGHTS]
    return ((terms[0] + terms[1]) + terms[2]) + terms[3]


def score_without_sequence() -> Column:
    """The two terms that need no Python."""
    return F.lit(0.45) * F.col("name_core_jaccard") + F.lit(0.20) * F.col("address_jaccard")


def gate() -> Column:
    return (F.col("name_core_jaccard") >= GATE) | (F.col("address_jaccard") >= GATE)


def rule_matches(features: DataFrame, threshold: float = RULE_THRESHOLD) -> DataFrame:
    """(s1, cand, score) of a complete feature frame that the rule accepts."""
    f = features.withColumn("score", weighted_score()).where((F.col("score") >= threshold) & gate())
    return f.select(F.col("source1_entity_id").alias("s1"), F.col("candidate_entity_id").alias("cand"), "score")


def rule_matches_of_pairs(pairs: DataFrame, source1: DataFrame, targets: DataFrame, threshold: float = RULE_THRESHOLD) -> DataFrame:
    """The same result, Python only where the rule can still accept.

    A sequence ratio is at most 2 * shorter / (both lengths), so pairs whose bound fails
    leave before any UDF; equal text pairs are computed once.
    """
    native = native_features()
    both = attach(pairs.select("s1", "cand"), source1, targets)
    cap = lambda f: F.when((F.length(f"l_{f}_norm") + F.length(f"r_{f}_norm")) == 0, 1.0).otherwise(F.try_divide(2.0 * F.least(F.length(f"l_{f}_norm"), F.length(f"r_{f}_norm")), F.length(f"l_{f}_norm") + F.length(f"r_{f}_norm")))
    p = both.select("s1", "cand", *[F.col(f"{s}_{f}_norm") for s in "lr" for f in ("name", "address")], *[native[f].alias(f) for f in ("name_core_jaccard", "address_jaccard")])
    bound = F.lit(0.45) * F.col("name_core_jaccard") + F.lit(0.25) * cap("name") + F.lit(0.20) * F.col("address_jaccard") + F.lit(0.10) * cap("address")
    p = p.where(gate() & (bound >= threshold - 1e-9))
    texts = ["l_name_norm", "r_name_norm", "l_address_norm", "r_address_norm"]
    ratio = p.select(*texts).distinct().select(*texts, sequence_ratio(F.col("l_name_norm"), F.col("r_name_norm")).alias("name_sequence"), sequence_ratio(F.col("l_address_norm"), F.col("r_address_norm")).alias("address_sequence"))
    return p.join(ratio, texts).withColumn("score", weighted_score()).where(F.col("score") >= threshold).select("s1", "cand", "score")


def match_lists_by_score(matches: DataFrame) -> DataFrame:
    """(s1, matches) by falling score, then id."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("o"), "cand")))
    return matches.groupBy("s1").agg(F.transform(ordered, lambda x: x["cand"]).alias("matches"))
