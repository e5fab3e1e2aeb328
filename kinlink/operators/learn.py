"""The gradient-boosted pair matcher."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions.similarity import FEATURES

from .decide import MODEL_THRESHOLD, match_lists_by_score


def pair_labels(pairs: DataFrame, truth_pairs: DataFrame, left: str = "source1_entity_id", right: str = "candidate_entity_id") -> DataFrame:
    """pairs + label: 1 if truth holds the pair; truth_pairs: (s1, cand)."""
    t = truth_pairs.select(F.col("s1").alias(left), F.col("cand").alias(right)).distinct().withColumn("_hit", F.lit(1))
    return pairs.join(t, [left, right], "left").withColumn("label", F.coalesce("_hit", F.lit(0))).drop("_hit")


def _classifier(rounds: int, weighted: bool = False):
    """The contract's trees: the native library's estimator where it is installed, else Spark's."""
    try:
        from xgboost.spark import SparkXGBClassifier
    except ImportError:
        return GBTClassifier(**({"weightCol": "weight"} if weighted else {}), maxDepth=5, stepSize=0.08, subsamplingRate=0.8, featureSubsetStrategy="0.9", maxBins=64, maxIter=rounds, seed=42, labelCol="label")
    return SparkXGBClassifier(**({"weight_col": "weight"} if weighted else {}), features_col="features", label_col="label", max_depth=5, learning_rate=0.08, subsample=0.8, colsample_bytree=0.9, reg_lambda=2.0, max_bin=64, tree_method="hist", n_estimators=rounds, random_state=42)


class PairMatcher:
    """Boosted trees over the pair features; depth, rate and rounds follow the contract."""

    def __init__(self, threshold: float = MODEL_THRESHOLD, rounds: int = 120):
        self.threshold, self.rounds, self.model = threshold, rounds, None

    def _vectors(self, features: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features)

    def fit(self, labelled: DataFrame) -> PairMatcher:
        """labelled: a feature frame with label (0 or 1), and weight if a row stands for several pairs."""
        weights = [F.col("weight").cast("double").alias("weight")] if "weight" in labelled.columns else []
        self.model = _classifier(self.rounds, bool(weights)).fit(self._vectors(labelled).select("features", F.col("label").cast("double").alias("label"), *weights))
        return self

    def predict_proba(self, features: DataFrame) -> DataFrame:
        if self.model is None:
            raise RuntimeError("the matcher has not been fitted")
        return self.model.transform(self._vectors(features)).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")

    def matches(self, features: DataFrame) -> DataFrame:
        """(s1, cand, score) at or above the threshold."""
        p = self.predict_proba(features).where(F.col("score") >= self.threshold)
        return p.select(F.col("source1_entity_id").alias("s1"), F.col("candidate_entity_id").alias("cand"), "score")

    def predict_ids(self, features: DataFrame) -> DataFrame:
        """(s1, matches) by falling probability, then id."""
        return match_lists_by_score(self.matches(features))
