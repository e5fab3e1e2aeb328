"""The linkage run: index, holdout, training or rule, validation, inference, audit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.text import add_normalized_columns, parse_ids
from kinlink.operators.blocking import TOP_K_CLI, candidates
from kinlink.operators.decide import RULE_THRESHOLD, match_lists_by_score, rule_matches_of_pairs
from kinlink.operators.features import feature_frame
from kinlink.operators.holdout import sample_n, split_by_source1
from kinlink.operators.learn import PairMatcher, pair_labels
from kinlink.operators.metrics import macro_f05
from kinlink.sources.sink import reset_outputs, write_results
from kinlink.sources.store import RecordIndex, build_index
from kinlink.sources.tsv import read_ground_truth, read_source

from .audit import Report, audit


@dataclass
class Options:
    data_dir: str = "dataset"
    output_dir: str = "output"
    work_dir: str = "work"
    mode: str = "baseline"
    max_candidates: int = TOP_K_CLI
    validation_entities: int = 1000
    training_entities: int = 4000
    threshold: float = RULE_THRESHOLD
    rounds: int = 120


def truth_map(truth: DataFrame) -> DataFrame:
    """(source1_entity_id, ids)."""
    return truth.select("source1_entity_id", parse_ids(F.col("matched_entity_ids")).alias("ids"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth_map(truth).select(F.col("source1_entity_id").alias("s1"), F.explode("ids").alias("cand"))


def make_candidates(source1: DataFrame, index: RecordIndex, k: int) -> DataFrame:
    return candidates(source1, index.records, k)


def write_table(frame: DataFrame, path: str) -> DataFrame:
    """Candidates feed features and two sinks: written once, read by all of them."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.parquet(path)


def decide(pairs: DataFrame, source1: DataFrame, index: RecordIndex, options: Options, matcher: PairMatcher | None) -> DataFrame:
    """(s1, cand, score) by the fitted matcher or the rule."""
    if matcher is None:
        return rule_matches_of_pairs(pairs, source1, index.records, options.threshold)
    return matcher.matches(feature_frame(pairs, source1, index.records))


def run(spark: SparkSession, options: Options) -> tuple[float, Report]:
    """The whole run: validation score and audit report."""
    train, test = f"{options.data_dir}/train", f"{options.data_dir}/test"
    s1, truth = read_source(spark, f"{train}/train_source1.tsv"), read_ground_truth(spark, f"{train}/train_ground_truth.tsv")
    test_s1 = read_source(spark, f"{test}/test_source1.tsv")
    train_index = build_index(spark, [f"{train}/train_source{i}.tsv" for i in (2, 3)], f"{options.work_dir}/train_index")
    test_index = build_index(spark, [f"{test}/test_source{i}.tsv" for i in (2, 3)], f"{options.work_dir}/test_index")
    fit_s1, valid_s1, _, valid_truth = split_by_source1(s1, truth)
    valid_s1 = sample_n(valid_s1, options.validation_entities, 42)
    expected = valid_s1.select(F.col("entity_id").alias("source1_entity_id")).join(truth_map(valid_truth), "source1_entity_id", "left")
    expected = expected.select("source1_entity_id", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))
    matcher = None
    if options.mode != "baseline":
        chosen = add_normalized_columns(sample_n(fit_s1, options.training_entities, 41))
        pairs = write_table(make_candidates(chosen, train_index, options.max_candidates), f"{options.work_dir}/training_pairs")
        labelled = pair_labels(feature_frame(pairs, chosen, train_index.records), truth_pairs(truth))
        matcher = PairMatcher(options.threshold, options.rounds).fit(write_table(labelled, f"{options.work_dir}/training_features"))
    valid = add_normalized_columns(valid_s1)
    pairs = write_table(make_candidates(valid, train_index, options.max_candidates), f"{options.work_dir}/validation_pairs")
    score = macro_f05(expected, match_lists_by_score(decide(pairs, valid, train_index, options, matcher))).first()["macro_f05"]
    reset_outputs(spark, options.output_dir)
    records = add_normalized_columns(test_s1)
    pairs = write_table(make_candidates(records, test_index, options.max_candidates), f"{options.work_dir}/test_pairs")
    found = write_table(decide(pairs, records, test_index, options, matcher), f"{options.work_dir}/test_matches")
    requested = test_s1.select(F.col("entity_id").alias("source1_entity_id"), F.monotonically_increasing_id().alias("position"))
    write_results(requested, pairs, found, options.output_dir)
    report = audit(spark, f"{options.output_dir}/matching_results.tsv", f"{options.output_dir}/candidate_pairs.tsv", test)
    return score, report
