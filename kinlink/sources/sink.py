"""Result files: one row per requested record, sorted unique ids, no quoting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tsv import delete, exists

# File names and headers of the result contract.
MATCHES = ("matching_results.tsv", "matched_entity_ids")
CANDIDATES = ("candidate_pairs.tsv", "candidate_entity_ids")


def id_lists(requested: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """(source1_entity_id, comma list) for every requested id; pairs: (s1, cand)."""
    lists = pairs.groupBy("s1").agg(F.array_join(F.array_sort(F.collect_set("cand")), ",").alias("_ids"))
    joined = requested.join(lists, requested["source1_entity_id"] == lists["s1"], "left")
    return joined.select(*requested.columns, F.coalesce("_ids", F.lit("")).alias(column))


def match_lists(requested: DataFrame, candidates: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predicted ids as far as they are candidates."""
    return id_lists(requested, predictions.join(candidates.select("s1", "cand"), ["s1", "cand"], "left_semi"), MATCHES[1])


def _append(spark: SparkSession, lines: DataFrame, header: str, path: str) -> None:
    """Write lines as one file; an existing file's lines come first, header once."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    parts = path + ".parts"
    delete(spark, parts)
    lines.write.option("compression", "none").text(parts)
    old = path + ".old"
    if exists(spark, path):
        fs.rename(target, jvm.org.apache.hadoop.fs.Path(old))
    out = fs.create(target, True)
    copy = jvm.org.apache.hadoop.io.IOUtils.copyBytes
    if exists(spark, old):
        src = fs.open(jvm.org.apache.hadoop.fs.Path(old))
        copy(src, out, conf, False)
        src.close()
    else:
        out.write(bytearray(header.encode()))
    names = sorted(s.getPath().toString() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(parts)) if s.getPath().getName().startswith("part-"))
    for n in names:
        src = fs.open(jvm.org.apache.hadoop.fs.Path(n))
        copy(src, out, conf, False)
        src.close()
    out.close()
    delete(spark, parts)
    delete(spark, old)


def write_results(requested: DataFrame, candidates: DataFrame, predictions: DataFrame, output_dir: str, append: bool = False) -> None:
    """Both result files, rows in the order of ``requested`` (source1_entity_id, position).

    Without ids, candidates and predictions both files are removed and none is written.
    """
    spark = requested.sparkSession
    paths = {name: f"{output_dir}/{name}" for name, _ in (CANDIDATES, MATCHES)}
    if requested.isEmpty() and candidates.isEmpty() and predictions.isEmpty():
        for p in paths.values():
            delete(spark, p)
        return
    if "position" not in requested.columns:
        requested = requested.withColumn("position", F.monotonically_increasing_id())
    if not append:
        for p in paths.values():
            delete(spark, p)
    for (name, column), frame in ((CANDIDATES, id_lists(requested, candidates, CANDIDATES[1])), (MATCHES, match_lists(requested, candidates, predictions))):
        lines = frame.orderBy("position").select(F.concat_ws("\t", "source1_entity_id", column).alias("value"))
        _append(spark, lines, f"source1_entity_id\t{column}\n", paths[name])


def reset_outputs(spark: SparkSession, output_dir: str) -> None:
    for name, _ in (CANDIDATES, MATCHES):
        delete(spark, f"{output_dir}/{name}")
