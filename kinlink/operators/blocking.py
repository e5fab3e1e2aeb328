"""Candidate generation: overlaps of token sets, block against block, and the first k of each class of copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinlink.functions.text import add_normalized_columns, blocking_tokens, token_sets
from kinlink.sources.scratch import scratch_path
from kinlink.sources.store import ordered, with_numbers

from . import overlap

TOP_K_CLI, TOP_K_API = 60, 250
#: What blocking needs of a record.
NUMBERED = ("num", "entity_id", "country", "size", "bag")


def _normalized(records: DataFrame) -> DataFrame:
    return records if {"name_tokens", "address_tokens"} <= set(records.columns) else add_normalized_columns(records)


def query_tokens(source1: DataFrame) -> DataFrame:
    """(s1, country, token) of the records that look for candidates."""
    s = _normalized(source1)
    return s.select(F.col("entity_id").alias("s1"), "country", F.explode(blocking_tokens(F.col("name_tokens"), F.col("address_tokens"))).alias("token"))


def overlaps(source1: DataFrame, token_postings: DataFrame) -> DataFrame:
    """(s1, cand, overlap): shared tokens of pairs within a country.

    Counts are combined before their shuffle; a hot token's join partition is split by
    adaptive execution.  Records without tokens drop out of the inner join.
    """
    p = token_postings.select(F.col("entity_id").alias("cand"), "country", "token")
    return query_tokens(source1).join(p, ["country", "token"]).groupBy("s1", "cand").agg(F.count(F.lit(1)).alias("overlap"))


def top_candidates(pairs: DataFrame, k: int | None) -> DataFrame:
    """Rank 1..k by overlap, then id; None or a negative k keeps all."""
    order = Window.partitionBy("s1").orderBy(F.desc("overlap"), "cand")
    ranked = pairs.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked if k is None or k < 0 else ranked.where(F.col("rank") <= k)


def numbered(records: DataFrame, whole: bool = False) -> DataFrame:
    """Records with num, size and bag (their tokens), written once unless they are numbered already.

    whole: normalised records with all columns and tokens; else only what blocking needs.
    """
    if "num" in records.columns:
        return records
    spark = records.sparkSession
    if not whole and "name_tokens" not in records.columns:
        overlap.bound_batches(spark)
        path = scratch_path(spark, "bags")
        kind = "entity_id string, country string, size int, bag string"
        records.select("entity_id", "country", "business_name", "business_address").mapInArrow(token_sets, kind).write.option("compression", "zstd").parquet(path)
        made = ordered(spark.read.schema(kind).parquet(path))
    else:
        made = with_numbers(records)
        made = made if whole else _bags(made).select(*NUMBERED)
    path = scratch_path(spark, "numbered")
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _bags(records: DataFrame) -> DataFrame:
    """Numbered records with size and bag."""
    if "bag" in records.columns:
        return records
    return records.withColumns({"size": F.when(F.col("tokens").isNotNull(), F.size("tokens")), "bag": F.array_join(F.array_sort("tokens"), " ")})


def classes(records: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """(num, entity_id, country, class, n, many, size, bag) of numbered records that have tokens, written.

    A class has one country, one token set and equal columns ``key``; its number is that of its
    first record (n = 1), which stands for the ``many`` of them and alone has the tokens.
    """
    r = _bags(records).where("country is not null and size > 0").select("num", "entity_id", "country", "size", "bag", *[F.col(c).alias(f"_{c}") for c in key])
    own = Window.partitionBy("country", "bag", *[f"_{c}" for c in key])
    r = r.withColumns({"class": F.first("num").over(own.orderBy("num")), "n": F.row_number().over(own.orderBy("num")), "many": F.count(F.lit(1)).over(own).cast("int")})
    path = scratch_path(records.sparkSession, "classes")
    r.select("num", "entity_id", "country", "class", "n", "many", "size", F.when(F.col("n") == 1, F.col("bag")).alias("bag")).write.option("compression", "zstd").parquet(path)
    return records.sparkSession.read.parquet(path)


def class_candidates(own: DataFrame, other: DataFrame, k: int) -> DataFrame:
    """(class, rank, overlap, cand, other): the first k candidates of each class of ``own``, written.

    own, other: ``classes``.  Copies have the same candidates, so they are ranked once, and of a
    class of the other side no more than its first k records can be among them.
    """
    first = lambda d: d.where("n = 1").withColumn("many", F.least("many", F.lit(max(1, k))))
    best = overlap.best_overlaps(first(own), first(other), max(1, k))
    members = other.where(F.col("n") <= k).select(F.col("class").alias("b"), "num", F.col("entity_id").alias("cand"))
    item = F.struct((-F.col("overlap")).alias("o"), "num", "cand", "b")
    ranked = best.join(members, "b").groupBy("a").agg(F.slice(F.array_sort(F.collect_list(item)), 1, max(1, k)).alias("top"))
    out = ranked.select("a", F.posexplode("top").alias("i", "x"))
    out = out.select(F.col("a").alias("class"), (F.col("i") + 1).cast("long").alias("rank"), (-F.col("x.o")).alias("overlap"), F.col("x.cand").alias("cand"), F.col("x.b").alias("other"))
    path = scratch_path(own.sparkSession, "ranked")
    out.where(F.col("rank") <= k).write.option("compression", "zstd").parquet(path)
    return own.sparkSession.read.parquet(path)


def _alone(records: DataFrame) -> DataFrame:
    """Numbered records as rows of blocks, each a class of its own."""
    return _bags(records).where("country is not null and size > 0").select("num", "entity_id", "country", F.lit(1).alias("many"), "size", "bag")


def all_overlaps(source1: DataFrame, targets: DataFrame) -> DataFrame:
    """(s1, cand, overlap) of every pair that shares a token: as many rows as there are such pairs."""
    return overlap.every_overlap(_alone(numbered(source1)), _alone(numbered(targets)))


def candidates(source1: DataFrame, targets: DataFrame, k: int | None = TOP_K_API) -> DataFrame:
    """(s1, cand, overlap, rank) against target records.

    With a k, no pair leaves the task that counts it unless it may be among the first k of its
    class, and ranked classes get their records back at the end.
    """
    if k is None or k < 0:
        return top_candidates(all_overlaps(source1, targets), k)
    return class_pairs(numbered(source1), numbered(targets), k).select("s1", "cand", "overlap", "rank")


def class_pairs(source1: DataFrame, targets: DataFrame, k: int, key: tuple[str, ...] = ()) -> DataFrame:
    """(s1, cand, overlap, rank, class, other): the first k candidates of numbered records, with both sides' ``classes`` by ``key``."""
    own = classes(source1, key)
    ranked = class_candidates(own, classes(targets, key), k)
    return own.select("class", F.col("entity_id").alias("s1")).join(ranked, "class").select("s1", "cand", "overlap", "rank", "class", "other")


def candidate_map(source1: DataFrame, ranked: DataFrame) -> DataFrame:
    """(s1, candidates) for every record, ordered by rank, empty where there are none."""
    lists = ranked.groupBy("s1").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "cand"))), lambda x: x["cand"]).alias("candidates"))
    return source1.select(F.col("entity_id").alias("s1")).join(lists, "s1", "left").select("s1", F.coalesce("candidates", F.array().cast("array<string>")).alias("candidates"))


def recall_ceiling(truth: DataFrame, mapped: DataFrame, target_count: int | DataFrame) -> DataFrame:
    """One row: share of true pairs among the candidates, and how many pairs blocking avoids.

    truth: (source1_entity_id, ids); mapped: candidate_map. The pairs counted are those
    of truth records, the possible ones those of all mapped records.
    """
    t = truth.join(mapped, truth["source1_entity_id"] == mapped["s1"], "left")
    c = F.coalesce("candidates", F.array().cast("array<string>"))
    sums = t.select(F.size(F.array_intersect("ids", c)).alias("hit"), F.size(F.array_distinct("ids")).alias("total"), F.size(c).alias("pairs")).agg(
        F.coalesce(F.sum("hit"), F.lit(0)).alias("hit"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))
    spark = truth.sparkSession
    size = target_count.agg(F.count(F.lit(1)).alias("targets")) if isinstance(target_count, DataFrame) else spark.range(1).select(F.lit(target_count).alias("targets"))
    all_ = mapped.agg(F.count(F.lit(1)).alias("mapped"))
    # three single rows side by side
    one = lambda d: d.withColumn("_k", F.lit(1))
    r = one(sums).join(one(size), "_k").join(one(all_), "_k")
    possible = F.greatest(F.lit(1), F.col("mapped") * F.col("targets"))
    return r.select(F.when(F.col("total") == 0, 1.0).otherwise(F.try_divide(F.col("hit").cast("double"), F.col("total"))).alias("recall"), (1 - F.col("pairs") / possible).alias("reduction"))
