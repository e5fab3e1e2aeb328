"""Source-1 records as a stream: every micro-batch is matched against the static index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinlink.operators.blocking import TOP_K_CLI, candidates, numbered
from kinlink.operators.decide import RULE_THRESHOLD, rule_matches_of_pairs
from kinlink.sources.store import RecordIndex


def match_arrivals(arrivals: DataFrame, index: RecordIndex, out: str, checkpoint: str, k: int = TOP_K_CLI, threshold: float = RULE_THRESHOLD) -> StreamingQuery:
    """Write (s1, cand, score, batch_id) of each micro-batch to ``out``; a repeated batch overwrites its own folder."""

    def match(batch: DataFrame, batch_id: int) -> None:
        records = numbered(batch, whole=True)
        pairs = candidates(records, index.records, k)
        found = rule_matches_of_pairs(pairs, records, index.records, threshold)
        found.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return arrivals.writeStream.foreachBatch(match).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
