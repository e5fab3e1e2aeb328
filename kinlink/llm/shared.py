"""Shared storage and materialised tables for the training-data operators.

Intermediate tables and archives go to the folder the cluster names in
``spark.checkpoint.dir``; executors and the driver all see it.  Only where that
setting is empty (unit tests, local mode) is a folder of our own chosen.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = "file://" + tempfile.mkdtemp(prefix="kinlink-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Bytes of an Arrow batch at most; a longer row is a batch of its own.
ARROW_BYTES = 8 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in bytes: texts differ in length by orders of magnitude,
    and a Python worker and its executor both hold the batches under way."""
    size = str(spark.conf.get(_ARROW_BYTES, "64m")).rstrip("b")
    if not size.isdigit() or not 0 < int(size) <= ARROW_BYTES:
        spark.conf.set(_ARROW_BYTES, str(ARROW_BYTES))


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_root(spark)}/kinlink/{label}-{uuid.uuid4().hex}"
    for paths in _recorders.get(threading.get_ident(), []):
        paths.append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps re-read the
    table instead of recomputing it, and a lost executor costs one task only."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kinlink_path = path
    return out


_recorders: dict[int, list[list[str]]] = {}


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that ``shared_path`` gives out to this thread meanwhile."""
    paths: list[str] = []
    own = _recorders.setdefault(threading.get_ident(), [])
    own.append(paths)
    try:
        yield paths
    finally:
        own[:] = [x for x in own if x is not paths]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables and archives that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables; only for those that no returned frame depends on."""
    for t in tables:
        remove(t.sparkSession, [t._kinlink_path])


def set_aside(docs: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
    """doc_id, text and every other column under a name of ours, so that none can clash.

    Also returns (our name, own name) of the others, in order.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    names = [(f"_other{i}", c) for i, c in enumerate(others)]
    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for n, c in names]), names
