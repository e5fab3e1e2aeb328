"""Tab-separated sources: every cell a string, missing cells empty, never null."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# The source contract's column names.
SOURCE_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")


#: A line whose cells are whole: bare ones, or quoted ones that are closed before the line ends.
#: Possessive, so that the JVM matches cells of any length without recursion.
_WHOLE_CELL = r'(?:(?!")[^\t]*+|"[^"]*+(?:""[^"]*+)*+"[^\t"]*+)'
_WHOLE_LINE = rf"^{_WHOLE_CELL}(?:\t{_WHOLE_CELL})*+$"


def read_tsv(spark: SparkSession, path: str | list[str], multi_line: bool | None = None) -> DataFrame:
    """All columns by header name; quotes as in common CSV, ``NA`` stays text.

    multi_line: whether quoted cells hold line feeds, so that a file cannot be split and is
    one task; None looks once through all lines.
    """
    if multi_line is None:
        multi_line = not spark.read.text(path).where(~F.col("value").rlike(_WHOLE_LINE)).isEmpty()
    raw = spark.read.options(header=True, sep="\t", quote='"', escape='"', multiLine=multi_line, inferSchema=False).csv(path)
    return raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])


def violations(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row: nulls in required columns, repeated keys (the first column is the key)."""
    nulls = sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0))
    key = F.col(columns[0])
    return frame.agg(F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls"), (F.count(F.lit(1)) - F.count_distinct(key) - F.count_if(key.isNull())).alias("repeated"))


def validate_frame(frame: DataFrame, columns: tuple[str, ...], name: str) -> DataFrame:
    """The frame itself, or ValueError: missing columns, then nulls, then repeated keys."""
    missing = [c for c in columns if c not in frame.columns]
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}")
    bad = violations(frame, columns).first()
    if bad["nulls"]:
        raise ValueError(f"{name} has nulls in required columns")
    if bad["repeated"]:
        raise ValueError(f"{name} has repeated {columns[0]} values")
    return frame


def read_source(spark: SparkSession, path: str | list[str], chunksize: int | None = None) -> DataFrame | Iterator[list[Row]]:
    """A validated source; with chunksize an unvalidated iterator of row lists."""
    frame = read_tsv(spark, path)
    return _chunks(frame, chunksize) if chunksize else validate_frame(frame, SOURCE_COLUMNS, str(path))


def _chunks(frame: DataFrame, size: int) -> Iterator[list[Row]]:
    rows: list[Row] = []
    for row in frame.toLocalIterator(prefetchPartitions=True):
        rows.append(row)
        if len(rows) == size:
            yield rows
            rows = []
    if rows:
        yield rows


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return validate_frame(read_tsv(spark, path), TRUTH_COLUMNS, str(path))


def load_split(spark: SparkSession, directory: str, prefix: str) -> dict[str, DataFrame]:
    """The three sources of a split by name."""
    return {f"source{i}": read_source(spark, f"{directory}/{prefix}_source{i}.tsv") for i in (1, 2, 3)}


def union_split(frames: dict[str, DataFrame]) -> DataFrame:
    """One frame of all sources, with the source's name."""
    parts = [f.withColumn("source", F.lit(name)) for name, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed first cells below the header, blanks left out."""
    lines = spark.read.text(path, wholetext=False).withColumn("at", F.monotonically_increasing_id())
    first = F.regexp_replace(F.substring_index("value", "\t", 1), r"(?U)^\s+|\s+$", "")
    return lines.where("at > 0").select(first.alias("id")).where("id <> ''").distinct()


def load_match_targets(spark: SparkSession, test_dir: str, warnings: list[str]) -> DataFrame | None:
    """Ids of sources 2 and 3, or None with a warning if a file is missing."""
    paths = [f"{test_dir}/test_source{i}.tsv" for i in (2, 3)]
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        warnings.append(f"match targets are not checked: missing {', '.join(missing)}")
        return None
    return read_ids(spark, paths[0]).union(read_ids(spark, paths[1])).distinct()


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def source_profile(sources: DataFrame) -> DataFrame:
    """Rows, countries, and blank names and addresses of each source."""
    from kinlink.functions.text import blank

    return sources.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("country").alias("countries"),
        F.count_if(blank(F.col("business_name"))).alias("missing_names"), F.count_if(blank(F.col("business_address"))).alias("missing_addresses"))
