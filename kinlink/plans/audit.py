"""Audit of result files: line relation -> violations -> a short report.

Lines stay distributed; only counts and five examples a rule reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinlink.sources.sink import CANDIDATES, MATCHES
from kinlink.sources.tsv import exists, load_match_targets, read_ids

EXAMPLES = 5
#: Rules in report order: (kind, what the report says).
RULES = [
    ("repeated_row", "the same source-1 id stands on several rows"),
    ("repeated_id", "an id is repeated inside a list"),
    ("self_match", "lists hold source-1 ids"),
    ("wrong_prefix", "ids have neither prefix S2- nor S3-"),
    ("unknown_id", "ids are not in the test sources 2 and 3"),
    ("missing_row", "required source-1 ids have no row"),
    ("extra_row", "rows use source-1 ids that are not required"),
]


@dataclass
class Report:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def exit_code(self) -> int:
        return 1 if self.errors else 0


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no from 1, line); a line ends with a line feed, a carriage return or both.

    Numbers come from each partition's size, not from one task.
    """
    raw = spark.read.text(path).select(F.monotonically_increasing_id().alias("_m"), F.col("value").alias("line"))
    raw = raw.select(F.shiftright("_m", 33).alias("_p"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("_r"), "line")
    sizes = raw.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # one row a partition
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return raw.join(before, "_p").select((F.col("_r") + F.col("_b") + 1).alias("line_no"), "line")


def parse_lines(lines: DataFrame) -> DataFrame:
    """(line_no, s1, tab, ids): the id is cut at the first tab and not trimmed; ids are not trimmed either."""
    tab = F.instr("line", "\t") > 0
    rest = F.expr("substring(line, instr(line, '\t') + 1)")
    blank = F.regexp_replace(rest, r"(?U)\s+", "") == ""
    ids = F.when(tab & ~blank, F.split(rest, ",")).otherwise(F.array().cast("array<string>"))
    return lines.where("line_no > 1").select("line_no", F.when(tab, F.substring_index("line", "\t", 1)).otherwise(F.col("line")).alias("s1"), tab.alias("tab"), ids.alias("ids"))


def violations(rows: DataFrame, required: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """Distinct (kind, offender) of parsed rows; required and valid: (id)."""
    rows = rows.where("tab")
    kind = lambda d, k, c: d.select(F.lit(k).alias("kind"), F.col(c).alias("offender"))
    each = rows.select("s1", F.explode("ids").alias("id"))
    known = F.col("id").startswith("S2-") | F.col("id").startswith("S3-")
    parts = [
        kind(rows.groupBy("s1").count().where("count > 1"), "repeated_row", "s1"),
        kind(rows.where(F.size("ids") != F.size(F.array_distinct("ids"))), "repeated_id", "s1"),
        kind(each.where(F.col("id").startswith("S1-")), "self_match", "id"),
        kind(each.where(~known & ~F.col("id").startswith("S1-")), "wrong_prefix", "id"),
        kind(required.join(rows.select(F.col("s1").alias("id")), "id", "left_anti"), "missing_row", "id"),
        kind(rows.select(F.col("s1").alias("id")).join(required, "id", "left_anti"), "extra_row", "id"),
    ]
    if valid is not None:
        parts.append(kind(each.where(known).join(valid, "id", "left_anti"), "unknown_id", "id"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def summary(found: DataFrame) -> DataFrame:
    """(kind, total, examples): the first offenders in order, never all of them in one row."""
    order = Window.partitionBy("kind").orderBy("offender")
    first = found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= EXAMPLES).groupBy("kind").agg(F.array_sort(F.collect_list("offender")).alias("examples"))
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("total")).join(first, "kind")


def row_counts(rows: DataFrame) -> DataFrame:
    return rows.where("tab").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size("ids") == 0).alias("empties"), F.count_if(F.size("ids") > 0).alias("non_empty"))


def lists_by_row(rows: DataFrame) -> DataFrame:
    """(s1, ids): the last row of an id wins."""
    return rows.where("tab").groupBy("s1").agg(F.max_by("ids", "line_no").alias("ids"))


def outside_candidates(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1) with a matched id that is not among its candidates."""
    m = matched.select("s1", F.explode("ids").alias("id"))
    c = candidates.select("s1", F.explode("ids").alias("id"))
    return m.join(c, ["s1", "id"], "left_anti").select("s1").distinct()


def _shown(total: int, some: list[str]) -> str:
    return f"{total} total, e.g. {', '.join(some)}, ..." if total > len(some) else ", ".join(some)


def audit_file(spark: SparkSession, path: str, expected: list[str], required: DataFrame, valid: DataFrame | None, report: Report) -> DataFrame | None:
    """Check one file; its parsed rows, or None if it cannot be parsed."""
    name = path.rstrip("/").rpartition("/")[2]
    if not exists(spark, path):
        report.errors.append(f"{path}: no such file")
        return None
    lines = read_lines(spark, path)
    if not lines.where(~F.is_valid_utf8("line")).isEmpty():
        report.errors.append(f"{name}: not valid UTF-8")
        return None
    head = lines.where("line_no = 1").first()
    if head is None:
        report.errors.append(f"{name}: empty file")
        return None
    if "\t" not in head["line"] and "," in head["line"]:
        report.errors.append(f"{name}: the header has commas and no tab; the file must be tab-separated")
        return None
    cells = [c.strip().lower() for c in head["line"].split("\t")]
    if cells != expected:
        report.errors.append(f"{name}: header {cells} instead of {expected}")
        return None
    rows = parse_lines(lines)
    for r in rows.where(~F.col("tab") & ~F.col("s1").rlike(r"(?U)^\s*$")).orderBy("line_no").limit(EXAMPLES).collect():
        report.errors.append(f"{name}: no tab in line {r['line_no']}: {r['s1'].rstrip()!r}")
    found = {r["kind"]: r for r in summary(violations(rows, required, valid)).collect()}
    for kind, what in RULES:
        if kind in found:
            report.errors.append(f"{name}: {what}: {_shown(found[kind]['total'], found[kind]['examples'])}")
    n = row_counts(rows).first()
    report.counts[name] = (n["n_rows"], n["empties"])
    return rows


def audit(spark: SparkSession, matching: str, candidate: str | None, test_dir: str, check_ids: bool = False) -> Report:
    """Check both result files against the test sources."""
    report = Report()
    source1 = f"{test_dir}/test_source1.tsv"
    if not exists(spark, source1):
        report.errors.append(f"{source1}: no such file")
        return report
    required = read_ids(spark, source1)
    valid = load_match_targets(spark, test_dir, report.warnings) if check_ids else None
    if not check_ids:
        report.warnings.append("ids are not looked up in the test sources")
    matched = audit_file(spark, matching, ["source1_entity_id", MATCHES[1]], required, valid, report)
    proposed = None
    if candidate and exists(spark, candidate):
        proposed = audit_file(spark, candidate, ["source1_entity_id", CANDIDATES[1]], required, valid, report)
    elif candidate:
        report.warnings.append(f"{candidate}: no such file, not checked")
    if matched is not None and proposed is not None:
        out = outside_candidates(lists_by_row(matched), lists_by_row(proposed))
        some = [r["s1"] for r in out.orderBy("s1").limit(EXAMPLES).collect()]
        if some:
            report.warnings.append(f"matches outside the candidates: {_shown(out.count(), some)}")
    return report
