from pyspark.sql import functions as F

from kinlink.plans import audit
from kinlink.sources import tsv


def test_lines_end_as_editors_of_any_system_end_them(spark, tmp_path):
    for name, end in (("unix", "\n"), ("windows", "\r\n"), ("old", "\r")):
        path = tmp_path / name
        path.write_bytes(end.join(["source1_entity_id\tmatched_entity_ids", "S1-1\tS2-1,S2-2", "S1-2\t", ""]).encode())
        rows = audit.parse_lines(audit.read_lines(spark, str(path))).orderBy("line_no").collect()
        assert [(r["line_no"], r["s1"], r["ids"]) for r in rows if r["tab"]] == [(2, "S1-1", ["S2-1", "S2-2"]), (3, "S1-2", [])]


def test_a_valid_windows_file_is_accepted(spark, tmp_path):
    (tmp_path / "test_source1.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\ta\tb\tUS\n")
    for i in (2, 3):
        (tmp_path / f"test_source{i}.tsv").write_text(f"entity_id\tbusiness_name\tbusiness_address\tcountry\nS{i}-1\ta\tb\tUS\n")
    for name, column in (("matching_results.tsv", "matched_entity_ids"), ("candidate_pairs.tsv", "candidate_entity_ids")):
        (tmp_path / name).write_bytes(f"source1_entity_id\t{column}\r\nS1-1\tS2-1,S3-1\r\n".encode())
    report = audit.audit(spark, str(tmp_path / "matching_results.tsv"), str(tmp_path / "candidate_pairs.tsv"), str(tmp_path), check_ids=True)
    assert report.errors == [] and report.warnings == []


def test_only_files_with_line_feeds_in_cells_are_read_whole(spark, tmp_path):
    plain, quoted = tmp_path / "plain.tsv", tmp_path / "quoted.tsv"
    plain.write_text('a\tb\n"x\ty"\t5" pipe\n\nq""z\tNA\n"p""q"\t\n')
    quoted.write_text('a\tb\n"one\ntwo"\tz\n')
    for path, want in ((plain, [("x\ty", '5" pipe'), ('q""z', "NA"), ('p"q', "")]), (quoted, [("one\ntwo", "z")])):
        for multi in (None, True):
            assert sorted(tuple(r) for r in tsv.read_tsv(spark, str(path), multi).collect()) == sorted(want)
    whole = spark.read.text(str(plain)).where(~F.col("value").rlike(tsv._WHOLE_LINE)).count()
    assert whole == 0 and spark.read.text(str(quoted)).where(~F.col("value").rlike(tsv._WHOLE_LINE)).count() > 0
