from kinlink.plans import cli


def test_audit_command_reports_and_exits(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "_session", lambda: spark)
    assert cli.main(["audit", "--test-dir", str(tmp_path)]) == 1
    assert "rejected" in capsys.readouterr().out
    (tmp_path / "test_source1.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\ta\tb\tc\n")
    good = tmp_path / "m.tsv"
    good.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS3-4\n")
    assert cli.main(["audit", "--matching", str(good), "--candidate", str(tmp_path / "none.tsv"), "--test-dir", str(tmp_path)]) == 0
    said = capsys.readouterr().out
    assert "m.tsv: 1 rows, 0 empty, 1 with ids" in said and "accepted" in said


def test_defaults_follow_the_contract():
    a = cli._parser().parse_args(["run"])
    assert (a.mode, a.max_candidates, a.validation_entities, a.training_entities, a.batch_size, a.index_chunk_size, a.threshold) == ("baseline", 60, 1000, 4000, 250, 10_000, 0.78)
