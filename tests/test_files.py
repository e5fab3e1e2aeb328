import os

import pytest

from kinlink.plans.audit import audit
from kinlink.plans.pipeline import Options, run
from kinlink.sources import sink, store, tsv

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def put(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, **({} if "b" in mode else {"encoding": "utf-8"})) as f:
        f.write(text)
    return str(path)


def test_tsv_quirks(spark, tmp_path):
    p = put(f"{tmp_path}/a.tsv", HEAD + 'S1-1\t"A\tB"\tq""z\tUS\n\nS1-2\t5" pipe\tNA\t\nS1-3\t"p""q"\t\tDE\n')
    rows = {r["entity_id"]: tuple(r)[1:] for r in tsv.read_source(spark, p).collect()}
    assert rows == {"S1-1": ("A\tB", 'q""z', "US"), "S1-2": ('5" pipe', "NA", ""), "S1-3": ('p"q', "", "DE")}
    assert [len(c) for c in tsv.read_source(spark, p, chunksize=2)] == [2, 1]


def test_long_quoted_cells(spark, tmp_path):
    long = 'a""b ' * 50_000
    p = put(f"{tmp_path}/a.tsv", HEAD + f'S1-1\t"{long}"\tx\tUS\nS1-2\t"y\nz"\tNA\tDE\n')
    rows = {r["entity_id"]: tuple(r)[1:] for r in tsv.read_source(spark, p).collect()}
    assert rows == {"S1-1": (long.replace('""', '"'), "x", "US"), "S1-2": ("y\nz", "NA", "DE")}


def test_validation_order(spark, tmp_path):
    d = spark.createDataFrame([("a", None), ("a", "x")], "k string, v string")
    with pytest.raises(ValueError, match="lacks"):
        tsv.validate_frame(d, ("k", "w"), "t")
    with pytest.raises(ValueError, match="nulls"):
        tsv.validate_frame(d, ("k", "v"), "t")
    with pytest.raises(ValueError, match="repeated"):
        tsv.validate_frame(d.fillna("x"), ("k", "v"), "t")
    assert tsv.validate_frame(d.fillna("x").limit(1), ("k", "v"), "t").count() == 1


def _sink(spark, folder, ids, candidates, matches, **more):
    r = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "source1_entity_id string, position long")
    pairs = lambda x: spark.createDataFrame([(a, b) for a, bs in x.items() for b in bs], "s1 string, cand string")
    sink.write_results(r, pairs(candidates), pairs(matches), str(folder), **more)


def test_sink_writes_nothing_for_nothing_and_removes_old_files(spark, tmp_path):
    put(f"{tmp_path}/matching_results.tsv", "old\n")
    _sink(spark, tmp_path, [], {}, {}, append=True)
    assert not [f for f in os.listdir(tmp_path) if not f.startswith(".")]


def test_sink_rows(spark, tmp_path):
    _sink(spark, tmp_path, ["S1-1", "S1-2"], {"S1-1": ["S2-12", "S2-10"], "S1-2": ["S3-20"]}, {"S1-1": ["S2-10", "S9-9"]})
    assert open(f"{tmp_path}/candidate_pairs.tsv").read() == "source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-10,S2-12\nS1-2\tS3-20\n"
    assert open(f"{tmp_path}/matching_results.tsv").read() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-10\nS1-2\t\n"
    _sink(spark, tmp_path, ["S1-3"], {}, {}, append=True)
    assert open(f"{tmp_path}/matching_results.tsv").read().endswith("S1-2\t\nS1-3\t\n")


def test_index_is_built_once_upserts_and_notices_new_inputs(spark, tmp_path):
    a = put(f"{tmp_path}/s2.tsv", HEAD + "S2-1\tOld Name\tRoad\tUS\nS2-2\tBee\tRoad\tUS\n")
    b = put(f"{tmp_path}/s3.tsv", HEAD + "S2-1\tNew Name\tRoad\tUS\n")
    one = store.build_index(spark, [a, b], f"{tmp_path}/ix")
    assert {r["entity_id"]: r["business_name"] for r in one.records.collect()} == {"S2-1": "New Name", "S2-2": "Bee"}
    assert {r["token"] for r in one.postings.where("entity_id = 'S2-1'").collect()} == {"new", "name", "road"}
    assert store.build_index(spark, [a, b], f"{tmp_path}/ix").folder == one.folder
    put(b, HEAD + "S2-1\tNewest\tRoad\tUSA\n")
    assert store.build_index(spark, [a, b], f"{tmp_path}/ix").folder != one.folder


def _audit(spark, folder, matching, candidate=None, source=HEAD + "S1-1\ta\tb\tc\nS1-2\ta\tb\tc\n", **more):
    put(f"{folder}/test/test_source1.tsv", source)
    m = put(f"{folder}/m.tsv", matching, "wb" if isinstance(matching, bytes) else "w")
    c = put(f"{folder}/c.tsv", candidate) if candidate else f"{folder}/none.tsv"
    return audit(spark, m, c, f"{folder}/test", **more)


M = "source1_entity_id\tmatched_entity_ids\n"


def test_audit_accepts_a_good_file(spark, tmp_path):
    r = _audit(spark, tmp_path, M + "S1-1\tS2-1,S3-2\nS1-2\t\n", "Source1_Entity_ID\tcandidate_entity_ids\nS1-1\tS2-1\nS1-2\t\n")
    assert r.errors == [] and r.exit_code == 0 and r.counts["m.tsv"] == (2, 1)
    assert any("outside the candidates: S1-1" in w for w in r.warnings)


@pytest.mark.parametrize(("text", "said"), [
    ("", "empty file"), ("source1_entity_id,matched_entity_ids\n", "commas"), ("a\tb\n", "header"), (M + "S1-1\tS2-1,,S2-2\nS1-2\t\n", "neither prefix"), (M + "S1-1\tS1-2\nS1-2\t\n", "source-1 ids"),
    (M + "S1-1\t\nS1-1\t\nS1-2\t\n", "several rows: S1-1"), (M + "S1-1\tS2-1,S2-1\nS1-2\t\n", "repeated inside a list: S1-1"), (M + "S1-1\t\n", "no row: S1-2"), (M + "S1-1\t\nS1-2\t\nS1-9\t\n", "not required: S1-9"),
    (M + "S1-1\t\nloose\nS1-2\t\n", "no tab in line 3: 'loose'"), (M.encode() + b"S1-1\t\xff\xfe\nS1-2\t\n", "UTF-8"),
])
def test_audit_rejects(spark, tmp_path, text, said):
    r = _audit(spark, tmp_path, text)
    assert r.exit_code == 1 and any(said in e for e in r.errors), r.errors


def test_audit_shows_five_offenders_and_checks_ids_if_asked(spark, tmp_path):
    r = _audit(spark, tmp_path, M + "S1-1\t\nS1-2\t\n" + "".join(f"S1-x{i}\t\n" for i in range(7)))
    assert any("7 total, e.g. S1-x0, S1-x1, S1-x2, S1-x3, S1-x4, ..." in e for e in r.errors)
    for i in (2, 3):
        put(f"{tmp_path}/test/test_source{i}.tsv", HEAD + f"S{i}-1\ta\tb\tc\n")
    assert any("S2-7" in e for e in _audit(spark, tmp_path, M + "S1-1\tS2-1,S2-7\nS1-2\t\n", check_ids=True).errors)
    os.remove(f"{tmp_path}/test/test_source3.tsv")
    assert not _audit(spark, tmp_path, M + "S1-1\tS2-1,S2-7\nS1-2\t\n", check_ids=True).errors


def test_missing_test_source_stops(spark, tmp_path):
    assert audit(spark, "m", None, str(tmp_path)).errors


@pytest.mark.parametrize("mode", ["baseline", "trees"])
def test_whole_run(spark, tmp_path, mode):
    names = ["red fox", "blue owl", "green ant", "grey bee", "pink cow", "gold emu", "teal elk", "lime hen", "navy cod", "rust koi"]
    for split in ("train", "test"):
        for i in (1, 2, 3):
            put(f"{tmp_path}/{split}/{split}_source{i}.tsv", HEAD + "".join(f"S{i}-{n}\t{x} co\t{n} main st\tUS\n" for n, x in enumerate(names)))
    put(f"{tmp_path}/train/train_ground_truth.tsv", "source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{n}\tS2-{n},S3-{n}\n" for n in range(10)))
    score, report = run(spark, Options(str(tmp_path), f"{tmp_path}/out", f"{tmp_path}/work", mode, rounds=5))
    assert score == 1.0 and report.errors == []
    assert "S1-3\tS2-3,S3-3\n" in open(f"{tmp_path}/out/matching_results.tsv").read()
