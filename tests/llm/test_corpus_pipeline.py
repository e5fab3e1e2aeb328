import shutil

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from kinlink.llm import decontaminate, minhash, pieces, quality, spans

DATA = "/root/testdata/sf0.001"


def test_five_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["quality rules", "minhash near-dedup", "substring dedup", "benchmark decontamination", "sentencepiece"]


def test_stages_do_what_their_operators_say(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels, bench = spark.read.parquet(f"{DATA}/labels.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    ids = lambda d: sorted(r["doc_id"] for r in d.select("doc_id").collect())
    steps = []
    d = docs
    for i, (_, f) in enumerate(cp.STAGES):
        f(spark, d, DATA).write.parquet(str(tmp_path / str(i)))
        steps.append(d)
        d = spark.read.parquet(str(tmp_path / str(i)))
    for s in steps[1:]:
        assert s.columns == docs.columns
    assert ids(steps[1]) == ids(quality.quality_rules(docs, labels).where("kept"))
    assert ids(steps[2]) == ids(minhash.near_duplicates(steps[1], 80).where("kept"))
    want = {r["doc_id"]: r["text"] for r in spans.dedup_spans(steps[2]).collect()}
    assert {r["doc_id"]: r["text"] for r in steps[3].collect()} == want and steps[3].where(F.length("text") != F.col("n_chars")).count() == 0
    leaked = {r["doc_id"] for r in decontaminate.find_leaks(steps[3], bench).collect()}
    assert ids(steps[4]) == sorted(set(ids(steps[3])) - leaked)
    assert ids(d) == ids(steps[4]) and d.where("not round_trip").count() == 0
    assert {r["doc_id"]: r["ids_sha256"] for r in d.collect()} == {r["doc_id"]: r["ids_sha256"] for r in pieces.encode(steps[4], pieces.default_model(), ids=False).collect()}
    assert ids(cp.run(spark, DATA)) == ids(d)


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_tables(spark, tmp_path, kind):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    text = docs.where("n_chars > 1500").first()["text"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, _id int, gone string, n_removed long"
    rows = [(1, text, None, None, None, "k", 1, "g", 5), (1, text, None, None, None, "k", 1, "g", 5), (None, text, None, "s", 0, None, None, None, None), (2, None, None, None, None, None, None, None, None), (3, "", "l", "s", 0, "k", 2, "g", 0)]
    (tmp_path / "in").mkdir()
    for t in ("labels", "benchmark"):
        shutil.copy(f"{DATA}/{t}.parquet", tmp_path / "in" / f"{t}.parquet")
    spark.createDataFrame(rows if kind == "odd" else [], schema).write.parquet(str(tmp_path / "in/documents.parquet"))
    got = cp.run(spark, str(tmp_path / "in")).collect()
    assert sorted(map(str, (r["doc_id"] for r in got))) == (["1", "None"] if kind == "odd" else [])
