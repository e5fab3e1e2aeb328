from kinlink.sources import store
from kinlink.streaming.arrivals import match_arrivals

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def test_micro_batches_match_against_the_index(spark, tmp_path):
    (tmp_path / "s2.tsv").write_text(HEAD + "S2-1\tAcme Corp\t1 Main St\tUS\n")
    index = store.build_index(spark, [str(tmp_path / "s2.tsv")], str(tmp_path / "ix"))
    rows = spark.createDataFrame([("S1-1", "ACME Corporation", "1 Main Street", "US"), ("S1-2", "Else", "x", "US")], "entity_id string, business_name string, business_address string, country string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    match_arrivals(stream, index, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert [(r["s1"], r["cand"]) for r in spark.read.parquet(str(tmp_path / "out/batch=0")).collect()] == [("S1-1", "S2-1")]
