import pytest
from pyspark.sql import functions as F

from kinlink.functions.text import add_normalized_columns
from kinlink.operators import blocking, decide, holdout, learn, metrics
from kinlink.operators.features import feature_frame
from kinlink.plans.pipeline import truth_map

COLUMNS = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def sides(spark):
    s1 = spark.createDataFrame([("S1-1", "Acme Corp", "1 Main St", "US"), ("S1-2", "", "", "US"), ("S1-3", "Other Ltd", "9 Far Rd", "DE")], COLUMNS)
    s2 = spark.createDataFrame([("S2-1", "ACME Corporation", "1 Main Street", "US"), ("S2-2", "Acme", "Else", "US"), ("S2-3", "Other Limited", "9 Far Road", "FR"), ("S3-1", "Other Limited", "9 Far Road", "DE"), ("S3-2", "Acme Main", "x", "US")], COLUMNS)
    return add_normalized_columns(s1), add_normalized_columns(s2)


def test_candidates_count_tokens_within_a_country_and_break_ties_by_id(sides):
    rows = [tuple(r) for r in blocking.candidates(*sides).orderBy("s1", "rank").collect()]
    assert rows == [("S1-1", "S2-1", 4, 1), ("S1-1", "S3-2", 2, 2), ("S1-1", "S2-2", 1, 3), ("S1-3", "S3-1", 4, 1)]
    assert blocking.candidates(*sides, k=1).count() == 2
    assert blocking.candidates(*sides, k=0).count() == 0
    assert blocking.candidates(*sides, k=-1).count() == 4


def _shuffled(spark):
    """Rows written to shuffles by all stages so far."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_pairs_of_hot_tokens_are_not_shuffled(spark):
    """1000 records look for candidates among 2000; all share some words."""
    make = lambda n, s: spark.range(n).select(F.concat(F.lit(f"S{s}-"), F.format_string("%04d", "id")).alias("entity_id"), F.lit("north south east west").alias("business_name"), F.concat(F.lit("own"), F.col("id") % 500).alias("business_address"), F.lit("US").alias("country"))
    before = _shuffled(spark)
    rows = blocking.candidates(make(1000, 1), make(2000, 2), 5).collect()
    assert _shuffled(spark) - before < 50_000
    got = {}
    for r in rows:
        got.setdefault(r["s1"], []).append((r["rank"], r["cand"], r["overlap"]))
    assert len(got) == 1000
    for s1, found in got.items():
        i = int(s1[3:]) % 500
        same = [i + 500 * j for j in range(4)]
        others = [c for c in range(5) if c not in same][:1]
        assert [c for _, c, _ in sorted(found)] == [f"S2-{c:04d}" for c in same + others] and [o for *_, o in sorted(found)] == [5, 5, 5, 5, 4]


@pytest.mark.parametrize("k", [1, 3, 250, None])
def test_blocks_count_and_rank_as_all_pairs_do(spark, monkeypatch, k):
    """Small blocks, copies, ties, rare and frequent words against plain sets."""
    import random

    from kinlink.operators import overlap

    monkeypatch.setattr(overlap, "LEFT_RECORDS", 7)
    monkeypatch.setattr(overlap, "RIGHT_RECORDS", 11)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.sample(words[: rng.choice((4, 12, 60))], rng.randint(0, 4))) for _ in range(40)]
    made = lambda s, n: [(f"S{s}-{i}", rng.choice(texts), rng.choice(texts), rng.choice(("US", "DE", None))) for i in range(n)]
    one, two = made(1, 60), made(2, 90)
    bag = lambda r: {w for w in f"{r[1]} {r[2]}".split() if len(w) > 1}
    want = set()
    for a in one:
        found = sorted((-len(bag(a) & bag(b)), b[0]) for b in two if a[3] and a[3] == b[3] and bag(a) & bag(b))
        want |= {(a[0], c, -o, i + 1) for i, (o, c) in enumerate(found[:k])}
    got = [tuple(r) for r in blocking.candidates(spark.createDataFrame(one, COLUMNS), spark.createDataFrame(two, COLUMNS), k).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_all_pairs_leave_python_as_arrays(spark, monkeypatch):
    """Records that share most words (up to 699), others that share one with one record, or nothing; dense pairs are no rows of Python's."""
    from kinlink.operators import overlap

    seen, real = spark.sparkContext.accumulator(0), overlap._all_of

    def counted(batches):
        for b in real(batches):
            seen.add(b.num_rows)
            yield b

    monkeypatch.setattr(overlap, "_all_of", counted)
    text = lambda n: " ".join(f"w{x}" for x in range(n))
    one = [(f"S1-{i}", text(i * 7 % 700), "", "US") for i in range(200)] + [(f"S1-x{i}", f"only{i}", "", "DE") for i in range(100)]
    two = [(f"S2-{j}", text(j * 13 % 700), "", "US") for j in range(300)] + [(f"S2-x{j}", f"only{j} else", "", "DE") for j in range(50, 120)]
    want = {(f"S1-{i}", f"S2-{j}", min(i * 7 % 700, j * 13 % 700)) for i in range(200) for j in range(300) if i * 7 % 700 and j * 13 % 700}
    want |= {(f"S1-x{i}", f"S2-x{i}", 1) for i in range(50, 100)}
    found = blocking.all_overlaps(spark.createDataFrame(one, COLUMNS), spark.createDataFrame(two, COLUMNS))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want
    assert seen.value < len(want) / 20
    assert found.dtypes == [("s1", "string"), ("cand", "string"), ("overlap", "bigint")]


def test_every_record_is_in_the_candidate_map(sides):
    got = {r["s1"]: r["candidates"] for r in blocking.candidate_map(sides[0], blocking.candidates(*sides)).collect()}
    assert got == {"S1-1": ["S2-1", "S3-2", "S2-2"], "S1-2": [], "S1-3": ["S3-1"]}


def test_rule_shortcut_equals_the_full_feature_frame(sides):
    pairs = blocking.candidates(*sides)
    full = {(r["s1"], r["cand"], round(r["score"], 9)) for r in decide.rule_matches(feature_frame(pairs, *sides)).collect()}
    fast = {(r["s1"], r["cand"], round(r["score"], 9)) for r in decide.rule_matches_of_pairs(pairs, *sides).collect()}
    assert full == fast and {(a, b) for a, b, _ in fast} == {("S1-1", "S2-1"), ("S1-3", "S3-1")}


def test_pairs_with_a_missing_record_drop_out(spark, sides):
    assert feature_frame(spark.createDataFrame([("S1-1", "S2-9"), ("S1-9", "S2-1")], "s1 string, cand string"), *sides).count() == 0


def test_f05(spark):
    truth = spark.createDataFrame([("a", ["x", "y"]), ("b", []), ("c", []), ("d", ["x"]), ("e", ["x"])], "source1_entity_id string, ids array<string>")
    said = spark.createDataFrame([("a", ["x", "y", "z"]), ("c", ["x"]), ("e", ["q"]), ("other", ["x"])], "s1 string, matches array<string>")
    got = {r["source1_entity_id"]: round(r["f05"], 6) for r in metrics.entity_scores(truth, said).collect()}
    assert got == {"a": 0.714286, "b": 1.0, "c": 0.0, "d": 0.0, "e": 0.0}
    assert metrics.macro_f05(truth, said).first()[0] == pytest.approx(sum(got.values()) / 5, abs=1e-6)
    assert metrics.macro_f05(truth.limit(0), said).first()[0] == 0.0


def test_recall_ceiling(spark, sides):
    mapped = blocking.candidate_map(sides[0], blocking.candidates(*sides))
    truth = truth_map(spark.createDataFrame([("S1-1", "S2-1,S2-9"), ("S1-3", "")], "source1_entity_id string, matched_entity_ids string"))
    r = blocking.recall_ceiling(truth, mapped, 5).first()
    assert r["recall"] == 0.5 and r["reduction"] == pytest.approx(1 - 4 / 15)
    assert blocking.recall_ceiling(truth.limit(0), mapped, sides[1]).first()["recall"] == 1.0


def test_split_is_disjoint_complete_and_repeatable(spark):
    s1 = spark.range(101).select(F.concat(F.lit("S1-"), "id").alias("entity_id"))
    truth = s1.select(F.col("entity_id").alias("source1_entity_id"), F.lit("").alias("matched_entity_ids"))
    a, b, ta, tb = holdout.split_by_source1(s1, truth)
    ids = lambda d, c="entity_id": {r[0] for r in d.select(c).collect()}
    assert len(ids(a)) == int(101 * 0.8) and ids(a) | ids(b) == ids(s1) and not ids(a) & ids(b)
    assert ids(ta, "source1_entity_id") == ids(a) and ids(tb, "source1_entity_id") == ids(b)
    assert ids(holdout.split_by_source1(s1.repartition(7), truth)[0]) == ids(a)
    assert holdout.split_by_source1(s1.limit(10), truth, 0.9)[0].count() == int(10 * (1.0 - 0.9))
    assert ids(holdout.sample_n(s1, 7, 42)) == ids(holdout.sample_n(s1.repartition(3), 7, 42))


def test_matcher_learns_and_refuses_before(spark, sides):
    pairs = blocking.candidates(*sides)
    f = feature_frame(pairs, *sides)
    with pytest.raises(RuntimeError):
        learn.PairMatcher().predict_proba(f)
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-3", "S3-1")], "s1 string, cand string")
    labelled = learn.pair_labels(f, truth)
    m = learn.PairMatcher(0.5, rounds=5).fit(labelled.union(labelled).union(labelled))
    got = {r["s1"]: r["matches"] for r in m.predict_ids(f).collect()}
    assert got == {"S1-1": ["S2-1"], "S1-3": ["S3-1"]}
    assert m.predict_ids(f.limit(0)).count() == 0


def test_the_registered_matcher_has_all_rounds(monkeypatch):
    from kinlink.plans import queries

    class Frame:
        def __getattr__(self, name):
            return lambda *a, **b: self

        read = write = property(lambda self: self)

    rounds = []
    monkeypatch.setattr(learn.PairMatcher, "fit", lambda self, labelled: rounds.append(self.rounds) or self)
    monkeypatch.setattr(learn.PairMatcher, "matches", lambda self, labelled: labelled)
    monkeypatch.setattr(learn, "pair_labels", lambda *a: Frame())
    for name in ("scratch_path", "feature_frame"):
        monkeypatch.setattr(queries, name, lambda *a: Frame())
    monkeypatch.setattr(queries, "_part_pairs", lambda *a: (Frame(), Frame(), Frame()))
    monkeypatch.setattr(queries.adapters, "part_truth", lambda *a: Frame())
    queries.QUERIES["gbt_matches"](Frame(), "")
    assert rounds == [120]


def test_ordered_lists(spark):
    d = spark.createDataFrame([("a", "z", 0.9), ("a", "b", 0.8), ("a", "a", 0.8)], "s1 string, cand string, score double")
    assert decide.match_lists_by_score(d).first()["matches"] == ["z", "a", "b"]


def test_trees_find_held_out_matches(spark):
    """Fitted on some parts, the matcher finds the true pairs of the others and little else."""
    from kinlink.plans import queries

    sf = queries._Place("/root/testdata/sf0.01")
    labelled = learn.pair_labels(feature_frame(*queries._part_pairs(spark, sf)), queries.adapters.part_truth(spark, sf)).cache()
    fifth = "cast(conv(substring(md5(concat('42:', source1_entity_id)), 1, 4), 16, 10) as int) % 5"
    found = learn.PairMatcher(decide.RULE_THRESHOLD, rounds=25).fit(labelled.where(f"{fifth} <> 0")).matches(labelled.where(f"{fifth} = 0"))
    got, want = ({(r["s1"], r["cand"]) for r in d.select("s1", "cand").collect()} for d in (found, labelled.where(f"{fifth} = 0 and label = 1").select(F.col("source1_entity_id").alias("s1"), F.col("candidate_entity_id").alias("cand"))))
    assert want and got == want


@pytest.mark.parametrize("name", ["blocking_topk_ties", "country_match", "feature_frame_sql", "feature_frame"])
def test_copies_of_parts_are_compared_once(spark, tmp_path, name):
    """1500 parts of 10 texts: rows equal the SQL's, and far fewer rows than pairs are shuffled."""
    import duckdb

    from kinlink.plans import queries

    sf = str(tmp_path)
    spark.range(1500).selectExpr("id as p_partkey", "concat('Acme Corp ', id % 5, ' bolt') as p_name", "concat('Brand#', id % 2) as p_brand", "if(id % 5 = 0, 'LARGE', 'SMALL') as p_type", "cast(7 as int) as p_size").write.parquet(f"{sf}/part.parquet")
    before = _shuffled(spark)
    df = queries.QUERIES[name](spark, sf)
    own = [tuple(r) for r in df.select(*sorted(df.columns)).collect()]
    assert _shuffled(spark) - before < 20_000 < len(own)
    con = duckdb.connect()
    con.execute(f"create view part as select * from '{sf}/part.parquet/*.parquet'")
    r = con.execute(queries.ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(own) == sorted(tuple(x[names.index(c)] for c in sorted(names)) for x in r.fetchall())


def test_trees_see_each_pair_of_texts_once(spark, tmp_path, monkeypatch):
    """1500 parts of 10 texts: rows are as many as text pairs, weights as training pairs; all held-out true pairs return."""
    from kinlink.plans import queries

    sf = str(tmp_path)
    spark.range(1500).selectExpr("id as p_partkey", "concat('Acme Corp ', id % 5, ' bolt') as p_name", "concat('Brand#', id % 2) as p_brand", "if(id % 5 = 0, 'LARGE', 'SMALL') as p_type", "cast(7 as int) as p_size").write.parquet(f"{sf}/part.parquet")
    made, fit = learn._classifier, learn.PairMatcher.fit
    seen = []
    monkeypatch.setattr(learn, "_classifier", lambda rounds, *a: made(5, *a))
    monkeypatch.setattr(learn.PairMatcher, "fit", lambda self, labelled: seen.append(labelled) or fit(self, labelled))
    got = {(r["s1"], r["cand"]) for r in queries.QUERIES["gbt_matches"](spark, sf).collect()}
    fifth = "cast(conv(substring(md5(concat('42:', s1)), 1, 4), 16, 10) as int) % 5"
    pairs = queries.QUERIES["blocking_topk_ties"](spark, sf).select("s1", "cand").cache()
    true = pairs.join(queries.adapters.part_truth(spark, sf), ["s1", "cand"])
    assert seen[0].count() <= 100
    assert seen[0].selectExpr("sum(weight)").first()[0] == pairs.where(f"{fifth} <> 0").count() > 20_000
    assert seen[0].selectExpr("sum(weight * label)").first()[0] == true.where(f"{fifth} <> 0").count()
    want = {(r["s1"], r["cand"]) for r in true.where(f"{fifth} = 0").collect()}
    assert want and got == want


def test_both_sides_are_numbered_at_once(spark, tmp_path, monkeypatch):
    """One pass reads the parts and makes their token sets, not one a side."""
    from kinlink.plans import queries

    spark.range(30).selectExpr("id as p_partkey", "concat('bolt ', id % 5) as p_name", "'Brand#1' as p_brand", "'LARGE' as p_type", "cast(7 as int) as p_size").write.parquet(f"{tmp_path}/part.parquet")
    written, path = [], blocking.scratch_path
    monkeypatch.setattr(blocking, "scratch_path", lambda s, label: written.append(label) or path(s, label))
    assert queries.QUERIES["blocking_topk_ties"](spark, str(tmp_path)).count() == 200
    assert [written.count(x) for x in ("bags", "numbered")] == [1, 1]
