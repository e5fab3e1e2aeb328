import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinlink.llm import kernel as K
from kinlink.llm import pieces, quality, toxicity
from kinlink.llm.labelled import isotonic
from tests.llm.test_near_duplicates import words_of

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def base_of(text):
    text = text or ""
    w = [x for x in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(words_of(line)) and line in seen
        seen.add(line)
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    cover = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover)


def test_base_statistics_equal_brute_force():
    rng = random.Random(1)
    texts = ["", None, " \n\n", "a", "a\na\n a\n\na", "x\r\nx\r\n", "é" * 9, "one two three one two three", "#*$%&|<>"] + ["".join(rng.choice("ab#é \n\t") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    data, off = K.buffers(pa.array(texts, pa.string()))
    s, e, first = K.words(data, off)
    got = quality.base_statistics(data, off, s, e, first, K.Prefix(data))
    for i, t in enumerate(texts):
        assert tuple(int(got[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base_of(t), repr(t)


def test_quality_learns_junk_and_keeps_clean_text(spark):
    d, l = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    out = quality.quality_rules(d, l).join(l, "doc_id").where("not base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in out.groupBy("quality", "kept").count().collect()}
    right = n.get((1, True), 0) + n.get((0, False), 0)
    assert right >= 0.97 * sum(n.values()) and n.get((1, False), 0) <= 0.01 * n.get((1, True), 1)


def test_quality_without_labels_and_with_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    d = spark.createDataFrame([(1, long, "a"), (1, long, "b"), (None, long, "c"), (2, None, "d"), (3, "", "e"), (4, "a b c " * 40, "f")], SCHEMA + ", probability string")
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    kept = quality.keep_good(d, none)
    assert kept.columns == d.columns and sorted(r["probability"] for r in kept.collect()) == ["a", "b", "c"]
    assert quality.keep_good(d.limit(0), none).count() == 0


def test_toxicity_on_held_out_rows(spark):
    out = toxicity.op4_toxicity(spark, "/root/testdata/sf0.1").where("held_out").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.01 * n[0, 0]


def test_toxicity_sees_text_only_and_takes_odd_rows(spark):
    d, l = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = toxicity.fit(toxicity.labelled_sample(d, l, "toxic", toxicity.FIT_ROWS, ~toxicity.in_held_out()))
    odd = spark.createDataFrame([(1, "you idiot moron trash", "x"), (2, "you idiot moron trash", "y"), (None, None, "z"), (3, "", "z")], SCHEMA + ", score string")
    got = [(r["doc_id"], r["score"]) for r in toxicity.score(odd, model).collect()]
    assert got[0][1] == got[1][1] and got[2][1] == got[3][1] and all(0 <= s <= 1 for _, s in got)
    assert toxicity.score(odd.limit(0), model).count() == 0
    flat = toxicity.fit(toxicity.labelled_sample(d, l.limit(0), "toxic", 10))
    assert len({r["score"] for r in toxicity.score(odd, flat).collect()}) == 1
    held = toxicity.in_held_out()
    import zlib

    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in spark.range(50).select("id", held_id(held).alias("h")).collect())


def held_id(_):
    return toxicity.in_held_out("id")


def test_isotonic_rises_and_follows_rates():
    x, y = isotonic(np.array([0.0, 1, 2, 3, 3]), np.array([0.0, 1, 0, 1, 1]))
    assert (np.diff(y) >= 0).all() and y[0] < 0.5 < y[-1]


@pytest.fixture(scope="module")
def model():
    return pieces.default_model().prepare()


def best_paths(m, text, n):
    t = (" " + text).encode() if text else b""
    cut = [i for i, b in enumerate(t) if b & 0xC0 != 0x80] + [len(t)]
    best = [[(0.0, ())]] + [[] for _ in cut[1:]]
    for p in range(1, len(cut)):
        found = []
        for k in range(1, min(p, m.longest) + 1):
            part = t[cut[p - k] : cut[p]]
            i = m.lookup.get(part, -1)
            if i >= 0 or k == 1:
                s, ids = (m.scores[i], (i,)) if i >= 0 else (m.unk, tuple(int(m.byte_ids[b]) for b in part))
                found += [(f + s, path + ids) for f, path in best[p - k]]
        best[p] = sorted(found, key=lambda x: -x[0])[:n]
    return best[-1]


def test_n_best_equals_brute_force_and_decodes(model):
    rng = random.Random(2)
    texts = ["", None, "a", "  a  b\nc\td ﬁ ™ é", "▁▁ x", "\n\n", "日本語 \U0001f600", " "] + ["".join(rng.choice("abcé \nth") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    data, off = K.buffers(pa.array(texts, pa.string()))
    x = pieces.encode_chunk(model, data, off, 4)
    again, at = pieces.decode(model, x.ids, x.first)
    assert again.tobytes() == data.tobytes() and at.tolist() == off.tolist()
    for i, t in enumerate(texts):
        want = best_paths(model, t or "", 4)
        assert np.allclose([f for f, _ in x.nbest[i]], [f for f, _ in want]), t
        ids = tuple(x.ids[x.first[i] : x.first[i + 1]].tolist())
        total = [f for f, p in want if p == ids]
        assert total and abs(total[0] - want[0][0]) < 1e-6


def test_every_segmentation_is_delivered(spark, model):
    import hashlib

    texts = ["hello world", "a b", "", "  a  b\nc\td ﬁ", "some longer words stand here, twice: some longer words", "abab" * 10]
    d = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    digest = lambda ids: hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
    short = {r["doc_id"]: r["nbest_sha256"] for r in pieces.encode(d, pieces.default_model(), ids=False).collect()}
    for r in pieces.encode(d, pieces.default_model()).collect():
        text, n = texts[r["doc_id"]], len(r["nbest_scores"])
        want = best_paths(model, text, n + 20)
        got = []
        for changes in r["nbest_changes"]:
            ids = list(r["ids"])
            for c in reversed(changes):
                ids[c["at"] : c["at"] + c["gone"]] = c["new"]
            got.append(tuple(ids))
        assert n == len(got) == len(set(got)) == min(len(want), pieces.N_BEST) and got[0] == tuple(r["ids"])
        by = dict((p, f) for f, p in want)
        assert np.allclose([by[g] for g in got], r["nbest_scores"])
        assert [digest(g) for g in got] == r["nbest_sha256"] == short[r["doc_id"]] and r["nbest_sha256"][0] == r["ids_sha256"]
        again, _ = pieces.decode(model, np.concatenate([np.array(g, np.int64) for g in got]), np.concatenate([[0], np.cumsum([len(g) for g in got])]))
        assert again.tobytes().decode() == text * n


def test_encoding_rows(spark, model):
    d = spark.createDataFrame([(1, "hello world", "x"), (1, "hello world", "y"), (None, None, "z"), (2, "w" * 3000, "q")], SCHEMA + ", ids string")
    rows = pieces.encode(d, pieces.default_model()).collect()
    assert all(r["round_trip"] for r in rows) and rows[0]["ids"] == rows[1]["ids"] and rows[2]["ids"] == [] and rows[2]["nbest_scores"] == [0.0]
    assert pieces.encode(d.limit(0), pieces.default_model()).count() == 0


def test_labels_rows_are_bounded(spark):
    d = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    l = d.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    assert toxicity.labelled_sample(d, l.union(l), "toxic", 9).count() == 9


def test_calibration_of_separable_scores_stays_finite_and_separates():
    from kinlink.llm.labelled import platt, sigmoid

    for n0, n1, gap in ((10, 790, 5.0), (400, 400, 60.0), (3, 5, 0.1)):
        rng = np.random.default_rng(n0)
        score = np.concatenate([rng.normal(-gap, 1e-2, n0), rng.normal(gap, 1e-2, n1)]) * 3 + 1000
        a, b = platt(score, np.repeat([0.0, 1.0], [n0, n1]))
        p = sigmoid(a * score + b)
        assert np.isfinite([a, b]).all() and p[:n0].max() < 0.5 < p[n0:].min()
    a, b = platt(np.array([1.0, 2, 3, 4]), np.array([1.0, 1, 0, 0]))  # a falling score carries no slope
    assert a == 0 and abs(sigmoid(b) - 0.5) < 0.01


def test_quality_drops_junk_of_all_documents(spark):
    d, l = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    junk = F.expr("regexp_count(text, '[#*$%&]{3}') > 5 or regexp_count(text, '!!') > 5 or regexp_count(text, ' \\\\| ') > 5")
    out = quality.quality_rules(d, l).join(d.select("doc_id", junk.alias("junk")), "doc_id").where("not base_failed")
    n = {(r["junk"], r["kept"]): r["count"] for r in out.groupBy("junk", "kept").count().collect()}
    assert n.get((True, True), 0) <= 0.01 * n[True, False] and n.get((False, False), 0) <= 0.005 * n[False, True]


def test_tied_segmentations_equal_brute_force(model):
    texts = ["-" * n for n in (1, 2, 7, 33, 64)] + ["=" * 40, " " * 50, "ab" * 30, "-=" * 25, "----  ----" * 3]
    data, off = K.buffers(pa.array(texts, pa.string()))
    x = pieces.encode_chunk(model, data, off, 4)
    for i, t in enumerate(texts):
        want = best_paths(model, t, 40)
        assert np.allclose([f for f, _ in x.nbest[i]], [f for f, _ in want[:4]]), t
        paths = [tuple(x.segmentation(i, k).tolist()) for k in range(len(x.nbest[i]))]
        assert len(set(paths)) == len(paths)


def test_long_units_are_walked_like_short_ones(model, monkeypatch):
    rng = random.Random(12)
    texts = ["".join(rng.choice("abcdé-日") for _ in range(n)) for n in (1, 3, 20, 90)] + ["x" * 70, "-" * 50, "a b " * 20]
    data, off = K.buffers(pa.array(texts, pa.string()))
    short = pieces.encode_chunk(model, data, off, 4)
    monkeypatch.setattr(pieces, "LONG", 2)
    alone = pieces.encode_chunk(model, data, off, 4)
    assert short.ids.tolist() == alone.ids.tolist() and short.score.tolist() == alone.score.tolist() and short.nbest == alone.nbest


def test_long_runs_and_texts_without_spaces_end_in_time(model):
    import time

    rng = random.Random(13)
    texts = ["-" * 1007, "-" * 20_000, "=" * 20_000, " " * 20_000, "".join(rng.choice("abcdefghé日") for _ in range(200_000))]
    data, off = K.buffers(pa.array(texts, pa.string()))
    began = time.monotonic()
    x = pieces.encode_chunk(model, data, off, 4)
    assert time.monotonic() - began < 30
    again, at = pieces.decode(model, x.ids, x.first)
    assert again.tobytes() == data.tobytes() and at.tolist() == off.tolist() and all(len(b) == 4 for b in x.nbest)


def polynomial(data):
    """The kernel's hash of some bytes, in Python integers."""
    return sum(int(K.CODES[b]) * pow(int(K.BASE), i, 1 << 64) for i, b in enumerate(data)) % (1 << 64)


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 % (1 << 64)
    x ^= x >> 27
    x = x * 0x94D049BB133111EB % (1 << 64)
    return x ^ x >> 31


def probability_of(text, model):
    """The quality model's probability by counting n-grams one by one."""
    import math

    data, top, bits = (text or "").encode(), 64 - quality.BITS, quality.BITS
    h = [polynomial(w.encode()) for w in (text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    word = [mixed(x) >> top for x in h] + [mixed((mixed(a) * int(K.BASE) + mixed(b)) % (1 << 64)) >> top for a, b in zip(h, h[1:], strict=False)]
    char = [(1 << bits) + ((int.from_bytes(data[i : i + 4], "little") * 0x9E3779B1 % (1 << 32)) >> (32 - bits)) for i in range(len(data) - 3)]
    z = sum(sum(model.weights[b] for b in part) / max(1, len(part)) for part in (word, char))
    return 1 / (1 + math.exp(-(model.slope * (z + model.bias) + model.shift)))


def test_quality_verdicts_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    model = quality.QualityModel(rng.normal(0, 9, 2 << quality.BITS), 0.2, 1.5, -0.3)
    r = random.Random(3)
    texts = [" ".join("".join(r.choice("abcdeé#") for _ in range(r.randint(1, 6))) for _ in range(r.randint(0, 90))) for _ in range(60)] + ["", None, "one", "abc", "same words again " * 30, "x " * 3000]
    got = {x["doc_id"]: x for x in quality.judge(quality.score(spark.createDataFrame(list(enumerate(texts)), SCHEMA), model)).collect()}
    for i, t in enumerate(texts):
        p, (n, _, _, _, repeat) = probability_of(t, model), base_of(t)
        assert abs(got[i]["probability"] - p) < 1e-9
        assert got[i]["base_failed"] == (n < 50 or 100 * repeat > 50 * n) and got[i]["kept"] == (not got[i]["base_failed"] and p >= quality.KEEP_AT)
    assert {x["kept"] for x in got.values()} == {True, False}


def dense_features(text):
    """Features that need no learned lexicon, word by word."""
    import math
    import re

    text = text or ""
    words = re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", text)
    low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    n, size = max(1, len(words)), max(1, len(text.encode()))
    hits = [i for i, w in enumerate(low) if w in toxicity.INSULTS]
    you = [i for i, w in enumerate(low) if w in toxicity.SECOND_PERSON]
    return {"seed": len(hits) / n, "second": len(you) / n, "near_second": sum(any(abs(i - j) <= toxicity.NEAR for j in you) for i in hits) / n, "capitals": sum("A" <= c <= "Z" for c in text) / size,
            "all_caps": sum(len(w.encode()) > 1 and all("A" <= c <= "Z" for c in w) for w in words) / n, "punct": sum(c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in text) / size, "exclaim": text.count("!") / size, "log_words": math.log1p(len(words))}


def test_toxicity_features_and_trees_equal_brute_force():
    r = random.Random(5)
    pool = ["you", "idiot", "YOU", "scum", "hello", "Ü", "IT", "x1", "fool!", "kill...", "dich", "a", "--", "\n"]
    texts = [" ".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(120)] + ["", None, "idiot", "é" * 50, "you " * 5000 + "idiot"]
    data, off = K.buffers(pa.array(texts, pa.string()))
    x = toxicity.features(data, off, np.zeros(0, "u8"))
    for i, t in enumerate(texts):
        for name, value in dense_features(t).items():
            assert abs(x[i, toxicity.FEATURES.index(name)] - value) < 1e-12, (name, t)
    y = np.array([float("idiot" in (t or "") and "you" in (t or "").lower()) for t in texts])
    trees = toxicity.Trees(rounds=12).fit(x, y)
    for i in range(len(texts)):
        z = trees.start
        for feat, cut, leaf in trees.splits:
            node = 0
            for level in range(trees.depth):
                at = (1 << level) - 1 + node
                right = sum(c <= x[i, feat[at]] for c in trees.cuts[feat[at]]) > cut[at]
                node = 2 * node + right
            z += leaf[node]
        assert abs(z - trees.margin(x)[i]) < 1e-9
    assert trees.margin(x)[y == 1].min() > trees.margin(x)[y == 0].mean()
