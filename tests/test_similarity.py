import math
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from kinlink.functions import similarity as sim


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def lev_ratio(a, b):
    return 1.0 if a == b else 0.0 if not a or not b else 1 - levenshtein(a, b) / max(len(a), len(b))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def grams(t):
    return {t[i : i + 3] for i in range(len(t) - 2)}


def cosine(a, b):
    return 1.0 if not a and not b else 0.0 if not a or not b else len(a & b) / math.sqrt(len(a) * len(b))


def tfidf(a, b):
    if not a and not b:
        return 1.0
    w = {t: math.log(3 / (1 + (t in a) + (t in b))) + 1 for t in {*a, *b}}
    x, y = ({t: s.count(t) * w[t] for t in set(s)} for s in (a, b))
    n = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return sum(x[t] * y.get(t, 0) for t in x) / n if n else 0.0


@pytest.fixture(scope="module")
def pairs():
    random.seed(2)
    words = ["ab", "abc", "main", "street", "a", "limited", "x1"]
    return [(" ".join(random.choices(words, k=random.randint(0, 5))), " ".join(random.choices(words, k=random.randint(0, 5)))) for _ in range(600)] + [("", ""), ("ab", "cd"), ("ab", "abc")]


def test_native_kernels_match_their_definitions(spark, pairs):
    d = spark.createDataFrame(pairs, "l string, r string")
    tok = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    d = d.withColumn("lt", tok("l")).withColumn("rt", tok("r"))
    lt, rt = F.col("lt"), F.col("rt")
    rows = d.select("l", "r", sim.jaccard(lt, rt).alias("j"), sim.levenshtein_ratio(F.col("l"), F.col("r")).alias("v"), sim.levenshtein_ratio(sim.sorted_text(lt), sim.sorted_text(rt)).alias("so"),
                    sim.levenshtein_ratio(sim.sorted_set_text(lt), sim.sorted_set_text(rt)).alias("se"), sim.set_cosine(sim.trigrams(F.col("l")), sim.trigrams(F.col("r"))).alias("c"), sim.tfidf_cosine(lt, rt).alias("t")).collect()
    for r in rows:
        a, b = r["l"].split(), r["r"].split()
        want = (jaccard({*a}, {*b}), lev_ratio(r["l"], r["r"]), lev_ratio(" ".join(sorted(a)), " ".join(sorted(b))), lev_ratio(" ".join(sorted({*a})), " ".join(sorted({*b}))), cosine(grams(r["l"]), grams(r["r"])), tfidf(a, b))
        assert all(abs(x - y) < 1e-9 for x, y in zip(want, (r["j"], r["v"], r["so"], r["se"], r["c"], r["t"]), strict=True)), (r, want)


def test_sequence_ratio_is_the_standard_librarys(spark, pairs):
    more = [*pairs, ("tide", "diet"), ("diet", "tide"), ("x y " * 60, "x z " * 55)]
    rows = spark.createDataFrame(more, "l string, r string").select("l", "r", sim.sequence_ratio(F.col("l"), F.col("r")).alias("s")).collect()
    for r in rows:
        assert r["s"] == pytest.approx(SequenceMatcher(None, r["l"], r["r"]).ratio())


def test_feature_order_has_eighteen_names():
    assert len(sim.FEATURES) == len(set(sim.FEATURES)) == 18
    assert set(sim.native_features()) | set(sim.SEQUENCE) == set(sim.FEATURES)
