import random

import numpy as np

from kinlink.llm import components, minhash

SCHEMA = "doc_id long, text string"


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def shingles(text, n=5):
    w = words_of(text)
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(docs, percent):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = {d: d for d, _ in docs if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


def edited(rng, words, share):
    return " ".join(rng.choice("qwertz") * 3 + str(rng.random()) if rng.random() < share else w for w in words)


def corpus(seed):
    rng = random.Random(seed)
    docs = []
    for g in range(5):
        base = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(20, 260))]
        docs += [edited(rng, base, rng.choice([0, 0, 0.003, 0.01, 0.02, 0.05])) for _ in range(25)]
        docs += [" ".join(base[: int(len(base) * rng.uniform(0.8, 1))]) for _ in range(6)]
        docs += [" ".join(base) + " " + " ".join(f"x{rng.random()}" for _ in range(rng.randint(0, len(base) // 4))) for _ in range(6)]
    passage = " ".join(f"p{i}" for i in range(60))
    docs += [passage + " " + " ".join(f"y{rng.random()}" for _ in range(rng.randint(5, 80))) for _ in range(30)]
    docs += ["", "  \n", "one", "One", "one two three", "A  b\tc d e", "a b c d e", None]
    rng.shuffle(docs)
    return list(enumerate(docs)) + [(None, "a b c d e"), (None, None)]


def rows(out):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=str)


def test_components_equal_brute_force(spark):
    for seed, percent in ((1, 85), (2, 80)):
        docs = corpus(seed)
        out = minhash.near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(5), percent)
        assert rows(out) == brute(docs, percent)
        assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in out.collect())


def test_small_sets_link_with_partners_larger_than_a_sketch(spark):
    for percent, sizes in ((85, (55, 61, 62, 63, 64)), (80, (52, 61, 62, 63, 64))):
        docs = []
        for n in sizes:
            for m in range(65, 100 * n // percent + 1):
                for copy in range(3):
                    words = [f"w{n}x{m}x{copy}x{i}" for i in range(m + 4)]
                    docs += [(len(docs), " ".join(words[: n + 4])), (len(docs) + 1, " ".join(words))]
        out = minhash.near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(3), percent)
        assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {d: d - d % 2 for d, _ in docs}


def linked_pair(rng, percent):
    """Two random sets of hashes that link, as close to the threshold as their sizes allow."""
    n = rng.choice([rng.randint(1, 12), rng.randint(50, 90), rng.randint(100, 1500)])
    m = rng.randint(-(-percent * n // 100), 100 * n // percent)
    both = -(-percent * (n + m) // (100 + percent))
    pool = np.array(rng.sample(range(1 << 62), n + m - both), "u8")
    return np.sort(pool[:n]), np.sort(np.concatenate([pool[:both], pool[n:]])), both


def test_no_bound_loses_a_linked_pair():
    rng = random.Random(5)
    for percent in (50, 80, 85, 90, 100):
        for _ in range(400):
            x, y, both = linked_pair(rng, percent)
            assert 100 * both >= percent * (len(x) + len(y) - both)
            a, b = (z[: minhash.retained(np.array(len(z)), percent)] for z in (x, y))
            for z in (x, y):
                assert len(np.intersect1d(a, b)) >= minhash.common_least(-(-percent * np.array(len(z)) // 100), percent) >= 1
            assert minhash.may_link(a, b, len(x), len(y), percent)
    x = np.sort(np.array(rng.sample(range(1 << 62), 400), "u8"))
    assert not minhash.may_link(x[:200][::2], x[:200][1::2], 200, 200, 80)


def test_sets_around_the_old_sketch_size_lose_no_link(spark):
    for percent in (80, 85):
        docs = []
        for n in range(50, 65):
            for m in {51, 100 * n // percent, min(80, 100 * n // percent)}:
                if not percent * m <= 100 * n or m < n:
                    continue
                for copy in range(4):
                    words = [f"v{n}x{m}x{copy}x{i}" for i in range(m + 4)]
                    docs += [(len(docs), " ".join(words[: n + 4])), (len(docs) + 1, " ".join(words))]
        out = minhash.near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(3), percent)
        assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {d: d - d % 2 for d, _ in docs}


def test_blocks_and_buckets_do_not_change_components(spark, monkeypatch):
    docs = corpus(7)
    d = spark.createDataFrame(docs, SCHEMA).repartition(3)
    want = brute(docs, 80)
    monkeypatch.setattr(minhash, "BLOCK_VALUES", 300)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("3", "19"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = rows(minhash.near_duplicates(d, 80))
        spark.conf.set("spark.sql.shuffle.partitions", old)
        assert got == want


def test_repeated_rows_shared_ids_and_extra_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    d = spark.createDataFrame([(3, text, 1), (3, text, 2), (1, "other words are here now", 3), (3, "third text of the same id", 4)], "doc_id long, text string, n_shingles int")
    assert rows(minhash.near_duplicates(d)) == [(1, 1, 1), (3, 2, 3), (3, 26, 3), (3, 26, 3)]
    assert sorted(r["n_shingles"] for r in minhash.keep_first(d).collect())[0] in (1, 2, 3, 4)
    assert minhash.keep_first(d).columns == d.columns and minhash.keep_first(d).count() == 2


def test_empty_table(spark):
    d = spark.createDataFrame([], SCHEMA)
    assert minhash.near_duplicates(d).count() == 0 and minhash.keep_first(d).count() == 0


def test_union_sketch_is_exact_for_small_sets():
    x, y = np.arange(10, dtype="u8"), np.arange(5, 20, dtype="u8")
    assert minhash.union_sketch_estimate(x, y, 64) == 5 / 20


def test_long_chains_and_stars_have_one_root(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[100 + i] == 100 for i in range(1, 50))
