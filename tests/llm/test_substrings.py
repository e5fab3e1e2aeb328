import hashlib
import random

import numpy as np

from kinlink.llm import spans, suffixes

SCHEMA = "doc_id long, text string"


def brute(docs):
    rank = lambda d: (1 << 63) - 1 if d is None else d
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            first[w] = min(first.get(w, rank(d)), rank(d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < rank(d):
                gone[i : i + 50] = [True] * 50
        out.append((d, len(b), sum(gone), sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abc") for _ in range(rng.randint(45, 120))) for _ in range(6)]
    piece = lambda: rng.choice([rng.choice(pool)[rng.randint(0, 20) : rng.randint(30, 120)], "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 60)))])
    docs = [(d, "".join(piece() for _ in range(rng.randint(0, 6)))) for d in range(120)]
    docs += [(300, None), (301, ""), (302, "a" * 500), (303, "a" * 200), (304, "ab" * 150), (305, "xab" * 100 + "ab" * 60), (306, "x" * 49), (307, "x" * 50), (308, "x" * 50), (None, "a" * 90), (5, pool[0]), (5, pool[0])]
    rng.shuffle(docs)
    return docs


def test_bytes_removed_equal_brute_force(spark):
    docs = corpus(3)
    out = suffixes.dedup_substrings(spark.createDataFrame(docs, SCHEMA).repartition(4))
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(docs)


def test_texts_that_repeat_a_few_bytes(spark):
    units = ("a", "ab", "abc", "- ", "x" * 30 + "y")
    docs = [(i, (u * 400)[:n] + end) for i, (u, n, end) in enumerate((u, n, end) for u in units for n, end in ((300, ""), (290, "b"), (120, "q"), (300, "")))]
    got = sorted((tuple(r) for r in suffixes.dedup_substrings(spark.createDataFrame(docs, SCHEMA)).collect()), key=str)
    assert got == brute(docs)


def test_spans_and_empty_table(spark):
    d = spark.createDataFrame([(1, "q" * 60), (2, "zz" + "q" * 55 + "é")], SCHEMA)
    got = {r["doc_id"]: r["spans"] for r in suffixes.dedup_substrings(d, with_spans=True).collect()}
    assert got == {1: [], 2: [[2, 57]]}
    assert suffixes.dedup_substrings(d.limit(0)).count() == 0


def test_suffix_sort_orders_bytes_even_under_a_colliding_hash():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 9))).encode() for _ in range(200)]
    data = np.frombuffer(b"".join(texts) + b"\0", np.uint8)
    size = np.array([len(t) for t in texts])
    group = np.sort(np.array([rng.randint(0, 5) for _ in texts]))

    class Blind(suffixes.Suffixes):
        def extension(self, i, j):  # every pair seems equal as far as it goes
            return np.minimum(self.size[i], self.size[j])

    for kind in (suffixes.Suffixes, Blind):
        order, lcp = kind(data, np.cumsum(size) - size, size).sort(group)
        assert [(group[i], texts[i]) for i in order] == sorted((g, t) for g, t in zip(group, texts, strict=True))
        for k in range(1, len(order)):
            a, b = texts[order[k - 1]], texts[order[k]]
            if group[order[k]] == group[order[k - 1]]:
                assert a[: lcp[k]] == b[: lcp[k]] and (lcp[k] in (len(a), len(b)) or a[lcp[k]] != b[lcp[k]])


def test_packed_columns_round_trip():
    x, y = np.array([5, 3, 9], "u8"), np.array([1, 2**40 - 1, 7], "u8")
    got = suffixes.unpack(suffixes.pack([(x, 4, True), (y, 5, False)]), [(4, True), (5, False)])
    assert [g.tolist() for g in got] == [x.tolist(), y.tolist()]


LONG = "One sentence of some words here. Another sentence follows it now. And a third one ends it."


def test_later_spans_go(spark):
    docs = [(1, "Start alone. " + LONG + " End alone."), (2, LONG), (3, "Before it. " + LONG.upper() + "\nAfter it."), (4, None), (5, " \n"), (6, "No repeats in this text at all."), (None, LONG), (7, LONG + " " + LONG)]
    d = spark.createDataFrame([(*x, "t", 0) for x in docs], "doc_id long, text string, gone string, n_removed int")
    out = {r["doc_id"]: r for r in spans.dedup_spans(d).collect()}
    assert {k: r["n_removed"] for k, r in out.items()} == {1: 0, 2: 3, 3: 3, 4: 0, 5: 0, 6: 0, None: 3, 7: 6}
    assert out[2]["text"] == "" and out[3]["text"] == "Before it. After it." and out[1]["text"] == docs[0][1] and out[5]["text"] == " \n" and out[7]["text"] == ""
    assert spans.dedup_spans(d).columns == ["doc_id", "text", "gone", "n_sentences", "n_removed"] and out[1]["gone"] == "t"


def test_a_row_keeps_its_own_first_run_and_rows_of_one_id_do_not_meet(spark):
    d = spark.createDataFrame([(1, LONG + " " + LONG), (1, LONG + " " + LONG)], SCHEMA)
    assert [r["text"] for r in spans.dedup_spans(d).collect()] == [LONG + " "] * 2
    assert spans.dedup_spans(d.limit(0)).count() == 0


def brute_spans(docs):
    """(doc_id, remaining text) by comparing runs of sentences as lists of words."""
    import re

    parts = []
    for d, t in docs:
        t = t or ""
        lead = re.match(r"[\x20\x09-\x0D]*", t).group()
        words = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", t)
        found, now = [], []
        for i, w in enumerate(words):
            now.append(w)
            bare = w.rstrip(" \t\n\x0b\x0c\r")
            if bare[-1] in ".!?" or "\n" in w[len(bare) :] or i == len(words) - 1:
                found.append(now)
                now = []
        parts.append((d, lead, found))
    low = lambda w: "".join(c.lower() if "A" <= c <= "Z" else c for c in w.rstrip(" \t\n\x0b\x0c\r"))
    rank = lambda d: (1 << 63) - 1 if d is None else d
    first, where = {}, []
    for d, _, found in parts:
        seen = {}
        for k, least in spans.RUNS:
            for i in range(len(found) - k + 1):
                words = [low(w) for s in found[i : i + k] for w in s]
                if len(words) >= least:
                    seen.setdefault((k, tuple(words)), []).append(i)
        where.append(seen)
        for r in seen:
            first[r] = min(first.get(r, rank(d)), rank(d))
    out = []
    for (d, lead, found), seen in zip(parts, where, strict=True):
        gone = {j for r, at in seen.items() for i in (at if first[r] < rank(d) else at[1:]) for j in range(i, i + r[0])}
        out.append((d, len(found), len(gone), lead + "".join("".join(s) for j, s in enumerate(found) if j not in gone)))
    return sorted(out, key=str)


def sentence_corpus(seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice(["one", "Two", "thrée", "x"]) for _ in range(rng.randint(1, 7))) + rng.choice([".", "!", "?", "", "\n"]) for _ in range(12)]
    docs = [(d, rng.choice(["", " ", "\n"]) + rng.choice([" ", "  ", "\n"]).join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for d in range(150)]
    return docs + [(300, None), (301, ""), (302, " \n"), (303, "Hi. Ho. Ha. " * 3000), (7, "Hi. Ho. Ha."), (7, "Hi. Ho. Ha."), (None, "Hi. Ho. Ha. Hu.")]


def test_spans_equal_brute_force(spark, monkeypatch):
    docs = sentence_corpus(9)
    d = spark.createDataFrame(docs, SCHEMA).repartition(4)
    get = lambda: sorted((tuple(r) for r in spans.dedup_spans(d).select("doc_id", "n_sentences", "n_removed", "text").collect()), key=str)
    assert get() == brute_spans(docs)
    monkeypatch.setattr(spans, "BLOCK_SENTENCES", 20)  # many small blocks
    assert get() == brute_spans(docs)


def test_colliding_run_hashes_are_told_apart_by_their_checks():
    v, c = np.array([3, 3, 9], "u8"), np.array([1, 5, 2], "u8")
    x, check = np.array([3, 3, 3, 9, 9, 0, 10], "u8"), np.array([5, 1, 7, 2, 3, 0, 1], "u8")
    assert spans._first_of(x, check, v, c).tolist() == [1, 0, -1, 2, -1, -1, -1]


def test_blocks_buckets_and_clashing_columns_do_not_change_removals(spark, monkeypatch):
    docs = corpus(5) + [(600, "long " * 30_000 + "end of a very long text")]
    d = spark.createDataFrame([(*x, b"c", 1) for x in docs], SCHEMA + ", a binary, _id int").repartition(3)
    want = brute(docs)
    monkeypatch.setattr(suffixes, "BLOCK_ANCHORS", 50)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("2", "23"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = sorted((tuple(r) for r in suffixes.dedup_substrings(d).collect()), key=str)
        spark.conf.set("spark.sql.shuffle.partitions", old)
        assert got == want
