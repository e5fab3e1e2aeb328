import random

import duckdb

from kinlink.llm import decontaminate as dc
from kinlink.llm import licences

SCHEMA = "doc_id long, text string"


def scan_both(spark, tmp_path, docs):
    d = spark.createDataFrame([(*x, "clash") for x in docs], SCHEMA + ", words string")
    d.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
    r = con.execute(licences.SQL["op10_licences"])
    names = [x[0] for x in r.description]
    own = [tuple(x) for x in licences.scan(d).select(*names).collect()]
    return own, [tuple(x) for x in r.fetchall()], names


def test_scan_equals_its_sql(spark, tmp_path):
    rng = random.Random(6)
    words = ["the", "mit", "license", "licensed", "under", "cc", "by", "nc", "4", "0", "general", "public", "gnu", "version", "3", "all", "rights", "reserved", "x", "É", "released"]
    notices = [t for _, t, _ in licences.TEMPLATES] + [p for p, _ in licences.BASE]
    text = lambda: rng.choice([" ", "\n", "-", ", "]).join(rng.choice([*words, *notices]) for _ in range(rng.randint(0, 14)))
    docs = [(i, text()) for i in range(150)] + [(200, None), (201, ""), (202, "..."), (203, "CC BY cc by CC-BY-NC 4.0"), (204, "Released under the MIT License."), (204, "Released under the MIT License."), (None, "All Rights Reserved"), (205, "linKed under the apache license"), (206, "mit license " * 3000)]
    own, sql, names = scan_both(spark, tmp_path, docs)
    assert sorted(map(str, own)) == sorted(map(str, sql))
    by = {r[names.index("doc_id")]: dict(zip(names, r, strict=True)) for r in own}
    assert by[203]["n_base"] == 3 and by[203]["labels"] == "cc-by,cc-by-nc" and by[203]["last_word"] == 4
    assert by[204]["labels"] == "mit" and by[204]["score"] == 1.0 and by[204]["n_base"] == 0
    assert by[200]["n_words"] == 0 and by[200]["first_word"] is None and by[200]["labels"] == ""


def test_no_files_to_scan(spark):
    assert licences.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def sentence(rng, n):
    return " ".join("".join(rng.choice("aeioustrn") for _ in range(rng.randint(2, 9))) for _ in range(n))


def leak_corpus(rng):
    items = [(i, f"{sentence(rng, rng.randint(8, 30)).capitalize()}? {sentence(rng, rng.randint(3, 12))}.") for i in range(30)] + [(90, "too short"), (91, None), (92, "")]
    docs = []
    for d in range(120):
        body = sentence(rng, rng.randint(0, 400))
        cut = rng.randint(0, len(body))
        if d % 3 == 0:
            body = f"{body[:cut]} {items[d % 30][1]} {body[cut:]}"
        elif d % 3 == 1:  # a decoy: a few words of an item
            body = f"{body[:cut]} {' '.join(items[d % 30][1].split()[:6])} {body[cut:]}"
        docs.append((d, body))
    return items, [*docs, (500, None), (501, ""), (502, items[0][1].upper()), (502, items[0][1]), (None, items[1][1])]


def brute_scores(items, query):
    """BM25 of all items for a set of terms, divided by each item's own."""
    import collections
    import math

    lists = {i: dc.terms_of(t).tolist() for i, t in items if t and len(dc.terms_of(t)) >= dc.SHINGLE}
    df = collections.Counter(t for w in lists.values() for t in set(w))
    mean = sum(map(len, lists.values())) / len(lists)
    out = {}
    for i, w in lists.items():
        impact = {t: math.log(1 + (len(lists) - df[t] + 0.5) / (df[t] + 0.5)) * n * (dc.K1 + 1) / (n + dc.K1 * (1 - dc.B + dc.B * len(w) / mean)) for t, n in collections.Counter(w).items()}
        out[i] = sum(v for t, v in impact.items() if t in query) / sum(impact.values())
    return out, df, mean, lists


def test_wand_retrieves_all_above_threshold():
    import numpy as np

    rng = random.Random(8)
    items, docs = leak_corpus(rng)
    _, df, mean, lists = brute_scores(items, set())
    index = dc.build_index([(i, t) for i, t in items if i in lists], len(lists), mean, df)
    for _, text in docs[:60]:
        terms = np.unique(index.term_ids(dc.terms_of(text or "")))
        terms = terms[terms >= 0]
        want, *_ = brute_scores(items, set(index.terms[terms].tolist()))
        for threshold in (0.05, 0.2, 0.5):
            got = {index.item_ids[i]: s for i, s in index.search(terms, threshold)}
            assert set(got) == {i for i, s in want.items() if s >= threshold}
            assert all(abs(s - want[i]) < 1e-9 for i, s in got.items())


def test_planted_items_are_found_and_decoys_left(spark, monkeypatch):
    rng = random.Random(9)
    items, docs = leak_corpus(rng)
    b, d = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame([(*x, "c") for x in docs], SCHEMA + ", score string").repartition(3)
    want = {(i, i % 30) for i in range(0, 120, 3)} | {(502, 0), (None, 1)}
    assert {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(d, b).collect()} == want
    monkeypatch.setattr(dc, "SHARD_BYTES", 700)  # several shards give the same pairs
    assert {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(d, b).collect()} == want
    left = dc.drop_leaks(d, b)
    assert left.columns == d.columns and left.count() == len(docs) - 40 - 3
    assert dc.find_leaks(d, b.limit(0)).count() == 0 and dc.drop_leaks(d, b.limit(0)).count() == len(docs) and dc.find_leaks(d.limit(0), b).count() == 0


def test_a_changed_word_does_not_hide_a_leak(spark):
    rng = random.Random(10)
    text = sentence(rng, 40) + ". " + sentence(rng, 10) + "."
    w = text.split()
    w[20] = "changed"
    b = spark.createDataFrame([(1, text)], "item_id long, text string")
    d = spark.createDataFrame([(1, sentence(rng, 300) + " " + " ".join(w))], SCHEMA)
    assert dc.find_leaks(d, b).count() == 1


def test_an_edit_at_the_end_does_not_hide_an_item_with_a_short_answer(spark):
    rng = random.Random(11)
    items, docs, want = [], [], set()
    for i, n in enumerate((1, 2, 3, 4)):
        q, a = sentence(rng, 40).split(), sentence(rng, n).split()
        items.append((i, f"{' '.join(q)}? {' '.join(a)}."))
        edits = [[*q, *a[:-1]], [*q, *a[:-1], "changed"], [*q[:-1], *a], [*q[:-1], "changed", *a], [*q, "inserted", *a]]
        left = [q[:-4], [*q[:-3], "other", "words", "stand", "here", "now"]]
        for k, w in enumerate(edits + left):
            docs.append((100 * i + k, f"{sentence(rng, 150)} {' '.join(w)} {sentence(rng, 150)}"))
        want |= {(100 * i + k, i) for k in range(len(edits))}
    b, d = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, SCHEMA)
    assert {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(d, b).collect()} == want


def brute_leaks(items, docs):
    """(doc_id, item_id) by scoring and comparing every passage with every item."""
    import math
    from collections import Counter

    word = lambda t: ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in dc._WORD.findall(t or "")]
    lists = [(i, t, word(t)) for i, t in items if word(t)]
    df, mean = Counter(w for _, _, ws in lists for w in set(ws)), sum(len(ws) for *_, ws in lists) / len(lists)
    stride = max(dc.MIN_STRIDE, max(len(ws) for *_, ws in lists))
    impacts = []
    for *_, ws in lists:
        x = {w: math.log(1 + (len(lists) - df[w] + 0.5) / (df[w] + 0.5)) * n * (dc.K1 + 1) / (n + dc.K1 * (1 - dc.B + dc.B * len(ws) / mean)) for w, n in Counter(ws).items()}
        impacts.append({w: v / sum(x.values()) for w, v in x.items()})
    found = set()
    for d, text in docs:
        w = word(text)
        for at in range(0, len(w), stride):
            passage = w[at : at + 2 * stride]
            have = set(passage)
            sh = {tuple(passage[i : i + 5]) for i in range(len(passage) - 4)}
            for (i, t, ws), impact in zip(lists, impacts, strict=True):
                if sum(v for x, v in impact.items() if x in have) < dc.THRESHOLD:
                    continue
                if len(ws) < 5:
                    if any(passage[k : k + len(ws)] == ws for k in range(len(passage))):
                        found.add((d, i))
                    continue
                cover = {j for k in range(len(ws) - 4) if tuple(ws[k : k + 5]) in sh for j in range(k, k + 5)}
                cut = dc._answer_start(t, len(ws))
                q, a = (sum(j in cover for j in part) / len(part) for part in (range(cut), range(cut, len(ws))))
                if q >= dc.OVERLAP and a >= dc.OVERLAP:
                    found.add((d, i))
    return found


def test_pairs_equal_brute_force_from_text_to_overlap(spark):
    rng = random.Random(14)
    items, docs = leak_corpus(rng)
    # answers of five words or more only, so that the short-answer rule, tested above, stays out
    items = [(i, f"{sentence(rng, 20)}? {sentence(rng, 7)}.") for i in range(20)] + [(30, "two words"), (31, "Lone"), (32, "a four word item"), (33, None), (34, "?!"), (7, "same id other item of some six words here. and its answer of six words too.")]
    for d in range(100):
        i, t = items[d % 20]
        w = t.split()
        for _ in range(d % 4):
            w[rng.randrange(len(w))] = rng.choice(["changed", "words", "a"])
        docs.append((1000 + d, f"{sentence(rng, rng.randint(0, 200))} {' '.join(w[d % 3 :])} {sentence(rng, rng.randint(0, 90))}"))
    docs += [(2000, "here are two words"), (2001, "words two"), (2002, "LONE"), (2003, "it is a four word item too"), (2004, "a four item word")]
    got = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute_leaks(items, docs)
    assert got == want and {(2000, 30), (2002, 31), (2003, 32)} <= want and len(want) > 40


def test_several_shards_share_a_scan(spark, monkeypatch):
    rng = random.Random(15)
    items, _ = leak_corpus(rng)
    b = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(dc, "SHARD_BYTES", 700)
    many = list(dc.scans_of(b))
    assert len(many) == 1 and len(many[0]) > 3
    size = max(s.index.bytes() for s in many[0])
    monkeypatch.setattr(dc, "SCAN_BYTES", 2 * size)
    assert all(sum(s.index.bytes() for s in scan) <= 2 * size for scan in dc.scans_of(b))


def test_whole_licence_texts_get_their_labels(spark, tmp_path):
    docs = [(i, f"Some project. {text} Some code follows.") for i, (_, text, _) in enumerate(licences.TEXTS)]
    docs += [(100, licences.TEXTS[0][1].replace("sublicense, and/or sell", "sublicense, rent, and/or sell")), (101, licences.TEXTS[5][1][:60])]
    own, sql, names = scan_both(spark, tmp_path, docs)
    assert sorted(map(str, own)) == sorted(map(str, sql))
    got = {r[names.index("doc_id")]: r[names.index("labels")].split(",") for r in own}
    assert all(label in got[i] for i, (label, *_) in enumerate(licences.TEXTS)) and "mit" in got[100] and got[101] == ["apache-2.0"]


def test_edited_notices_keep_every_label_that_the_places_allow(spark, tmp_path):
    rng = random.Random(16)
    docs = [(0, "permission is hereby granted free of charge to any person obtaining a copy of this software and its associated documentation files")]
    for i in range(1, 240):
        words = rng.choice(licences.TEMPLATES)[1].split()
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = rng.choice([["its"], [], [rng.choice(words)]])
        docs.append((i, " ".join(["x"] * rng.randint(0, 3) + words * rng.randint(1, 2))))
    own, sql, names = scan_both(spark, tmp_path, docs)
    assert sorted(map(str, own)) == sorted(map(str, sql))
    assert {r[names.index("doc_id")]: r[names.index("labels")] for r in own}[0] == "mit"
