import random
import sys
import unicodedata

from pyspark.sql import functions as F

from kinlink.functions.text import ABBREVIATIONS, LEGAL_SUFFIXES, add_normalized_columns, blank, blocking_tokens, normalize_text, parse_ids, token_sets, transliterate


def decomposed(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def cleaned(text):
    out = decomposed(text).lower().replace("&", " and ")
    return "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in out).split()


def test_every_code_point_normalises_like_its_decomposition(spark):
    step, texts = 997, []
    points = [cp for cp in range(1, sys.maxunicode + 1) if not 0xD800 <= cp < 0xE000 and (cp < 0x3400 or unicodedata.decomposition(chr(cp)) or unicodedata.combining(chr(cp)) or cp % step == 0)]
    texts = [f"x{chr(cp)}Y z" for cp in points]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.trim(F.regexp_replace(F.replace(F.lower(transliterate(F.col("t"))), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")).alias("n")).collect()
    wrong = [r["t"] for r in rows if r["n"] != " ".join(cleaned(r["t"]))]
    assert not wrong, wrong[:10]


def test_expansion_and_suffix_cut_match_a_list_definition(spark):
    random.seed(5)
    words = [*ABBREVIATIONS, *[w for s in LEGAL_SUFFIXES for w in s.split()], "acme", "x", "liability"]
    names = [" ".join(random.choices(words, k=random.randint(0, 6))) for _ in range(800)]

    def expected(name, cut):
        parts = [ABBREVIATIONS.get(w, w) for w in cleaned(name)]
        while cut and parts and parts[-1] in LEGAL_SUFFIXES:
            parts.pop()
        return " ".join(parts)

    d = spark.createDataFrame([(n,) for n in names], "n string")
    for r in d.select("n", normalize_text(F.col("n")).alias("a"), normalize_text(F.col("n"), True).alias("b")).collect():
        assert (r["a"], r["b"]) == (expected(r["n"], False), expected(r["n"], True)), r["n"]


def test_traps(spark):
    got = spark.createDataFrame([("Acme LLC",), ("Acme Limited Liability Company",), ("Foo Pvt. Ltd.",), ("Ltd",), ("Café & Søn",), ("ﬁ ½ ™",)], "n string").select(normalize_text(F.col("n")).alias("a"), normalize_text(F.col("n"), True).alias("b")).collect()
    assert [tuple(r) for r in got] == [("acme limited liability company", "acme"), ("acme limited liability company", "acme limited liability"), ("foo private limited", "foo"), ("limited", ""), ("cafe and s n", "cafe and s n"), ("fi 1 2 tm", "fi 1 2 tm")]


def test_tokens_ids_and_blanks(spark):
    d = spark.createDataFrame([("S1-1", "A Bee & Co", "1 Main St", "US"), ("S1-2", "", "", "US")], "entity_id string, business_name string, business_address string, country string")
    rows = {r["entity_id"]: r for r in add_normalized_columns(d).withColumn("bt", blocking_tokens(F.col("name_tokens"), F.col("address_tokens"))).collect()}
    assert rows["S1-1"]["bt"] == ["bee", "and", "company", "main", "street"]
    assert rows["S1-2"]["name_tokens"] == [] and rows["S1-2"]["bt"] == []
    one = spark.createDataFrame([("a,,b", " \t "), (None, "x")], "l string, s string").select(parse_ids(F.col("l")).alias("ids"), blank(F.col("s")).alias("blank")).collect()
    assert [tuple(r) for r in one] == [(["a", "b"], True), ([], False)]


def test_many_legal_forms_at_the_end(spark):
    d = spark.createDataFrame([("Acme" + " ltd llc" * 20_000,), ("Acme ltd ltdx",), ("ltd",), ("Acme co company",)], "text string")
    assert [r[0] for r in d.select(normalize_text(F.col("text"), True)).collect()] == ["acme", "acme limited ltdx", "", "acme"]


def test_token_sets_equal_the_native_tokens(spark):
    """All code points between letters, expansions, ampersands and nulls."""
    texts = ["a" + "".join(f"{chr(c)}b{chr(c)} c{c % 7}{chr(c)}" for c in range(lo, lo + 0x400) if not 0xD800 <= c < 0xE000) for lo in range(0, 0x30000, 0x400)]
    texts += ["Acme LLC & Co. st ST x", "", "a b", "R&D ave.", None]
    rows = [(str(i), t, "Ltd caf\u00e9" if i % 2 else "", "US") for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")
    r = add_normalized_columns(d)
    want = {x["entity_id"]: None if x["t"] is None else sorted(x["t"]) for x in r.select("entity_id", blocking_tokens(F.col("name_tokens"), F.col("address_tokens")).alias("t")).collect()}
    got = {x["entity_id"]: None if x["bag"] is None else x["bag"].split() for x in d.mapInArrow(token_sets, "entity_id string, country string, size int, bag string").collect()}
    assert got == want
