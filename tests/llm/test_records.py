import hashlib
import json
import random

import duckdb

from kinlink.llm import quotes, warc
from kinlink.llm.shared import shared_path

PAGES = "page_id long, url string, html string, digest string"


def test_archives_round_trip(spark):
    same, big = "é" * 60, "x" * 700_000
    rows = [(3, "http://a/3", same, "clash"), (1, None, same, "c"), (2, "u\r\nEvil: 1", "short", ""), (4, "u", "short", ""), (5, "u", None, ""), (6, "u", "", ""), (7, "u", big, ""), (8, "u", big, ""), (9, "u", "WARC/1.1\r\n\r\n" * 9 + same, ""), (None, "u", "no id", "")]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    index = warc.write_archives(warc.plan_records(pages), shared_path(spark, "test"))
    got = {r["page_id"]: r for r in warc.read_archives(index).collect()}
    text = {r[0]: (r[2] or "").encode() for r in rows}
    assert set(got) == set(text)
    for k, r in got.items():
        assert (r["payload_bytes"], r["payload_digest"]) == (len(text[k]), hashlib.sha256(text[k]).hexdigest())
        assert bytes(r["payload"]) == (b"" if r["record_type"] == "revisit" else text[k])
    assert {k: r["refers_to"] for k, r in got.items() if r["record_type"] == "revisit"} == {3: 1, 8: 7}
    at = index.where("page_id = 9").first()
    head, block = warc.read_record(at["bundle"], at["frame"], at["inner"], at["length"])
    assert head["WARC-Type"] == "response" and block == text[9]


def test_no_pages(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_many_frames_are_independent(spark, tmp_path):
    w = warc.BundleWriter(f"file://{tmp_path}/b.warc.zst")
    rng = random.Random(1)
    rows = []
    for i in range(40):
        rows += w.add(i, warc.record_bytes(i, "u", bytes(rng.randrange(256) for _ in range(30_000)), "d", None))
    rows += w.close()
    assert len({r[2] for r in rows}) > 3 and [r[0] for r in rows] == list(range(40))
    for key, uri, frame, _, _, inner, n in rows:
        assert warc.read_record(uri, frame, inner, n)[0]["WARC-Record-ID"] == f"<urn:page:{key}>"


CHAT = [
    (1, 0, "user", "Hello there.\nWhat is the plan?"),
    (1, 1, "assistant", "> What is the plan?\nWe go home."),
    (1, 2, "user", "> > What is   the PLAN\n> We go home.\n\nFine by me."),
    (1, 3, "user", "Unlinked words"),
    (1, 4, "assistant", "On Monday Ann wrote:\n> Fine by me.\nThanks"),
    (1, 5, "user", "> said by nobody\nHm"),
    (2, 0, "user", "> We go home.\nOther conversation"),
    (2, 1, None, None),
    (3, 0, "user", "> only quotes\n> here"),
    (None, 1, "user", "> Hello there.\nno conversation"),
    (4, None, "user", "no turn"),
    (5, 0, "user", "same"), (5, 0, "user", "same"), (5, 1, "user", "> same\nyes"), (5, 1, "user", "> same\nyes"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def linked(spark):
    return quotes.link_conversations(spark.createDataFrame([(*c, 7) for c in CHAT], SCHEMA + ", thread int"))


def test_quotes_link_and_go(spark):
    got = {(r["conv_id"], r["turn"]): r for r in linked(spark).collect()}
    assert {k: (r["reply_to"], r["thread"]) for k, r in got.items() if k[0] == 1} == {(1, 0): (None, 0), (1, 1): (0, 0), (1, 2): (1, 0), (1, 3): (None, 3), (1, 4): (2, 0), (1, 5): (None, 5)}
    assert got[1, 2]["text"] == "Fine by me." or got[1, 2]["text"].strip() == "Fine by me."
    assert got[1, 4]["text"] == "Thanks" and got[1, 2]["depth"] == 2 and got[3, 0]["text"] == "" and got[2, 1]["text"] == ""
    assert got[2, 0]["reply_to"] is None and got[None, 1]["reply_to"] is None and got[5, 1]["reply_to"] == 0
    assert linked(spark).count() == len(CHAT)


def test_quotes_equal_their_sql(spark, tmp_path):
    path = str(tmp_path / "c.json")
    with open(path, "w") as f:
        f.writelines(json.dumps(dict(zip(("conv_id", "turn", "role", "text"), c, strict=True))) + "\n" for c in CHAT)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_json('{path}', columns={{conv_id: 'BIGINT', turn: 'BIGINT', role: 'VARCHAR', text: 'VARCHAR'}})")
    r = con.execute(quotes.SQL["op7_quotes"])
    names = [x[0] for x in r.description]
    assert sorted(map(str, (tuple(x) for x in linked(spark).select(*names).collect()))) == sorted(map(str, r.fetchall()))


def test_rendering_is_in_reply_order(spark):
    chat = {(r["conv_id"], r["piece"]): r["chat"] for r in quotes.render(linked(spark)).collect()}
    said = chat[1, 0]
    assert said.index("What is the plan?") < said.index("We go home.") < said.index("Thanks") < said.index("Unlinked words") and ">" not in said.replace("|>", "")


def test_no_messages(spark):
    assert quotes.link_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_threads_stay_whole_and_replies_follow_their_sources(spark):
    """A long conversation of two interleaved threads, cut into pieces by position."""
    rows = [(9, i, "user", f"Root number {i}.") for i in (0, 1)]
    rows += [(9, i, "user", f"> {'Root number' if i < 4 else 'Reply number'} {i - 2}.\nReply number {i}.") for i in range(2, 700)]
    d = quotes.link_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = sorted(d.collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(700))
    assert [r["turn"] for r in got] == [*range(0, 700, 2), *range(1, 700, 2)]
    at = {r["turn"]: r["position"] for r in got}
    assert all(r["reply_to"] == r["turn"] - 2 and at[r["reply_to"]] < r["position"] for r in got if r["turn"] > 1)
    pieces = quotes.render(d, 100).collect()
    assert len(pieces) == 7 and all(r["chat"].count("<|user|>") == 100 for r in pieces)


def test_partial_and_rewrapped_quotations_link(spark):
    rows = [(1, 0, "user", "First there was a plan. Then it\nchanged for good! Nobody knew."), (1, 1, "user", "Something else."), (1, 2, "user", "> Then it changed\n> for good!\nYes."), (1, 3, "user", "> there was a plan\nNo such sentence.")]
    got = {r["turn"]: r["reply_to"] for r in quotes.link_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: None, 1: None, 2: 0, 3: None}


def test_a_table_of_quotes_is_linked_as_built(spark):
    out = quotes.quoted_conversations(spark, "/root/testdata/sf0.001")
    n, linked = out.count(), out.where("reply_to is not null").count()
    assert 3 * linked >= n and out.where("reply_to >= turn or text like '%> %'").count() == 0


def test_repeated_pages_keep_a_record_each(spark):
    same = "y" * 200
    rows = [(1, "u", same, ""), (1, "u", same, ""), (2, "u", same, ""), (2, "u", "other " * 40, "")]
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(spark.createDataFrame(rows, PAGES)).collect())
    assert got == [(1, "response", None), (1, "response", None), (2, "response", None), (2, "revisit", 1)]


def test_a_line_of_very_many_marks(spark):
    said = [(1, 0, "user", "Hello there."), (1, 1, "assistant", ">" * 100_000 + " hello there"), (1, 2, "user", "> " * 50_000 + "hello there")]
    got = quotes.link_conversations(spark.createDataFrame(said, SCHEMA)).orderBy("turn").collect()
    assert [(r["reply_to"], r["text"]) for r in got] == [(None, "Hello there."), (0, ""), (0, "")]
