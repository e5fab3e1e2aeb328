"""Chat formatting by quotation linking, DataFrame functions only.

A message's lines are parsed into nested quote levels (``>`` marks).  Runs of lines
of one level are quoted passages; normalised passages, their lines and their sentences
(a re-wrapped or partial quotation) are hashed and joined to the earliest earlier message
of the same conversation that says them unquoted.  The message replies to the source of
its shallowest linked passage.  Threads follow those links to their roots (pointer
doubling).  Messages are numbered in reply order: thread by thread, each by turn, so every
message stands after the one it replies to; all quotes and attribution lines are removed.

Every join has one row a key on its right side, so AQE may split a hot conversation;
positions come from range partitions on (conversation, thread, turn), so nothing gathers a
conversation in one row or task.  ``render`` formats a fixed number of positions a row.

Defined cases: a null text is empty; an empty or wholly quoted message keeps its row
with an empty text; a message with a null conversation or turn links to nothing and is its
own thread, and null conversations are numbered as one; repeated rows get equal results
but for their positions; of several sources the earliest turn counts; a passage quoted
from nowhere links to nothing; a very long text is parsed whole; columns other than
conv_id, turn, role and text, whatever their names, are not read; no messages: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialise

#: Possessive, so that a line of any number of marks is matched without recursion.
MARKS = r"^(?:[ \t]*+>)++"
ATTRIBUTION = r"(?i)^\s*(on|am|le|el)\b.*(wrote|schrieb|écrit|escribió)\s*:\s*$"
SENTENCE = r"[^.!?]+"
PIECE_TURNS = 256


def normalise(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _parsed(messages: DataFrame) -> DataFrame:
    """Messages with their lines, quote levels and own text."""
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), "\r\n?", "\n")
    m = messages.select("conv_id", "turn", "role", text.alias("whole"))
    m = m.withColumn("quotes", F.expr(r"whole rlike '(?m)^[ \t]*>'"))
    m = m.withColumn("lines", F.when(F.col("quotes"), F.split("whole", "\n")))
    m = m.withColumn("marks", F.transform("lines", lambda l: F.length(F.regexp_replace(F.regexp_extract(l, MARKS, 0), r"[^>]", ""))))
    m = m.withColumn("bodies", F.transform("lines", lambda l: F.trim(F.regexp_replace(l, MARKS, ""))))
    own = F.filter("lines", lambda l, i: (F.get("marks", i) == 0) & ~(l.rlike(ATTRIBUTION) & (F.coalesce(F.get("marks", i + 1), F.lit(0)) > 0)))
    return m.select("conv_id", "turn", "role", "whole", "quotes", "marks", "bodies", F.trim(F.when(F.col("quotes"), F.array_join(own, "\n")).otherwise(F.col("whole"))).alias("text"))


def _passages(quoting: DataFrame) -> DataFrame:
    """(conv_id, turn, msg, level, part, at, key): passages (part 0), their lines (1), their sentences (2)."""
    q = quoting.select("conv_id", "turn", F.md5("whole").alias("msg"), "marks", "bodies").dropDuplicates(["conv_id", "turn", "msg"])
    q = q.withColumn("starts", F.filter(F.transform("marks", lambda x, i: F.when((i == 0) | (x != F.get("marks", i - 1)), i)), lambda i: i.isNotNull()))
    run = F.transform("starts", lambda s, k: F.struct(F.get("marks", s).alias("level"), F.lit(0).alias("part"), s.alias("at"),
                      F.array_join(F.slice("bodies", s + 1, F.coalesce(F.get("starts", k + 1), F.size("bodies")) - s), " ").alias("said")))
    line = F.transform("bodies", lambda b, i: F.struct(F.get("marks", i).alias("level"), F.lit(1).alias("part"), i.alias("at"), b.alias("said")))
    sentences = F.flatten(F.transform(run, lambda p: F.transform(F.regexp_extract_all(p["said"], F.lit(SENTENCE), F.lit(0)), lambda x: F.struct(p["level"].alias("level"), F.lit(2).alias("part"), p["at"].alias("at"), x.alias("said")))))
    p = q.select("conv_id", "turn", "msg", F.explode(F.filter(F.concat(run, line, sentences), lambda x: x["level"] > 0)).alias("p"))
    said = normalise(F.col("p.said"))
    return p.select("conv_id", "turn", "msg", "p.level", "p.part", "p.at", said.alias("said")).where("said <> ''").select("conv_id", "turn", "msg", "level", "part", "at", F.md5("said").alias("key"))


def _sources(parsed: DataFrame, quoting: DataFrame) -> DataFrame:
    """(conv_id, key, source): the earliest turn that says a passage unquoted."""
    talks = quoting.select("conv_id").distinct()
    o = parsed.select("conv_id", "turn", "text").join(talks, "conv_id", "left_semi")
    said = F.array_distinct(F.concat(F.array("text"), F.split("text", r"\n\s*\n"), F.split("text", "\n"), F.regexp_extract_all(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(SENTENCE), F.lit(0))))
    o = o.select("conv_id", "turn", F.explode(F.transform(said, normalise)).alias("said")).where("said <> ''")
    return o.groupBy("conv_id", F.md5("said").alias("key")).agg(F.min("turn").alias("source"))


def link_quotes(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, msg, reply_to): each quoting message's direct source."""
    parsed = _parsed(messages)
    quoting = parsed.where("quotes")
    found = _passages(quoting).join(_sources(parsed, quoting), ["conv_id", "key"]).where("source < turn")
    best = found.groupBy("conv_id", "turn", "msg").agg(F.min(F.struct("level", "part", "at", "source")).alias("b"))
    return best.select("conv_id", "turn", "msg", F.col("b.source").alias("reply_to"))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread): the root of every message that has a link."""
    up = materialise(links.groupBy("conv_id", "turn").agg(F.min("reply_to").alias("thread")), "quote-links")
    while True:
        over = up.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"))
        step = materialise(up.join(over, ["conv_id", "thread"], "left").select("conv_id", "turn", F.coalesce("next", "thread").alias("thread"), F.col("next").isNotNull().alias("moved")), "quote-threads")
        if step.where("moved").isEmpty():
            return step.select("conv_id", "turn", "thread")
        up = step.select("conv_id", "turn", "thread")


def in_reply_order(messages: DataFrame) -> DataFrame:
    """messages + position: 0, 1, ... in each conversation by (thread, turn), nulls first.

    Range partitions sorted within give a global order; offsets of partitions and
    conversations are sums and minima, so a conversation of any size is many tasks' work.
    """
    spark = messages.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["conv_id", "thread", "turn", "msg", "role"]
    m = messages.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_n", F.monotonically_increasing_id())
    m = materialise(m, "reply-order").withColumns({"_p": F.shiftright("_n", 33), "_r": F.col("_n").bitwiseAND((1 << 33) - 1)})
    sizes = m.groupBy("_p").agg(F.count(F.lit(1)).alias("_size"))  # one row a partition
    before = sizes.select("_p", F.coalesce(F.sum("_size").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    m = m.join(F.broadcast(before), "_p").withColumn("_at", F.col("_r") + F.col("_before"))
    first = m.groupBy(F.col("conv_id").alias("_c")).agg(F.min("_at").alias("_first"))
    m = m.join(first, F.col("conv_id").eqNullSafe(F.col("_c")))
    return m.withColumn("position", F.col("_at") - F.col("_first")).drop("_n", "_p", "_r", "_before", "_at", "_c", "_first")


def link_conversations(messages: DataFrame) -> DataFrame:
    """One row per message: own text, reply_to, thread, and its position in reply order."""
    links = materialise(link_quotes(messages), "quotes")
    roots = threads(links)
    m = _parsed(messages).select("conv_id", "turn", "role", "text", F.md5("whole").alias("msg"), F.coalesce(F.array_max("marks"), F.lit(0)).alias("depth"),
                                 F.coalesce(F.size(F.filter("marks", lambda x: x > 0)), F.lit(0)).alias("n_quoted"))
    m = m.join(links, ["conv_id", "turn", "msg"], "left").join(roots, ["conv_id", "turn"], "left")
    thread = F.when(F.col("reply_to").isNotNull(), F.col("thread")).otherwise(F.col("turn"))
    m = m.select("conv_id", "turn", "role", "text", F.col("n_quoted").cast("long"), F.col("depth").cast("long").alias("depth"), F.col("reply_to"), thread.alias("thread"), "msg")
    return in_reply_order(m).drop("msg")


def render(linked: DataFrame, piece: int = PIECE_TURNS) -> DataFrame:
    """(conv_id, piece, chat): formatted messages in reply order, ``piece`` of them a row at most."""
    line = F.struct("position", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.col("text")).alias("said"))
    g = linked.groupBy("conv_id", F.floor(F.col("position") / piece).alias("piece")).agg(F.array_sort(F.collect_list(line)).alias("m"))
    return g.select("conv_id", "piece", F.array_join(F.transform("m", lambda x: x["said"]), "\n").alias("chat"))


def quoting(messages: DataFrame) -> DataFrame:
    """The conversations as mail would carry them: every odd turn quotes the turn before, every fourth the one before that too."""
    said = messages.where("conv_id is not null and turn is not null and text is not null").groupBy("conv_id", "turn").agg(F.min("text").alias("said"))
    earlier = lambda k: said.select("conv_id", (F.col("turn") + k).alias("turn"), F.col("said").alias(f"said{k}"))
    m = messages.select("conv_id", "turn", "role", "text").join(earlier(1), ["conv_id", "turn"], "left").join(earlier(2), ["conv_id", "turn"], "left")
    quote = lambda c, mark: F.concat(F.lit(mark), F.replace(F.col(c), F.lit("\n"), F.lit("\n" + mark)), F.lit("\n"))
    both = F.concat(F.when(F.col("turn") % 4 == 3, F.coalesce(quote("said2", "> > "), F.lit(""))).otherwise(""), F.coalesce(quote("said1", "> "), F.lit("")), F.coalesce("text", F.lit("")))
    return m.select("conv_id", "turn", "role", F.when(F.col("turn") % 2 == 1, both).otherwise(F.col("text")).alias("text"))


def op7_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def quoted_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator over all conversations in which odd turns quote their predecessors."""
    return link_conversations(quoting(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


_SQL = r"""
with recursive m as (select row_number() over () r, conv_id, turn, role, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') w from conversations),
l as (select r, conv_id, turn, role, w, regexp_matches(w, '(?m)^[ \t]*>') q, string_split(w, chr(10)) ls from m),
x as (select r, conv_id, turn, i, ls[i] as line, length(regexp_replace(regexp_extract(ls[i], '^(?:[ \t]*>)+'), '[^>]', '', 'g')) mark,
    trim(regexp_replace(ls[i], '^(?:[ \t]*>)+', ''), ' ') body from (select *, unnest(range(1, len(ls) + 1)) i from l where q)),
y as (select *, coalesce(lead(mark) over (partition by r order by i), 0) nxt, case when mark is distinct from lag(mark) over (partition by r order by i) then 1 else 0 end s from x),
z as (select *, sum(s) over (partition by r order by i) g from y),
own as (select l.r, l.conv_id, l.turn, l.role, l.w, trim(case when q then coalesce(t, '') else w end, ' ') as t, coalesce(nq, 0) nq, coalesce(dp, 0) dp from l left join
    (select r, string_agg(line, chr(10) order by i) filter (where mark = 0 and not (nxt > 0 and regexp_matches(line, '(?i)^\s*(on|am|le|el)\b.*(wrote|schrieb|écrit|escribió)\s*:\s*$'))) t,
       count(*) filter (where mark > 0) nq, max(mark) dp from z group by r) u using (r)),
p as (select r, conv_id, turn, mark lv, 0 part, min(i) a, trim(regexp_replace(lower(string_agg(body, ' ' order by i)), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') said from z where mark > 0 group by r, conv_id, turn, mark, g
    union all select r, conv_id, turn, mark, 1, i, trim(regexp_replace(lower(body), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') from z where mark > 0
    union all select r, conv_id, turn, lv, 2, a, trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') from (select r, conv_id, turn, mark lv, min(i) a, unnest(regexp_extract_all(string_agg(body, ' ' order by i), '[^.!?]+')) x from z where mark > 0 group by r, conv_id, turn, mark, g)),
o as (select conv_id, turn, unnest(list_concat([t], regexp_split_to_array(t, '\n\s*\n'), string_split(t, chr(10)), regexp_extract_all(replace(t, chr(10), ' '), '[^.!?]+'))) s from own where conv_id in (select conv_id from l where q)),
src as (select conv_id, said, min(turn) source from (select conv_id, turn, trim(regexp_replace(lower(s), '[^\p{L}\p{N}]+', ' ', 'g'), ' ') said from o) where said <> '' group by conv_id, said),
lk as (select p.r, p.conv_id, p.turn, min({'a': lv, 'b': part, 'c': a, 'd': source}).d reply_to from p join src on src.conv_id = p.conv_id and src.said = p.said and source < p.turn group by p.r, p.conv_id, p.turn),
up as (select conv_id, turn, min(reply_to) parent from lk group by conv_id, turn),
rt as (select conv_id, turn, parent as thread from up union select rt.conv_id, rt.turn, up.parent from rt join up on up.conv_id = rt.conv_id and up.turn = rt.thread),
root as (select conv_id, turn, min(thread) thread from rt group by conv_id, turn),
fin as (select own.conv_id, own.turn, own.role, own.t as text, cast(nq as bigint) n_quoted, cast(dp as bigint) as depth, lk.reply_to, case when lk.reply_to is null then own.turn else root.thread end as thread, md5(own.w) msg
    from own left join lk using (r) left join root on root.conv_id = own.conv_id and root.turn = own.turn)
select conv_id, turn, role, text, n_quoted, depth, reply_to, thread,
  row_number() over (partition by conv_id order by thread nulls first, turn nulls first, msg nulls first, role nulls first) - 1 as position from fin"""
_QUOTING = """with recursive said as (select conv_id, turn, min(text) said from conversations where conv_id is not null and turn is not null and text is not null group by conv_id, turn),
quoting as (select c.conv_id, c.turn, c.role, case when c.turn % 2 = 1 then
    case when c.turn % 4 = 3 then coalesce('> > ' || replace(b.said, chr(10), chr(10) || '> > ') || chr(10), '') else '' end || coalesce('> ' || replace(a.said, chr(10), chr(10) || '> ') || chr(10), '') || coalesce(c.text, '') else c.text end as text
  from conversations c left join said a on a.conv_id = c.conv_id and a.turn + 1 = c.turn left join said b on b.conv_id = c.conv_id and b.turn + 2 = c.turn),
m as"""
SQL = {"op7_quotes": _SQL, "quoted_conversations": _SQL.replace("with recursive m as", _QUOTING).replace("w from conversations)", "w from quoting)")}
