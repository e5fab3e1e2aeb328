"""Substring dedup by sliding sentence spans.

A sentence ends with a word that ends in ``.``, ``!`` or ``?``, with a line feed after
a word, or with the text.  Every run of ``RUN`` consecutive sentences is hashed over its
words with A-Z lower-cased; longer repeated runs are covered by these.  Runs of two
sentences count too if they have ``PAIR_WORDS`` words, since a long passage may hold no
more whole sentences.  Runs are joined over all texts; the occurrence first by (doc_id,
position) stays, and each sentence that any other occurrence covers goes.

Runs are told apart by 96 bits of hash.  A block of texts sends each run once, with its
smallest id, so a passage that a third of all texts share costs one entry a block; texts
are only shuffled to meet their lists of removed sentences.

Defined cases: a null text is empty; a text without words stays as it is; a very long
text is handled whole; rows that share an id never remove each other's sentences (a run
repeated inside one row still loses its later occurrences), repeated rows get equal
results; of equal runs in one text the first stays; a row with a null id ranks after all
ids; white space before the first word stays, white space after a sentence goes with it;
other columns are carried whatever their names (n_sentences and n_removed are replaced);
an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .shared import bound_batches, materialise, set_aside

RUN = 3
#: Words at least in a run of only two sentences.
PAIR_WORDS = 10
#: (sentences, words at least) of the runs that are hashed.
RUNS = ((RUN, 1), (2, PAIR_WORDS))
#: Sentences of a block of texts that is sent at once, about.
BLOCK_SENTENCES = 1 << 20
LAST = (1 << 63) - 1
_END = np.zeros(256, bool)
_END[list(b".!?")] = True
BATCH = "batch string, ids binary, marks binary, sizes binary, vals binary, checks binary"


def sentences(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
    """Each sentence's first word (one more at the end), each text's first sentence, the words' starts and their parts."""
    s, e, first = K.words(data, off)
    if not len(s):
        return np.zeros(1, np.int64), np.zeros(len(off), np.int64), s, (s, e, first)
    feeds = np.concatenate([[0], np.cumsum(data == 10)])
    nxt = np.append(s[1:], len(data))
    stop = _END[data[e - 1]] | (feeds[nxt] > feeds[e])
    ends = first[1:][first[1:] > 0] - 1
    stop[ends] = True
    begin = np.concatenate([[0], np.flatnonzero(stop) + 1])
    return begin, np.searchsorted(begin[:-1], first), s, (s, e, first)


def run_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(RUNS, sentences) hashes of the runs from each sentence on, 0 for none, their checks, and each text's first sentence."""
    low = K.LOWER[data]
    begin, at, _, (s, e, _) = sentences(low, off)
    n = len(begin) - 1
    out, check = np.zeros((len(RUNS), max(n, 0)), K.U), np.zeros((len(RUNS), max(n, 0)), K.U)
    if n <= 0:
        return out, check, at
    px = K.Prefix(low)
    w = px.span(s, e)
    inv = K._pow("i", K.BASE_INV, len(w) + 1)
    sums = [np.concatenate([np.zeros(1, K.U), np.cumsum(K.mix(w ^ salt) * K._pow("b", K.BASE, len(w) + 1)[: len(w)])]) for salt in (K.U(0), K.CODES[7])]
    last = np.repeat(at[1:], np.diff(at))
    i = np.arange(n)
    for j, (k, least) in enumerate(RUNS):
        use = np.flatnonzero(i + k <= last)
        a, b = begin[use], begin[use + k]
        big = b - a >= least
        use, a, b = use[big], a[big], b[big]
        size = K.mix((b - a).astype(K.U)) + K.U(k)
        out[j, use] = K.mix((sums[0][b] - sums[0][a]) * inv[a] + size) | K.U(1)
        check[j, use] = K.mix((sums[1][b] - sums[1][a]) * inv[a] + size) >> K.U(32)
    return out, check, at


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("_mark", F.xxhash64(text)).withColumn("_text", text)


def _batches(docs: DataFrame) -> DataFrame:
    def blocks(it: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        block, held = [], 0
        for rb in it:
            for a, b, data, off in K.chunked(rb.column("_text")):
                runs, checks, at = run_hashes(data, off)
                block.append((*(rb.column(c).slice(a, b - a).to_numpy(zero_copy_only=False).astype("<i8") for c in ("_id", "_mark")), np.diff(at).astype("<i8"), runs, checks))
                held += runs.shape[1]
                if held >= BLOCK_SENTENCES:
                    yield block
                    block, held = [], 0
        if block:
            yield block

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(it):
            *whole, runs, checks = zip(*block, strict=True)
            blobs = [np.concatenate(x).tobytes() for x in whole] + [np.concatenate(runs, 1).tobytes(), K.pack([(np.concatenate(checks, 1).ravel(), 4, False)])]
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *[pa.array([x], pa.binary()) for x in blobs]], [x.split(" ")[0] for x in BATCH.split(", ")])

    return materialise(_identified(docs).select("_id", "_mark", "_text").mapInArrow(run, BATCH), "sentence-runs")


def _read(row: dict) -> tuple[np.ndarray, ...]:
    ids, marks, sizes = (np.frombuffer(row[c] or b"", "<i8") for c in ("ids", "marks", "sizes"))
    return ids, marks, sizes, np.frombuffer(row["vals"] or b"", "<u8").reshape(len(RUNS), -1), K.unpack(row["checks"], [(4, False)])[0].reshape(len(RUNS), -1)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


_ASKED = [(8, True), (4, False), (8, False), (1, False)]  # run, check, smallest id, occurrences up to 2
_FOUND = _ASKED[:3]


def repeated_runs(batches: DataFrame) -> DataFrame:
    """(batch, list): a block's runs that occur twice or more anywhere, with their smallest id."""
    buckets = int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for row in rb.to_pylist():
                ids, _, sizes, runs, checks = _read(row)
                v, c = runs.ravel(), checks.ravel()
                owner = np.tile(np.repeat(ids, sizes), len(RUNS))[v > 0]
                v, c = v[v > 0], c[v > 0]
                order = np.lexsort((owner, c, v))
                v, c, owner = v[order], c[order], owner[order]
                new = np.flatnonzero(_changes(v, c))
                n = np.minimum(np.diff(np.append(new, len(v))), 2)
                v, c, owner = v[new], c[new], owner[new]
                to = K.mix(v) % K.U(buckets)
                order = np.argsort(to, kind="stable")
                cut = np.searchsorted(to[order], np.arange(buckets + 1))
                columns = [x[order] for x in (v, c, owner.view("<u8"), n)]
                some = [j for j in range(buckets) if cut[j + 1] > cut[j]]
                lists = [K.pack([(x[cut[j] : cut[j + 1]], *how) for x, how in zip(columns, _ASKED, strict=True)]) for j in some]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([row["batch"]] * len(some), pa.string()), pa.array(lists, pa.binary())], ["bucket", "batch", "list"])

    def meet(table: pa.Table) -> pa.Table:
        parts = [K.unpack(x, _ASKED) for x in table.column("list").to_pylist()]
        v, c, first, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        first = first.view("<i8")
        order = np.lexsort((first, c, v))
        new = _changes(v[order], c[order])
        group = np.cumsum(new) - 1
        low, many = np.empty(len(v), np.int64), np.empty(len(v), bool)
        low[order] = first[order][new][group]
        many[order] = (np.bincount(group, weights=n[order]) > 1)[group]
        out, at = [], 0
        for x, *_ in parts:
            use = np.flatnonzero(many[at : at + len(x)]) + at
            at += len(x)
            out.append(K.pack([(y[use], *how) for y, how in zip((v, c, low.view("<u8")), _FOUND, strict=True)]) if len(use) else None)
        return pa.table({"batch": table.column("batch"), "list": pa.array(out, pa.binary())})

    sent = batches.mapInArrow(send, "bucket int, batch string, list binary")
    return sent.groupBy("bucket").applyInArrow(meet, "batch string, list binary").where("list is not null")


def _first_of(x: np.ndarray, check: np.ndarray, v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Places of the runs x in the sorted (v, c), -1 where there is none."""
    at = np.searchsorted(v, x)
    out = np.full(len(x), -1, np.int64)
    todo = np.flatnonzero(x > 0)
    while len(todo):  # more than one round only where hashes collide
        todo = todo[at[todo] < len(v)]
        todo = todo[v[at[todo]] == x[todo]]
        hit = c[at[todo]] == check[todo]
        out[todo[hit]] = at[todo[hit]]
        todo = todo[~hit]
        at[todo] += 1
    return out


def removals(batches: DataFrame) -> DataFrame:
    """(_id, _mark, gone): a text's sentences that go, as bits; only texts that lose any."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = [K.unpack(x, _FOUND) for x in right.column("list").to_pylist()]
        v, c, first = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0, K.U) for _ in range(3))
        order = np.lexsort((c, v))
        v, c, first = v[order], c[order], first[order].view("<i8")
        out: tuple[list, list, list] = ([], [], [])
        for row in left.to_pylist():
            ids, marks, sizes, runs, checks = _read(row)
            at = np.concatenate([[0], np.cumsum(sizes)])
            owner = np.repeat(np.arange(len(ids)), sizes)
            cover = np.zeros(len(owner) + 1, np.int64)
            for j, (k, _) in enumerate(RUNS):
                pos = _first_of(runs[j], checks[j], v, c)
                hit = np.flatnonzero(pos >= 0)
                if not len(hit):
                    continue
                other = first[pos[hit]] < ids[owner[hit]]
                # inside the first text, all but the earliest occurrence
                key = np.lexsort((hit, pos[hit], owner[hit]))
                again = np.zeros(len(hit), bool)
                again[key] = ~_changes(pos[hit][key], owner[hit][key])
                bad = hit[other | again]
                np.add.at(cover, bad, 1)
                np.add.at(cover, bad + k, -1)
            gone = np.cumsum(cover)[:-1] > 0
            n = np.diff(np.concatenate([[0], np.cumsum(gone)])[at])
            for i in np.flatnonzero(n):
                out[0].append(int(ids[i]))
                out[1].append(int(marks[i]))
                out[2].append(np.packbits(gone[at[i] : at[i + 1]]).tobytes())
        return pa.table({"_id": pa.array(out[0], pa.int64()), "_mark": pa.array(out[1], pa.int64()), "gone": pa.array(out[2], pa.binary())})

    found = repeated_runs(batches)
    return batches.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(run, "_id long, _mark long, gone binary").dropDuplicates(["_id", "_mark"])


def dedup_spans(docs: DataFrame) -> DataFrame:
    """docs with the remaining text, n_sentences and n_removed; other columns as they are.

    A column of docs that has the name of one of these two is replaced.
    """
    bound_batches(docs.sparkSession)
    order = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    docs, others = set_aside(docs)
    lists = materialise(removals(_batches(docs)), "removed-sentences")
    d = _identified(docs).drop("text").join(lists.hint("merge"), ["_id", "_mark"], "left").drop("_id", "_mark")
    keep = [f for f in d.schema if f.name not in ("_text", "gone", "n_sentences", "n_removed")]
    d = d.select(*[F.col(f"`{f.name}`") for f in keep], "_text", "gone")
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in keep], "text string", "n_sentences long", "n_removed long"])

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for a, b, data, off in K.chunked(rb.column("_text")):
                begin, at, s, _ = sentences(data, off)
                flags = rb.column("gone").slice(a, b - a).to_pylist()
                stay, removed = np.ones(len(data), bool), np.zeros(b - a, np.int64)
                edge = np.append(s, len(data))
                for i, g in enumerate(flags):
                    if g is None:
                        continue
                    gone = np.flatnonzero(np.unpackbits(np.frombuffer(g, np.uint8), count=at[i + 1] - at[i]))
                    removed[i] = len(gone)
                    for j in gone + at[i]:
                        stay[edge[begin[j]] : min(edge[begin[j + 1]], off[i + 1])] = False
                text = data[stay].tobytes()
                cuts = np.concatenate([[0], np.cumsum(stay)])[off]
                cols = [rb.column(f.name).slice(a, b - a) for f in keep]
                cols += [pa.array([text[cuts[i] : cuts[i + 1]].decode() for i in range(b - a)], pa.string()), pa.array(np.diff(at).astype(np.int64)), pa.array(removed)]
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in keep] + ["text", "n_sentences", "n_removed"])

    back = {c: n for n, c in others}
    return d.mapInArrow(cut, schema).select(*[F.col(back.get(c, c)).alias(c) for c in order], "n_sentences", "n_removed")


def op6_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_spans(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_sentences", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), "text")


SQL = {"op6_spans": r"""
with p as (select doc_id, regexp_extract(coalesce(text, ''), '^[\x20\x09-\x0D]*') lead, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') ps from documents),
u as (select doc_id, i, ps[i] x, regexp_extract(ps[i], '^[^\x20\x09-\x0D]+') w, i = len(ps) fin from (select *, unnest(range(1, len(ps) + 1)) i from p)),
e as (select *, case when regexp_matches(w, '[.!?]$') or contains(substr(x, length(w) + 1), chr(10)) or fin then 1 else 0 end stop from u),
g as (select *, coalesce(sum(stop) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) s from e),
t as (select doc_id, s, string_agg(x, '' order by i) x, string_agg(translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' order by i) z, count(*) n from g group by doc_id, s),
l as (select *, lead(z) over o z2, lead(z, 2) over o z3, lead(n) over o n2 from t window o as (partition by doc_id order by s)),
r as (select doc_id, s, 3 k, z || ' ' || z2 || ' ' || z3 as h from l where z3 is not null union all select doc_id, s, 2, z || ' ' || z2 from l where n + n2 >= 10),
f as (select *, row_number() over (partition by k, h order by doc_id, s) o from r),
gone as (select distinct doc_id, s + j as s from (select doc_id, s, unnest(range(0, k)) j from f where o > 1)),
k as (select t.doc_id, count(*) n, count(gone.s) m, string_agg(case when gone.s is null then x else '' end, '' order by t.s) x from t left join gone on gone.doc_id = t.doc_id and gone.s = t.s group by t.doc_id)
select p.doc_id, cast(coalesce(k.n, 0) as bigint) n_sentences, cast(coalesce(k.m, 0) as bigint) n_removed, sha256(lead || coalesce(k.x, '')) kept_sha256, lead || coalesce(k.x, '') as text from p left join k using (doc_id)"""}
