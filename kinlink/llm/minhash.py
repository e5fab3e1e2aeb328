"""MinHash near-duplicate detection from bottom-k sketches of one hash function.

A text's set holds its distinct word shingles; its sketch is its ``retained`` smallest
hashes, a number that grows with the set.  Two sets link if 100 * |x & y| >= percent *
|x | y|.  No step loses a link: each bound below follows from sizes alone.

1. Inverted lists of the retained values.  All but (100 - percent) % of a set stand in
   any linked one, so of its 15 % + that many smallest values a known number is retained
   by the partner too; a text that shares fewer with any other text leaves.
2. The remaining texts' whole sets go into inverted lists; set elements are ordered by
   list length, rarest first.  Equal texts count once (their smallest id).
3. Star candidates: each list links to its most shared member.  Union sketches
   estimate the similarity and filter: of the union's smallest values no more may be
   held by one side only than a link of these two sizes allows.  Whole sets verify.
4. Candidates between different components: prefix filter with positions.  An entry
   at rank i of a set of size n only meets partners of sizes for which the elements
   from rank i on still suffice, so lists are joined on (value, size class), and only
   with at least one side outside a list's main component.  These also are estimated
   and verified.  Every linked pair is either inside a component or found here.

A hot list has one entry a block of texts in the shuffles of 1 and 2, is never gathered
or paired with itself, and in 4 its main component is only met by the few outside it.
Lists travel as 48 (in 1) or 64 (in 2) bits; equal bits of different shingles in 1 can
only make a text stay that could have left.

Defined cases: no words or null text: empty set, linked with nothing, its own
component; a very long text is one set, handled whole; repeated rows and rows that share
an id are one node, and ``keep_first`` keeps any one of those; ties of similarity need no
order, a component's smallest id is kept; a row with a null id has a null component and is
kept; columns other than doc_id and text, whatever their names, are ignored
(``keep_first`` returns them as they are); an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .components import components
from .shared import bound_batches, materialise

WORDS, PERCENT = 5, 80
#: Share of a set that its sketch holds beyond what a linked text may lack; any value is exact.
SPARE = 15
#: Values of a block of texts that is sent at once, about.
BLOCK_VALUES = 2 << 20
KEY_BYTES = 6
BATCH = "batch string, ids binary, valid binary, sizes binary, h1 binary, h2 binary, kept binary, vals binary"
_BATCH_NAMES = [x.split(" ")[0] for x in BATCH.split(", ")]


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text and each text's first."""
    low = K.LOWER[data]
    s, e, first = K.words(low, off)
    h, at = K.runs(K.Prefix(low).span(s, e), first, words, whole=True)
    row = K.row_of(at)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(off)))


def _segment_sum(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])[first])


def common_least(n: np.ndarray, percent: int) -> np.ndarray:
    """How many of its smallest common values a set of n is sure to retain with a linked set of n or more."""
    return np.minimum(-(-percent * n // 100), -(-SPARE * n // 100))


def retained(n: np.ndarray, percent: int) -> np.ndarray:
    """Size of the sketch of a set of n values.

    A linked set holds ceil(percent * n / 100) of the values or more, so the c-th
    smallest common value has at most n - that + c values up to it.
    """
    return n - -(-percent * n // 100) + common_least(n, percent)


def batches_of_sets(docs: DataFrame, words: int, percent: int | None) -> DataFrame:
    """BATCH rows, one a block of texts: ids, set sizes, set digests, and sketches or (percent None) whole sets.

    Sketches are sorted keys of KEY_BYTES bytes, whole sets sorted hashes.
    """

    def blocks(it: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        block, held = [], 0
        for batch in it:
            for a, b, data, off in K.chunked(batch.column("text")):
                h, first = shingle_sets(data, off, words)
                size = np.diff(first)
                keep = size if percent is None else retained(size, percent)
                vals = h[np.arange(len(h)) - np.repeat(first[:-1], size) < np.repeat(keep, size)]
                if percent is not None:
                    vals, owner = K.mix(vals) >> K.U(64 - 8 * KEY_BYTES), np.repeat(np.arange(b - a), keep)
                    vals = vals[np.lexsort((vals, owner))]
                ids = batch.column("doc_id").slice(a, b - a)
                block.append((ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"), ids.is_valid().to_numpy(zero_copy_only=False).astype("u1"), size.astype("<i8"),
                              _segment_sum(K.mix(h + K.U(1)), first).astype("<u8"), _segment_sum(K.mix(h ^ K.BASE), first).astype("<u8"), keep.astype("<i8"), vals.astype("<u8")))
                held += len(vals)
                if held >= BLOCK_VALUES:
                    yield block
                    block, held = [], 0
        if block:
            yield block

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(it):
            *blobs, vals = (np.concatenate(x) for x in zip(*block, strict=True))
            packed = vals.tobytes() if percent is None else K.pack([(vals, KEY_BYTES, True)])
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *[pa.array([x.tobytes()], pa.binary()) for x in blobs], pa.array([packed], pa.binary())], _BATCH_NAMES)

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(d.mapInArrow(run, BATCH), "sets")


def _unpack(row: dict, sketch: bool) -> dict[str, np.ndarray]:
    kinds = {"ids": "<i8", "valid": "u1", "sizes": "<i8", "h1": "<u8", "h2": "<u8", "kept": "<i8"}
    vals = _values(row["vals"], sketch) if "vals" in row else None
    return {k: np.frombuffer(row[k] or b"", t) for k, t in kinds.items()} | {"vals": vals}


def _values(blob: bytes, sketch: bool) -> np.ndarray:
    return K.unpack(blob, [(KEY_BYTES, True)])[0] if sketch else np.frombuffer(blob or b"", "<u8")


def list_lengths(batches: DataFrame, sketch: bool) -> DataFrame:
    """(batch, bucket, v, n): a block's values that two or more texts hold, with their numbers of texts.

    A value is sent once a block, whatever the number of its texts there, packed by bucket.
    """
    spark = batches.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = [(8, True), (4, False)]

    def send(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for row in rb.to_pylist():
                v, n = np.unique(_values(row["vals"], sketch), return_counts=True)
                to, v = v % K.U(buckets), v // K.U(buckets)
                order = np.argsort(to, kind="stable")
                cut = np.searchsorted(to[order], np.arange(buckets + 1))
                v, n = v[order], n[order].astype(K.U)
                some = [j for j in range(buckets) if cut[j + 1] > cut[j]]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([row["batch"]] * len(some), pa.string()),
                                                  pa.array([K.pack([(v[cut[j] : cut[j + 1]], 8, True), (n[cut[j] : cut[j + 1]], 4, False)]) for j in some], pa.binary())], ["bucket", "batch", "list"])

    def count(table: pa.Table) -> pa.Table:
        parts = [K.unpack(x, kind) for x in table.column("list").to_pylist()]
        _, inv = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
        total = np.bincount(inv, weights=np.concatenate([n for _, n in parts]))[inv].astype(K.U)
        out, at = [], 0
        for v, _ in parts:
            t = total[at : at + len(v)]
            at += len(v)
            out.append(K.pack([(v[t > 1], 8, True), (np.minimum(t[t > 1], K.U((1 << 32) - 1)), 4, False)]) if (t > 1).any() else None)
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "list": pa.array(out, pa.binary())})

    sent = batches.select("batch", "vals").mapInArrow(send, "bucket int, batch string, list binary")
    return sent.groupBy("bucket").applyInArrow(count, "batch string, bucket int, list binary").where("list is not null")


def _joined(pairs: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """All of a block's returned values, sorted, and their list lengths."""
    got = [(*K.unpack(x, [(8, True), (4, False)]), j) for x, j in zip(pairs.column("list").to_pylist(), pairs.column("bucket").to_pylist(), strict=True)]
    if not got:
        return np.zeros(0, "<u8"), np.zeros(0, "<u8")
    v, n = np.concatenate([v * K.U(buckets) + K.U(j) for v, _, j in got]), np.concatenate([n for _, n, _ in got])
    o = np.argsort(v)
    return v[o], n[o]


def _look_up(x: np.ndarray, v: np.ndarray, n: np.ndarray) -> np.ndarray:
    """List lengths of x; 1 where it was not returned."""
    if not len(v):
        return np.ones(len(x), np.int64)
    at = np.minimum(np.searchsorted(v, x), len(v) - 1)
    return np.where(v[at] == x, n[at], 1).astype(np.int64)


def possible(batches: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n, h1, h2) of texts whose sketch shares enough values with others."""
    buckets = int(batches.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        v, n = _joined(right, buckets)
        cols: list[list] = [[], [], [], []]
        for row in left.to_pylist():
            x = _unpack(row, sketch=True)
            first = np.concatenate([[0], np.cumsum(x["kept"])])
            shared = _segment_sum((_look_up(x["vals"], v, n) > 1).astype(np.int64), first)
            # the smallest linked partner retains the fewest
            need = common_least(-(-percent * x["sizes"] // 100), percent)
            ok = (x["sizes"] > 0) & (shared >= need) & (x["valid"] > 0)
            for c, y in zip(cols, (x["ids"], x["sizes"], x["h1"].view("<i8"), x["h2"].view("<i8")), strict=True):
                c.append(y[ok])
        return pa.table({c: pa.array(np.concatenate(y) if y else np.zeros(0, np.int64), pa.int64()) for c, y in zip(("doc_id", "n", "h1", "h2"), cols, strict=True)})

    found = list_lengths(batches, sketch=True)
    return batches.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(run, "doc_id long, n long, h1 long, h2 long")


ENTRY = "value long, node long, n long, rank long, shared long"


def prefix_entries(sets: DataFrame, percent: int) -> DataFrame:
    """ENTRY rows: each set's rarest elements that others hold, as far as a link needs them."""
    buckets = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        v, n = _joined(right, buckets)
        out: list[np.ndarray] = [np.zeros((0, 5), np.int64)]
        for row in left.to_pylist():
            x = _unpack(row, sketch=False)
            size = x["kept"]
            first = np.concatenate([[0], np.cumsum(size)])
            length = _look_up(x["vals"], v, n)
            owner = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((x["vals"], length, owner))
            value, length = x["vals"][order], length[order]
            shared = _segment_sum((length > 1).astype(np.int64), first)
            rank = np.arange(len(value)) - first[:-1][owner]
            prefix = size - -(-size * percent // 100) + 1
            ok = (rank < prefix[owner]) & (length > 1) & (100 * shared >= percent * size)[owner]
            o = owner[ok]
            out.append(np.stack([value[ok].view("<i8"), x["ids"][o], size[o], rank[ok], shared[o]], 1))
        all_rows = np.concatenate(out)
        return pa.table({c: pa.array(np.ascontiguousarray(all_rows[:, j]), pa.int64()) for j, c in enumerate(("value", "node", "n", "rank", "shared"))})

    found = list_lengths(sets, sketch=False)
    return sets.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(run, ENTRY)


def one_set_a_row(sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, vals, sketch): each text's sorted set as bytes, its size, and its retained values."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for row in rb.to_pylist():
                x = _unpack(row, sketch=False)
                first = np.concatenate([[0], np.cumsum(x["kept"])])
                parts = [x["vals"][first[i] : first[i + 1]] for i in range(len(x["ids"]))]
                keep = retained(x["kept"], percent)
                yield pa.RecordBatch.from_arrays([pa.array(x["ids"]), pa.array(x["kept"]), pa.array([p.tobytes() for p in parts], pa.binary()), pa.array([p[:k].tobytes() for p, k in zip(parts, keep, strict=True)], pa.binary())], ["node", "n", "vals", "sketch"])

    return sets.mapInArrow(run, "node long, n long, vals binary, sketch binary")


def union_sketch_estimate(x: np.ndarray, y: np.ndarray, k: int) -> float:
    """Share of the union's k smallest values that both hold; exact for unions of up to k."""
    u = np.union1d(x, y)[:k]
    return len(np.intersect1d(np.intersect1d(x, y, True), u, True)) / max(1, len(u))


def may_link(x: np.ndarray, y: np.ndarray, n: int, m: int, percent: int) -> bool:
    """Whether sets of n and m values with the sketches x and y can link, by their union sketch.

    Up to the smaller of the sketches' last values the union is known; a link has at
    most n + m - 2 * (values that it must share) values held by one side only.
    """
    last = min([int(s[-1]) for s, size in ((x, n), (y, m)) if 0 < len(s) < size], default=None)
    if last is not None:
        x, y = (s[: np.searchsorted(s, K.U(last), "right")] for s in (x, y))
    k = len(np.union1d(x, y))
    one_sided = k - round(union_sketch_estimate(x, y, k) * k)
    return one_sided <= n + m - 2 * -(-percent * (n + m) // (100 + percent))


def _keep_pairs(pairs: DataFrame, sets: DataFrame, column: str, test) -> DataFrame:
    left = sets.select(F.col("node").alias("a"), F.col(column).alias("x"), F.col("n").alias("xn"))
    right = sets.select(F.col("node").alias("b"), F.col(column).alias("y"), F.col("n").alias("yn"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            x, y, xn, yn = (rb.column(c).to_pylist() for c in ("x", "y", "xn", "yn"))
            ok = [test(np.frombuffer(x[i], "<u8"), np.frombuffer(y[i], "<u8"), xn[i], yn[i]) for i in range(rb.num_rows)]
            yield pa.RecordBatch.from_arrays([rb.column("a"), rb.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "xn", "yn").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: union sketches first, whole sets then."""
    likely = _keep_pairs(pairs, sets, "sketch", lambda x, y, n, m: may_link(x, y, n, m, percent))

    def exact(x: np.ndarray, y: np.ndarray, n: int, m: int) -> bool:
        both = len(np.intersect1d(x, y, True))
        return 100 * both >= percent * (n + m - both)

    return _keep_pairs(materialise(likely, "likely"), sets, "vals", exact)


def star_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """Each list's members with its most shared one, sizes permitting."""
    top = entries.groupBy("value").agg(F.max_by(F.struct("node", "n"), F.struct(F.col("shared") / F.col("n"), -F.col("node"))).alias("p"), F.count(F.lit(1)).alias("m")).where("m > 1")
    e = entries.select("value", "node", "n").join(top.select("value", F.col("p.node").alias("pn"), F.col("p.n").alias("ps")), "value")
    e = e.where((F.col("node") != F.col("pn")) & (100 * F.least("n", "ps") >= percent * F.greatest("n", "ps")))
    return e.select(F.least("node", "pn").alias("a"), F.greatest("node", "pn").alias("b")).distinct()


def outside_pairs(entries: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that prefixes, positions and sizes allow.

    The smaller partner x meets the larger y on (value, class of x's size); y lists
    the classes of the sizes it can meet from its rank on.
    """
    width = 1.01
    need = lambda a, b: F.ceil(percent * (a + b) / (100 + percent))
    cls = lambda n: F.floor(F.log(n.cast("double")) / F.log(F.lit(width)) + 1e-9).cast("int")
    e = entries.join(roots.withColumnRenamed("node", "node_"), F.col("node") == F.col("node_"), "left").select("value", "node", "n", "rank", F.coalesce("root", "node").alias("comp"))
    mixed = e.groupBy("value").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 < c1").select("value")
    e = materialise(e.join(mixed, "value"), "mixed-entries")
    rest = F.col("n") - F.col("rank")
    small = e.where(rest >= need(F.col("n"), F.col("n"))).withColumn("size", cls(F.col("n")))
    lo = F.ceil(F.col("n") * percent / 100)
    hi = F.least(F.col("n"), F.floor(rest * (100 + percent) / percent) - F.col("n"))
    large = e.where(hi >= lo).withColumn("size", F.explode(F.sequence(cls(lo), cls(hi))))
    keys = ["value", "size"]
    counts = small.select(*keys, "comp").union(large.select(*keys, "comp")).groupBy(*keys, "comp").agg(F.count(F.lit(1)).alias("m"))
    main = counts.groupBy(*keys).agg(F.max_by("comp", F.struct("m", -F.col("comp"))).alias("main"), F.count(F.lit(1)).alias("comps")).where("comps > 1").select(*keys, "main")
    main = materialise(main, "mixed-lists")
    s = materialise(small.join(main, keys).select(*keys, F.struct("node", "n", "rank", "comp").alias("x"), (F.col("comp") == F.col("main")).alias("xm")), "small-side")
    l = materialise(large.join(main, keys).select(*keys, F.struct("node", "n", "rank", "comp").alias("y"), (F.col("comp") == F.col("main")).alias("ym")), "large-side")
    x, y = F.col("x"), F.col("y")
    met = (x["comp"] != y["comp"]) & (x["n"] <= y["n"]) & (x["n"] - x["rank"] >= need(x["n"], y["n"])) & (y["n"] - y["rank"] >= need(x["n"], y["n"]))
    pairs = s.where("not xm").join(l, keys).where(met).select("x", "y").union(s.where("xm").join(l.where("not ym"), keys).where(met).select("x", "y"))
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept."""
    bound_batches(docs.sparkSession)
    batches = batches_of_sets(docs, words, percent)
    alive = materialise(possible(batches, percent), "possible")
    classes = materialise(alive.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("node")), "classes")
    chosen = docs.select("doc_id", "text").join(classes.select(F.col("node").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    sets = batches_of_sets(chosen, words, None)
    each = materialise(one_set_a_row(sets, percent), "set-rows")
    entries = materialise(prefix_entries(sets, percent), "entries")
    stars = materialise(verified(materialise(star_pairs(entries, percent), "stars"), each, percent), "star-links")
    roots = components(stars)
    more = materialise(verified(materialise(outside_pairs(entries, roots, percent), "outside"), each, percent), "outside-links")
    if not more.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    labelled = classes.join(roots, "node", "left").select("n", "h1", "h2", F.coalesce("root", "node").alias("root"))

    def narrow(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for row in rb.to_pylist():
                x = _unpack(row, sketch=True)
                yield pa.RecordBatch.from_arrays([pa.array(x["ids"], mask=x["valid"] == 0), pa.array(x["sizes"]), pa.array(x["h1"].view("<i8")), pa.array(x["h2"].view("<i8"))], ["doc_id", "n", "h1", "h2"])

    d = batches.drop("vals").mapInArrow(narrow, "doc_id long, n long, h1 long, h2 long").join(labelled, ["n", "h1", "h2"], "left")
    # rows that share an id are one node
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return d.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component: its smallest id; rows without an id all stay.

    Of rows that share a kept id one stays.
    """
    kept = near_duplicates(docs, percent).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    rows = docs.join(kept.hint("merge"), docs["doc_id"] == kept["_kept"], "left_semi").dropDuplicates(["doc_id"])
    return rows.union(docs.where(docs["doc_id"].isNull()))


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), 85)


SQL = {"op1_minhash": r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) end) as g from w),
n as (select doc_id, count(*) n from s group by doc_id),
x as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
l as (select a, b from x join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 85 * (na.n + nb.n - c)),
r as (select doc_id, doc_id as c from documents union select r.doc_id, l.b from r join l on l.a = r.c),
m as (select doc_id, min(c) c from r group by doc_id)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, m.c as component_id, d.doc_id = m.c as kept from documents d join m using (doc_id) left join n using (doc_id)"""}
