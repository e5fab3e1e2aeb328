"""Benchmark decontamination: a BM25 index of test items searched by every passage.

Every text is cut into passages of ``2 * stride`` words, ``stride`` apart, where stride
is at least the longest item, so each planted item lies whole in some passage.  The
inverted index holds, for each term, its BM25 impact on each item divided by the
item's score for its own text: a passage with all of an item's terms scores 1.  The
item range is cut into blocks and every list keeps its largest impact in each block.

Retrieval is exact for all items scoring ``threshold`` or more: block bounds of a
whole Arrow batch are summed in numpy, a passage whose bounds fail in every block has
no pivot and ends there; the others run block-max WAND over the blocks that are left.
Retrieved items are verified: of the words of the question and of the words of the
answer (the item's last sentence, or last fifth) the share ``overlap`` must lie in
five-word shingles that the passage has.  An answer shorter than a shingle counts with
the words before it, up to five, each of which may also follow the item's last shingle in
the passage word by word: one edit at the item's end does not hide it.

An item of fewer than five words is one sequence, which must stand in the passage whole.

Items are gathered in shards of ``SHARD_BYTES`` of text, with document frequencies counted
over all items; a scan of the corpus broadcasts as many shards as fit ``SCAN_BYTES`` of
measured index.  An index has one bound for each term and block that the term occurs in.

Defined cases: a null text is empty; a text without words matches nothing, an item without
words is no item; a very long text is cut into passages like any other; of a text's
passages the best (score, then overlaps) is reported; repeated texts report each row's id
(once per id and item), and equal items all count; a null id is reported as null; columns
other than doc_id, item_id and text, whatever their names, are not read (``drop_leaks``
returns those of docs as they are); no items or no texts: no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .shared import bound_batches, materialise

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, SHINGLE = 0.5, 0.8, 5
MIN_STRIDE, BLOCKS = 64, 64
#: Item text of an index, about, and bytes of indexes broadcast to a scan, about.
SHARD_BYTES, SCAN_BYTES = 8 << 20, 128 << 20
GAP = np.ones(256, bool)
GAP[48:58] = GAP[65:91] = GAP[97:123] = False
GAP[128:] = False
_WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
FOUND = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def _terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = K.LOWER[data]
    s, e, first = K.words(low, off, GAP)
    return K.mix(K.Prefix(low).span(s, e)), first


def terms_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return _terms(data, np.array([0, len(data)]))[0]


def _answer_start(text: str, n: int) -> int:
    """Words before the answer: those before the last sentence, or four fifths."""
    cuts = [len(_WORD.findall(text[: m.end()])) for m in re.finditer(r"[.!?]\s+|\n+", text)]
    inside = [c for c in cuts if 0 < c < n]
    return inside[-1] if inside else n - max(1, n // 5)


@dataclass
class Index:
    """Items, impacts and block bounds; items are numbered in order of their ids."""

    item_ids: list[int | None]
    terms: np.ndarray  # sorted term hashes
    start: np.ndarray  # each term's first posting
    items: np.ndarray  # postings: item numbers, ascending in each list
    impacts: np.ndarray
    block: int  # items a block
    blocks: int
    bound_start: np.ndarray  # each term's first bound
    bound_block: np.ndarray
    bound: np.ndarray  # largest impact of the term in that block
    words: list[np.ndarray]
    answers: list[int]

    def term_ids(self, h: np.ndarray) -> np.ndarray:
        if not len(self.terms):
            return np.full(len(h), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1)

    def bytes(self) -> int:
        return sum(x.nbytes for x in (self.terms, self.start, self.items, self.impacts, self.bound_start, self.bound_block, self.bound, *self.words))

    def bounds_of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which of the terms, block, bound) of all bounds of the terms."""
        n = self.bound_start[terms + 1] - self.bound_start[terms]
        to = np.cumsum(n)
        at = np.arange(to[-1] if len(to) else 0) - np.repeat(to - n - self.bound_start[terms], n)
        return np.repeat(np.arange(len(terms)), n), self.bound_block[at], self.bound[at]

    def search(self, terms: np.ndarray, threshold: float, blocks: np.ndarray | None = None) -> list[tuple[int, float]]:
        """Block-max WAND: all items whose score for the distinct ``terms`` reaches threshold."""
        out = []
        which, block, bound = self.bounds_of(terms)
        bounds = np.zeros((len(terms), self.blocks), np.float32)
        bounds[which, block] = bound
        for k in range(self.blocks) if blocks is None else blocks:
            use = np.flatnonzero(bounds[:, k] > 0)
            lists = [(self.items[a:b], self.impacts[a:b]) for a, b in zip(self.start[terms[use]], self.start[terms[use] + 1], strict=True)]
            tops = bounds[use, k]
            end = (k + 1) * self.block
            at = [int(np.searchsorted(x, k * self.block)) for x, _ in lists]
            live = [j for j in range(len(lists)) if at[j] < len(lists[j][0]) and lists[j][0][at[j]] < end]
            while live:
                live.sort(key=lambda j: lists[j][0][at[j]])
                total, pivot = 0.0, -1
                for i, j in enumerate(live):
                    total += tops[j]
                    if total >= threshold - 1e-12:
                        pivot = i
                        break
                if pivot < 0:
                    break
                item = lists[live[pivot]][0][at[live[pivot]]]
                if lists[live[0]][0][at[live[0]]] == item:
                    score = 0.0
                    for j in live:
                        if lists[j][0][at[j]] == item:
                            score += float(lists[j][1][at[j]])
                            at[j] += 1
                    if score >= threshold - 1e-12:
                        out.append((int(item), score))
                else:
                    for j in live[:pivot]:
                        if lists[j][0][at[j]] < item:
                            at[j] = int(np.searchsorted(lists[j][0], item))
                live = [j for j in live if at[j] < len(lists[j][0]) and lists[j][0][at[j]] < end]
        return out


def build_index(rows: list[tuple[int | None, str]], n_items: int, mean_words: float, df: dict[int, int]) -> Index:
    """rows: (item_id, text) of a shard; df: term hash -> items of the whole benchmark that hold it."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
    words = [terms_of(t) for _, t in rows]
    posting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i, w in enumerate(words):
        t, tf = np.unique(w, return_counts=True)
        d = np.array([df[int(x)] for x in t], float)
        idf = np.log(1 + (n_items - d + 0.5) / (d + 0.5))
        impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean_words))
        posting.append((t, np.full(len(t), i), impact / impact.sum()))
    t, i, x = (np.concatenate([p[j] for p in posting]) if posting else np.zeros(0, [K.U, np.int64, float][j]) for j in range(3))
    order = np.lexsort((i, t))
    t, i, x = t[order], i[order], x[order]
    terms, start = np.unique(t, return_index=True)
    start = np.append(start, len(t))
    block = max(1, -(-len(rows) // BLOCKS))
    blocks = max(1, -(-len(rows) // block))
    key, at = np.unique(np.repeat(np.arange(len(terms)), np.diff(start)) * blocks + i // block, return_inverse=True)
    bound = np.zeros(len(key), np.float32)
    np.maximum.at(bound, at, np.nextafter(x.astype(np.float32), np.float32(2)))
    return Index([r[0] for r in rows], terms, start, i, x, block, blocks, np.searchsorted(key, np.arange(len(terms) + 1) * blocks), (key % blocks).astype(np.int32), bound,
                 words, [_answer_start(r[1], len(w)) for r, w in zip(rows, words, strict=True)])


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    best = [0] * (len(y) + 1)
    for a in x.tolist():
        last = 0
        for j, b in enumerate(y.tolist(), 1):
            last, best[j] = best[j], last + 1 if a == b else max(best[j], best[j - 1])
    return best[-1]


def overlaps(item: np.ndarray, answer: int, passage: np.ndarray) -> tuple[float, float]:
    """Shares of the question's and the answer's words in five-word shingles of the passage; short answers as above."""
    n = min(SHINGLE, len(item))
    if not n or len(passage) < n:
        return 0.0, 0.0
    sh = lambda w: K.runs(w, np.array([0, len(w)]), n, whole=False)[0]
    if len(item) < SHINGLE:
        return (1.0, 1.0) if sh(item)[0] in sh(passage) else (0.0, 0.0)
    own, other = sh(item), sh(passage)
    hit = np.isin(own, other)
    mark = np.zeros(len(item) + 1, np.int64)
    np.add.at(mark, np.flatnonzero(hit), 1)
    np.add.at(mark, np.flatnonzero(hit) + n, -1)
    covered = np.cumsum(mark)[:-1] > 0
    q, a = float(covered[:answer].mean()), float(covered[answer:].mean())
    if len(item) - answer < n and hit.any() and not hit[-1]:
        i = int(np.flatnonzero(hit)[-1])
        # one word more than the item has from there: an inserted one
        a = max(a, *(_common(item[-n:], passage[p : p + len(item) - i + 1]) / n for p in np.flatnonzero(other == own[i])))
    return q, a


def search_chunk(index: Index, data: np.ndarray, off: np.ndarray, stride: int, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
    """(text, item, score, question overlap, answer overlap): best passage of every verified pair."""
    h, first = _terms(data, off)
    tid = index.term_ids(h)
    size = np.diff(first)
    pieces = -(-size // stride)
    p_first = np.concatenate([[0], np.cumsum(pieces)])
    if not p_first[-1]:
        return []
    # bounds of every passage by block, each of its terms once; a passage is two pieces
    row = np.repeat(np.arange(len(size)), size)
    known = np.flatnonzero(tid >= 0)
    piece = p_first[row[known]] + (known - first[row[known]]) // stride
    owner = np.repeat(np.arange(len(size)), pieces)
    back = np.flatnonzero((piece > 0) & (owner[np.maximum(piece - 1, 0)] == owner[piece]))
    width = len(index.terms) + 1
    key = np.unique(np.concatenate([piece * width + tid[known], (piece[back] - 1) * width + tid[known][back]]))
    which, block, bound = index.bounds_of(key % width)
    sums = np.bincount((key // width)[which] * index.blocks + block, weights=bound, minlength=p_first[-1] * index.blocks).reshape(-1, index.blocks)
    alive = sums >= threshold - 1e-3
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for p in np.flatnonzero(alive.any(1)):
        i = int(owner[p])
        a = first[i] + (p - p_first[i]) * stride
        b = min(a + 2 * stride, first[i + 1])
        terms = np.unique(tid[a:b])
        for item, score in index.search(terms[terms >= 0], threshold, np.flatnonzero(alive[p])):
            q, w = overlaps(index.words[item], index.answers[item], h[a:b])
            if q >= overlap and w >= overlap:
                best[i, item] = max(best.get((i, item), (0.0, 0.0, 0.0)), (score, q, w))
    return [(i, item, *x) for (i, item), x in best.items()]


@dataclass
class Shard:
    """One part of the benchmark: its index, and how to search with it."""

    index: Index
    stride: int


def shards_of(benchmark: DataFrame) -> Iterator[Shard]:
    """The benchmark in parts of about SHARD_BYTES, with statistics of all of it; none if it has no items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()

    def tokenise(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for a, b, data, off in K.chunked(rb.column("text")):
                h, first = _terms(data, off)
                parts = [np.unique(h[first[i] : first[i + 1]]).view(np.int64).tolist() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([rb.column("item_id").slice(a, b - a), rb.column("text").slice(a, b - a), pa.array(np.diff(first)), pa.array(parts, pa.list_(pa.int64()))], ["item_id", "text", "n", "terms"])

    parsed = materialise(items.mapInArrow(tokenise, "item_id long, text string, n long, terms array<long>").where("n > 0"), "items")
    size = parsed.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("w"), F.max("n").alias("m"), F.sum(F.length("text")).alias("b")).first()
    if not size["n"]:
        return
    stride, shards = max(MIN_STRIDE, size["m"]), -(-size["b"] // SHARD_BYTES)
    df = materialise(parsed.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")), "item-terms")
    for k in range(shards):
        shard = parsed.where(F.pmod(F.xxhash64("text"), F.lit(shards)) == k)
        rows = [(r["item_id"], r["text"]) for r in shard.select("item_id", "text").collect()]
        known = {r["term"] & (1 << 64) - 1: r["df"] for r in shard.select(F.explode("terms").alias("term")).distinct().join(df, "term").collect()}
        yield Shard(build_index(rows, size["n"], size["w"] / size["n"], known), stride)


def scans_of(benchmark: DataFrame) -> Iterator[list[Shard]]:
    """Shards that one scan of the corpus searches together."""
    held: list[Shard] = []
    for shard in shards_of(benchmark):
        if held and sum(s.index.bytes() for s in held) + shard.index.bytes() > SCAN_BYTES:
            yield held
            held = []
        held.append(shard)
    if held:
        yield held


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every verified pair."""
    spark = docs.sparkSession
    bound_batches(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], FOUND)
    for shards in scans_of(benchmark):
        held = spark.sparkContext.broadcast(shards)

        def run(it: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for rb in it:
                for a, b, data, off in K.chunked(rb.column("text")):
                    ids = rb.column("doc_id").slice(a, b - a).to_pylist()
                    for shard in held.value:
                        got = search_chunk(shard.index, data, off, shard.stride, threshold, overlap)
                        cols = [[ids[g[0]] for g in got], [shard.index.item_ids[g[1]] for g in got], *[[g[j] for g in got] for j in (2, 3, 4)]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), *[pa.float64()] * 3], strict=True)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        found = found.union(d.mapInArrow(run, FOUND))
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """docs without the rows that hold a verified item; no shuffle."""
    spark = docs.sparkSession
    bound_batches(spark)
    column = docs.columns.index("text")
    for shards in scans_of(benchmark):
        held = spark.sparkContext.broadcast(shards)

        def run(it: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for rb in it:
                stay = np.ones(rb.num_rows, bool)
                for a, _, data, off in K.chunked(rb.column(column)):
                    for shard in held.value:
                        stay[[a + g[0] for g in search_chunk(shard.index, data, off, shard.stride, threshold, overlap)]] = False
                yield rb.filter(pa.array(stay))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
