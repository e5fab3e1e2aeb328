"""Exact substring dedup over bytes by a sparse, hash-compared suffix sort.

A byte goes if it lies in a ``SPAN``-byte string that also starts in a document of a
smaller id.  Of every such string one ``GRAM``-byte piece, its minimal hash, is an
anchor, chosen by content alone, so equal strings have their anchors at equal offsets.

1. Anchors meet by content (bucketed by hash; a batch sends the smallest id of equal
   contexts only).  An anchor whose whole context - every byte that a string around it
   can reach - stands in a smaller document is settled: all of its context goes.
2. The others, if their piece has several contexts, send those bytes.  Per piece the
   suffixes to the right and, reversed, to the left of the anchors are sorted by
   mergesort; two suffixes are compared by their longest common extension, found by
   binary search over prefix polynomial hashes, and the bytes of sorted neighbours are
   then compared, so a hash collision is noticed and sorted again by bytes.  Suffixes
   that share r bytes are neighbours, so every SPAN-byte string around an anchor is a
   pair of intervals, one a side, and its smallest document follows from integers.
3. Documents meet their settled contexts and intervals; remaining bytes are hashed.

Contexts are compared in step 1 by 104 bits (40 of the piece, 64 of the whole context)
and not by bytes: among all contexts of 100 TB about 1e-6 pairs would be taken for equal.
Hot strings cost one entry a block of texts in step 1 and one for each different context
in step 2; those of one piece are sorted in one task.

Defined cases: a null text is empty; texts shorter than SPAN lose nothing; a very long
text is handled whole, matches may lie anywhere in it; rows that share an id do not
remove each other's bytes, and repeated rows get equal results; of equal strings those of
the smallest id stay; a null id ranks after all ids; columns other than doc_id and text,
whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .kernel import pack, unpack
from .shared import bound_batches, materialise
from .spans import _identified

SPAN, GRAM = 50, 24
EXT = SPAN - GRAM
#: Anchors of a block of texts that is sent at once, about.
BLOCK_ANCHORS = 1 << 19


def _window_min(h: np.ndarray, w: int) -> np.ndarray:
    n = 1
    m = h
    while n * 2 <= w:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    size = len(h) - w + 1
    return np.minimum(m[:size], m[w - n : w - n + size]) if n < w else m


def anchors(data: np.ndarray, off: np.ndarray, px: K.Prefix) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, piece hashes and text numbers of all anchors."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < SPAN:
        return none, none.astype(K.U), none
    h = K.mix(px.windows(GRAM))
    low = _window_min(h, EXT + 1)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    fits = np.arange(len(low)) + SPAN <= off[1:][row[: len(low)]]
    low = np.where(fits, low, K.U(0))
    mark = np.zeros(len(h), bool)
    for j in range(EXT + 1):
        mark[j : j + len(low)] |= h[j : j + len(low)] == low
    p = np.flatnonzero(mark)
    return p, h[p], row[p]


ENTRY = [(5, False), (8, False), (8, True), (4, True), (4, True)]  # piece, context, id, text number, position
SENT = "bucket int, batch string, kind int, ids binary, a binary, b binary"
_SENT = [x.split(" ")[0] for x in SENT.split(", ")]


def _anchored(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of texts: ids, marks, text starts, and each anchor's text, position, piece and context."""
    parts, held = [], 0
    for rb in it:
        for a, b, data, off in K.chunked(rb.column("_text")):
            ids, marks = (rb.column(c).slice(a, b - a).to_numpy(zero_copy_only=False).astype("<i8") for c in ("_id", "_mark"))
            px = K.Prefix(data)
            p, piece, row = anchors(data, off, px)
            lo, hi = np.maximum(p - EXT, off[row]), np.minimum(p + SPAN, off[row + 1])
            parts.append((ids, marks, np.diff(off), row, p, piece, K.mix(px.span(lo, hi) + (p - lo).astype(K.U) * K.BASE)))
            held += len(p)
            if held >= BLOCK_ANCHORS:
                yield _block(parts)
                parts, held = [], 0
    if parts:
        yield _block(parts)


def _block(parts: list[tuple]) -> tuple[np.ndarray, ...]:
    texts = np.cumsum([0, *(len(x[0]) for x in parts)])
    bytes_ = np.cumsum([0, *(int(x[2].sum()) for x in parts)])
    moved = [(i, m, n, row + t, p + at, piece, context) for (i, m, n, row, p, piece, context), t, at in zip(parts, texts, bytes_, strict=False)]
    ids, marks, size, row, p, piece, context = (np.concatenate(x) for x in zip(*moved, strict=True))
    return ids, marks, np.concatenate([[0], np.cumsum(size)]), row, p, piece, context


def _send_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """kind 0: a block's ids, marks, text starts and anchors settled inside it; kind 1: its entries for a bucket."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, marks, off, row, p, piece, context in _anchored(it):
            name = uuid.uuid4().hex
            to, piece = (piece & K.U(0xFFFFFF)) % K.U(buckets), piece >> K.U(24)
            order = np.lexsort((ids[row], context, piece))
            new = np.ones(len(p), bool)
            new[1:] = (piece[order][1:] != piece[order][:-1]) | (context[order][1:] != context[order][:-1])
            low = np.empty(len(p), np.int64)
            low[order] = ids[row[order]][new][np.cumsum(new) - 1]
            out = ids[row] == low
            here = np.flatnonzero(~out)
            rows = [(buckets + int(name[:6], 16) % buckets, name, 0, ids.tobytes() + marks.tobytes() + off.astype("<i8").tobytes(), pack([(row[here], 4, True), (p[here], 4, True)]), b"")]
            out = np.flatnonzero(out)
            out = out[np.argsort(to[out], kind="stable")]
            cut = np.searchsorted(to[out], np.arange(buckets + 1))
            for j in range(buckets):
                e = out[cut[j] : cut[j + 1]]
                if len(e):
                    rows.append((j, name, 1, b"", pack([(x, *how) for x, how in zip((piece[e], context[e], ids[row[e]].view("<u8"), row[e], p[e]), ENTRY, strict=True)]), b""))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), pa.string(), pa.int32(), *[pa.binary()] * 3], strict=True)], _SENT)

    return docs.select("_id", "_mark", "_text").mapInArrow(run, SENT)


def _settle(table: pa.Table) -> pa.Table:
    """Kind 1 rows become each batch's settled (a) and open (b) anchors: text number, position."""
    t = table.to_pylist()
    passed = [r for r in t if r["kind"] == 0]
    rows = [r for r in t if r["kind"] == 1]
    if rows:
        parts = [unpack(r["a"], ENTRY) for r in rows]
        piece, context, ids = (np.concatenate([p[j] for p in parts]) for j in range(3))
        ids = ids.view("<i8")
        order = np.lexsort((ids, context, piece))
        ps, cs, ds = piece[order], context[order], ids[order]
        np_ = np.concatenate([[True], ps[1:] != ps[:-1]])
        nc = np_ | np.concatenate([[True], cs[1:] != cs[:-1]])
        low = ds[nc][np.cumsum(nc) - 1]
        group = np.cumsum(np_) - 1
        start = np.flatnonzero(np_)
        many = (np.bincount(group, weights=nc) > 1) & (np.minimum.reduceat(ds, start) < np.maximum.reduceat(ds, start))
        settled, open_ = np.empty(len(ds), bool), np.empty(len(ds), bool)
        settled[order] = ds > low
        open_[order] = (ds == low) & many[group]
        at = 0
        for r, p in zip(rows, parts, strict=True):
            n = len(p[0])
            s, o = settled[at : at + n], open_[at : at + n]
            at += n
            r |= {"a": pack([(p[3][s], 4, True), (p[4][s], 4, True)]) if s.any() else b"", "b": pack([(p[3][o], 4, True), (p[4][o], 4, True)]) if o.any() else b""}
        rows = [r for r in rows if r["a"] or r["b"]]
    kept = passed + rows
    return pa.table({c: pa.array([r[c] for r in kept], t) for c, t in zip(_SENT[1:], [pa.string(), pa.int32(), *[pa.binary()] * 3], strict=True)})


def _by_text(table: pa.Table) -> pa.Table:
    """One row for each text of a batch that has anchors: id, mark and their positions in it."""
    rows = table.to_pylist()
    meta = next(r for r in rows if r["kind"] == 0)
    n = (len(meta["ids"]) // 8 - 1) // 3
    x = np.frombuffer(meta["ids"], "<i8")
    ids, marks, off = x[:n], x[n : 2 * n], x[2 * n :]
    lists = []
    for c in ("a", "b"):
        got = [unpack(r[c], [(4, True), (4, True)]) for r in rows if r[c]]
        row = np.concatenate([np.zeros(0, np.int64), *[g[0].astype(np.int64) for g in got]])
        p = np.concatenate([np.zeros(0, np.int64), *[g[1].astype(np.int64) for g in got]])
        o = np.argsort(p, kind="stable")
        row, p = row[o], p[o] - off[row[o]]
        lists.append((p, np.searchsorted(row, np.arange(n + 1))))
    have = np.flatnonzero((np.diff(lists[0][1]) > 0) | (np.diff(lists[1][1]) > 0))
    blobs = [[pack([(p[at[i] : at[i + 1]], 4, True)]) if at[i + 1] > at[i] else b"" for i in have] for p, at in lists]
    return pa.table({"_id": pa.array(ids[have]), "_mark": pa.array(marks[have]), "a": pa.array(blobs[0], pa.binary()), "b": pa.array(blobs[1], pa.binary())})


class Suffixes:
    """Bounded suffixes of one buffer, compared by longest common extension."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.data, self.start, self.size, self.px = data, start, size, K.Prefix(data)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common prefix of suffixes i and j, by binary search over prefix hashes."""
        hi = np.minimum(self.size[i], self.size[j])
        lo = np.zeros_like(hi)
        a, b = self.start[i], self.start[j]
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = self.px.span(a, a + mid) == self.px.span(b, b + mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.extension(i, j)
        i_ends, j_ends = n == self.size[i], n == self.size[j]
        last = len(self.data) - 1
        byte = self.data[np.minimum(self.start[i] + n, last)] < self.data[np.minimum(self.start[j] + n, last)]
        return np.where(i_ends & j_ends, or_equal, np.where(i_ends, True, np.where(j_ends, False, byte)))

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order by (group, suffix) and the common prefix of each element with the one before it.

        group: ascending numbers.  All groups are merged at once, level by level.
        """
        n = len(group)
        order = np.arange(n)
        first = np.concatenate([[0], np.flatnonzero(group[1:] != group[:-1]) + 1, [n]]) if n else np.zeros(1, np.int64)
        size = np.diff(first)
        width = 1
        while n and width < size.max():
            big = np.repeat(size > width, size)
            e = np.flatnonzero(big)
            g0, gn = np.repeat(first[:-1], size)[e], np.repeat(size, size)[e]
            at = e - g0
            block = at // (2 * width) * (2 * width)
            right = at - block >= width
            other = np.where(right, block, np.minimum(block + width, gn))
            end = np.where(right, block + width, np.minimum(block + 2 * width, gn))
            lo, hi = other.copy(), end.copy()
            todo = np.flatnonzero(lo < hi)
            while len(todo):
                mid = (lo[todo] + hi[todo]) >> 1
                before = self.less(order[g0[todo] + mid], order[e[todo]], right[todo])
                lo[todo] = np.where(before, mid + 1, lo[todo])
                hi[todo] = np.where(before, hi[todo], mid)
                todo = todo[lo[todo] < hi[todo]]
            own = at - block - np.where(right, width, 0)
            moved = order.copy()
            moved[g0 + block + own + lo - other] = order[e]
            order = moved
            width *= 2
        lcp = np.zeros(n, np.int64)
        if n > 1:
            near = np.flatnonzero(group[1:] == group[:-1])
            i, j = order[near], order[near + 1]
            lcp[near + 1] = self.extension(i, j)
            if not self._verified(i, j, lcp[near + 1]):
                return self._by_bytes(group)
        return order, lcp

    def _verified(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> bool:
        """The common prefixes hold byte for byte, and the next bytes are in order."""
        for k in range(int(n.max(initial=0))):
            use = np.flatnonzero(n > k)
            if (self.data[self.start[i[use]] + k] != self.data[self.start[j[use]] + k]).any():
                return False
        return True

    def _by_bytes(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = [self.data[s : s + n].tobytes() for s, n in zip(self.start, self.size, strict=True)]
        order = np.array(sorted(range(len(text)), key=lambda i: (group[i], text[i])), np.int64)
        lcp = np.zeros(len(text), np.int64)
        for k in range(1, len(order)):
            x, y = text[order[k - 1]], text[order[k]]
            if group[order[k]] == group[order[k - 1]]:
                lcp[k] = next((m for m, (c, d) in enumerate(zip(x, y, strict=False)) if c != d), min(len(x), len(y)))
        return order, lcp


def covered_offsets(data: np.ndarray, start: np.ndarray, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """(fragments, EXT + 1): whether the SPAN-byte string from ``o`` bytes before the anchor stands in a smaller document.

    A fragment is left bytes, the GRAM-byte piece and right bytes, from start on.
    """
    n = len(start)
    out = np.zeros((n, EXT + 1), bool)
    if not n:
        return out
    mid = start + left
    piece = np.stack([data[mid + k] for k in range(GRAM)], 1)
    order = np.lexsort((ids, *[w for w in np.ascontiguousarray(piece).view("<u8").T]))
    same = (piece[order][1:] == piece[order][:-1]).all(1)
    group = np.concatenate([[0], np.cumsum(~same)])
    start, left, right, ids, mid = start[order], left[order], right[order], ids[order], mid[order]
    flip = data[::-1]
    sides = []
    for buf, at, size in ((data, mid + GRAM, right), (flip, len(data) - mid, left)):
        o, lcp = Suffixes(buf, at, size).sort(group)
        head = np.concatenate([[True], group[1:] != group[:-1]])
        sides.append((o, lcp, head))
    number = []
    for o, lcp, head in sides:
        per = np.empty((EXT + 1, n), np.int32)
        for r in range(EXT + 1):
            per[r, o] = np.cumsum(head | (lcp < r))
        number.append(per)
    found = np.zeros((n, EXT + 1), bool)
    for o in range(EXT + 1):
        r = EXT - o
        use = np.flatnonzero((left >= o) & (right >= r))
        if not len(use):
            continue
        key = number[1][o, use].astype(np.int64) * (n + 1) + number[0][r, use]
        by = np.lexsort((ids[use], key))
        new = np.concatenate([[True], key[by][1:] != key[by][:-1]])
        low = ids[use][by][new][np.cumsum(new) - 1]
        found[use[by], o] = ids[use][by] > low
    out[order] = found
    return out


FRAGMENT = [(8, True), (8, False), (1, False), (1, False)]  # id, mark, left, right
PLACE = [(4, True), (4, True)]  # number of a fragment, its position


def _distinct(data: np.ndarray, px: K.Prefix, row: np.ndarray, lo: np.ndarray, p: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of a text's fragments of equal bytes around equal anchors, and the number of each fragment's one.

    A text that repeats a few bytes has an anchor at every one of them, but few fragments.
    Hashes find the equal ones and bytes confirm them.
    """
    order = np.lexsort((px.span(lo, hi), p - lo, hi - lo, row))
    i, j = order[1:], order[:-1]
    h = px.span(lo[order], hi[order])
    same = (h[1:] == h[:-1]) & (row[i] == row[j]) & (p[i] - lo[i] == p[j] - lo[j]) & (hi[i] - lo[i] == hi[j] - lo[j])
    for k in range(EXT + SPAN):
        use = np.flatnonzero(same)
        use = use[lo[i[use]] + k < hi[i[use]]]
        if not len(use):
            break
        same[use[data[lo[i[use]] + k] != data[lo[j[use]] + k]]] = False
    new = np.concatenate([[True], ~same])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _send_fragments(texts: DataFrame, buckets: int) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for a, b, data, off in K.chunked(rb.column("_text")):
                got = [unpack(x, [(4, True)])[0].astype(np.int64) if x else np.zeros(0, np.int64) for x in rb.column("b").slice(a, b - a).to_pylist()]
                row = np.repeat(np.arange(b - a), [len(g) for g in got])
                if not len(row):
                    continue
                p = np.concatenate(got) + off[row]
                lo, hi = np.maximum(p - EXT, off[row]), np.minimum(p + SPAN, off[row + 1])
                px = K.Prefix(data)
                to = (K.mix(px.span(p, p + GRAM)) >> K.U(16)) % K.U(buckets)
                ids, marks = (rb.column(c).slice(a, b - a).to_numpy(zero_copy_only=False).astype("<i8") for c in ("_id", "_mark"))
                one, number = _distinct(data, px, row, lo, p, hi)
                order = np.lexsort((p, number, to))
                cut = np.searchsorted(to[order], np.arange(buckets + 1))
                rows = []
                for j in range(buckets):
                    e = order[cut[j] : cut[j + 1]]
                    if len(e):
                        some, at = np.unique(number[e], return_inverse=True)
                        f = one[some]
                        size = hi[f] - lo[f]
                        copied = np.repeat(lo[f] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                        rows.append((j, pack([(ids[row[f]].view("<u8"), 8, True), (marks[row[f]].view("<u8"), 8, False), (p[f] - lo[f], 1, False), (hi[f] - p[f] - GRAM, 1, False)]),
                                     pack([(at, 4, True), (p[e] - off[row[e]], 4, True)]), zstandard.ZstdCompressor(level=1).compress(data[copied].tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), *[pa.binary()] * 3], strict=True)], ["bucket", "head", "places", "bytes"])

    return texts.mapInArrow(run, "bucket int, head binary, places binary, bytes binary")


def _sort_fragments(table: pa.Table) -> pa.Table:
    """(_id, _mark, spans): covered intervals of each text, as start and end positions."""
    heads = [unpack(x, FRAGMENT) for x in table.column("head").to_pylist()]
    data = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(x) for x in table.column("bytes").to_pylist()), np.uint8)
    ids, marks, left, right = (np.concatenate([h[j] for h in heads]).view("<i8") for j in range(4))
    places = [unpack(x, PLACE) for x in table.column("places").to_pylist()]
    ahead = np.cumsum([0, *(len(h[0]) for h in heads)])
    of = np.concatenate([x[0].view("<i8") + n for x, n in zip(places, ahead, strict=False)])
    pos = np.concatenate([x[1].view("<i8") for x in places])
    size = left + GRAM + right
    hit = covered_offsets(data, np.cumsum(size) - size, left, right, ids)
    some = np.flatnonzero(hit.any(1)[of])
    f, o = np.nonzero(hit[of[some]])
    f, begin = of[some][f], pos[some][f] - o
    order = np.lexsort((begin, marks[f], ids[f]))
    f, begin = f[order], begin[order]
    i, m = ids[f], marks[f]
    new = np.ones(len(f), bool)
    new[1:] = (i[1:] != i[:-1]) | (m[1:] != m[:-1])
    cut = new.copy()
    cut[1:] |= begin[1:] > begin[:-1] + SPAN
    s = np.flatnonzero(cut)
    e = np.append(s[1:], len(f)) - 1 if len(f) else s
    head = np.flatnonzero(new)
    at = np.searchsorted(s, np.append(head, len(f)))
    return pa.table({"_id": pa.array(i[head]), "_mark": pa.array(m[head]), "spans": pa.array([pack([(begin[s[x:y]], 4, True), (begin[e[x:y]] + SPAN, 4, True)]) for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())})


OUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def dedup_substrings(docs: DataFrame, with_spans: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_spans adds the removed [start, end) pairs."""
    spark = docs.sparkSession
    bound_batches(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = _identified(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "_id", "_mark", "_text")
    settled = _send_anchors(base, buckets).groupBy("bucket").applyInArrow(_settle, "batch string, kind int, ids binary, a binary, b binary")
    lists = settled.groupBy("batch").applyInArrow(_by_text, "_id long, _mark long, a binary, b binary").dropDuplicates(["_id", "_mark"])
    lists = materialise(lists, "anchors")
    keys = ["_id", "_mark"]
    opened = base.join(lists.where(F.length("b") > 0).select(*keys, "b").hint("merge"), keys).select("doc_id", "_id", "_mark", "_text", "b")
    spans = _send_fragments(opened, buckets).groupBy("bucket").applyInArrow(_sort_fragments, "_id long, _mark long, spans binary")
    spans = spans.groupBy(*keys).agg(F.collect_list("spans").alias("spans"))
    both = lists.select(*keys, "a").join(spans.hint("merge"), keys, "left")
    full = base.join(both.hint("merge"), keys, "left").select("doc_id", "_text", "a", "spans")

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for a, b, data, off in K.chunked(rb.column("_text")):
                settled_at, intervals = rb.column("a").slice(a, b - a).to_pylist(), rb.column("spans").slice(a, b - a).to_pylist()
                edge = np.zeros(len(data) + 1, np.int64)
                for i in range(b - a):
                    if settled_at[i]:
                        p = unpack(settled_at[i], [(4, True)])[0].astype(np.int64) + off[i]
                        np.add.at(edge, np.maximum(p - EXT, off[i]), 1)
                        np.add.at(edge, np.minimum(p + SPAN, off[i + 1]), -1)
                    for x in intervals[i] or ():
                        s, e = (y.astype(np.int64) + off[i] for y in unpack(x, [(4, True), (4, True)]))
                        np.add.at(edge, s, 1)
                        np.add.at(edge, e, -1)
                gone = np.cumsum(edge)[:-1] > 0
                starts = gone.copy()
                inner = np.ones(len(data), bool)
                inner[off[:-1][off[:-1] < len(data)]] = False
                starts[1:] &= ~(gone[:-1] & inner[1:])
                n_gone, n_spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[off]) for x in (gone, starts))
                kept = data[~gone]
                at = off - np.concatenate([[0], np.cumsum(gone)])[off]
                digest = [hashlib.sha256(kept[at[i] : at[i + 1]].tobytes()).hexdigest() for i in range(b - a)]
                cols = [rb.column("doc_id").slice(a, b - a), pa.array(np.diff(off)), pa.array(n_gone.astype(np.int64)), pa.array(n_spans.astype(np.int64)), pa.array(digest, pa.string())]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_spans:
                    ends = gone.copy()
                    ends[:-1] &= ~(gone[1:] & inner[1:])
                    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
                    j = np.searchsorted(s, off)
                    cols.append(pa.array([[[int(x - off[i]), int(y - off[i])] for x, y in zip(s[j[i] : j[i + 1]], e[j[i] : j[i + 1]], strict=True)] for i in range(b - a)], pa.list_(pa.list_(pa.int64()))))
                    names.append("spans")
                yield pa.RecordBatch.from_arrays(cols, names)

    return full.mapInArrow(cut, "doc_id long, " + OUT + (", spans array<array<long>>" if with_spans else ""))


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = {"op5_suffixes": """
with h as (select doc_id, hex(encode(coalesce(text, ''))) x, octet_length(encode(coalesce(text, ''))) n from documents),
w as (select doc_id, i, md5(substr(x, 2 * i - 1, 100)) s from (select *, unnest(range(1, n - 48)) i from h)),
f as (select s, min(doc_id) m from w group by s),
b as (select w.doc_id, i from w join f using (s) where m < w.doc_id),
g as (select *, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end k from b),
u as (select *, sum(k) over (partition by doc_id order by i) r from g),
r as (select doc_id, min(i) a, max(i) + 49 z from u group by doc_id, r),
p as (select r.doc_id, a, z, substr(x, 2 * coalesce(lag(z) over (partition by r.doc_id order by a), 0) + 1, 2 * (a - 1 - coalesce(lag(z) over (partition by r.doc_id order by a), 0))) y from r join h using (doc_id)),
t as (select doc_id, sum(z - a + 1) n_removed, count(*) n_spans, string_agg(y, '' order by a) y, max(z) z from p group by doc_id)
select h.doc_id, cast(n as bigint) n_bytes, cast(coalesce(n_removed, 0) as bigint) n_removed, cast(coalesce(n_spans, 0) as bigint) n_spans,
  sha256(unhex(case when t.doc_id is null then x else y || substr(x, 2 * t.z + 1) end)) kept_sha256 from h left join t using (doc_id)"""}
