"""Exact overlaps of token sets, block against block.

Records stand in blocks of one country with the postings of their tokens.  Every block of one
side meets every block of the other in a Cartesian product of two written tables, so no pair
is ever shuffled.  A pair of blocks is counted as a matrix product over its frequent tokens
and by posting over the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.sources.scratch import scratch_path

#: Records and tokens of a block at most; a record with more tokens is a block of its own.
LEFT_RECORDS, RIGHT_RECORDS, BLOCK_TOKENS = 2048, 4096, 1 << 21
#: A token in more than this share of a pair of blocks goes into the matrix product.
FREQUENT = 0.002
_CHUNK = 255  # tokens of one matrix product: a count stays below 256, and a float holds three of them
_PAIRS, _SPAN = 1 << 20, 256  # posting pairs opened at once, and left records they may be of
#: Records of an output row of pairs: the JVM holds all pairs of a row at once.
_LEFT_TILE, _RIGHT_TILE = 32, 256
_ROWS = 1 << 16  # pairs of an output batch
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: nums: longs in falling size, then order; ids by offset; many: copies each record stands for; terms: the
#: distinct tokens by offset; counts, docs: each token's number of records and their places in the block.
_BLOCK = "country string, largest int, nums binary, ids binary, id_ends binary, many binary, sizes binary, terms binary, term_ends binary, counts binary, docs binary"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of 8 MB at most, or one row: texts and blocks are long rows."""
    size = str(spark.conf.get(_ARROW_BYTES, "64m")).rstrip("b")
    if not size.isdigit() or not 0 < int(size) <= 8 << 20:
        spark.conf.set(_ARROW_BYTES, str(8 << 20))


def _strings(values: pa.Array) -> tuple[bytes, bytes]:
    """A string array as its bytes and its ends."""
    values = pa.concat_arrays([values.cast(pa.string()), pa.array([], pa.string())])
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False))]).astype(np.int32)
    data = values.buffers()[2]
    first = np.frombuffer(values.buffers()[1], np.int32)[values.offset] if len(values) else 0
    return (data.slice(int(first), int(ends[-1])).to_pybytes() if data is not None else b""), ends.tobytes()


def _array(data: bytes, ends: bytes) -> pa.Array:
    return pa.StringArray.from_buffers(len(ends) // 4 - 1, pa.py_buffer(ends), pa.py_buffer(data))


def _block(rows: pa.Table) -> dict:
    """One block of records (num, entity_id, country, many, size, bag)."""
    rows = rows.sort_by("num").combine_chunks()
    column = lambda c: rows[c].chunk(0)
    words = pc.split_pattern(column("bag"), " ")
    terms = words.flatten().dictionary_encode()
    at = terms.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(rows), dtype=np.uint16), pc.list_value_length(words).to_numpy())
    sizes = column("size").to_numpy()
    ids, id_ends = _strings(column("entity_id"))
    text, term_ends = _strings(terms.dictionary)
    return {"country": rows["country"][0].as_py(), "largest": int(sizes.max()), "nums": column("num").to_numpy().astype(np.int64).tobytes(), "ids": ids, "id_ends": id_ends,
            "many": column("many").to_numpy().astype(np.int32).tobytes(), "sizes": sizes.astype(np.int32).tobytes(), "terms": text, "term_ends": term_ends,
            "counts": np.bincount(at, minlength=len(terms.dictionary)).astype(np.int32).tobytes(), "docs": doc[np.argsort(at, kind="stable")].tobytes()}


def _packer(most: int, schema: pa.Schema):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of neighbouring records of one country."""
        held: list[pa.Table] = []
        n = size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                yield pa.RecordBatch.from_pylist([_block(pa.concat_tables(held))], schema)
                held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            place, sizes = batch.column("country").to_pylist(), batch.column("size").to_pylist()
            start = 0
            for i in range(batch.num_rows):
                before = place[i - 1] if i else held[-1]["country"][0].as_py() if held else None
                if n and (place[i] != before or n >= most or size + sizes[i] > BLOCK_TOKENS):
                    if i > start:
                        held.append(table.slice(start, i - start))
                    yield from flush()
                    start, n, size = i, 0, 0
                n, size = n + 1, size + sizes[i]
            held.append(table.slice(start))
        yield from flush()

    return pack


def _blocks(sets: DataFrame, most: int, label: str, prefix: str) -> DataFrame:
    """Blocks of (num, entity_id, country, many, size, bag), written: long records together, so most blocks
    hold none that could displace a candidate; their columns under a prefix."""
    spark = sets.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("country"), F.desc("size"), F.col("num")]
    dealt = sets.select("num", "entity_id", "country", "many", "size", "bag").repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = spark.createDataFrame([], _BLOCK).schema
    arrow = pa.schema([(f.name, {"string": pa.string(), "integer": pa.int32(), "binary": pa.binary()}[f.dataType.typeName()]) for f in schema])
    path = scratch_path(spark, label)
    dealt.mapInArrow(_packer(most, arrow), schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path).select(*[F.col(f.name).alias(f"{prefix}_{f.name}") for f in schema])


class _Side:
    """A block's arrays, read from row i of a batch."""

    def __init__(self, batch: pa.RecordBatch, prefix: str, i: int):
        cell = lambda c: batch.column(f"{prefix}_{c}")[i].as_buffer()
        ints = lambda c, kind: np.frombuffer(cell(c), kind)
        self.nums, self.many, self.sizes = ints("nums", np.int64), ints("many", np.int32), ints("sizes", np.int32)
        self.largest = batch.column(f"{prefix}_largest")[i].as_py()
        self.ids, self.terms = _array(cell("ids"), cell("id_ends")), _array(cell("terms"), cell("term_ends"))
        self.counts, self.docs = ints("counts", np.int32).astype(np.int64), ints("docs", np.uint16)
        self.token = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)

    def postings(self, token_of: np.ndarray, keep: np.ndarray | None = None, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(token, doc) by the new numbers of tokens (-1: gone) and records, in the order of the old tokens."""
        t = token_of[self.token]
        ok = t >= 0 if keep is None else (t >= 0) & keep[self.docs]
        d = self.docs[ok].astype(np.int64)
        return t[ok], d if place is None else place[d]


def _multiplied(ac: np.ndarray, ad: np.ndarray, bc: np.ndarray, bd: np.ndarray, tokens: int, out: np.ndarray) -> None:
    """Adds the overlaps by postings (token, record) of both sides; three left records stand in one float, 8 bits each."""
    n, w = out.shape
    m = -(-n // 3)
    group, part = ad % m, ad // m
    for lo in range(0, tokens, _CHUNK):
        wide = min(_CHUNK, tokens - lo)
        a, b = np.zeros((m, wide), np.float32), np.zeros((w, wide), np.float32)
        for p in range(3):
            i = (ac >= lo) & (ac < lo + wide) & (part == p)
            a[group[i], ac[i] - lo] += np.float32(1 << 8 * p)
        j = (bc >= lo) & (bc < lo + wide)
        b[bd[j], bc[j] - lo] = 1
        held = (a @ b.T).astype(np.int32)
        for p in range(3):
            rows = out[p * m : (p + 1) * m]
            rows += (held[: len(rows)] >> 8 * p) & 255


def _counts(l: _Side, r: _Side, rows: np.ndarray) -> np.ndarray:
    """Overlaps of the left records in rows with all right ones."""
    n, w = len(rows), len(r.nums)
    out = np.zeros((n, w), np.int32)
    at = pc.index_in(r.terms, value_set=l.terms)
    known = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    lt = at.drop_null().to_numpy().astype(np.int64)
    if not len(known):
        return out
    keep = np.zeros(len(l.nums), bool)
    keep[rows] = True
    place = np.zeros(len(l.nums), np.int64)
    place[rows] = np.arange(n)
    shared = np.full(len(l.counts), -1, np.int64)
    shared[lt] = np.arange(len(lt))
    a_tok, a_doc = l.postings(shared, keep, place)
    a_n, b_n = np.bincount(a_tok, minlength=len(lt)), r.counts[known]
    frequent = a_n * b_n > FREQUENT * n * w
    shared_r = np.full(len(r.counts), -1, np.int64)
    shared_r[known] = np.where(a_n > 0, np.arange(len(lt)), -1)
    b_tok, b_doc = r.postings(shared_r)
    column = np.cumsum(frequent) - 1
    fa, fb = frequent[a_tok], frequent[b_tok]
    ac, ad, bc, bd = column[a_tok[fa]], a_doc[fa], column[b_tok[fb]], b_doc[fb]
    _multiplied(ac, ad, bc, bd, int(frequent.sum()), out)
    # the others: each left posting with its token's right ones, a record's together
    at_, ad = a_tok[~fa], a_doc[~fa]
    order = np.argsort(ad, kind="stable")
    at_, ad = at_[order], ad[order]
    order = np.argsort(b_tok[~fb], kind="stable")
    bt, bd = b_tok[~fb][order], b_doc[~fb][order]
    has = np.bincount(bt, minlength=len(lt))
    first = np.cumsum(has) - has
    each = has[at_]
    done = np.concatenate([[0], np.cumsum(each)])
    lo = 0
    while lo < len(at_):
        hi = max(lo + 1, min(int(np.searchsorted(done, done[lo] + _PAIRS, "right")) - 1, int(np.searchsorted(ad, ad[lo] + _SPAN))))
        e, top, end = each[lo:hi], int(ad[lo]), int(ad[hi - 1]) + 1
        place = np.repeat((ad[lo:hi] - top) * w, e)
        place += bd[np.arange(done[hi] - done[lo]) + np.repeat(first[at_[lo:hi]] - (done[lo:hi] - done[lo]), e)]
        out[top:end] += np.bincount(place, minlength=(end - top) * w).reshape(end - top, w)
        lo = hi
    return out


class _Best:
    """The best right records of each record of a left block so far, by overlap, then number."""

    def __init__(self, side: _Side, k: int):
        self.k, self.a = k, side.nums
        self.count = np.zeros((len(self.a), 0), np.int64)
        self.num = np.zeros((len(self.a), 0), np.int64)
        self.many = np.zeros((len(self.a), 0), np.int64)
        self.least = np.ones(len(self.a), np.int64)

    def add(self, rows: np.ndarray, counts: np.ndarray, r: _Side) -> None:
        """A record whose overlap k others exceed leaves; of equal ones the first k stay."""
        w, k = counts.shape[1], self.k
        some = (counts >= self.least[rows][:, None]).any(axis=1)
        rows, counts = rows[some], counts[some]
        if not len(rows):
            return
        kind = np.int32 if (int(counts.max()) + 1) * w < 1 << 31 else np.int64
        key = counts.astype(kind) * kind(w) + np.arange(w - 1, -1, -1, dtype=kind)
        if w > k:
            key = np.partition(key, w - k, axis=1)[:, w - k:]
        at = w - 1 - key % w
        new = (key // w).astype(np.int64)
        wide = self.count.shape[1]
        count, num, many = np.hstack([self.count[rows], new]), np.hstack([self.num[rows], r.nums[at]]), np.hstack([self.many[rows], r.many[at]])
        order = np.lexsort((num, -count), axis=1)[:, :k]
        count, num, many = (np.take_along_axis(x, order, 1) for x in (count, num, many))
        if count.shape[1] > wide:
            grow = lambda x: np.hstack([x, np.zeros((len(x), count.shape[1] - wide), np.int64)])
            self.count, self.num, self.many = grow(self.count), grow(self.num), grow(self.many)
        self.count[rows, : count.shape[1]], self.num[rows, : count.shape[1]], self.many[rows, : count.shape[1]] = count, num, many
        full = np.cumsum(np.where(count > 0, many, 0), axis=1) >= k
        self.least[rows] = np.maximum(1, np.where(full.any(axis=1), np.take_along_axis(count, full.argmax(axis=1)[:, None], 1)[:, 0], 1))

    def rows(self) -> Iterator[pa.RecordBatch]:
        i, j = np.nonzero(self.count >= self.least[:, None])
        for lo in range(0, len(i), _ROWS):
            x, y = i[lo : lo + _ROWS], j[lo : lo + _ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(self.a[x]), pa.array(self.num[x, y]), pa.array(self.count[x, y])], names=["a", "b", "overlap"])


def _best_of(k: int):
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, _Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                l, r = _Side(batch, "l", i), _Side(batch, "r", i)
                state = states.setdefault(int(l.nums[0]), _Best(l, k))
                # a pair shares no more tokens than its shorter record has
                rows = np.flatnonzero((state.least <= r.largest) & (state.least <= l.sizes))
                if len(rows):
                    state.add(rows, _counts(l, r, rows), r)
        for state in states.values():
            yield from state.rows()

    return best


def _lists(ends: list[np.ndarray], *values: pa.Array) -> pa.RecordBatch:
    """(s1s, cands, counts) by the ends of their lists."""
    of = lambda e, v: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], e]), pa.int32()), v)
    return pa.RecordBatch.from_arrays([of(e, v) for e, v in zip(ends, values, strict=True)], names=["s1s", "cands", "counts"])


def _all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (s1s, cands, counts): the overlaps of each s1 with all cands, one s1 after the other, 0 where none.

    Where few pairs overlap, a row has one s1 and those that overlap with it.
    """
    for batch in batches:
        for i in range(batch.num_rows):
            l, r = _Side(batch, "l", i), _Side(batch, "r", i)
            counts = _counts(l, r, np.arange(len(l.nums)))
            tiles = np.append(np.arange(0, len(r.nums), _RIGHT_TILE), len(r.nums))
            for lo in range(0, len(l.nums), _LEFT_TILE):
                part = counts[lo : lo + _LEFT_TILE]
                n, found = len(part), np.count_nonzero(part, axis=1)
                if 2 * int(found.sum()) > part.size:
                    own = l.ids.take(pa.array(np.tile(np.arange(lo, lo + n), len(tiles) - 1)))
                    cells = np.concatenate([part[:, a:b].ravel() for a, b in zip(tiles, tiles[1:])])
                    yield _lists([n * np.arange(1, len(tiles)), tiles[1:], n * tiles[1:]], own, r.ids, pa.array(cells))
                elif found.any():
                    x, y = np.nonzero(part)
                    ends = np.cumsum(found[found > 0])
                    yield _lists([np.arange(1, len(ends) + 1), ends, ends], l.ids.take(pa.array(lo + np.flatnonzero(found))), r.ids.take(pa.array(y)), pa.array(part[x, y]))


def _met(left: DataFrame, right: DataFrame) -> tuple[DataFrame, int]:
    """Each left block with all right ones of its country, a task for each two partitions; the left side's partitions."""
    bound_batches(left.sparkSession)
    l, r = _blocks(left, LEFT_RECORDS, "left-blocks", "l"), _blocks(right, RIGHT_RECORDS, "right-blocks", "r")
    return l.join(r.hint("shuffle_replicate_nl"), F.col("l_country") == F.col("r_country")), max(1, l._jdf.queryExecution().toRdd().getNumPartitions())


def best_overlaps(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """(a, b, overlap) among (num, entity_id, country, many, size, bag): for each left record the right ones
    that may be among its first k by overlap, then number, each counted ``many`` times.

    One task has a left block's pairs where the files have no preferred places; where they have
    some, several tasks may share them, and each gives its own best.
    """
    met, tasks = _met(left, right)
    return met.coalesce(tasks).mapInArrow(_best_of(k), "a long, b long, overlap long")


def every_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """(s1, cand, overlap) of all pairs that share a token.

    Counts leave Python as arrays with the ids of both sides once; rows are made of them by the generated code.
    """
    met = _met(left, right)[0].mapInArrow(_all_of, "s1s array<string>, cands array<string>, counts array<int>")
    one = met.select(F.posexplode("s1s").alias("i", "s1"), "cands", "counts")
    pairs = one.select("s1", "i", "counts", F.size("cands").alias("w"), F.posexplode("cands").alias("j", "cand"))
    count = F.get("counts", F.col("i") * F.col("w") + F.col("j"))
    return pairs.where(count > 0).select("s1", "cand", count.cast("long").alias("overlap"))
