"""Quality rules: hashed n-gram logistic regression with base text statistics.

Features are words, word pairs and 4-byte character n-grams of the whole text,
hashed into fixed tables and normalised by their number.  The regression is fitted
on at most ``FIT_ROWS`` labelled rows (a documented bound; everything else covers
all rows), its probability is calibrated on rows it was not fitted on, and whole
texts are scored in Arrow batches against the fixed threshold ``KEEP_AT``.

Defined cases: a null text is empty; an empty text has no words, fails the base
rules and is not kept; a very long text is read whole; repeated rows are judged alike,
each on its own; a probability equal to the threshold keeps; repeated labels of an id count
as their maximum; other columns are not read, and ``keep_good`` returns them as they are,
whatever their names; without labels of both kinds the probability is constant and only
base rules decide; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .labelled import labelled_sample, platt, sigmoid
from .shared import bound_batches, set_aside

#: Labelled rows at most that the regression and its calibration are fitted on.
FIT_ROWS = 4000
#: A text is kept if its calibrated probability of label 1 is at least this.
KEEP_AT = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BITS = 16
FIT_BLOCK = 200
SCALE, RIDGE = 20.0, 1e-6
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


@dataclass
class QualityModel:
    weights: np.ndarray  # words and pairs first, then character n-grams
    bias: float
    slope: float
    shift: float

    def probability(self, z: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (z + self.bias) + self.shift)


def _counts(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[off])


def _buckets(data, off, s, e, first, px) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word and pair buckets with their texts, then character buckets with theirs."""
    h = px.span(s, e)
    pair, at = K.runs(h, first, 2, whole=False)
    wb = np.concatenate([K.mix(h), pair]) >> K.U(64 - BITS)
    wr = np.concatenate([K.row_of(first), K.row_of(at)])
    n = len(data)
    if n < 4:
        return wb.astype(np.int64), wr, np.zeros(0, np.int64), np.zeros(0, np.int64)
    d = data.astype(np.uint32)
    v = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
    v = (v * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    size = np.maximum(np.diff(off) - 3, 0)
    row = np.repeat(np.arange(len(off) - 1), size)
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    cb = v[np.arange(len(row)) - np.repeat(start - off[:-1], size)]
    return wb.astype(np.int64), wr, cb.astype(np.int64) + (1 << BITS), row


def base_statistics(data: np.ndarray, off: np.ndarray, s, e, first, px: K.Prefix) -> dict[str, np.ndarray]:
    """The five base columns of every text in a chunk."""
    n_docs = len(off) - 1
    solid = ~K.SPACE[data]
    out = {
        "n_words": np.diff(first),
        "word_chars": _counts(solid & ((data & 0xC0) != 0x80), off),
        "n_symbols": _counts(SYMBOL[data], off),
    }
    # lines: cut at \n and at text borders
    nl = np.flatnonzero(data == 10)
    ls = np.union1d(off[:-1], nl + 1)
    ls = ls[ls < len(data)]
    le = np.concatenate([ls[1:], [len(data)]])
    le = np.where((le > ls) & (data[np.maximum(le - 1, 0)] == 10), le - 1, le) if len(data) else le
    words_to = np.concatenate([[0], np.cumsum(solid)])
    has = words_to[le] > words_to[ls]
    ls, le = ls[has], le[has]
    row = np.searchsorted(off, ls, "right") - 1
    key = K.mix(px.span(ls, le) + K.mix((le - ls).astype(K.U))) ^ K.mix(row.astype(K.U))
    _, where = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(row, minlength=n_docs) - np.bincount(row[where], minlength=n_docs)
    # words within 3-word windows found twice or more
    tri, at = K.runs(px.span(s, e), first, 3, whole=False)
    row = K.row_of(at)
    _, inv, count = np.unique(tri ^ K.mix(row.astype(K.U)), return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[inv] > 1)
    start = again - at[row[again]] + first[row[again]]
    mark = np.zeros(len(s) + 1, np.int64)
    np.add.at(mark, start, 1)
    np.add.at(mark, start + 3, -1)
    covered = np.cumsum(mark)[: len(s)] > 0
    out["n_repeat_words"] = np.diff(np.concatenate([[0], np.cumsum(covered)])[first])
    return out


def minimise(loss, x: np.ndarray, steps: int = 30, memory: int = 8, small: float = 1e-3) -> np.ndarray:
    """L-BFGS with halved steps, until the gradient is ``small`` times the first one."""
    f, g = loss(x)
    end, pairs = small * np.linalg.norm(g), []
    for _ in range(steps):
        if not np.linalg.norm(g) > end:
            break
        d, used = g.copy(), []
        for s, t in reversed(pairs):
            used.append((s @ d) / (s @ t))
            d -= used[-1] * t
        d *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / np.linalg.norm(g)
        for (s, t), a in zip(pairs, reversed(used), strict=True):
            d += (a - (t @ d) / (s @ t)) * s
        size = 1.0
        while (new := loss(x - size * d))[0] > f - 1e-4 * size * (g @ d):
            size /= 2
            if size < 1e-6:
                return x
        s, t = -size * d, new[1] - g
        x, (f, g) = x + s, new
        if s @ t > 1e-12:
            pairs = [*pairs[1 - memory :], (s, t)]
    return x


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, off in K.chunked(batch.column("text")):
            s, e, first = K.words(data, off)
            wb, wr, cb, cr = _buckets(data, off, s, e, first, K.Prefix(data))
            nw, nc = np.bincount(wr, minlength=b - a), np.bincount(cr, minlength=b - a)
            key, n = np.unique(np.concatenate([wr << (BITS + 1) | wb, cr << (BITS + 1) | cb]), return_counts=True)
            row, col = key >> (BITS + 1), key & ((1 << (BITS + 1)) - 1)
            x = n / np.where(col >> BITS, nc[row], nw[row])
            cut = np.searchsorted(row, np.arange(b - a + 1))
            rows = range(b - a)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(a, b - a), batch.column("y").slice(a, b - a).cast(pa.int32()),
                pa.array([col[cut[i]:cut[i + 1]].astype("<i4").tobytes() for i in rows], pa.binary()),
                pa.array([x[cut[i]:cut[i + 1]].astype("<f4").tobytes() for i in rows], pa.binary())], ["doc_id", "y", "col", "x"])


def fit(sample: DataFrame) -> QualityModel:
    """Fit on rows (doc_id, text, y); every fifth row by id hash only calibrates."""
    bound_batches(sample.sparkSession)
    got = sample.mapInArrow(_fit_rows, "doc_id long, y int, col binary, x binary").toArrow().sort_by([("doc_id", "ascending"), ("y", "ascending"), ("col", "ascending")])
    ids, y = got.column("doc_id").to_numpy(), got.column("y").to_numpy().astype(float)
    held = K.mix(ids.view(K.U)) % K.U(5) == 0
    w = np.zeros(2 << BITS)
    if len(set(y[~held])) < 2:
        return QualityModel(w, 0.0, 0.0, 35.0)
    # blocks of rows, so that temporaries stay small
    blocks = []
    for a in range(0, len(y), FIT_BLOCK):
        col, val = got.column("col").slice(a, FIT_BLOCK).to_pylist(), got.column("x").slice(a, FIT_BLOCK).to_pylist()
        row = np.repeat(np.arange(a, a + len(col), dtype=np.int32), [len(c) // 4 for c in col])
        blocks.append((np.frombuffer(b"".join(col), "<i4"), np.frombuffer(b"".join(val), "<f4") * np.float32(SCALE), row))
    del got

    share = np.where(y == 1, 0.5 / max(1, (y[~held] == 1).sum()), 0.5 / max(1, (y[~held] == 0).sum()))
    share[held] = 0

    def margins(x: np.ndarray) -> np.ndarray:
        z = np.full(len(y), x[-1])
        for c, v, r in blocks:
            z += np.bincount(r, weights=x[c] * v, minlength=len(y))
        return z

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        """Both labels with equal weight, and its gradient: two passes over the blocks."""
        z = margins(x)
        err = share * (sigmoid(z) - y)
        g = np.append(RIDGE * x[:-1], err.sum())
        for c, v, r in blocks:
            g[:-1] += np.bincount(c, weights=err[r] * v, minlength=len(g) - 1)
        return float(share @ np.logaddexp(0, (1 - 2 * y) * z)) + RIDGE / 2 * float(x[:-1] @ x[:-1]), g

    x = minimise(loss, np.zeros(len(w) + 1))
    z = margins(x)
    fit_on = held if len(set(y[held])) == 2 else ~held
    slope, shift = platt(z[fit_on], y[fit_on])
    return QualityModel(x[:-1] * SCALE, float(x[-1]), slope, shift)


SCORED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, probability double"


def score(docs: DataFrame, model: QualityModel, carry: tuple[str, ...] = ()) -> DataFrame:
    """Base statistics and probability of every row, with the columns named in carry."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(c) for c in carry if c not in ("doc_id", "text")])
    keep = [c for c in carry if c not in ("doc_id",)]
    schema = SCORED + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for a, b, data, off in K.chunked(batch.column("text")):
                s, e, first = K.words(data, off)
                px = K.Prefix(data)
                base = base_statistics(data, off, s, e, first, px)
                wb, wr, cb, cr = _buckets(data, off, s, e, first, px)
                z = np.zeros(b - a)
                for bucket, row in ((wb, wr), (cb, cr)):
                    z += np.bincount(row, weights=model.weights[bucket], minlength=b - a) / np.maximum(np.bincount(row, minlength=b - a), 1)
                cols = [batch.column("doc_id").slice(a, b - a), *[pa.array(base[c].astype(np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                        pa.array(model.probability(z)), *[batch.column(c).slice(a, b - a) for c in keep]]
                yield pa.RecordBatch.from_arrays(cols, [x.split(" ")[0] for x in SCORED.split(", ")] + keep)

    return d.mapInArrow(run, schema)


def judge(scored: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("probability") >= keep_at))


def quality_rules(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Fit on labelled rows, score and judge all documents."""
    return judge(score(docs, fit(labelled_sample(docs, labels, "quality", FIT_ROWS)), carry))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, all columns as they were."""
    d, others = set_aside(docs)
    own = {n: c for n, c in others}
    good = quality_rules(d, labels, ("text", *own)).where("kept")
    back = {c: n for n, c in others} | {"text": "text", "doc_id": "doc_id"}
    return good.select(*[F.col(back[c]).alias(c) for c in docs.columns])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")
