"""Toxicity: gradient-boosted trees over dense text features, isotonic calibration.

Features of a whole text: densities of a seed lexicon and of a lexicon learned from
labelled rows (also on a de-obfuscated view of the text), nearness of lexicon words
to second-person words, capitals, punctuation and obfuscation rates.  Trees are
Newton-boosted on binned features; their margin is calibrated by isotonic
regression on rows that neither the trees nor the learned lexicon saw.  Fitting
uses at most ``FIT_ROWS`` labelled rows; scoring covers every row and sees only its
text.

Defined cases: a null text is empty; an empty text has all features 0 and gets the
calibrated score of that point; a very long text is read whole, rates do not depend on
its length; repeated rows score alike; of equal gains the first feature and cut split, equal
margins are calibrated as one; repeated labels of an id count as their maximum; columns
other than doc_id and text, whatever their names, are not read; without labels of both
kinds every score is the smoothed label rate; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .labelled import isotonic, labelled_sample
from .shared import bound_batches

#: Labelled rows at most for lexicon, trees and calibration together.
FIT_ROWS = 20_000
#: Learned entries are whole words and word beginnings of STEMS bytes, so that
#: inflected forms count; each must lean to label 1 by both its log-odds and their z.
LEXICON_SIZE, LEXICON_MIN_DOCS, LEXICON_Z, LEXICON_ODDS = 2000, 4, 3.0, 2.0
STEMS = (4, 5, 6, 7)
NEAR = 5
INSULTS = ("idiot idiots moron morons stupid dumb fool loser losers trash garbage scum filth worthless pathetic disgusting clown jerk "
           "hate kill die ugly vermin freak creep liar shut bastard damn hell crap imbecile cretin").split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos usted tus vosotros".split()

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_ALNUM[128:] = True
GAP = ~_ALNUM
PUNCT = np.zeros(256, bool)
PUNCT[33:48] = PUNCT[58:65] = PUNCT[91:97] = PUNCT[123:127] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
#: Look-alike bytes read as letters, and bytes dropped, in the de-obfuscated view.
PLAIN = K.LOWER.copy()
for _a, _b in zip(b"013457@$", b"oieastas", strict=True):
    PLAIN[_a] = _b
DROPPED = np.zeros(256, bool)
DROPPED[list(b"*.-_'!,#%&?;:\"()~^")] = True

FEATURES = ["seed", "learned", "seed_plain", "learned_plain", "seed_any", "learned_any", "near_second", "second", "capitals", "all_caps", "punct", "exclaim", "obfuscated", "repeats", "log_words"]


def _hash(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(w.encode()) for w in words])])
    return np.sort(np.unique(K.mix(K.Prefix(data).span(off[:-1], off[1:]))))


SEED_HASHES, YOU_HASHES = _hash(INSULTS), _hash(SECOND_PERSON)


def _in(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    if len(table) == 0:
        return np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return table[at] == h


def _sum(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])


def word_hashes(data, off):
    """Hashes of lower-cased alphanumeric words, their spans, each text's first word, prefix hashes."""
    low = K.LOWER[data]
    s, e, first = K.words(low, off, GAP)
    px = K.Prefix(low)
    return K.mix(px.span(s, e)), s, e, first, px


def plain_hashes(data, off):
    """The same of the de-obfuscated view: look-alikes read, separators dropped, spaces cut."""
    keep = ~DROPPED[data]
    moved = np.concatenate([[0], np.cumsum(keep)])[off]
    plain = PLAIN[data[keep]]
    s, e, first = K.words(plain, moved)
    return K.mix(K.Prefix(plain).span(s, e)), first


def stem_hashes(px: K.Prefix, s: np.ndarray, e: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first n bytes of longer words, and which words those are."""
    at = np.flatnonzero(e - s > n)
    return K.mix(px.span(s[at], s[at] + n) + K.U(n)), at


def features(data: np.ndarray, off: np.ndarray, learned: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    h, s, e, first, px = word_hashes(data, off)
    p, p_first = plain_hashes(data, off)
    words, size = np.maximum(np.diff(first), 1), np.maximum(np.diff(off), 1)
    seed, lex, you = _in(h, SEED_HASHES), _in(h, learned), _in(h, YOU_HASHES)
    for k in STEMS:
        stem, at = stem_hashes(px, s, e, k)
        lex[at] |= _in(stem, learned)
    hit = seed | lex
    row = K.row_of(first)
    # hits with a second-person word within NEAR words of the same text
    at = np.concatenate([[0], np.cumsum(you)])
    i = np.arange(len(h))
    near = hit & (at[np.minimum(i + NEAR + 1, first[1:][row])] - at[np.maximum(i - NEAR, first[:-1][row])] > 0)
    upper = (data >= 65) & (data <= 90)
    ups = np.concatenate([[0], np.cumsum(upper)])
    caps = (ups[e] - ups[s] == e - s) & (e - s > 1)
    mixed = np.zeros(len(data), bool)
    if len(data) > 2:  # a digit or mark between letters
        mixed[1:-1] = LETTER[data[:-2]] & LETTER[data[2:]] & ~LETTER[data[1:-1]] & ~K.SPACE[data[1:-1]] & (data[1:-1] < 128) & (data[1:-1] != 39) & (data[1:-1] != 45)
    same = np.zeros(len(data), bool)
    if len(data) > 2:
        same[2:] = (data[2:] == data[1:-1]) & (data[2:] == data[:-2]) & LETTER[data[2:]]
    p_words = np.maximum(np.diff(p_first), 1)
    p_seed, p_lex = _sum(_in(p, SEED_HASHES), p_first), _sum(_in(p, learned), p_first)
    n_seed, n_lex = _sum(seed, first), _sum(lex, first)
    cols = [n_seed / words, n_lex / words, p_seed / p_words, p_lex / p_words, np.minimum(np.maximum(n_seed, p_seed), 8), np.minimum(np.maximum(n_lex, p_lex), 8),
            _sum(near, first) / words, _sum(you, first) / words, _sum(upper, off) / size, _sum(caps, first) / words, _sum(PUNCT[data], off) / size,
            _sum(data == 33, off) / size, _sum(mixed, off) / size, _sum(same, off) / size, np.log1p(np.diff(first))]
    return np.stack(cols, 1).astype(float) if n else np.zeros((0, len(FEATURES)))


@dataclass
class Trees:
    """Newton-boosted complete trees of fixed depth on quantile bins."""

    depth: int = 3
    rounds: int = 60
    rate: float = 0.15
    bins: int = 32
    min_hessian: float = 4.0
    ridge: float = 1.0
    cuts: list[np.ndarray] = field(default_factory=list)
    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    start: float = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.cuts = [np.unique(np.quantile(np.unique(v), np.linspace(0, 1, self.bins + 1)[1:-1])) if len(v) else np.zeros(0) for v in x.T]
        b, f = self._binned(x), x.shape[1]
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        z, width = np.full(len(y), self.start), self.bins + 1
        flat = b + np.arange(f) * width
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-z))
            g, h = p - y, p * (1 - p)
            node, feat, cut = np.zeros(len(y), np.int64), [], []
            for level in range(self.depth):
                k = 1 << level
                key = (node[:, None] * (f * width) + flat).ravel()
                gs = np.bincount(key, np.repeat(g, f), k * f * width).reshape(k, f, width).cumsum(2)
                hs = np.bincount(key, np.repeat(h, f), k * f * width).reshape(k, f, width).cumsum(2)
                ga, ha = gs[..., -1:], hs[..., -1:]
                gain = gs**2 / (hs + self.ridge) + (ga - gs) ** 2 / (ha - hs + self.ridge) - ga**2 / (ha + self.ridge)
                gain[(hs < self.min_hessian) | (ha - hs < self.min_hessian)] = 0
                best = gain.reshape(k, -1).argmax(1)
                bf, bc = best // width, np.where(gain.reshape(k, -1).max(1) > 1e-9, best % width, width)
                feat.append(bf)
                cut.append(bc)
                node = node * 2 + (b[np.arange(len(y)), bf[node]] > bc[node])
            k = 1 << self.depth
            leaf = -self.rate * np.bincount(node, g, k) / (np.bincount(node, h, k) + self.ridge)
            self.splits.append((np.concatenate(feat), np.concatenate(cut), leaf))
            z += leaf[node]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not self.cuts or not len(x):
            return np.full(len(x), self.start)
        b, z, i = self._binned(x), np.full(len(x), self.start), np.arange(len(x))
        for feat, cut, leaf in self.splits:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                node = node * 2 + (b[i, feat[at]] > cut[at])
            z += leaf[node]
        return z


@dataclass
class ToxicityModel:
    learned: np.ndarray
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.trees.margin(x), *self.knots), 0.0, 1.0)


def _lexicon(sample: DataFrame) -> np.ndarray:
    """Hashes of words and stems whose document frequency leans most to label 1."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in K.chunked(batch.column("text")):
                h, s, e, first, px = word_hashes(data, off)
                y = batch.column("y").slice(a, b - a).to_numpy(zero_copy_only=False).astype(np.int64)
                row = K.row_of(first)
                stems = [stem_hashes(px, s, e, k) for k in STEMS]
                h, row = np.concatenate([h, *[x for x, _ in stems]]), np.concatenate([row, *[row[at] for _, at in stems]])
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                word, inv, n = np.unique(h[new], return_inverse=True, return_counts=True)
                ones = np.bincount(inv, weights=y[row[new]], minlength=len(word)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(ones), pa.array(n.astype(np.int64))], ["word", "ones", "n"])

    size = sample.groupBy("y").count().collect()
    n1 = sum(r["count"] for r in size if r["y"] == 1)
    n0 = sum(r["count"] for r in size if r["y"] != 1)
    if not n1 or not n0:
        return np.zeros(0, K.U)
    t = sample.mapInArrow(distinct, "word long, ones long, n long").groupBy("word").agg(F.sum("ones").alias("a"), F.sum("n").alias("n"))
    a, b = F.col("a") + F.lit(0.5), F.col("n") - F.col("a") + F.lit(0.5)
    odds = F.log(a / (F.lit(n1 + 1.0) - a)) - F.log(b / (F.lit(n0 + 1.0) - b))
    z = odds / F.sqrt(1 / a + 1 / b)
    rows = t.where(F.col("a") >= LEXICON_MIN_DOCS).select("word", z.alias("z"), odds.alias("odds")).where((F.col("z") > LEXICON_Z) & (F.col("odds") > LEXICON_ODDS)).orderBy(F.desc("z"), "word").limit(LEXICON_SIZE).collect()
    return np.sort(np.array([r["word"] for r in rows], np.int64).view(K.U))


def fit(sample: DataFrame) -> ToxicityModel:
    """Fit on rows (doc_id, text, y): lexicon and trees on seven tenths, calibration on the rest."""
    bound_batches(sample.sparkSession)
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(10))
    learned = _lexicon(sample.where(part < 7))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, off in K.chunked(batch.column("text")):
                x = features(data, off, learned)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("y").slice(a, b - a), batch.column("part").slice(a, b - a), *[pa.array(c) for c in x.T]], ["doc_id", "y", "part", *FEATURES])

    schema = "doc_id long, y int, part long, " + ", ".join(f"{c} double" for c in FEATURES)
    got = sample.withColumn("part", part).mapInArrow(vectors, schema).toPandas().sort_values(["doc_id", "y"])
    x, y, grown = got[FEATURES].to_numpy(float), got["y"].to_numpy(float), (got["part"] < 7).to_numpy()
    trees = Trees()
    if grown.any() and 0 < y[grown].mean() < 1:
        trees.fit(x[grown], y[grown])
    calibrate = ~grown if (~grown).any() else grown
    return ToxicityModel(learned, trees, isotonic(trees.margin(x[calibrate]), y[calibrate]))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row, in Arrow batches."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            for a, b, data, off in K.chunked(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(m.score(features(data, off, m.learned)))], ["doc_id", "score"])

    return d.mapInArrow(run, "doc_id long, score double")


def in_held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(labelled_sample(docs, labels, "toxic", FIT_ROWS, ~in_held_out()))
    return score(docs, model).select("doc_id", F.coalesce(in_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
