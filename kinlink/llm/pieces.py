"""SentencePiece encoding and decoding with exact N-best segmentation.

The model file gives pieces and scores; a segmentation's score is the sum of its
pieces' scores, a character that is no piece costs ``unk`` and becomes byte pieces.
A forward Viterbi pass fills every lattice node with the best score of its prefix;
N-best paths come from a backward A* search from the end of the text, for which
those forward scores are an exact heuristic, so each pop that reaches the start is
the next best path.

No piece has a space except at its start and none has a line feed, so a text's
lattice is a chain of independent units (a run of spaces and the word after it).
The forward pass runs over all distinct units of an Arrow batch at once in numpy; a
unit of more than ``LONG`` characters has its pieces found at once and is walked alone.
The N best of a text only ever deviate in the N - 1 units whose second best path
costs least, so A* runs on those and a heap joins their paths: still exact.

Work is bounded by the size of the text: A* leaves a position after N visits (the N best
paths need no more than the N best ways from it to the end), and of equal scores it
follows the one nearest the start, so ties never spread.

Defined cases: a null or empty text has no tokens, score 0 and one segmentation; equal
scores prefer the longer last piece, in the best path, and any order among the others;
U+2581 itself is byte pieces, so decoding gives back every text byte for byte; a text with
fewer than N segmentations lists all; a very long text, also one without spaces, is encoded
whole, in time and memory in proportion to its length; repeated rows give equal rows;
other columns, whatever their names, are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .shared import bound_batches

N_BEST = 4
#: Bytes of text encoded at a time; more share more distinct units.
CHUNK_BYTES = 6 << 20
UNK_PENALTY = 10.0
USER_DEFINED = -1e8
_SLOT_BITS = 20
#: Characters of a unit beyond which it is walked alone.
LONG = 256


@dataclass
class PieceModel:
    """Pieces of a model file; ▁ is kept as a space."""

    pieces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    prefix: bool

    @classmethod
    def load(cls, path: str) -> PieceModel:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        pieces, scores, byte_ids = [b""] * n, np.zeros(n), np.full(256, -1, np.int64)
        for i in range(n):
            name = m.id_to_piece(i)
            if m.is_byte(i):
                byte_ids[int(name[1:-1], 16)] = i
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                pieces[i] = name.replace("▁", " ").encode()
                scores[i] = m.get_score(i)
        # user-defined pieces (the lone space, runs of spaces) have no learned score: they are
        # priced like the rarest piece that has one
        scores[scores <= USER_DEFINED] = scores[scores > USER_DEFINED].min(initial=0.0)
        if (byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        if any(b"\n" in p or b" " in p.lstrip(b" ") for p in pieces):
            raise ValueError("a piece crosses a word border")
        return cls(pieces, scores, byte_ids, m.encode("a", out_type=str)[0].startswith("▁"))

    def prepare(self) -> PieceModel:
        """Lookup tables; made on each worker, not shipped."""
        if hasattr(self, "slots"):
            return self
        used = np.array([i for i, p in enumerate(self.pieces) if p], np.int64)
        data = np.frombuffer(b"".join(self.pieces[i] for i in used), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(self.pieces[i]) for i in used])])
        h = K.mix(K.Prefix(data).span(off[:-1], off[1:]))
        slot = (h >> K.U(64 - _SLOT_BITS)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        self.keys, self.ids = h[order], used[order]
        self.slots = np.searchsorted(slot[order], np.arange((1 << _SLOT_BITS) + 1)).astype(np.int32)
        self.depth = int(np.diff(self.slots).max())
        self.longest = max(len(p.decode()) for p in self.pieces)
        self.unk = float(self.scores.min()) - UNK_PENALTY
        self.lookup = {p: i for i, p in enumerate(self.pieces) if p}
        text = [bytes([np.flatnonzero(self.byte_ids == i)[0]]) if not p and (self.byte_ids == i).any() else p for i, p in enumerate(self.pieces)]
        self.text, self.text_off = np.frombuffer(b"".join(text), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in text])])
        return self

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of span hashes, -1 where there is none."""
        h = K.mix(h)
        slot = (h >> K.U(64 - _SLOT_BITS)).astype(np.int64)
        lo = self.slots[slot]
        left = np.flatnonzero(self.slots[slot + 1] > lo)
        out = np.full(len(h), -1, np.int64)
        for d in range(self.depth):
            at = lo[left] + d
            same = self.keys[at] == h[left]
            out[left[same]] = self.ids[at[same]]
            rest = ~same & (at + 1 < self.slots[slot[left] + 1])
            left = left[rest]
            if not len(left):
                break
        return out


def _ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices of start[i] .. start[i] + count[i] - 1, one after another."""
    to = np.cumsum(count)
    return np.arange(to[-1] if len(to) else 0) - np.repeat(to - count - start, count)


@dataclass
class Lattice:
    """Forward pass over distinct units: node scores, best paths, price of the second best."""

    base: np.ndarray
    alpha: np.ndarray
    second: np.ndarray  # per unit: loss of its second best path
    score: np.ndarray
    ids: np.ndarray
    first: np.ndarray  # per unit: its first token, one more at the end


def _edges(m: PieceModel, px: K.Prefix, pos: np.ndarray) -> tuple[list[int], list[int], list[int], list[float]]:
    """All pieces of one unit by their end: end and size in characters, piece (-1: none), score."""
    ends, sizes, found = [], [], []
    for n in range(1, min(m.longest, len(pos) - 1) + 1):
        got = m.find(px.span(pos[:-n], pos[n:]))
        at = np.arange(len(got)) if n == 1 else np.flatnonzero(got >= 0)
        ends.append(at + n)
        sizes.append(np.full(len(at), n))
        found.append(got[at])
    end, size, piece = np.concatenate(ends), np.concatenate(sizes), np.concatenate(found)
    order = np.argsort(end, kind="stable")  # smaller pieces stay first
    piece = piece[order]
    return end[order].tolist(), size[order].tolist(), piece.tolist(), np.where(piece >= 0, m.scores[piece], m.unk).tolist()


def _forward_alone(m: PieceModel, px: K.Prefix, pos: np.ndarray) -> tuple[list[float], list[float], list[int], list[int]]:
    """alpha, loss, span and piece of every node of one long unit."""
    n = len(pos)
    alpha, other, span, piece = [0.0] + [-np.inf] * (n - 1), [-np.inf] * n, [0] * n, [-1] * n
    for e, k, i, s in zip(*_edges(m, px, pos), strict=True):
        v = alpha[e - k] + s
        if v >= alpha[e]:
            alpha[e], other[e], span[e], piece[e] = v, alpha[e], k, i
        elif v > other[e]:
            other[e] = v
    return alpha, [x - y if y > -np.inf else np.inf for x, y in zip(alpha, other, strict=True)], span, piece


def forward(m: PieceModel, data: np.ndarray, px: K.Prefix, chars: np.ndarray, cs: np.ndarray, cl: np.ndarray) -> Lattice:
    """cs, cl: each unit's first character and number of characters; chars: byte offsets."""
    order = np.argsort(-cl, kind="stable")
    cs, cl = cs[order], cl[order]
    base = np.concatenate([[0], np.cumsum(cl + 1)])
    alpha, loss = np.full(base[-1], -np.inf), np.full(base[-1], np.inf)
    span, piece = np.zeros(base[-1], np.int64), np.full(base[-1], -1, np.int64)
    alpha[base[:-1]] = 0
    alone = int((cl > LONG).sum())
    for u in range(alone):
        nodes = slice(base[u], base[u + 1])
        alpha[nodes], loss[nodes], span[nodes], piece[nodes] = _forward_alone(m, px, chars[cs[u] : cs[u] + cl[u] + 1])
    active = np.searchsorted(-cl, -np.arange(1, (cl[alone] if len(cl) > alone else 0) + 1), "right")
    for p, to in enumerate(active, 1):
        k = to - alone
        node, end = base[alone:to] + p, chars[cs[alone:to] + p]
        best, other = np.full(k, -np.inf), np.full(k, -np.inf)
        bl, bi = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        for n in range(1, min(p, m.longest) + 1):
            start = chars[cs[alone:to] + p - n]
            got = m.find(px.span(start, end))
            use = np.flatnonzero(got >= 0) if n > 1 else np.arange(k)
            if not len(use):
                continue
            s = np.where(got[use] >= 0, m.scores[got[use]], m.unk)
            v = alpha[node[use] - n] + s
            up = v >= best[use]
            w = use[up]
            other[use] = np.where(up, best[use], np.maximum(other[use], v))
            best[w], bl[w], bi[w] = v[up], n, got[w]
        alpha[node], span[node], piece[node] = best, bl, bi
        loss[node] = np.where(np.isfinite(other), best - other, np.inf)
    # walk the best paths back, all units a step at a time, long ones alone
    n_units = len(cs)
    tokens, second = np.zeros(n_units, np.int64), np.full(n_units, np.inf)
    walked: list[np.ndarray] = []
    for u in range(alone):
        back, p = span[base[u] : base[u + 1]].tolist(), int(cl[u])
        path = []
        while p:
            path.append(p)
            p -= back[p]
        nodes = np.array(path[::-1], np.int64)
        walked.append(nodes)
        tokens[u], second[u] = len(nodes), loss[base[u] + nodes].min()
    unit = np.arange(alone, n_units)
    at = cl[alone:].copy()
    steps: list[tuple] = []
    while len(unit):
        node = base[unit] + at
        second[unit] = np.minimum(second[unit], loss[node])
        at = at - span[node]
        steps.append((unit, piece[node], cs[unit] + at))
        tokens[unit] += 1
        go = at > 0
        unit, at = unit[go], at[go]
    at = np.cumsum(tokens)
    pid, char = np.zeros(at[-1] if n_units else 0, np.int64), np.zeros(at[-1] if n_units else 0, np.int64)
    for u, nodes in enumerate(walked):
        use = slice(at[u] - tokens[u], at[u])
        pid[use], char[use] = piece[base[u] + nodes], cs[u] + nodes - span[base[u] + nodes]
    for j, (u, i, c) in enumerate(steps):
        pid[at[u] - 1 - j], char[at[u] - 1 - j] = i, c
    count = np.where(pid < 0, chars[char + 1] - chars[char], 1)
    ids = np.repeat(pid, count)
    raw = ids < 0
    ids[raw] = m.byte_ids[data[(_ragged(chars[char], count))[raw]]]
    first = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], at])]
    # back to the callers' order
    back = np.empty(n_units, np.int64)
    back[order] = np.arange(n_units)
    size = np.diff(first)[back]
    ids = ids[_ragged(first[:-1][back], size)]
    return Lattice(base[:-1][back], alpha, second[back], alpha[base[:-1] + cl][back], ids, np.concatenate([[0], np.cumsum(size)]))


def backward(m: PieceModel, text: bytes, alpha: np.ndarray, n: int) -> list[tuple[float, list[int]]]:
    """The n best paths of one unit by A* from its end; alpha: its forward scores by character."""
    cut, score, reach = [i for i, b in enumerate(text) if b & 0xC0 != 0x80] + [len(text)], m.scores, alpha.tolist()
    visits = [0] * len(cut)
    # of equal scores the position nearest the start first, so a tied path is ended before others grow
    heap, out, tick = [(-reach[-1], len(cut) - 1, 0, 0.0, ())], [], 0
    while heap and len(out) < n:
        f, p, _, g, path = heapq.heappop(heap)
        if p == 0:
            ids: list[int] = []
            while path:
                ids += path[0]
                path = path[1]
            out.append((-f, ids))
            continue
        if visits[p] == n:
            continue
        visits[p] += 1
        for k in range(1, min(p, m.longest) + 1):
            part = text[cut[p - k] : cut[p]]
            i = m.lookup.get(part, -1)
            if i >= 0:
                s, ids = float(score[i]), [i]
            elif k == 1:
                s, ids = m.unk, [int(m.byte_ids[b]) for b in part]
            else:
                continue
            if visits[p - k] < n or p == k:
                tick += 1
                heapq.heappush(heap, (-(g + s + reach[p - k]), p - k, tick, g + s, (ids, path)))
    return out


def join_best(lists: list[list[float]], total: float, n: int) -> list[tuple[float, list[int]]]:
    """The n best sums of one entry a list (each sorted, best first): (score, choice of each)."""
    heap, seen, out = [(-total, (0,) * len(lists))], set(), []
    while heap and len(out) < n:
        f, pick = heapq.heappop(heap)
        out.append((-f, list(pick)))
        for j, l in enumerate(lists):
            if pick[j] + 1 < len(l):
                nxt = pick[:j] + (pick[j] + 1,) + pick[j + 1 :]
                if nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (f + l[pick[j]] - l[pick[j] + 1], nxt))
    return out


def _units(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Character offsets; each unit's first character and size; each text's first unit."""
    n = len(data)
    space, feed = data == 32, data == 10
    chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), n)
    head = np.zeros(n, bool)
    head[off[:-1][off[:-1] < n]] = True
    head |= feed
    head[1:] |= feed[:-1] | (space[1:] & ~space[:-1])
    starts = np.flatnonzero(head)
    cs = np.searchsorted(chars, starts)
    cl = np.diff(np.append(cs, len(chars) - 1))
    return chars, cs, cl, np.searchsorted(starts, off)


@dataclass
class Encoded:
    ids: np.ndarray
    first: np.ndarray
    score: np.ndarray
    nbest: list[list[tuple[float, list[tuple[int, int, list[int]]]]]]  # score, [(position in the text's ids, ids that go, ids in their place)]

    def segmentation(self, i: int, k: int) -> np.ndarray:
        """All ids of the k-th best segmentation of text i; 0 is the best."""
        ids, parts, at = self.ids[self.first[i] : self.first[i + 1]], [], 0
        for p, gone, new in self.nbest[i][k][1]:
            parts += [ids[at:p], np.array(new, ids.dtype)]
            at = p + gone
        return np.concatenate([*parts, ids[at:]])


def encode_chunk(m: PieceModel, data: np.ndarray, off: np.ndarray, n: int) -> Encoded:
    """Encode the texts data[off[i]:off[i + 1]], with the n best segmentations of each."""
    if m.prefix:
        full = np.flatnonzero(np.diff(off) > 0)
        data = np.insert(data, off[:-1][full], 32)
        off = off + np.concatenate([[0], np.cumsum(np.diff(off) > 0)])
    chars, cs, cl, first = _units(data, off)
    px = K.Prefix(data)
    _, one, which = np.unique(K.mix(px.span(chars[cs], chars[cs + cl]) + cl.astype(K.U)), return_index=True, return_inverse=True)
    # the distinct units alone, side by side
    start, cl = chars[cs[one]], cl[one]
    data = data[_ragged(start, chars[cs[one] + cl] - start)]
    chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    cs = np.cumsum(cl) - cl
    lat = forward(m, data, K.Prefix(data), chars, cs, cl)
    count = np.diff(lat.first)[which]
    ids = lat.ids[_ragged(lat.first[:-1][which], count)]
    to = np.concatenate([[0], np.cumsum(count)])
    total = np.concatenate([[0.0], np.cumsum(lat.score[which])])
    score = np.array([lat.score[which[a:b]].sum() for a, b in zip(first[:-1], first[1:], strict=True)]) if len(off) > 1 else total[:0]
    second, done, best = lat.second[which], {}, []
    for i in range(len(off) - 1):
        a, b = first[i], first[i + 1]
        loss = second[a:b]
        if b - a > n - 1 > 0:
            top = np.argpartition(loss, n - 2)[: n - 1]
        else:
            top = np.arange(b - a if n > 1 else 0)
        top = np.sort(top[np.isfinite(loss[top])])
        paths = []
        for u in top:
            w = int(which[a + u])
            if w not in done:
                c, l, s = cs[w], cl[w], lat.base[w]
                found = backward(m, data[chars[c] : chars[c + l]].tobytes(), lat.alpha[s : s + l + 1], n)
                # of equal scores the forward path is the first
                own = lat.ids[lat.first[w] : lat.first[w + 1]].tolist()
                others = [p for _, p in found if p != own]
                done[w] = [(f, p) for (f, _), p in zip(found, [own, *others], strict=False)]
            paths.append(done[w])
        best.append([(f, [(int(to[a + top[j]] - to[a]), int(count[a + top[j]]), paths[j][k][1]) for j, k in enumerate(pick) if k]) for f, pick in join_best([[p[0] for p in x] for x in paths], float(score[i]), n)])
    return Encoded(ids, to[first], score, best)


def decode(m: PieceModel, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts from their ids; the dummy space goes."""
    size = np.diff(m.text_off)[ids]
    data = m.text[_ragged(m.text_off[:-1][ids], size)]
    off = np.concatenate([[0], np.cumsum(size)])[first]
    if m.prefix and len(data):
        lead = off[:-1][np.diff(off) > 0]
        keep = np.ones(len(data), bool)
        keep[lead[data[lead] == 32]] = False
        data, off = data[keep], np.concatenate([[0], np.cumsum(keep)])[off]
    return data, off


def encode(docs: DataFrame, model: PieceModel, n: int = N_BEST, ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, score, nbest_scores, nbest_sha256, ids_sha256, round_trip and, if asked for, ids and nbest_changes.

    The digests are of the ids as little-endian 32-bit integers, nbest_sha256 of each
    segmentation's, the best first; round_trip says that decoding the best gives the text
    again, byte for byte.  nbest_changes has what each segmentation changes in ids: from
    position ``at`` on, ``gone`` of them are replaced by ``new``.
    """
    bound_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, score double, nbest_scores array<double>, nbest_sha256 array<string>, ids_sha256 string, round_trip boolean" + (", ids array<int>, nbest_changes array<array<struct<at:int,gone:int,new:array<int>>>>" if ids else "")
    changes = pa.list_(pa.list_(pa.struct([("at", pa.int32()), ("gone", pa.int32()), ("new", pa.list_(pa.int32()))])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value.prepare()
        for batch in batches:
            for a, b, data, off in K.chunked(batch.column("text"), CHUNK_BYTES):
                x = encode_chunk(m, data, off, n)
                again, at = decode(m, x.ids, x.first)
                raw = x.ids.astype("<i4")
                rows = range(b - a)
                same = np.diff(at) == np.diff(off)
                ok = [bool(same[i]) and np.array_equal(again[at[i] : at[i + 1]], data[off[i] : off[i + 1]]) for i in rows]
                cols = [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(x.first)), pa.array(x.score), pa.array([[f for f, _ in best] for best in x.nbest], pa.list_(pa.float64())),
                        pa.array([[hashlib.sha256(x.segmentation(i, k).astype("<i4").tobytes()).hexdigest() for k in range(len(x.nbest[i]))] for i in rows], pa.list_(pa.string())),
                        pa.array([hashlib.sha256(raw[x.first[i] : x.first[i + 1]].tobytes()).hexdigest() for i in rows], pa.string()), pa.array(ok, pa.bool_())]
                names = ["doc_id", "n_tokens", "score", "nbest_scores", "nbest_sha256", "ids_sha256", "round_trip"]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(x.first.astype(np.int32)), pa.array(raw)))
                    cols.append(pa.array([[[{"at": p, "gone": g, "new": new} for p, g, new in c] for _, c in best] for best in x.nbest], changes))
                    names += ["ids", "nbest_changes"]
                yield pa.RecordBatch.from_arrays(cols, names)

    return d.mapInArrow(run, schema)


def default_model() -> PieceModel:
    import public_tokenizers

    return PieceModel.load(public_tokenizers.path("piece_bpe_32k.model"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_model(), N_BEST, ids=False)
