"""Vectorised text kernels over Arrow buffers (numpy, no per-row Python).

All hashes are polynomials modulo 2**64 over randomly coded bytes, read from
prefix sums: ``hash(s, e) = (H[e] - H[s]) * B**-s``.  Word and shingle hashes are
mixed afterwards.  The constants are fixed, so every executor agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)  # odd, so invertible modulo 2**64
BASE_INV = U(pow(int(BASE), -1, 1 << 64))
#: [\x20\x09-\x0D]
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text handled at a time; a longer text is handled alone.
CHUNK_BYTES = 2 << 20

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


CODES = mix(np.arange(1, 257, dtype=U) * BASE)


def _pow(kind: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1024)
        p = np.full(size, base, dtype=U)
        p[0] = U(1)
        p = np.multiply.accumulate(p)
        if size <= 4 * CHUNK_BYTES:
            _powers[kind] = p
        return p
    return have


class Prefix:
    """Prefix hashes of one byte buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.h = np.zeros(n + 1, dtype=U)
        np.cumsum(CODES[data] * _pow("b", BASE, n + 1)[:n], out=self.h[1:])
        self.inv = _pow("i", BASE_INV, n + 1)

    def span(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Hashes of data[s:e]; equal bytes give equal hashes wherever they stand."""
        return (self.h[e] - self.h[s]) * self.inv[s]

    def windows(self, n: int) -> np.ndarray:
        """Hashes of all windows of n bytes."""
        m = len(self.h) - n
        return (self.h[n:] - self.h[:m]) * self.inv[:m] if m > 0 else np.zeros(0, dtype=U)


def buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, dat = col.buffers()
    o = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    d = np.frombuffer(dat, np.uint8) if dat is not None and dat.size else np.zeros(0, np.uint8)
    return d[o[0] : o[-1]], o - o[0]


def chunked(col, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes."""
    data, off = buffers(col)
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def words(data: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and first word of every text (one more at the end)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    solid = ~gap[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    cut = off[(off > 0) & (off < n)]
    before[cut], after[cut - 1] = False, False
    s, e = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return s, e, np.searchsorted(s, off)


def row_of(first: np.ndarray) -> np.ndarray:
    """Text number of every item, from each text's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def runs(h: np.ndarray, first: np.ndarray, n: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of n items within each text and each text's first run.

    whole: a text of 1 to n - 1 items gives its whole sequence as one run.
    """
    size = np.diff(first)
    count = np.maximum(size - n + 1, 0)
    if whole:
        count = np.where((size > 0) & (count == 0), 1, count)
    start = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(start[-1]) - np.repeat(start[:-1] - first[:-1], count)
    last = np.repeat(first[1:], count) - 1
    m = mix(h)
    out = np.zeros(len(at), dtype=U)
    for j in range(n):
        p = at + j
        ok = p <= last
        v = m[np.minimum(p, last)] if len(last) else m[:0]
        out = out * BASE + np.where(ok, v, U(j + 7))
    return mix(out), start


def _planes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view("u1").reshape(-1, 8)[:, :width].T).tobytes() if len(x) else b""


def _unplanes(b: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), "u1")
    out[:, :width] = b.reshape(width, n).T
    return out.reshape(-1).view("<u8")


def pack(columns: list[tuple[np.ndarray, int, bool]]) -> bytes:
    """(values, bytes each, differences?) columns of one length, byte planes, compressed."""
    n = len(columns[0][0])
    body = b"".join(_planes(np.diff(x.astype("<u8"), prepend=U(0)) if d else x, w) for x, w, d in columns)
    return zstandard.ZstdCompressor(level=1).compress(n.to_bytes(8, "little") + body)


def unpack(blob: bytes, columns: list[tuple[int, bool]]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, []
    for w, d in columns:
        x = _unplanes(np.frombuffer(raw, "u1", n * w, at), n, w)
        mask = U((1 << 8 * w) - 1)
        out.append(np.cumsum(x) & mask if d else x)
        at += n * w
    return out
