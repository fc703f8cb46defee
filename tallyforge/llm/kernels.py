"""Vectorised text kernels shared by the operators: no Python loop runs per byte or per word.

An Arrow string column is one byte buffer with offsets, so words, lines and rolling hashes of
thousands of documents are computed by a few numpy passes.  Words are maximal runs of bytes
other than space and 0x09-0x0D; A-Z count as a-z.  Identity is by 64-bit hashes.  Memory is
about 60 bytes for each byte of a piece; a piece holds ``PIECE`` bytes or one longer document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
BATCH = 1 << 20
U = np.uint64
SEP = np.zeros(256, bool)
SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = U(0x9E3779B97F4A7C15)
BASE_INV = U(pow(int(BASE), -1, 1 << 64))


def narrow_batches(spark) -> None:
    """Let Spark hand rows to Python by at most about BATCH bytes, not 64 MB: a batch is held by the JVM and by Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("bB")
    if not now.isdigit() or int(now) > BATCH:
        spark.conf.set(key, str(BATCH))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


RAW = mix(np.arange(1, 257, dtype=U) * BASE)
FOLDED = RAW[LOWER]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of BASE and of its inverse, modulo 2^64."""
    size = max(PIECE * 2, 1 << max(0, int(n)).bit_length())
    if size > PIECE * 2:
        return _power_table(size)
    if size not in _powers:
        _powers[size] = _power_table(size)
    return _powers[size]


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, BASE_INV):
        p = np.full(size, base, U)
        p[0] = U(1)
        out.append(np.cumprod(p))
    return out[0], out[1]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.empty(0, np.uint8)
    return buf, off - off[0]


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text, or with a single row."""
    for batch in batches:
        _, off = texts(batch.column(text))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
            yield batch.slice(i, min(j, n) - i)
            i = min(j, n)


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal true runs that don't cross the offsets."""
    n = len(inside)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = off[(off > 0) & (off < n)]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    before[cut] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[cut - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def owner(off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Index of the row that holds each byte position."""
    return np.searchsorted(off, at, "right") - 1


def rolling(buf: np.ndarray, table: np.ndarray = RAW) -> np.ndarray:
    """Prefix sums from which span_hash gets the hash of any byte range."""
    c = np.zeros(len(buf) + 1, U)
    np.cumsum(table[buf] * powers(len(buf))[0][: len(buf)], out=c[1:])
    return c


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((c[end] - c[start]) * powers(len(c))[1][start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, hashes and rows of all words."""
    start, end = runs(~SEP[buf], off)
    return start, end, span_hash(rolling(buf, FOLDED), start, end), owner(off, start)


def shingles(hashes: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of all k-word shingles; fewer than k words make one shingle, none make none."""
    n = len(hashes)
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    out, at = [], []
    if n >= k:
        h = np.zeros(n - k + 1, U)
        for j in range(k):
            h = h * BASE + hashes[j : n - k + 1 + j]
        own = row[: n - k + 1] == row[k - 1 :]
        out.append(mix(h[own]))
        at.append(row[: n - k + 1][own])
    for m in range(1, k):
        rows = np.flatnonzero(count == m)
        if len(rows):
            h = np.full(len(rows), (m * 0xA0761D6478BD642F) & (2**64 - 1), U)
            for j in range(m):
                h = h * BASE + hashes[first[rows] + j]
            out.append(mix(h ^ U(0xE7037ED1A0B428DB)))
            at.append(rows)
    if not out:
        return np.empty(0, U), np.empty(0, np.int64)
    out, at = np.concatenate(out), np.concatenate(at)
    order = np.argsort(at, kind="stable")
    return out[order], at[order]


def distinct_sets(h: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, and offsets."""
    edge = np.searchsorted(row, np.arange(n_rows + 1))
    h = h.copy()
    for i in range(n_rows):
        h[edge[i] : edge[i + 1]].sort()
    if not len(h):
        return h, edge
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[fresh], np.concatenate(([0], np.cumsum(fresh)))[edge]


def parity_sketches(h: np.ndarray, edge: np.ndarray, least: int, per: int, most: int = 1 << 16) -> pa.ListArray:
    """For each slice of hashes the parities of how many fall on each bit, in a power of two of bits: about ``per`` for a hash,
    from ``least`` to ``most``.  The Hamming distance of two sketches is at most the symmetric difference of the sets."""
    n = np.diff(edge)
    size = np.clip(1 << np.ceil(np.log2(np.maximum(per * n, 1))).astype(np.int64), least, most)
    first = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(first[:-1], n) + ((h >> U(20)).astype(np.int64) & np.repeat(size - 1, n))
    odd = (np.bincount(at, minlength=int(first[-1])) & 1).astype(np.uint8)
    return pa.ListArray.from_arrays(pa.array((first // 64).astype(np.int32)), pa.array(np.packbits(odd).view(np.int64)))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
