"""Comparison of the members of groups by their bit sketches, in blocks of bounded size.

A group's asking members are compared with all its members.  Groups of more than ``ROWS`` members are cut into blocks by
hash, and each block of askers meets each block of members once, so no task holds a group whole; small groups share a
task.  A pair becomes a row only if its Hamming distance, a lower bound of the symmetric difference, allows J >= 0.75.
Sketch lengths are powers of two, so the longer of two sketches folds onto the shorter one by XOR.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS, HELD, PAIRS, WORDS = 2048, 8 << 20, 1 << 20, 1 << 21


def may_match(na: str, nb: str, ba: str, bb: str) -> Column:
    """Whether the sizes and bit sketches of two sets allow J >= 0.75."""
    half = lambda x: F.zip_with(F.slice(x, 1, (F.size(x) / 2).cast("int")), F.slice(x, (F.size(x) / 2).cast("int") + 1, F.size(x)), lambda u, v: u.bitwiseXOR(v))
    fold = lambda x, y: F.when(F.size(x) > F.size(y), half(F.col(x))).otherwise(F.col(x))
    hamming = F.aggregate(F.zip_with(fold(ba, bb), fold(bb, ba), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.when(F.least(na, nb) * 4 >= F.greatest(na, nb) * 3, 7 * hamming <= F.col(na) + F.col(nb)).otherwise(F.lit(False))


def _blocked(rows: DataFrame) -> DataFrame:
    """Rows (g, i, j, x, y, team, role) of the blocks; role 1 asks, role 2 answers, role 3 does both."""
    size = rows.groupBy("g").agg(F.count("*").alias("c"), F.count_if("asks").alias("q")).where("q > 0 AND c > 1")
    of = lambda n: F.ceil(F.col(n) / ROWS).cast("int")
    luck = F.xxhash64("x", "y")
    cell = lambda i, j, role: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), role.alias("role"))
    alone = F.array(cell(F.lit(0), F.lit(0), F.when(F.col("asks"), 3).otherwise(2)))
    answers = F.transform(F.sequence(F.lit(0), of("q") - 1), lambda k: cell(k, F.pmod(luck, of("c")), F.lit(2)))
    questions = F.transform(F.sequence(F.lit(0), of("c") - 1), lambda k: cell(F.pmod(luck, of("q")), k, F.lit(1)))
    cells = F.when(F.col("c") <= ROWS, alone).when(F.col("asks"), F.concat(answers, questions)).otherwise(answers)
    return rows.join(size, "g").select("g", "x", "y", "team", F.inline(cells))


class _Sketches:
    def __init__(self, column: pa.ListArray):
        self.flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        off = column.offsets.to_numpy().astype(np.int64)
        self.first, self.size = off[:-1] - off[0], np.diff(off)

    def folded(self, row: np.ndarray, size: int, to: int) -> np.ndarray:
        at = self.first[row][:, None] + np.arange(to)
        out = self.flat[at]
        for k in range(1, size // to):
            out ^= self.flat[at + k * to]
        return out

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        kinds = self.size[a] << 32 | self.size[b]
        for kind in np.unique(kinds).tolist():
            na, nb = kind >> 32, kind & 0xFFFFFFFF
            w = min(na, nb)
            own = np.flatnonzero(kinds == kind)
            step = max(1, WORDS // max(1, w))
            for k in range(0, len(own), step):
                part = own[k : k + step]
                x = self.folded(a[part], na, w) ^ self.folded(b[part], nb, w)
                out[part] = np.bitwise_count(x).sum(1, dtype=np.int64)
        return out


def _near(t: pa.Table, earlier: bool) -> Iterator[pa.RecordBatch]:
    """The near pairs of whole groups, sorted by group."""
    t = t.combine_chunks()
    g, i, j, x, y, team, role, n = (t.column(c).to_numpy() for c in ("g", "i", "j", "x", "y", "team", "role", "n"))
    bits = _Sketches(t.column("bits").combine_chunks())
    own = np.cumsum(np.concatenate(([True], (g[1:] != g[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
    left, right = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    low, high = np.searchsorted(own[right], own[left], "left"), np.searchsorted(own[right], own[left], "right")
    upto = np.concatenate(([0], np.cumsum(high - low)))
    k = 0
    while k < len(left):
        m = max(k + 1, int(np.searchsorted(upto, upto[k] + PAIRS, "right")) - 1)
        count = (high - low)[k:m]
        a = np.repeat(left[k:m], count)
        b = right[np.repeat(low[k:m] - (upto[k:m] - upto[k]), count) + np.arange(len(a))]
        ok = 4 * np.minimum(n[a], n[b]) >= 3 * np.maximum(n[a], n[b])
        if earlier:
            ok &= (x[b] < x[a]) | ((x[b] == x[a]) & (y[b] < y[a]))
        else:
            ok &= (team[a] != team[b]) & ((role[b] == 2) | (x[a] < x[b]))
        a, b = a[ok], b[ok]
        ok = 7 * bits.distance(a, b) <= n[a] + n[b]
        a, b = a[ok], b[ok]
        for at in range(0, len(a), 1 << 16):
            p, q = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (x[p], y[p], x[q], y[q])], ["ax", "ay", "bx", "by"])
        k = m


def _compare(earlier: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = rows = 0
        for b in batches:
            held.append(b)
            size, rows = size + b.nbytes, rows + b.num_rows
            if size >= HELD or rows >= 4 * ROWS:
                t = pa.Table.from_batches(held).combine_chunks()
                keys = [t.column(c).to_numpy() for c in ("g", "i", "j")]
                last = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in keys]))
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield from _near(t.slice(0, cut), earlier)
                held, size, rows = t.slice(cut).combine_chunks().to_batches(), 0, 0
        if sum(b.num_rows for b in held):
            yield from _near(pa.Table.from_batches(held), earlier)

    return run


def near_pairs(rows: DataFrame, sketches: DataFrame, earlier: bool = False) -> DataFrame:
    """Distinct pairs (ax, ay), (bx, by) of an asker and a member of one of its groups whose sketches are near enough.

    ``rows`` are (g, x, y, team, asks), ``sketches`` (x, y, n, bits).  With ``earlier``, b comes before a; otherwise a and b
    are of different teams."""
    cells = _blocked(rows).join(sketches.select("x", "y", F.col("n").cast("long").alias("n"), "bits"), ["x", "y"])
    cells = cells.select("g", "i", "j", "x", "y", "team", "role", "n", "bits").repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
    return cells.mapInArrow(_compare(earlier), "ax long, ay int, bx long, by int").distinct()
