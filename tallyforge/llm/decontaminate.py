"""Benchmark decontamination by character grams and exact edit verification.

Texts are compared as words (A-Z as a-z) joined by one space.  A document is contaminated by an item if some part of
it is within edit distance ``k = floor(SHARE * n)`` of the item's n characters.

* Grams: the q-letter grams of a document, spaces left out, are looked up in the items' grams, in one band of diagonals
  (position in the document less position in the item) after another.  Leaving out spaces adds no edits, and joined and
  split words look alike.  k edits move a match over at most k + 1 diagonals, so two neighbouring wide bands of k + 1
  hold it whole.
* Items under ``SMALL`` letters: k edits leave one of k + 1 pieces unchanged, so q = n // (k + 1), at most 4, and one
  gram in the bands is enough: no match within the bound is lost.
* Longer items: q is 5 or 6.  As many grams as k edits at random places leave in all but 0.5 % of trials are ``usual``;
  a match must have ``NEAR`` times as many in two neighbouring bands of a ``FINE``-th of that width, or ``WIDE`` times as many
  in two wide ones.  Only a match whose edits are spread so evenly, or drift so steadily, that fewer stay is lost.
* What the grams propose, widened by the bound, is verified by exact approximate-substring dynamic programming
  (Sellers); no other filter comes between.
* Items of fewer than five words are too short for edits and match word for word, up to 64-bit hash collisions.

Scale: one scan of the documents without a shuffle; the items are shipped with the tasks in slices of at most
``SLICE`` bytes, one scan for each slice, so nothing shipped grows without bound.  Any number of documents may hold
an item: each is decided in its own task.  Work grows with the grams that documents and items share.

Defined cases: null or empty texts have no grams; items without a word, null item texts and ids are ignored; repeated
rows of a document or an item give one row for each (doc_id, item_id) with the smallest distance; an empty benchmark
or table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.kernels import BASE, LOWER, SEP, U, mix, owner, pieces, texts, words

SHARE, LEAST = 0.2, 5
SMALL, MIDDLE, FINE, NEAR, WIDE, JOINED = 42, 120, 4, 0.75, 1.75, 2
SLICE = 8 << 20
BATCH, HELD, TABLE = 8192, 1 << 22, 1 << 21
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def normal(raw: bytes) -> str:
    return b" ".join(raw.translate(FOLD).replace(b"\x0b", b" ").replace(b"\x0c", b" ").split()).decode(errors="replace")


def padded(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each string in a row, 0 after the end, and lengths."""
    size = np.array([len(s) for s in strings], np.int64)
    out = np.zeros((len(strings), int(size.max(initial=0)) + 1), np.uint32)
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out, size


def substring_distance(pattern: list[str], text: list[str]) -> np.ndarray:
    """The least edit distance of each pattern to any substring of its text (Sellers, 1980), all pairs at once.

    The columns of the recursion are held as bits, 64 rows in a word (Myers, 1999; Hyyro, 2003)."""
    names = {x: i for i, x in enumerate(dict.fromkeys(pattern))}
    p, n = padded(list(names))
    which = np.array([names[x] for x in pattern], np.int64)
    best = n[which]
    blocks = (best + 63) // 64
    for w in np.unique(blocks[blocks > 0]).tolist():
        own = np.flatnonzero(blocks == w)
        step = max(1, TABLE // (w * max(1, len(np.unique(p)))))
        for i in range(0, len(own), step):
            part = own[i : i + step]
            used, at = np.unique(which[part], return_inverse=True)
            best[part] = _bits(p[used], n[used], at, [text[j] for j in part], w)
    return best


def _bits(p: np.ndarray, n: np.ndarray, which: np.ndarray, text: list[str], blocks: int) -> np.ndarray:
    """The distances of patterns p[which], of n characters in so many words, to the texts."""
    order = np.argsort([-len(x) for x in text], kind="stable")
    which = which[order]
    t, m = padded([text[i] for i in order])
    letters = np.unique(p)
    equal = np.zeros((blocks, len(n), len(letters) + 1), U)
    for j in range(min(int(n.max()), p.shape[1])):
        i = np.flatnonzero(n > j)
        equal[j // 64, i, np.searchsorted(letters, p[i, j])] |= U(1) << U(j % 64)
    code = np.minimum(np.searchsorted(letters, t), len(letters) - 1)
    code = np.where(letters[code] == t, code, len(letters)).astype(np.int64) + which[:, None] * (len(letters) + 1)
    code = np.ascontiguousarray(code.T)
    equal = equal.reshape(blocks, -1)
    plus, minus = np.full((blocks, len(m)), ~U(0)), np.zeros((blocks, len(m)), U)
    score = n[which].copy()
    best = score.copy()
    last = ((n[which] - 1) % 64).astype(U)
    alive = np.searchsorted(-m, -np.arange(code.shape[0]), "left")
    for c, k in zip(code, alive, strict=True):
        if not k:
            break
        up, down = U(0), U(0)
        for b in range(blocks):
            pv, mv, eq = plus[b, :k], minus[b, :k], equal[b, c[:k]]
            xv = eq | mv
            eq |= down
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            top = last[:k] if b == blocks - 1 else U(63)
            up_, down_ = (ph >> top) & U(1), (mh >> top) & U(1)
            ph, mh = (ph << U(1)) | up, (mh << U(1)) | down
            plus[b, :k], minus[b, :k] = mh | ~(xv | ph), ph & xv
            up, down = up_, down_
        score[:k] += up.view(np.int64) - down.view(np.int64)
        np.minimum(best[:k], score[:k], out=best[:k])
    out = np.empty_like(best)
    out[order] = best
    return out


def gram_size(n: int, k: int) -> int:
    """For n letters and k edits."""
    return max(1, min(4, n // (k + 1))) if n < SMALL else 5 if n < MIDDLE else 6


@cache
def _least(n: int, k: int, q: int) -> int:
    """The 0.5 % quantile of the grams of n letters that k replaced ones leave unchanged."""
    draw = np.random.default_rng((29, n)).random((1000, n))
    hit = np.zeros((1000, n + 1), np.int32)
    np.put_along_axis(hit, np.argpartition(draw, k, axis=1)[:, :k] + 1, 1, axis=1)
    hit = hit.cumsum(1)
    return int(np.quantile((hit[:, q:] == hit[:, :-q]).sum(1), 0.005))


def usual(n: int, k: int) -> float:
    """The grams that a match of an item of n letters nearly always has, if its edits are at random places."""
    near = n - n % 10 if n < 2000 else 2000
    return _least(near, min(near - 1, k * near // n), gram_size(n, k)) * n / near


def characters(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts as ``normal`` writes them, with a space left at the end at most, and offsets."""
    sep = SEP[buf]
    again = np.empty(len(buf), bool)
    again[1:] = sep[:-1]
    again[off[:-1][off[:-1] < len(buf)]] = True
    keep = ~(sep & again)
    low = np.where(sep, 32, LOWER[buf]).astype(np.uint8)
    size = np.concatenate(([0], np.cumsum(keep & ((low & 0xC0) != 0x80))))[off]
    raw = low[keep].tobytes()
    flat = raw.decode(errors="replace")
    if len(flat) != size[-1]:
        edge = np.concatenate(([0], np.cumsum(keep)))[off]
        rows = [raw[i:j].decode(errors="replace") for i, j in zip(edge[:-1], edge[1:], strict=True)]
        size, flat = np.concatenate(([0], np.cumsum([len(x) for x in rows], dtype=np.int64))), "".join(rows)
    return np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32), size


def runs_of(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k neighbours in a row, and where they start."""
    m = len(h) - k + 1
    if m <= 0:
        return np.empty(0, U), np.empty(0, np.int64)
    out = np.full(m, k, U)
    for j in range(k):
        out = out * BASE + h[j : m + j]
    at = np.flatnonzero(row[:m] == row[k - 1 :])
    return mix(out[at]), at


class Lookup:
    """Hashes with two numbers each, to be found by hash."""

    def __init__(self, key: np.ndarray, item: np.ndarray, offset: np.ndarray):
        order = np.argsort(key, kind="stable")
        self.key, self.first = np.unique(key[order], return_index=True)
        self.last = np.append(self.first[1:], len(key))
        self.item, self.offset = item[order], offset[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.key >> U(44)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes into ``h`` and into the entries, for each equal pair."""
        hit = np.flatnonzero(self.maybe[(h >> U(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.key, h[hit]), len(self.key) - 1)
        same = self.key[k] == h[hit]
        hit, k = hit[same], k[same]
        n = self.last[k] - self.first[k]
        return np.repeat(hit, n), np.repeat(self.first[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _two(key: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The counts of each band and the next one together."""
    after = np.append(key[1:] == key[:-1] + 1, False)
    return c + np.where(after, np.append(c[1:], 0), 0)


class Items:
    """The items of a slice with their grams, and the short ones with their words."""

    def __init__(self, ids: list[int], raw: list[str]):
        buf, off = texts(pa.array(raw, pa.large_string()))
        _, _, h, row = words(buf, off)
        count = np.bincount(row, minlength=len(raw))
        self.ids, self.texts = np.array(ids, np.int64), [normal(x.encode()) for x in raw]
        self.n = np.array([len(x) for x in self.texts], np.int64)
        self.k = np.array([int(SHARE * n) for n in self.n], np.int64)
        own_texts = [x.replace(" ", "") for x in self.texts]
        self.letters = np.array([len(x) for x in own_texts], np.int64)
        use = count >= LEAST
        least = np.array([usual(int(x), int(k)) if u and x >= SMALL else 0 for x, k, u in zip(self.letters, self.k, use, strict=True)])
        self.near, self.wide = (np.maximum(1, np.where(self.letters < SMALL, 1, least * x)) for x in (NEAR, WIDE))
        self.width = (self.k + FINE) // FINE
        sizes = np.array([gram_size(int(x), int(k)) for x, k in zip(self.letters, self.k, strict=True)], np.int64)
        cp, size = characters(*texts(pa.array(own_texts, pa.large_string())))
        at = owner(size, np.arange(len(cp)))
        self.grams: list[tuple[int, Lookup]] = []
        for q in np.unique(sizes[use]).tolist():
            g, p = runs_of(cp.astype(U), at, q)
            own = ((sizes == q) & use)[at[p]]
            self.grams.append((q, Lookup(g[own], at[p[own]], p[own] - size[at[p[own]]])))
        self.whole: list[tuple[int, Lookup]] = []
        for m in range(1, LEAST):
            if (count == m).any():
                g, p = runs_of(h, row, m)
                own = (count == m)[row[p]]
                self.whole.append((m, Lookup(g[own], row[p[own]], p[own])))

    def exact(self, b: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        """(row, item) for each short item that a row holds word for word."""
        if not self.whole:
            return
        _, _, h, row = words(*texts(b.column("text")))
        for m, lookup in self.whole:
            g, p = runs_of(h, row, m)
            i, j = lookup.find(g)
            yield from np.unique(np.stack([row[p[i]], lookup.item[j]]), axis=1).T.tolist()

    def windows(self, b: pa.RecordBatch) -> Iterator[tuple[int, int, str]]:
        """(row, item, window) for each stretch of bands with enough grams, widened by the bound."""
        cp, size = characters(*texts(b.column("text")))
        place = np.flatnonzero(cp != 32)
        edge = np.searchsorted(place, size)
        letters = cp[place].astype(U)
        row = np.repeat(np.arange(b.num_rows), np.diff(edge))
        for q, lookup in self.grams:
            d, item, start, end = self._bands(letters, row, edge, q, lookup)
            first, last = np.maximum(edge[d], edge[d] + start), np.minimum(edge[d + 1], edge[d] + end)
            full = last > first
            low, high = place[first[full]], place[last[full] - 1] + 1
            for r, i, x, y in zip(d[full].tolist(), item[full].tolist(), low.tolist(), high.tolist(), strict=True):
                yield r, i, cp[x:y].tobytes().decode("utf-32-le", "surrogatepass")

    def _bands(self, letters: np.ndarray, row: np.ndarray, edge: np.ndarray, q: int, lookup: Lookup) -> tuple[np.ndarray, ...]:
        """Rows, items, starts and ends of the stretches, up to ``JOINED`` neighbouring bands in each."""
        g, p = runs_of(letters, row, q)
        i, j = lookup.find(g)
        if not len(i):
            return (np.empty(0, np.int64),) * 4
        n = self.letters
        pad = int(n.max())
        p, item = p[i], lookup.item[j]
        fine = (p - edge[row[p]] - lookup.offset[j] + pad) // self.width[item]
        many = (int(fine.max()) + 2) // FINE * FINE + FINE
        key, c = np.unique((row[p] * len(n) + item) * many + fine, return_counts=True)
        item = key // many % len(n)
        good = key[_two(key, c) >= self.near[item]] // FINE
        first = np.flatnonzero(np.append(True, key[1:] // FINE != key[:-1] // FINE))
        many //= FINE
        key, c = key[first] // FINE, np.add.reduceat(c, first)
        key = np.union1d(good, key[_two(key, c) >= self.wide[key // many % len(n)]])
        fresh = np.flatnonzero(np.append(True, key[1:] != key[:-1] + 1)) if len(key) else key
        place = np.arange(len(key)) - np.repeat(fresh, np.diff(np.append(fresh, len(key))))
        key = key[place % JOINED == 0]
        item, first = key // many % len(n), key % many
        k, width = self.k[item], self.width[item] * FINE
        return key // many // len(n), item, first * width - pad - k, (first + JOINED + 1) * width - pad + k + n[item]


def _matches(items: Items):
    def decide(held: list[tuple[int, int, str]]) -> Iterator[pa.RecordBatch]:
        dist = substring_distance([items.texts[x[1]] for x in held], [x[2] for x in held])
        size = np.array([len(items.texts[x[1]]) for x in held])
        good = np.flatnonzero(dist <= np.floor(SHARE * size))
        cols = [pa.array([held[j][0] for j in good], pa.int64()), pa.array([int(items.ids[held[j][1]]) for j in good], pa.int64()), pa.array(dist[good]), pa.array(size[good])]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "distance", "item_chars"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, str]] = []
        size = 0
        for b in pieces(batches):
            ids = b.column("doc_id").to_pylist()
            whole = list(items.exact(b))
            if whole:
                cols = [pa.array([ids[d] for d, _ in whole], pa.int64()), pa.array(items.ids[[i for _, i in whole]]), pa.array(np.zeros(len(whole), np.int64)), pa.array(items.n[[i for _, i in whole]])]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "item_id", "distance", "item_chars"])
            for d, *rest in items.windows(b):
                held.append((ids[d], *rest))
                size += len(rest[1])
                if len(held) >= BATCH or size >= HELD:
                    yield from decide(held)
                    held, size = [], 0
        if held:
            yield from decide(held)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, distance, item_chars`` for each pair of a document and an item that it holds."""
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    rows = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slices = max(1, -(-total // SLICE))
    found = None
    for i in range(slices):
        own = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == i).collect()
        items = Items([r[0] for r in own], [r[1] for r in own])
        part = docs.mapInArrow(_matches(items), "doc_id long, item_id long, distance long, item_chars long")
        found = part if found is None else found.union(part)
    return found.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"), F.max("item_chars").alias("item_chars"))
