"""Removal of repeated 200-byte strings with suffix arrays by linear grouping construction (Baier, 2016).

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too.  Texts are UTF-8 bytes and
matches never cross documents.

1. Anchors.  Among the starts s .. s + W - 1 of K-byte strings inside a LENGTH-byte string (W = LENGTH - K + 1) the
   leftmost one with the least hash is the anchor of s.  It depends on those LENGTH bytes alone, so equal strings have
   equal anchors at equal offsets: only starts whose anchors have the same hash can match.  The starts that
   share an anchor are consecutive; an anchor's region is what their strings cover.
2. Anchors are counted by hash.  Equal regions (by hash and offset) settle each other: all of both goes.  Groups that
   also have differing regions (near copies, the edges of a shared passage) go on with one copy of each region.
3. Regions are cut into ``BLOCK``-byte symbols, aligned at the anchor and ranked in byte order, and the suffix array of a
   stretch of groups is built by grouping: suffixes are grouped by Lyndon prefix from the highest group down, with
   previous-smaller pointers, and the groups' order is then emitted from the lowest suffix up, without recursion or
   renaming.  Neighbours in it that agree in as many symbols as LENGTH bytes surely hold are candidates, and their
   strings are compared exactly, by 64-bit hashes, at each start.

The symbols stand for BLOCK bytes because the construction is sequential Python; see the README for figures.

Scale: one row for each anchor (about 1.6 % of the bytes) is shuffled once by anchor hash.  Text is scanned twice;
regions are fetched by a Bloom filter of bounded size whose false positives only cost rows.  A group with more
than ``BIG`` different regions is not gathered: the hashes of its strings are counted with partial aggregation.
The intervals of a document, bounded by its own length, are joined with its text by doc_id.

Defined cases: null text is empty; texts shorter than LENGTH lose nothing; rows that share a doc_id share the intervals;
no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.bloom import Bloom
from tallyforge.llm.kernels import U, mix, owner, pieces, powers, rolling, runs, signed, span_hash, texts
from tallyforge.plans.scratch import staged

LENGTH, K = 200, 80
W = LENGTH - K + 1
BLOCK = 8
SURE = (LENGTH - BLOCK + 1) // BLOCK
BIG, SYMBOLS = 4096, 60_000


def suffix_array(text: list[int]) -> list[int]:
    """The suffix array of a sequence of non-negative integers, by linear grouping construction.

    Phase 1 keeps suffixes in ordered groups, at first by symbol.  From the highest group down, each member i points to
    the nearest earlier suffix of a lower group; that one's Lyndon prefix is longer by the members that point to it,
    so it leaves its group for a new one just above, by how many they are.  Phase 2 goes through suffixes in order: for each,
    the chain of previous-smaller pointers from the suffix before it is placed at the front of their groups."""
    n = len(text)
    if not n:
        return []
    members: list[list[int]] = []
    below: list[int] = []
    above: list[int] = []
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_symbol.setdefault(c, []).append(i)
    group = [0] * n
    for g, c in enumerate(sorted(by_symbol)):
        members.append(by_symbol[c])
        below.append(g - 1)
        above.append(g + 1)
        for i in by_symbol[c]:
            group[i] = g
    above[-1] = -1
    lowest = 0
    previous, done = [-1] * n, bytearray(n)
    g = len(members) - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        own.sort()
        members[g] = own
        count: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and (done[j] or group[j] == g):
                j = previous[j]
            previous[i] = j
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        for i in own:
            done[i] = 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, times in count.items():
            moved.setdefault((group[j], times), []).append(j)
        last: dict[int, int] = {}
        for h, times in sorted(moved):
            new, under = len(members), last.get(h, h)
            over = above[under]
            members.append(moved[h, times])
            below.append(under)
            above.append(over)
            above[under] = new
            if over >= 0:
                below[over] = new
            last[h] = new
            for j in members[new]:
                group[j] = new
        g = below[g]
    front, at, g = [0] * len(members), 1, lowest
    while g >= 0:
        front[g] = at
        at += sum(1 for i in members[g] if group[i] == g)
        g = above[g]
    order, placed = [n] * (n + 1), bytearray(n)
    for r in range(n + 1):
        j = order[r] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[front[g]] = j
            front[g] += 1
            placed[j] = 1
            j = previous[j]
    return order[1:]


def anchors(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first start, number of further starts, the anchor's offset from the first start, its hash, and the region's hash."""
    n = len(buf)
    c = rolling(buf)
    none = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64, U, U))
    if n < LENGTH:
        return none
    at = np.arange(n - K + 1)
    gram = span_hash(c, at, at + K)
    key = ((gram >> U(30)) << U(30)) | at.astype(U)
    size = -(-len(key) // W) * W
    full = np.full(size + W, np.iinfo(np.uint64).max, U)
    full[: len(key)] = key
    block = full.reshape(-1, W)
    ahead = np.minimum.accumulate(block, axis=1).reshape(-1)
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    m = n - LENGTH + 1
    least = np.minimum(behind[:m], ahead[W - 1 : m + W - 1])
    anchor = (least & U((1 << 30) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:m]
    valid = np.arange(m) + LENGTH <= off[1:][row]
    first = np.flatnonzero(valid & np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | ~valid[:-1])))
    if not len(first):
        return none
    edge = valid & np.concatenate(((anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | ~valid[1:], [True]))
    last = np.flatnonzero(edge)
    rel = anchor[first] - first
    region = mix(span_hash(c, first, last + LENGTH) ^ (rel.astype(U) * U(0x9E3779B97F4A7C15)) ^ ((last - first).astype(U) * U(0xC2B2AE3D27D4EB4F)))
    return row[first], first, last - first, rel, gram[anchor[first]], region


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        buf, off = texts(b.column("text"))
        row, first, more, rel, a, region = anchors(buf, off)
        ids = b.column("doc_id").to_numpy(zero_copy_only=False)
        cols = [pa.array(signed(a)), pa.array(signed(region)), pa.array(ids[row]), pa.array(first - off[row]), pa.array((more << 16 | rel).astype(np.int32))]
        yield pa.RecordBatch.from_arrays(cols, ["a", "region", "doc_id", "first", "shape"])


def _regions(bloom: Bloom):
    """As _anchor_rows for the wanted anchors, with the bytes that the starts cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            buf, off = texts(b.column("text"))
            row, first, more, rel, a, _ = anchors(buf, off)
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)[row]
            at = first - off[row]
            take = np.flatnonzero(bloom.has(ids, at))
            raw = buf.tobytes()
            cut = [raw[s : s + x + LENGTH] for s, x in zip(first[take].tolist(), more[take].tolist(), strict=True)]
            cols = [pa.array(signed(a[take])), pa.array(ids[take]), pa.array(at[take]), pa.array((more << 16 | rel)[take].astype(np.int32)), pa.array(cut, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["a", "doc_id", "first", "shape", "raw"])

    return run


def strings_of(raw: list[bytes], rel: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every start of every region: the region, the start relative to the anchor, and the string's hash."""
    buf = np.frombuffer(b"".join(raw), np.uint8)
    edge = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    c = rolling(buf)
    count = np.diff(edge) - LENGTH + 1
    own = np.repeat(np.arange(len(raw)), count)
    start = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    at = edge[:-1][own] + start
    return own, start - rel[own], span_hash(c, at, at + LENGTH)


def candidates(raw: list[bytes], rel: np.ndarray) -> np.ndarray:
    """Which (region, symbol) positions share SURE symbols with another region, from the suffix array: keys region << 20 | symbol."""
    shift = rel % BLOCK
    count = np.array([(len(x) - s) // BLOCK for x, s in zip(raw, shift, strict=True)])
    blocks = np.concatenate([np.frombuffer(x, ">u8", k, s) for x, s, k in zip(raw, shift.tolist(), count.tolist(), strict=True)])
    stop = np.cumsum(count + 1) - 1
    place = np.arange(len(blocks)) + np.repeat(np.arange(len(raw)), count)
    symbols = np.zeros(len(blocks) + len(raw), np.int64)
    symbols[place] = np.unique(blocks, return_inverse=True)[1] + 1
    order = np.array(suffix_array(symbols.tolist()))
    c = np.zeros(len(symbols) + 1, U)
    p = powers(len(symbols) + 1)
    np.cumsum(mix(symbols.astype(U) + U(1)) * p[0][: len(symbols)], out=c[1:])
    left = np.repeat(stop, count + 1) - np.arange(len(symbols))
    end = np.minimum(np.arange(len(symbols)) + SURE, len(symbols))
    head = (c[end] - c[:-1]) * p[1][: len(symbols)]
    good = left[order] >= SURE
    same = good[1:] & good[:-1] & (head[order][1:] == head[order][:-1])
    hit = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    region = np.searchsorted(stop, hit)
    return np.sort(region << 20 | (hit - (stop[region] - count[region])))


def repeats(raw: list[bytes], rel: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(region, start in it) of the strings that also are at the same offset in another region of the group."""
    own, at, h = strings_of(raw, rel)
    start = at + rel[own]
    symbol = -(-(start - (rel % BLOCK)[own]) // BLOCK)
    found = candidates(raw, rel)
    key = own << 20 | symbol
    ok = found[np.minimum(np.searchsorted(found, key), max(len(found) - 1, 0))] == key if len(found) else np.zeros(len(own), bool)
    own, start, h, at = own[ok], start[ok], h[ok], at[ok]
    k = mix(h ^ mix(group[own].view(U) + at.astype(U)))
    _, back, times = np.unique(k, return_inverse=True, return_counts=True)
    twice = times[back] > 1
    return own[twice], start[twice]


def _spans(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive starts of a document as (doc, start, end)."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1))) if len(doc) else np.empty(0, bool)
    last = np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1) if len(doc) else np.empty(0, np.int64)
    return doc[new], start[new], start[last] + LENGTH


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor; whole groups are gathered up to about SYMBOLS symbols."""
    held: list[tuple] = []
    size = 0

    def out() -> pa.RecordBatch:
        a, doc, first, shape, raw = (list(x) for x in zip(*held, strict=True))
        own, start = repeats(raw, np.array(shape) & 0xFFFF, np.array(a, np.int64))
        cols = _spans(np.array(doc, np.int64)[own], np.array(first, np.int64)[own] + start)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["doc_id", "start", "end"])

    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if size > SYMBOLS and held and held[-1][0] != r[0]:
                yield out()
                held, size = [], 0
            held.append(r)
            size += len(r[4]) // BLOCK + 1
    if held:
        yield out()


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 256):
            s = b.slice(i, 256)
            own, at, h = strings_of(s.column("raw").to_pylist(), s.column("shape").to_numpy() & 0xFFFF)
            rel = s.column("shape").to_numpy()[own] & 0xFFFF
            k = mix(h ^ mix(s.column("a").to_numpy()[own].view(U) + at.astype(U)))
            yield pa.RecordBatch.from_arrays([pa.array(signed(k)), pa.array(s.column("doc_id").to_numpy()[own]), pa.array(s.column("first").to_numpy()[own] + at + rel)], ["k", "doc_id", "start"])


def repeated(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, end)``: byte ranges that go; they may overlap."""
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    rows = docs.mapInArrow(_anchor_rows, "a long, region long, doc_id long, first long, shape int")
    whole, equal = Window.partitionBy("a"), Window.partitionBy("a", "region")
    rows = rows.repartition(F.col("a")).withColumn("ca", F.count("*").over(whole)).where("ca > 1").withColumn("cr", F.count("*").over(equal)).withColumn("nth", F.row_number().over(equal.orderBy("doc_id", "first")))
    hits = staged(rows, "anchors")
    settled = hits.where("cr > 1").select("doc_id", F.col("first").alias("start"), (F.col("first") + F.shiftright("shape", 16) + LENGTH).alias("end"))
    groups = hits.groupBy("a").agg(F.min("cr").alias("least"), F.sum(F.when(F.col("nth") == 1, 1)).alias("regions")).where("least = 1 AND regions > 1").select("a", "regions")
    wanted = staged(hits.where("nth = 1").select("a", "doc_id", "first").join(groups, "a"), "wanted")
    if not wanted.take(1):
        return settled
    bloom = Bloom(wanted.select("doc_id", "first"))
    kinds = "a long, doc_id long, first long, shape int, raw binary"
    found = docs.mapInArrow(_regions(bloom), kinds)
    found = staged(found.join(wanted, ["a", "doc_id", "first"]), "regions")
    small = found.where(F.col("regions") <= BIG).drop("regions").select("a", "doc_id", "first", "shape", "raw")
    by_suffix = small.repartition(F.col("a")).sortWithinPartitions("a").mapInArrow(_suffixes, "doc_id long, start long, end long")
    spans = settled.union(by_suffix)
    if groups.where(F.col("regions") > BIG).take(1):
        strings = found.where(F.col("regions") > BIG).drop("regions").mapInArrow(_strings, "k long, doc_id long, start long")
        twice = strings.groupBy("k").count().where("count > 1").select("k")
        spans = spans.union(strings.join(twice, "k", "left_semi").select("doc_id", "start", (F.col("start") + LENGTH).alias("end")))
    return spans


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        buf, off = texts(b.column("text"))
        starts, ends = b.column("starts"), b.column("ends")
        at = np.repeat(off[:-1], np.diff(starts.offsets.to_numpy()))
        depth = np.zeros(len(buf) + 1, np.int64)
        np.add.at(depth, at + starts.flatten().to_numpy(zero_copy_only=False), 1)
        np.add.at(depth, np.minimum(at + ends.flatten().to_numpy(zero_copy_only=False), len(buf)), -1)
        gone = np.cumsum(depth[:-1]) > 0
        row = owner(off, np.flatnonzero(gone))
        first, _ = runs(gone, off)
        kept = buf[~gone]
        edge = np.concatenate(([0], np.cumsum(~gone)))[off]
        raw = kept.tobytes()
        cut = [raw[i:j] for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        n = lambda x: pa.array(np.bincount(x, minlength=b.num_rows).astype(np.int64))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(off)), n(row), n(owner(off, first)), pa.array(cut, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every document; kept is what stays, as bytes."""
    marks = staged(repeated(docs).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("m")).select("doc_id", F.col("m.start").alias("starts"), F.col("m.end").alias("ends")), "marks")
    empty = F.array().cast("array<long>")
    rows = docs.select("doc_id", "text").join(marks.hint("merge"), "doc_id", "left").select("doc_id", "text", F.coalesce("starts", empty).alias("starts"), F.coalesce("ends", empty).alias("ends"))
    return rows.mapInArrow(_apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    return deduplicate(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int, str]]:
    """The digest of a small table, for tests."""
    seen: dict[bytes, int] = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, x in raw:
        for s in range(len(x) - LENGTH + 1):
            seen[x[s : s + LENGTH]] = seen.get(x[s : s + LENGTH], 0) + 1
    out = {}
    for i, x in raw:
        gone = bytearray(len(x))
        for s in range(len(x) - LENGTH + 1):
            if seen[x[s : s + LENGTH]] > 1:
                gone[s : s + LENGTH] = b"\1" * LENGTH
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        out[i] = (len(x), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(x, gone, strict=True) if not g)).hexdigest())
    return out
