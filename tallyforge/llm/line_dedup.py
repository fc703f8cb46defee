"""Line deduplication by an exact set-similarity self-join (prefix, positional and length filters).

A line's tokens are its distinct five-word shingles (A-Z as a-z); a line of one to four words has its whole word
sequence as its one token.  A line goes if an earlier line, by (doc_id, line number), has Jaccard similarity of at
least 0.75 with it, so a short line goes if it is an exact repeat, as words.

* Lines with equal sets are grouped by one partially aggregated hash; all but the first go.  Sets of one or two tokens
  reach 0.75 only with equal ones, so the grouping settles them and they are in no join.
* Tokens are ordered by rarity: frequent ones (counted over all lines, the ``FREQUENT`` most frequent known by
  count) come last, others by hash, the same order everywhere.  Two lines with J >= 0.75 share a token among the
  first n - ceil(0.75 n) + 1 of each, so these prefixes are joined; at a shared token the positions bound the
  overlap that is still possible, and lengths must be within 3/4.
* A line of a shared bucket is compared with the bucket's earliest line first, which settles most copies and variants in
  linear work.  What is left is compared with all earlier lines of its buckets by bit sketches in blocks (``blocks``),
  so a pair becomes a row only if its sketches allow J >= 0.75; the whole token sets of these pairs are intersected.

Scale: text is scanned a few times and not shuffled; prefixes (about a quarter of the tokens) are shuffled once.  The
many copies of a frequent line are skipped by a bounded list of first occurrences; further copies only repeat
candidates.  Lines to verify are known by Bloom filters of bounded size; a false positive costs a row.

Defined cases: null and empty texts and lines without a word have no token and stay; rows that share a doc_id are one document's; the doc_id null rows
lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.blocks import may_match, near_pairs
from tallyforge.llm.bloom import Bloom
from tallyforge.llm.kernels import FOLDED, SEP, U, distinct_sets, mix, owner, parity_sketches, pieces, rolling, runs, shingles, signed, span_hash, texts
from tallyforge.plans.scratch import staged

K = 5
FREQUENT, REPEATED = 1 << 16, 1 << 18
#: The size up to which only equal sets have J >= 0.75.
SETTLED = 2


def lines(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line (the newline excluded), its row and its number in the row."""
    cuts = np.flatnonzero(buf == 10)
    full = np.flatnonzero(np.diff(off) > 0)
    start = np.sort(np.concatenate([off[full], cuts[~np.isin(cuts + 1, off)] + 1]))
    row = owner(off, start)
    end = np.minimum(np.append(start[1:], len(buf)), off[1:][row]) if len(start) else start
    end = np.where((end > start) & (buf[np.maximum(end - 1, 0)] == 10), end - 1, end) if len(start) else start
    return start, end, row, np.arange(len(row)) - np.searchsorted(row, row)


def line_sets(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token sets of the lines with a word: sorted hashes, offsets, row and line number."""
    buf, off = texts(b.column("text"))
    start, end, row, number = lines(buf, off)
    ws, we = runs(~SEP[buf], off)
    at = np.searchsorted(start, ws, "right") - 1
    h = span_hash(rolling(buf, FOLDED), ws, we)
    full = np.bincount(at, minlength=len(start)) > 0 if len(start) else np.empty(0, bool)
    new = np.cumsum(full) - 1
    hashes, edge = distinct_sets(*shingles(h, new[at] if len(at) else at, int(full.sum()), K), int(full.sum()))
    return hashes, edge, row[full], number[full]


def _fingerprints(h: np.ndarray, edge: np.ndarray) -> np.ndarray:
    return mix(np.add.reduceat(mix(h), edge[:-1]) + np.diff(edge).astype(U)) if len(edge) > 1 else np.empty(0, U)


_SCANNED = ["doc_id", "line", "fp", "token", "c"]
_KINDS = "doc_id long, line int, fp long, token long, c long"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, line, fp), and rows (token, c) of tokens that occur three times or more in a stretch."""
    held, size = [], 0

    def frequent() -> pa.RecordBatch:
        t, c = np.unique(np.concatenate(held), return_counts=True)
        t, c = t[c > 2], c[c > 2]
        none = [pa.nulls(len(t), x) for x in (pa.int64(), pa.int32(), pa.int64())]
        return pa.RecordBatch.from_arrays([*none, pa.array(signed(t)), pa.array(c)], _SCANNED)

    for b in pieces(batches):
        h, edge, row, number = line_sets(b)
        ids = b.column("doc_id").take(pa.array(row))
        yield pa.RecordBatch.from_arrays([ids, pa.array(number.astype(np.int32)), pa.array(signed(_fingerprints(h, edge))), pa.nulls(len(row), pa.int64()), pa.nulls(len(row), pa.int64())], _SCANNED)
        joined = h[np.repeat(np.diff(edge) > SETTLED, np.diff(edge))]
        held.append(joined)
        size += len(joined)
        if size > 2_000_000:
            yield frequent()
            held, size = [], 0
    if size:
        yield frequent()


def _prefixes(tokens: np.ndarray, counts: np.ndarray, fps: np.ndarray, first_doc: np.ndarray, first_line: np.ndarray):
    """Rows (token, doc_id, line, ni): the prefix tokens, with the set's size and the position packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            h, edge, row, number = line_sets(b)
            if not len(row):
                continue
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)[row]
            f = signed(_fingerprints(h, edge))
            at = np.minimum(np.searchsorted(fps, f), max(len(fps) - 1, 0))
            copy = (fps[at] == f) & ((first_doc[at] != ids) | (first_line[at] != number)) if len(fps) else np.zeros(len(f), bool)
            n = np.diff(edge)
            copy |= n <= SETTLED
            own = np.repeat(np.arange(len(n)), n)
            k = np.minimum(np.searchsorted(tokens, h), max(len(tokens) - 1, 0))
            often = np.where(tokens[k] == h, counts[k], 0) if len(tokens) else np.zeros(len(h), np.int64)
            if often.any():
                some = np.zeros(len(n), bool)
                some[own[often > 0]] = True
                some = np.flatnonzero(some[own])
                h[some] = h[some][np.lexsort((h[some], often[some], own[some]))]
            place = np.arange(len(h)) - np.repeat(edge[:-1], n)
            take = (place < (n - -(-3 * n // 4) + 1)[own]) & ~copy[own]
            own, place, h = own[take], place[take], h[take]
            cols = {"token": pa.array(signed(h)), "doc_id": pa.array(ids[own]), "line": pa.array(number[own].astype(np.int32)), "ni": pa.array((n[own] << 32) | place)}
            for i in range(0, len(h), 1 << 16):
                yield pa.RecordBatch.from_arrays([c.slice(i, 1 << 16) for c in cols.values()], list(cols))

    return run


def _most(counted: DataFrame, n: int) -> DataFrame:
    """The rows with the largest c, at most n: those from the lowest power of two that lets so few through."""
    sizes = counted.groupBy(F.floor(F.log2("c")).alias("e")).count().orderBy(F.desc("e")).collect()
    least, total = 1 << 62, 0
    for e, k in sizes:
        total += k
        if total > n:
            break
        least = 1 << e
    return counted.where(F.col("c") >= least)


def _wanted(docs: DataFrame, lines: DataFrame, whole: bool) -> DataFrame:
    """``doc_id, line, n`` of the given lines and a few others, with their bit sketches or, if ``whole``, their tokens."""
    wanted, some = Bloom(lines), Bloom(lines.select("doc_id").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(some.filter(batches, "doc_id")):
            h, edge, row, number = line_sets(b)
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)[row]
            take = wanted.has(ids, number)
            n = np.diff(edge)
            h, edge = h[np.repeat(take, n)], np.concatenate(([0], np.cumsum(n[take])))
            lists = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(signed(h))) if whole else parity_sketches(h, edge, 128, 4)
            yield pa.RecordBatch.from_arrays([pa.array(ids[take]), pa.array(number[take].astype(np.int32)), pa.array(n[take]), lists], ["doc_id", "line", "n", "bits"])

    return staged(docs.mapInArrow(run, "doc_id long, line int, n long, bits array<long>"), "sets" if whole else "sketches")


def _fits(ni: str, nj: str) -> str:
    """Length and positional filter of two rows that share a token."""
    n, m, i, j = f"shiftright({ni}, 32)", f"shiftright({nj}, 32)", f"({ni} & 4294967295)", f"({nj} & 4294967295)"
    return f"4 * least({n}, {m}) >= 3 * greatest({n}, {m}) AND 7 * (1 + least({n} - {i}, {m} - {j}) - 1 + least({i}, {j})) >= 3 * ({n} + {m})"


def _hits(rows: DataFrame) -> DataFrame:
    """Rows of the buckets of two lines or more, with the bucket's size and its earliest line."""
    w = Window.partitionBy("token")
    rows = rows.select("token", F.struct(F.struct("doc_id", "line").alias("x"), "ni").alias("own"))
    rows = rows.select("own", F.count("*").over(w).alias("c"), F.min("own").over(w).alias("first")).where("c > 1")
    return rows.select("own.x", "own.ni", "c", F.col("first.x").alias("y"), F.col("first.ni").alias("nj"))


def _verified(near: DataFrame, docs: DataFrame) -> DataFrame:
    """``x`` of the pairs (x, y) whose sets have J >= 0.75; the earliest partner of a line first, others only if it fails."""
    near = staged(near, "near")
    if not near.take(1):
        return near.select("x")
    ends = staged(near.select("x.*").union(near.select("y.*")).distinct(), "ends")
    s = _wanted(docs, ends, True).select(F.struct("doc_id", "line").alias("id"), F.col("bits").alias("h"))

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(s.toDF("x", "hx"), "x").join(s.toDF("y", "hy"), "y").withColumn("same", F.size(F.array_intersect("hx", "hy")))
        return staged(both.where("4 * same >= 3 * (size(hx) + size(hy) - same)").select("x").distinct(), "matched")

    first = near.groupBy("x").agg(F.min("y").alias("y"))
    found = verified(first)
    others = staged(near.join(first.withColumnRenamed("y", "f"), "x").where("y <> f").select("x", "y").join(found, "x", "left_anti"), "others")
    return found.union(verified(others)) if others.take(1) else found


def _rest(hits: DataFrame, done: DataFrame, sets: DataFrame) -> DataFrame:
    """Near pairs (x, y) of a line that has no match yet and an earlier one of its buckets.

    Buckets are met by their earliest line, so that a pair is not compared once for each token that it shares."""
    rows = hits.groupBy(F.xxhash64("y").alias("g"), "x").agg(F.max((F.col("c") > 2) & (F.col("x") != F.col("y"))).alias("asks"))
    rows = rows.join(done.select("x", "copy"), "x", "left").where("copy IS NULL OR NOT copy")
    rows = staged(rows.select("g", F.col("x.doc_id").alias("x"), F.col("x.line").alias("y"), F.lit(0).cast("long").alias("team"), (F.col("asks") & F.col("copy").isNull()).alias("asks")), "open")
    pairs = near_pairs(rows, sets.select(F.col("doc_id").alias("x"), F.col("line").alias("y"), "n", "bits"), earlier=True)
    end = lambda k: F.struct(F.col(f"{k}x").alias("doc_id"), F.col(f"{k}y").alias("line"))
    return pairs.select(end("a").alias("x"), end("b").alias("y"))


def removed_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, line)`` of the lines to remove, and ``(doc_id, line)`` of all lines with a word."""
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    seen = staged(docs.mapInArrow(_scan, _KINDS), "lines")
    every = seen.where("token IS NULL").select("doc_id", "line", "fp")
    groups = staged(every.groupBy("fp").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "line")).alias("first")).where("c > 1"), "groups")
    copies = staged(every.join(groups, "fp").where("struct(doc_id, line) <> first").select("doc_id", "line"), "copies")

    often = _most(staged(seen.where("token IS NOT NULL").groupBy("token").agg(F.sum("c").alias("c")), "often"), FREQUENT).toArrow()
    again = _most(groups, REPEATED).select("fp", "first.doc_id", "first.line").toArrow()
    tokens, counts = often.column("token").to_numpy().view(U), often.column("c").to_numpy()
    order, by_fp = np.argsort(tokens), np.argsort(again.column("fp").to_numpy())
    lists = [again.column(c).to_numpy()[by_fp] for c in ("fp", "doc_id", "line")]
    hits = staged(_hits(docs.mapInArrow(_prefixes(tokens[order], counts[order], *lists), "token long, doc_id long, line int, ni long")), "hits")

    known = copies.select(F.struct("doc_id", "line").alias("x"))
    stars = staged(hits.where(F.expr(f"x <> y AND {_fits('ni', 'nj')}")).select("x", "y").distinct().join(known, "x", "left_anti"), "stars")
    lines = staged(hits.select("x.*").distinct().join(copies, ["doc_id", "line"], "left_anti"), "wanted")
    sketches = _wanted(docs, lines, False)
    k = sketches.select(F.struct("doc_id", "line").alias("id"), "n", "bits")
    near = stars.join(k.toDF("x", "nx", "bx"), "x").join(k.toDF("y", "ny", "by"), "y").where(may_match("nx", "ny", "bx", "by")).select("x", "y")
    found = _verified(near, docs)
    done = known.withColumn("copy", F.lit(True)).union(found.withColumn("copy", F.lit(False)))
    found = found.union(_verified(_rest(hits, done, sketches), docs))
    return staged(copies.union(found.select("x.doc_id", "x.line")).distinct(), "removed"), every.select("doc_id", "line")


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed``: lines with a word, and the sorted numbers of those that go."""
    gone, every = removed_lines(docs)
    n = every.groupBy("doc_id").agg(F.count("*").alias("n_lines"))
    out = gone.groupBy("doc_id").agg(F.count("*").alias("n_removed"), F.array_sort(F.collect_set("line")).alias("removed"))
    ids = docs.select("doc_id")
    return ids.join(n, "doc_id", "left").join(out, "doc_id", "left").select("doc_id", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"), F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents with the lines taken out of ``text``; other columns are carried along."""
    gone, _ = removed_lines(docs)
    marks = staged(gone.groupBy("doc_id").agg(F.collect_set("line").alias("gone")), "marks")
    rows = docs.select(F.struct("*").alias("row")).join(marks.hint("merge"), F.col("row.doc_id") == F.col("doc_id"), "left")
    text = F.col("row.text")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), text).otherwise(left)
    return rows.select(*(text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def brute_force(rows: list[tuple[int, str | None]]) -> dict[int, list[int]]:
    """The removed line numbers of each document of a small table, for tests."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    every = []
    for doc, text in sorted(rows):
        for i, line in enumerate((text or "").split("\n")):
            w = [x for x in "".join(" " if c in "\t\v\f\r" else c for c in line.translate(lower)).split(" ") if x]
            if w:
                every.append((doc, i, {tuple(w[j : j + K]) for j in range(max(1, len(w) - K + 1))}))
    out: dict[int, list[int]] = {}
    for b, (doc, i, s) in enumerate(every):
        if any(4 * len(s & t) >= 3 * len(s | t) for _, _, t in every[:b]):
            out.setdefault(doc, []).append(i)
    return out
