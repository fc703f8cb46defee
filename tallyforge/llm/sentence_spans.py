"""Substring deduplication by sliding sentence spans.

A text is cut into pieces: a run of bytes other than ``. ! ?`` and newline, with the delimiters that
follow it.  A piece with words (runs of bytes other than delimiters, space and 0x09-0x0D; A-Z as a-z)
is a sentence.  From every sentence on, these runs of consecutive sentences are hashed: the shortest one of two or more
sentences with ``LEAST`` words, however many short sentences that takes; three sentences with ``THREE`` words; and the sentence
alone, if it has ``ALONE`` words.  Longer runs repeat only where these do.  Runs that occur more than once anywhere, the
same document included, are repeated, and all but the first by (doc_id, position) have their sentences removed.  The word
minimums are long enough that chance repetition of short sentences doesn't count.  A repeat that shares no whole run
with its original, as it begins and ends inside sentences, is not found.

Scale: one row for each span is counted with partial aggregation, so a passage that a third of the
documents share is one row for each task; the rows go back to their first occurrence by an
equi-join that adaptive execution splits when a key is hot.  A document's marks are bounded by its own
sentences; texts are joined with them on doc_id by a
sort-merge join at every size, so that no broadcast depends on the data.

Defined cases: null and empty texts have no sentences and stay; rows that share a doc_id count
as one document, with the first by text order of positions; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.kernels import BASE, FOLDED, SEP, U, mix, owner, pieces, powers, rolling, runs, signed, span_hash, texts
from tallyforge.plans.scratch import staged

LEAST, THREE, ALONE = 16, 12, 20
DELIM = np.zeros(256, bool)
DELIM[list(b".!?\n")] = True


def sentences(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each sentence's piece, its row, its hash and its number of words."""
    start, _ = runs(~DELIM[buf], off)
    row = owner(off, start)
    end = np.append(start[1:], len(buf))
    end = np.minimum(end, off[1:][row]) if len(row) else end[:0]
    ws, we = runs(~(SEP | DELIM)[buf], off)
    h = span_hash(rolling(buf, FOLDED), ws, we)
    first = np.searchsorted(ws, start)
    last = np.append(first[1:], len(ws)) if len(first) else first
    n = last - first
    p, inverse = powers(len(h) + 1)
    c = np.zeros(len(h) + 1, U)
    np.cumsum(h * p[: len(h)], out=c[1:])
    full = n > 0
    whole = mix((c[last[full]] - c[first[full]]) * inverse[first[full]] + n[full].astype(U))
    return start[full], end[full], row[full], whole, n[full]


def hashed_runs(row: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First sentence and number of sentences of every run that is hashed, each once."""
    m = len(row)
    upto, at = np.concatenate(([0], np.cumsum(n))), np.arange(m)
    stop = np.searchsorted(row, row, "right")
    short = np.maximum(np.searchsorted(upto, upto[:-1] + LEAST), at + 2)
    ok = short <= stop
    first, size = [at[ok]], [(short - at)[ok]]
    three = np.flatnonzero((at + 3 <= stop) & ~(ok & (short == at + 3)))
    three = three[upto[three + 3] - upto[three] >= THREE]
    alone = np.flatnonzero(n >= ALONE)
    return np.concatenate([*first, three, alone]), np.concatenate([*size, np.full(len(three), 3), np.ones(len(alone), np.int64)])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        ids = b.column("doc_id").to_numpy(zero_copy_only=False)
        _, _, row, h, n = sentences(*texts(b.column("text")))
        pos = np.arange(len(row)) - np.searchsorted(row, row)
        at, k = hashed_runs(row, n)
        p, inverse = powers(len(h) + 1)
        c = np.concatenate(([U(0)], np.cumsum(h * p[: len(h)], dtype=U)))
        key = mix((c[at + k] - c[at]) * inverse[at] + k.astype(U) * BASE)
        for i in range(0, len(at), 1 << 16):
            own = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(signed(key[own])), pa.array(ids[row[at[own]]]), pa.array(pos[at[own]].astype(np.int32)), pa.array(k[own].astype(np.int32))], ["h", "doc_id", "pos", "k"])


def repeated(docs: DataFrame) -> DataFrame:
    """``(doc_id, gone)``: the runs to remove, position << 32 | number of sentences, for documents that have any."""
    spans = docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(_spans, "h long, doc_id long, pos int, k int")
    spans = staged(spans, "spans")
    first = spans.groupBy("h").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "pos")).alias("first")).where("c > 1").select("h", "first")
    later = spans.join(first, "h").where("struct(doc_id, pos) <> first")
    return later.groupBy("doc_id").agg(F.collect_list(F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("k").cast("long"))).alias("gone"))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        buf, off = texts(b.column("text"))
        start, end, row, _, n = sentences(buf, off)
        marks = b.column("gone")
        flat, width = marks.flatten().to_numpy(zero_copy_only=False), np.diff(marks.offsets.to_numpy())
        at = np.searchsorted(row, np.repeat(np.arange(b.num_rows), width)) + (flat >> 32)
        depth = np.zeros(len(row) + 1, np.int64)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + (flat & 0xFFFFFFFF), -1)
        drop = np.cumsum(depth[:-1]) > 0
        keep = np.zeros(len(buf) + 1, np.int32)
        np.add.at(keep, start[drop], 1)
        np.add.at(keep, end[drop], -1)
        keep = np.cumsum(keep[:-1]) == 0
        left = buf[keep]
        at = np.concatenate(([0], np.cumsum(keep)))[off].astype(np.int64)
        text = pa.LargeStringArray.from_buffers(b.num_rows, pa.py_buffer(at.tobytes()), pa.py_buffer(left.tobytes())).cast(pa.string())
        count = lambda of, w=None: pa.array(np.bincount(of, w, b.num_rows).astype(np.int64))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), text, count(row), count(row[drop]), count(row[drop], n[drop])], ["doc_id", "kept", "n_sentences", "n_removed", "n_removed_words"])


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id, kept, n_sentences, n_removed, n_removed_words``: every document with the text that stays."""
    docs = docs.select("doc_id", "text")
    marks = staged(repeated(docs), "marks")
    rows = docs.join(marks.hint("merge"), "doc_id", "left").select("doc_id", "text", F.coalesce("gone", F.array().cast("array<long>")).alias("gone"))
    return rows.mapInArrow(_apply, "doc_id long, kept string, n_sentences long, n_removed long, n_removed_words long")


def digest(docs: DataFrame) -> DataFrame:
    out = deduplicate(docs)
    return out.select("doc_id", "n_sentences", "n_removed", "n_removed_words", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
p AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^.!?\n]+[.!?\n]*')) AS piece, generate_subscripts(regexp_extract_all(text, '[^.!?\n]+[.!?\n]*'), 1) AS i FROM t),
w AS (SELECT *, regexp_extract_all(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D.!?]+') AS ws FROM p),
s AS (SELECT doc_id, i, len(ws) AS n, array_to_string(ws, ' ') AS norm, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos FROM w WHERE len(ws) > 0),
u AS (SELECT *, SUM(n) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM s),
e AS (SELECT x.doc_id, x.pos, MIN(y.pos) AS last FROM u x JOIN u y ON y.doc_id = x.doc_id AND y.pos BETWEEN x.pos + 1 AND x.pos + 16 AND y.upto - x.upto + x.n >= 16 GROUP BY 1, 2),
l AS (SELECT *, LEAD(upto, 2) OVER (PARTITION BY doc_id ORDER BY pos) AS u2 FROM u),
q AS (SELECT doc_id, pos, last - pos + 1 AS k FROM e UNION SELECT doc_id, pos, 3 FROM l WHERE u2 - upto + n >= 12 UNION SELECT doc_id, pos, 1 FROM u WHERE n >= 20),
r AS (SELECT q.doc_id, q.pos, q.k, string_agg(s.norm, '.' ORDER BY s.pos) AS key FROM q JOIN s ON s.doc_id = q.doc_id AND s.pos BETWEEN q.pos AND q.pos + q.k - 1 GROUP BY 1, 2, 3),
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k, key ORDER BY doc_id, pos) AS rn FROM r),
g AS (SELECT DISTINCT doc_id, pos + unnest(range(k)) AS pos FROM o WHERE rn > 1),
m AS (SELECT s.*, g.pos IS NOT NULL AS gone FROM s LEFT JOIN g ON g.doc_id = s.doc_id AND g.pos = s.pos),
k AS (SELECT p.doc_id, string_agg(piece, '' ORDER BY p.i) AS kept FROM p LEFT JOIN m ON m.doc_id = p.doc_id AND m.i = p.i WHERE COALESCE(NOT gone, TRUE) GROUP BY p.doc_id),
c AS (SELECT doc_id, COUNT(*) AS n_sentences, COUNT(*) FILTER (WHERE gone) AS n_removed, SUM(CASE WHEN gone THEN n ELSE 0 END) AS n_removed_words FROM m GROUP BY doc_id)
SELECT t.doc_id, CAST(COALESCE(n_sentences, 0) AS BIGINT) AS n_sentences, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, CAST(COALESCE(n_removed_words, 0) AS BIGINT) AS n_removed_words,
       sha256(regexp_extract(text, '^[.!?\n]*') || COALESCE(kept, '')) AS kept_sha256
FROM t LEFT JOIN c ON c.doc_id = t.doc_id LEFT JOIN k ON k.doc_id = t.doc_id
"""
