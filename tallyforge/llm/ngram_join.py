"""N-gram Jaccard self-join by parity sketches: exact links at J >= 0.75, and their components.

A document's set holds its distinct five-word shingles (64-bit hashes).  Two sketches are used:

* A *word sketch*: P cells for a size band; each shingle goes to one cell, and a cell's value is
  the XOR of its shingles' hashes.  Two sketches differ in at most as many cells as the sets differ
  in shingles (cells that agree by collision aside), and J >= 0.75 bounds that symmetric difference
  by (|A| + |B|) / 7, at most |A| / 3.  By the pigeonhole principle, among the first
  |A| // 3 + 1 *non-empty* cells of either document at least one is equal in both, so joining these
  cells loses no link; no two documents meet because a cell is empty in both.  Bands are a factor 4
  wide; a document near the upper end of its band also appears in the next one.
* A *bit sketch* of at least four bits for each shingle (65,536 at most), each the parity of the shingles hashed to it: the
  Hamming distance of two bit sketches is a lower bound of the symmetric difference and discards candidates
  unread.  Lengths are powers of two, so the longer of two sketches folds onto the shorter by XOR.

What is left is verified on the whole sets: 100 * intersection >= 75 * union.

Each document emits a quarter more cells than that, t in all.  A linked partner that emits as far then shares at least
t - |A| // 3 of them.  So a document that shares fewer cells with others (a passage that very many documents have) is
linked with nothing and is left out, and one that shares k looks for partners in its k - (t - |A| // 3) + 1
smallest buckets only.  No group is expanded into pairs: equal sets become one representative first, members are paired with the
smallest of their bucket, verified links give components, and only members of buckets that still hold different components are
compared across them, by bit sketches in blocks (see ``blocks``).

Scale: four scans of the text and no shuffle of it (one on doc_id if many documents repeat); bounded Bloom filters
pick the documents whose cells or sets are needed again;
about half a row of 20 bytes for each shingle are shuffled once by cell value.  A hot set is
pre-aggregated; a hot near-copy group spreads over |A| / 3 cell values.  Intermediate tables are
written to the shared scratch folder.  Hashes are 64 bits, so a wrong or lost link needs a collision.

Defined cases: null text or text without words has n_shingles 0 and is its own component; fewer
than five words make one shingle of the whole sequence; rows that share a doc_id are one document
for links and each is returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyforge.llm.blocks import may_match, near_pairs
from tallyforge.llm.bloom import Bloom
from tallyforge.llm.kernels import U, distinct_sets, mix, parity_sketches, pieces, shingles, signed, texts, words
from tallyforge.operators.components import connected_components
from tallyforge.plans.scratch import staged

K, NUM, DEN = 5, 75, 100
BITS = 256


def sets_of(batch: pa.RecordBatch, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and offsets."""
    buf, off = texts(batch.column("text"))
    _, _, h, row = words(buf, off)
    return distinct_sets(*shingles(h, row, batch.num_rows, k), batch.num_rows)


def _segments(op: np.ufunc, x: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """op over each slice of x; 0 for empty slices."""
    out = np.zeros(len(edge) - 1, x.dtype)
    full = np.flatnonzero(np.diff(edge))
    if len(full):
        out[full] = op.reduceat(x, edge[:-1][full])
    return out


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        h, edge = sets_of(b)
        cols = [b.column("doc_id"), pa.array(np.diff(edge)), pa.array(signed(_segments(np.add, mix(h), edge))), pa.array(signed(_segments(np.bitwise_xor, mix(h ^ U(0x5851F42D4C957F2D)), edge))), parity_sketches(h, edge, BITS, 4)]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "fa", "fb", "bits"])


def band(n: int) -> int:
    """Sizes 4^j .. 4^(j+1) - 1 are band j."""
    return (int(n).bit_length() - 1) // 2


def cells(h: np.ndarray, j: int) -> np.ndarray:
    """Values of the non-empty cells of the word sketch of band j, in cell order, marked with the band."""
    size = max(4 ** (j + 1), 1 << 16 if j < 4 else 0)
    cell = (mix(h ^ U(0x2545F4914F6CDD1D)) >> U(16)) % U(size)
    order = np.argsort(cell, kind="stable")
    cell, h = cell[order], h[order]
    start = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
    return mix(np.bitwise_xor.reduceat(h, start) ^ mix(cell[start] * U(64) + U(j)))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sig, rep, spare): the first n // 3 + 1 + EXTRA(n) cells of each band, and how many of them a partner that emits as
    far surely shares, with the band."""
    for b in pieces(batches):
        h, edge = sets_of(b)
        ids = b.column("doc_id").to_numpy(zero_copy_only=False)
        sig, rep, spare = [], [], []
        for i in range(b.num_rows):
            n = int(edge[i + 1] - edge[i])
            if not n:
                continue
            own = band(n)
            for j in (own, own + 1) if 3 * 4 ** (own + 1) <= 4 * n else (own,):
                c = cells(h[edge[i] : edge[i + 1]], j)[: n // 3 + 4 + n // 12]
                sig.append(c)
                rep.append(np.full(len(c), ids[i], np.int64))
                spare.append(np.full(len(c), max(1, len(c) - n // 3) * 32 + j, np.int32))
        if sig:
            cols = {"sig": pa.array(signed(np.concatenate(sig))), "rep": pa.array(np.concatenate(rep)), "spare": pa.array(np.concatenate(spare))}
            for at in range(0, len(cols["sig"]), 1 << 16):
                yield pa.RecordBatch.from_arrays([c.slice(at, 1 << 16) for c in cols.values()], list(cols))


def _sets(used: Bloom):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(used.filter(batches, "doc_id")):
            h, edge = sets_of(b)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(signed(h)))], ["rep", "h"])

    return emit


def _shared(rows: DataFrame) -> DataFrame:
    """Rows of the buckets with two members or more, with the bucket's size and smallest member."""
    w = Window.partitionBy("sig")
    return rows.withColumn("c", F.count("*").over(w)).withColumn("center", F.min("rep").over(w)).where("c > 1")


def _verified(pairs: DataFrame, docs: DataFrame, members: DataFrame, again: bool) -> DataFrame:
    """The pairs (a, b) of representatives that are linked."""
    m = members.select("rep", "n", "bits")
    a, b = m.toDF("a", "na", "ba"), m.toDF("b", "nb", "bb")
    near = staged(pairs.join(a, "a").join(b, "b").where(may_match("na", "nb", "ba", "bb")).select("a", "b", "na", "nb"), "near")
    used = Bloom(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct())
    rows = docs.where("doc_id IS NOT NULL").mapInArrow(_sets(used), "rep long, h array<long>")
    sets = staged(rows.dropDuplicates(["rep"]) if again else rows, "sets")
    both = near.join(sets.toDF("a", "ha"), "a").join(sets.toDF("b", "hb"), "b").withColumn("same", F.size(F.array_intersect("ha", "hb")))
    return both.where(f"{DEN} * same >= {NUM} * (na + nb - same)").select("a", "b")


def _marked(hits: DataFrame) -> DataFrame:
    """Adds ``active`` for the smallest buckets of each document, as many as must hold one partner: of k shared cells a
    linked partner has at least ``spare``, so k - spare + 1 are enough, and a document with k < spare is linked with nothing."""
    own = Window.partitionBy("rep", "spare")
    k, rank, least = F.count("*").over(own), F.row_number().over(own.orderBy("c", "sig")), F.shiftright("spare", 5)
    return hits.select("sig", "rep", "center", ((k >= least) & (rank <= k - least + 1)).alias("active"))


def _across(marked: DataFrame, comp: DataFrame, one: DataFrame) -> DataFrame:
    """Near pairs of an active row and another one of its bucket that is in a different component.

    Buckets are met by their smallest member, of which a set of near copies has few, so that a pair is not compared once
    for each cell that it shares."""
    teams = marked.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("team", F.coalesce("component", "rep"))
    known = F.col("active") & (F.col("rep") != F.col("center"))
    open_ = teams.groupBy("sig").agg(F.min("team").alias("low"), F.max("team").alias("high"), F.count("*").alias("c"), F.max("active").alias("any"), F.max(known).alias("known"))
    open_ = open_.where("low <> high AND any AND NOT (c = 2 AND known)").select("sig")
    rows = staged(teams.join(open_, "sig").groupBy(F.col("center").alias("g"), F.col("rep").alias("x"), "team").agg(F.max("active").alias("asks")), "open")
    sketches = one.select(F.col("rep").alias("x"), F.lit(0).alias("y"), "n", "bits")
    pairs = near_pairs(rows.select("g", "x", F.lit(0).alias("y"), "team", "asks"), sketches)
    return pairs.select(F.least("ax", "bx").alias("a"), F.greatest("ax", "bx").alias("b")).distinct()


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members`` (doc_id, n, rep of equal sets, bits) and the components (node, component) of linked representatives."""
    docs = docs.select("doc_id", "text")
    found = staged(docs.mapInArrow(_summaries, "doc_id long, n long, fa long, fb long, bits array<long>"), "summaries")
    group = found.where("n > 0").groupBy("n", "fa", "fb").agg(F.min("doc_id").alias("rep"))
    members = staged(found.join(group, ["n", "fa", "fb"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"), F.when(F.col("doc_id") == F.col("rep"), F.col("bits")).alias("bits")), "members")
    again = staged(members.where("doc_id <> rep OR n = 0").select("doc_id").distinct(), "again")
    first = docs.where("doc_id IS NOT NULL").join(again, "doc_id", "left_anti")
    twins = _repeats(members)
    base = first.mapInArrow(_cells, "sig long, rep long, spare int")
    marked = staged(_marked(_shared(base.distinct() if twins else base)), "marked")
    one = members.where("doc_id = rep").dropDuplicates(["rep"]) if twins else members.where("doc_id = rep")

    stars = marked.where("active AND rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    edges = staged(_verified(stars, docs, one, twins), "links")
    comp = connected_components(edges, "a", "b")
    more = staged(_verified(_across(marked, comp, one), docs, one, twins), "links")
    if more.take(1):
        comp = connected_components(edges.union(more), "a", "b")
    return members, comp


def _repeats(members: DataFrame) -> bool:
    """Whether rows share a doc_id."""
    return bool(members.where("n > 0").groupBy("doc_id").count().where("count > 1").take(1))


def components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document."""
    members, comp = links(docs)
    low = members.select("doc_id", F.col("n").alias("n_shingles"), "rep").join(comp, F.col("rep") == F.col("node"), "left")
    return low.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i+4], ' ') END AS s
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
c AS (SELECT doc_id, COUNT(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS k FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_shingles, COALESCE(m.low, d.doc_id) AS component_id
FROM documents d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN (SELECT a, MIN(b) AS low FROM r GROUP BY a) m ON m.a = d.doc_id
"""
