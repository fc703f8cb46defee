"""Nearest neighbours by inner product with randomly rotated one-bit codes (RaBitQ; Gao and Long, 2024).

Every vector v is rotated by one random orthogonal matrix and its signs are packed into bits.
With o = v / |v| and x = signs / sqrt(D), the stored scalars are |v| and <x, o>.  For a rotated
query q the inner product <o, q> is estimated as <x, q> / <x, o>; with high probability its error
is at most ``EPS`` * sqrt((1 - <x,o>^2) / <x,o>^2 / (D - 1)) * |q|.  A vector is reranked with its
original components, in double precision, if its upper bound reaches the k-th largest lower
bound, so the number of reranked vectors adapts to each query and no fixed cut is needed.

Scale: rows are packed into blocks of codes, scalars and vectors, and queries into blocks; each
query block meets each data block once by an equi-join on the query block's number (a stated query
set against all rows, in blocks).  A task keeps k rows for each query, and k-row lists are merged
by a top-k per query whose input is bounded by k times the number of data blocks.  Every row is
indexed; the rotation depends on the dimension and a seed only, so nothing is fitted.

Defined cases: null, empty, zero vectors, vectors with null or non-finite components, null ids and
vectors of another length than the most frequent one take no part; equal scores go to smaller ids;
fewer than k candidates give all of them; repeated rows of an id are candidates each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 2.5
BLOCK, QUERIES = 8192, 1024


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def encode(vectors: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths and <x, o> of each row."""
    norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)).astype(np.float32)
    turned = (vectors / np.maximum(norm, 1e-38)[:, None]).astype(np.float32) @ rotate
    return np.packbits(turned > 0, axis=1), norm, np.abs(turned).sum(1) / np.sqrt(vectors.shape[1], dtype=np.float32)


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, codes: np.ndarray, norm: np.ndarray, fit: np.ndarray, rotate: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of a block for each query: query rows, ids and exact scores."""
    dim = vectors.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = queries.astype(np.float32) @ rotate
    scale = norm / np.maximum(fit, 1e-6)
    estimate = (turned @ signs.T) * (scale / np.sqrt(dim, dtype=np.float32))
    spread = EPS * norm * np.sqrt(np.maximum(1 - fit * fit, 0) / np.maximum(fit * fit, 1e-12) / max(dim - 1, 1))
    length = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    q, found, score = [], [], []
    exact_v = vectors.astype(np.float64)
    for i, row in enumerate(estimate):
        err = spread * np.float32(length[i]) + np.float32(1e-6)
        low = row - err
        low[ids == query_ids[i]] = -np.inf
        at = np.arange(len(ids))
        if len(ids) > k + 1:
            at = np.flatnonzero(row + err >= np.partition(low, len(low) - k)[len(low) - k])
        at = at[ids[at] != query_ids[i]]
        exact = (exact_v[at] * queries[i].astype(np.float64)).sum(1)
        best = np.lexsort((ids[at], -exact))[:k]
        q.append(np.full(len(best), query_ids[i]))
        found.append(ids[at][best])
        score.append(exact[best])
    return np.concatenate(q), np.concatenate(found), np.concatenate(score)


def _matrix(column: pa.Array, dim: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dim)


def nearest(vectors: DataFrame, query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that satisfy ``query``, against all rows but their own."""
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    rows = vectors.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(query, F.lit(False)).alias("q"))
    dims = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.sum(F.col("q").cast("int")).alias("nq")).orderBy(F.desc("n"), "d").take(1)
    if not dims or not dims[0]["nq"]:
        return spark.createDataFrame([], empty)
    dim, n_blocks = dims[0]["d"], -(-dims[0]["nq"] // QUERIES)
    rows = rows.where(F.size("v") == dim)
    rotate = rotation(dim)

    def pack(per: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []

            def block() -> pa.RecordBatch:
                t = pa.Table.from_batches(held).combine_chunks()
                v = _matrix(t.column("v").combine_chunks(), dim, np.float64)
                parts = [t.column("id").to_numpy().tobytes(), v.tobytes(), *(x.tobytes() for x in encode(v, rotate))]
                return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in parts], ["ids", "vs", "codes", "norm", "fit"])

            for b in batches:
                held.append(b)
                if sum(x.num_rows for x in held) >= per:
                    yield block()
                    held.clear()
            if sum(x.num_rows for x in held):
                yield block()

        return run

    data = rows.select("id", "v").mapInArrow(pack(BLOCK), "ids binary, vs binary, codes binary, norm binary, fit binary")
    queries = rows.where("q").select("id", "v", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int").alias("block"))

    def query_blocks(t: pa.Table) -> pa.Table:
        ids = t.column("id").combine_chunks().to_numpy()
        v = _matrix(t.column("v").combine_chunks(), dim, np.float64)
        return pa.table({"block": t.column("block").slice(0, 1), "qids": pa.array([ids.tobytes()], pa.binary()), "qs": pa.array([v.tobytes()], pa.binary())})

    qb = queries.groupBy("block").applyInArrow(query_blocks, "block int, qids binary, qs binary")
    met = data.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(qb, "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, qids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["qids"], np.int64)
                v, qs = np.frombuffer(r["vs"]).reshape(-1, dim), np.frombuffer(r["qs"]).reshape(-1, dim)
                codes = np.frombuffer(r["codes"], np.uint8).reshape(len(ids), -1)
                q, found, score = search_block(qs, qids, v, ids, codes, np.frombuffer(r["norm"], np.float32), np.frombuffer(r["fit"], np.float32), rotate, k)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    part = met.mapInArrow(search, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(table: pd.DataFrame, k: int, every: int) -> dict[int, list[int]]:
    """Exact answer on a small table, for tests and recall figures."""
    v, ids = np.array(table["embedding"].tolist(), np.float64), table["vec_id"].to_numpy()
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = v @ v[i]
        order = np.lexsort((ids, -s))
        out[int(ids[i])] = [int(x) for x in ids[order] if x != ids[i]][:k]
    return out
