"""First-wins dedup, anti-join prefilters, upserts, key registries and snapshots.

"First" always means an explicit order with a full tie-break, never arrival order.  Null keys are equal to each other
wherever the ingest semantics ask for it.  All of it is equi-joins and per-key windows; the one global number
(new surrogate ids) comes from per-partition counts and offsets, not from a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.plans.scratch import staged

Order = Sequence[Column | str]


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def keep_first(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row for each key, null keys being equal: the first in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def survivors(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """``id, survivor``: every id with the smallest id of its key."""
    return df.select(id_col, F.min(id_col).over(Window.partitionBy(*keys)).alias("survivor"))


def repoint(child: DataFrame, fk: str, mapping: DataFrame, id_col: str) -> DataFrame:
    """A child table with its foreign key moved to the survivor."""
    m = mapping.select(F.col(id_col).alias("_id"), "survivor")
    return child.join(m, child[fk] == m["_id"], "left").withColumn(fk, F.coalesce("survivor", F.col(fk))).drop("_id", "survivor")


def filter_new_rows(frame: DataFrame, existing: DataFrame, keys: Sequence[str], order: Order, lower: Sequence[str] = (), join_nulls: bool = True) -> DataFrame:
    """First write wins: dedups the batch, then drops rows whose key exists; keys in ``lower`` ignore case.

    With ``join_nulls`` null equals null; without, a row with a null key is always new."""
    named = [f"_k{i}" for i in range(len(keys))]
    norm = lambda df, out: df.withColumns({n: F.lower(k) if k in lower else F.col(k) for n, k in zip(out, keys, strict=True)})
    batch = norm(frame, named)
    there = any_null = reduce(lambda a, b: a | b, (F.col(n).isNull() for n in named))
    if join_nulls:
        batch = keep_first(batch, named, order)
    else:
        batch = keep_first(batch.where(~there), named, order).unionByName(batch.where(any_null))
    old = norm(existing, named).select(*named).distinct()
    cond = null_safe(batch, old, named) if join_nulls else reduce(lambda a, b: a & b, (batch[n] == old[n] for n in named))
    return batch.join(old, cond, "left_anti").drop(*named)


def upsert_do_nothing(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Order, where: str | None = None) -> DataFrame:
    """The existing rows and the new ones; ``where`` is the predicate of a partial unique index."""
    if not where:
        return existing.unionByName(filter_new_rows(incoming, existing, keys, order), allowMissingColumns=True)
    inside = incoming.where(where)
    outside = incoming.where(f"NOT coalesce({where}, false)")
    return existing.unionByName(filter_new_rows(inside, existing.where(where), keys, order), allowMissingColumns=True).unionByName(outside, allowMissingColumns=True)


def upsert_do_update(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Order, keep: Sequence[str] = ("created_at",)) -> DataFrame:
    """Last write wins for each key; columns in ``keep`` stay as they were."""
    n = len(order)
    newest = keep_first(incoming, keys, [F.col(o).desc() if isinstance(o, str) else o for o in order][:n])
    o, i = existing.alias("o"), newest.withColumn("_new", F.lit(True)).alias("i")
    on = reduce(lambda a, b: a & b, (F.col(f"o.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys))
    joined = o.withColumn("_old", F.lit(True)).alias("o").join(i, on, "full_outer")
    new = F.col("i._new").isNotNull()
    cols = []
    for c in existing.columns:
        if c not in incoming.columns:
            cols.append(F.col(f"o.{c}").alias(c))
        elif c in keep:
            cols.append(F.when(F.col("o._old").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(f"i.{c}")).alias(c))
        else:
            cols.append(F.when(new, F.col(f"i.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    return joined.select(*cols)


def numbered(df: DataFrame, order: Order, name: str, offset: Column | int = 0) -> DataFrame:
    """Consecutive numbers from offset + 1 in the given order, without a single-partition window.

    Rows are range-partitioned and numbered inside each partition; only one count for each partition is summed up."""
    parted = staged(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "numbered")
    parted = parted.withColumn("_rn", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    counts = parted.groupBy(F.col("_p").alias("_q")).agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_q", "_before")
    add = offset if isinstance(offset, Column) else F.lit(offset)
    return parted.join(F.broadcast(before), F.col("_p") == F.col("_q")).withColumn(name, (F.col("_rn") + F.col("_before") + add).cast("long")).drop("_p", "_q", "_rn", "_before")


def register_keys(registry: DataFrame, incoming: DataFrame, nk: str, id_col: str = "id") -> DataFrame:
    """``nk, id``: known natural keys keep their id, new ones go on after the largest, in the order of the key."""
    new = incoming.select(nk).where(F.col(nk).isNotNull()).distinct().join(registry.select(nk), nk, "left_anti")
    top = registry.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_top"))
    fresh = numbered(new, [nk], id_col).crossJoin(F.broadcast(top)).withColumn(id_col, F.col(id_col) + F.col("_top"))
    return registry.select(nk, id_col).unionByName(fresh.select(nk, id_col))


def snapshot_diff(a: DataFrame, b: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Rows of one snapshot that the other lacks, as a multiset, with ``side`` a or b; volatile columns are dropped."""
    cols = [c for c in a.columns if c not in drop]
    x, y = a.select(cols), b.select(cols)
    return x.exceptAll(y).withColumn("side", F.lit("a")).unionByName(y.exceptAll(x).withColumn("side", F.lit("b")))


def versions(changes: DataFrame, key: str, at: str, payload: Sequence[str]) -> DataFrame:
    """A numbered JSON snapshot for each change of a row."""
    w = Window.partitionBy(key).orderBy(at)
    return changes.select(key, at, F.row_number().over(w).alias("version_number"), F.to_json(F.struct(*payload)).alias("data"))


def star_edges(df: DataFrame, group: Sequence[str], node: str) -> DataFrame:
    """An edge from the smallest node of each group to every other one."""
    w = Window.partitionBy(*group)
    return df.select(*group, node).distinct().withColumn("anchor", F.min(node).over(w)).where(F.col(node) != F.col("anchor")).select(F.col("anchor").alias("a"), F.col(node).alias("b"))


def split_known(rows: DataFrame, known: DataFrame, fk: str, pk: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose parent exists, and orphans (null keys among them)."""
    k = known.select(F.col(pk).alias("_pk")).distinct()
    return rows.join(k, F.col(fk) == F.col("_pk"), "left_semi"), rows.join(k, F.col(fk) == F.col("_pk"), "left_anti")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """By name, missing columns null, types widened to string where they differ."""
    kinds: dict[str, set[str]] = {}
    for f in frames:
        for c, t in f.dtypes:
            kinds.setdefault(c, set()).add(t)
    relaxed = [f.select(*(F.col(c).cast("string").alias(c) if len(kinds[c]) > 1 else F.col(c) for c in f.columns)) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), relaxed)


def pad_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Missing source columns as null strings."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})
