"""Mixing sources to target weights by Pareto order sampling (Rosén, 1997), in DataFrame operations only.

A source's target is its weighted share of all words, at most ``max_copies`` times its own; the excess is shared again
by weight (water filling, in closed form over the sources).  A source's target is dealt out the same way to classes of
documents by preference, so that a document's expected copies are in proportion to its preference, up to
``max_copies``: by default the bits of its size, so longer documents are preferred a little.  The whole part of the
expectation are certain copies, and the rest is the document's inclusion probability p.  Documents are ranked by
``odds(u) / odds(p)`` for a u that hashes the id, and the first ones are taken until the words that the source still
lacks are nearest to reached, so the sample's size is fixed and a source misses its target by about half a document.

Scale: a source may hold any share of the rows.  Its ranks are cut into buckets of about ``BUCKET`` documents by the
rank key; bucket sums are partially aggregated, a running sum goes over buckets, and single documents are ordered
only inside the one bucket where a source's budget ends: there, the key is near 1, a bucket holds at most as many as
if keys were uniform.  A row for each source and class is joined back, which Spark broadcasts if that is small.

Defined cases: null text has size 0 and is taken 0 words; null sources are one source, ordered last; a null, negative
or zero preference is taken 0 words; identical rows share one fate; no rows give no rows; a column to keep that
has the name of a result column gives way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.plans.scratch import staged

WORD = r"[^\x20\x09-\x0D]+"
BUCKET = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _u(key: Column, seed: int) -> Column:
    """Uniform in (0, 1) from the first 52 bits of an md5."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def water_fill(rows: DataFrame, own: list[str], total: Column, order: str) -> DataFrame:
    """Adds ``share``: each group's total dealt out by ``w`` and at most ``cap`` to each row, the excess dealt out again.

    A group's rows are few: sources, or classes of a source."""
    every = Window.partitionBy(*own)
    before = every.orderBy(F.col("cap") / F.col("w"), F.col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    rows = rows.withColumn("level", level)
    level = F.max(F.when(F.col("level") <= F.col("cap") / F.col("w"), F.col("level"))).over(every)
    return rows.withColumn("level", F.coalesce(level, F.lit(float("inf")))).withColumn("share", F.least(F.col("cap").cast("double"), F.col("w") * F.col("level")))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """``(s, source_size, n, target)`` for each source of ``(id, s, size)``."""
    order = Window.orderBy(F.col("s").asc_nulls_last())
    by = sizes.groupBy("s").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    by = by.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1)).cast("long"))
    by = by.withColumn("cap", max_copies * F.col("source_size"))
    return water_fill(by, [], F.sum("source_size").over(Window.partitionBy()), "s").select("s", "source_size", "n", F.col("share").alias("target"))


def _class(preference: Column | None, size: Column) -> Column:
    """Bits of the size, or a preference down to a sixteenth of its powers of two, so that a source has few classes."""
    if preference is None:
        return F.when(size > 0, F.length(F.bin(size)).cast("long"))
    return F.when((size > 0) & (preference > 0), F.pow(F.lit(2.0), F.floor(F.log2(preference.cast("double")) * 16) / 16))


def _ranked(sizes: DataFrame, plan: DataFrame, max_copies: int, seed: int) -> DataFrame:
    """Adds whole copies, the rank key and the bucket of the key."""
    df = sizes.join(plan, sizes["s"].eqNullSafe(plan["s"]) & sizes["pref"].eqNullSafe(plan["pref"])).drop(plan["s"]).drop(plan["pref"])
    expected = F.when(F.col("level").isNotNull(), F.least(F.lit(float(max_copies)), F.col("pref") * F.col("level"))).otherwise(0.0)
    df = df.withColumn("expected", expected).withColumn("whole", F.floor("expected")).withColumn("p", F.col("expected") - F.col("whole")).withColumn("u", _u(F.col("id"), seed))
    odds = lambda x: x / (1.0 - x)
    df = df.withColumn("key", F.when(F.col("p") > 0, odds(F.col("u")) / odds(F.col("p"))))
    return df.withColumn("bucket", F.floor(F.col("key") / (1.0 + F.col("key")) * F.ceil(F.col("n") / BUCKET)))


RESULT = ["size", "source_size", "target", "taken"]


def mix_to_targets(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_copies: int = 3, seed: int = 20, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", preference: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``id_col, size, source_size, target, taken`` for every row; ``keep`` names columns of docs to carry along, before these."""
    size = n_words(F.col(text_col))
    narrow = [F.col(id_col).alias("id"), F.col(source_col).alias("s"), size.alias("size"), _class(F.col(preference) if preference else None, size).alias("pref")]
    sizes = staged(docs.select(*narrow), "sizes")
    sources = source_targets(sizes, weights, max_copies)
    classes = sizes.groupBy(F.col("s").alias("cs"), "pref").agg(F.sum("size").alias("class_size"))
    by = sources.join(classes, F.col("s").eqNullSafe(F.col("cs"))).withColumn("cap", max_copies * F.col("class_size")).withColumn("w", F.col("pref") * F.col("class_size"))
    wet = water_fill(by.where("w > 0"), ["s"], F.col("target"), "pref").select(F.col("s").alias("cs"), F.col("pref").alias("cp"), "level")
    sources = staged(by.select("s", "source_size", "n", "target", "pref").join(wet, F.col("s").eqNullSafe(F.col("cs")) & (F.col("pref") == F.col("cp")), "left").drop("cs", "cp"), "sources")
    ranked = _ranked(sizes, sources, max_copies, seed)
    own = lambda: Window.partitionBy("s")
    sums = ranked.groupBy("s", "bucket", "target").agg(F.sum(F.when(F.col("p") > 0, F.col("size")).otherwise(0)).alias("words"), F.sum(F.col("whole") * F.col("size")).alias("certain"))
    sums = sums.withColumn("budget", F.col("target") - F.sum("certain").over(own())).where("bucket IS NOT NULL")
    sums = sums.withColumn("upto", F.sum("words").over(own().orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    ends = staged(sums.groupBy("s").agg(F.min(F.when(F.col("upto") > F.col("budget"), F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "budget"))).alias("e")).select("s", "e.*"), "ends")
    e = ends.select(F.col("s").alias("es"), F.col("bucket").alias("cut"), "before", "budget")
    inside = ranked.join(e, F.col("s").eqNullSafe(F.col("es")) & (F.col("bucket") == F.col("cut")))
    order = F.struct("key", "id", "size")
    upto = F.sum("size").over(own().orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0))
    last = inside.withColumn("mid", F.col("before") + upto - F.col("size") / 2).where("mid <= budget").groupBy("s").agg(F.max(order).alias("last"))
    cuts = e.join(last.withColumnRenamed("s", "ls"), F.col("es").eqNullSafe(F.col("ls")), "left").select("es", "cut", "last")
    plan = staged(sources.join(cuts, F.col("s").eqNullSafe(F.col("es")), "left").drop("es"), "plan")
    kept = [c for c in keep or [] if c not in RESULT]
    carried = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(kept)]
    out = _ranked(docs.select(*narrow, *carried) if keep else sizes, plan, max_copies, seed)
    sampled = F.col("p").__gt__(0) & (F.col("cut").isNull() | (F.col("bucket") < F.col("cut")) | ((F.col("bucket") == F.col("cut")) & F.coalesce(order <= F.col("last"), F.lit(False))))
    copies = F.col("whole") + F.when(sampled, 1).otherwise(0)
    first = [F.col(f"keep_{i}").alias(c) for i, c in enumerate(kept)] if keep else [F.col("id").alias(id_col)]
    return out.select(*first, "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"))


ORACLE = r"""
WITH sizes AS (SELECT doc_id, source AS s, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
by_s AS (SELECT s, CAST(SUM(size) AS BIGINT) AS source_size FROM sizes GROUP BY s),
w AS (SELECT *, 3 * source_size AS cap, [5, 2, 1][CAST((ROW_NUMBER() OVER (ORDER BY s NULLS LAST) - 1) % 3 + 1 AS INT)] AS w FROM by_s),
lv AS (SELECT *, (SUM(source_size) OVER () - COALESCE(SUM(cap) OVER b, 0)) / (SUM(w) OVER () - COALESCE(SUM(w) OVER b, 0)) AS lev
       FROM w WINDOW b AS (ORDER BY cap / w, s NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT s, source_size, LEAST(CAST(cap AS DOUBLE), w * MAX(CASE WHEN lev <= cap / w THEN lev END) OVER ()) AS target FROM lv),
c AS (SELECT s, length(bin(size)) AS bits, CAST(SUM(size) AS BIGINT) AS class_size FROM sizes WHERE size > 0 GROUP BY 1, 2),
cl AS (SELECT c.*, t.target, 3 * class_size AS cap, bits * class_size AS w FROM c JOIN t ON c.s IS NOT DISTINCT FROM t.s),
cv AS (SELECT *, (target - COALESCE(SUM(cap) OVER b, 0)) / (SUM(w) OVER (PARTITION BY s) - COALESCE(SUM(w) OVER b, 0)) AS lev
       FROM cl WINDOW b AS (PARTITION BY s ORDER BY cap / w, bits ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ce AS (SELECT s, bits, LEAST(3.0::DOUBLE, bits * COALESCE(MAX(CASE WHEN lev <= cap / w THEN lev END) OVER (PARTITION BY s), 'inf'::DOUBLE)) AS expected FROM cv),
d AS (SELECT doc_id, size, t.*, COALESCE(expected, 0) AS expected, floor(COALESCE(expected, 0)) AS whole, COALESCE(expected, 0) - floor(COALESCE(expected, 0)) AS p,
      (CAST('0x' || substr(md5('20:' || doc_id), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
      FROM sizes JOIN t ON sizes.s IS NOT DISTINCT FROM t.s LEFT JOIN ce ON ce.s IS NOT DISTINCT FROM t.s AND size > 0 AND ce.bits = length(bin(size))),
k AS (SELECT *, CASE WHEN p > 0 THEN u / (1 - u) / (p / (1 - p)) END AS key, target - SUM(whole * size) OVER (PARTITION BY s) AS budget FROM d),
m AS (SELECT *, CASE WHEN p > 0 THEN SUM(size) OVER (PARTITION BY s, p > 0 ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2 END AS mid FROM k)
SELECT doc_id, size, source_size, target, CAST((whole + CASE WHEN p > 0 AND mid <= budget THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM m
"""
