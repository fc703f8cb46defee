"""Analytics and resolved views over the unified tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nonzero_sum(x: Column | str) -> Column:
    """The sum of values that are neither null nor zero; 0 for none."""
    c = F.col(x) if isinstance(x, str) else x
    return F.coalesce(F.sum(F.when(c != 0, c)), F.lit(0).cast("decimal(15,2)"))


def summary(tx: DataFrame, by: str, amount: str = "amount") -> DataFrame:
    """Count and non-zero total by a column, UNKNOWN for null."""
    return tx.groupBy(F.coalesce(F.col(by), F.lit("UNKNOWN")).alias(by)).agg(F.count("*").alias("n"), nonzero_sum(amount).alias("total"))


def histogram(tx: DataFrame, amount: str = "amount") -> DataFrame:
    """Counts up to 100 (negatives too), 1,000, 10,000 and above; nulls are in none."""
    a = F.col(amount)
    n = lambda c: F.coalesce(F.sum(F.when(c, 1)), F.lit(0)).cast("long")
    return tx.agg(n(a <= 100).alias("up_to_100"), n((a > 100) & (a <= 1000)).alias("up_to_1000"), n((a > 1000) & (a <= 10000)).alias("up_to_10000"), n(a > 10000).alias("above_10000"))


def top(parents: DataFrame, tx: DataFrame, key: str, fk: str, name: Column, k: int = 10, how: str = "left") -> DataFrame:
    """The k parents with the largest sums; with a left join those without transactions count as 0. Null names go."""
    rows = parents.join(tx.groupBy(F.col(fk).alias("_fk")).agg(F.sum("amount").alias("_s"), F.count("*").alias("_n")), F.col(key) == F.col("_fk"), how)
    out = rows.select(F.col(key).alias("id"), name.alias("name"), F.coalesce("_s", F.lit(0).cast("decimal(25,2)")).alias("total"), F.coalesce("_n", F.lit(0).cast("long")).alias("n"))
    return out.where("name IS NOT NULL").orderBy(F.desc("total"), "id").limit(k)


def name_as_of(tx: DataFrame, history: DataFrame, key: str = "entity_id", date: str = "date", tx_id: str = "tx_id") -> DataFrame:
    """The most frequent name whose window holds the transaction's date, open at null ends; else null. Ties: smaller name."""
    h = history.select(F.col(key).alias("_k"), "name", "first_seen", "last_seen", "occurrences")
    inside = (F.col("first_seen").isNull() | (F.col("first_seen") <= F.col(date))) & (F.col("last_seen").isNull() | (F.col("last_seen") >= F.col(date)))
    hit = tx.join(h, (F.col(key) == F.col("_k")) & inside)
    best = hit.groupBy(tx_id).agg(F.min_by("name", F.struct((-F.col("occurrences")).alias("o"), "name")).alias("name_as_of"))
    return tx.join(best, tx_id, "left")


def interval_pick(facts: DataFrame, windows: DataFrame, key: str, date: str, pick: str, fact_id: str) -> DataFrame:
    """One row of ``windows`` (key, start, stop) that covers each fact's date; the latest start, then the smallest pick."""
    w = windows.select(F.col(key).alias("_k"), "start", "stop", pick)
    hit = facts.join(w, (F.col(key) == F.col("_k")) & (F.col("start") <= F.col(date)) & (F.col("stop").isNull() | (F.col("stop") >= F.col(date))))
    best = hit.groupBy(fact_id).agg(F.min_by(pick, F.struct((-F.unix_date(F.col("start").cast("date"))).alias("s"), pick)).alias(pick))
    return facts.join(best, fact_id, "left")


def cross_role(given: DataFrame, received: DataFrame) -> DataFrame:
    """Entities on both sides, from (entity_id, amount) of each."""
    g = given.groupBy("entity_id").agg(F.count("*").alias("n_given"), F.sum("amount").alias("given"))
    r = received.groupBy("entity_id").agg(F.count("*").alias("n_received"), F.sum("amount").alias("received"))
    return g.join(r, "entity_id").withColumn("total_activity", F.col("given") + F.col("received"))


def occupancy(links: DataFrame) -> DataFrame:
    """Entities and transactions at each address, from (address_id, entity_id, transaction_id)."""
    return links.groupBy("address_id").agg(F.countDistinct("entity_id").alias("n_entities"), F.countDistinct("transaction_id").alias("n_transactions"))


def reconcile(reports: DataFrame, tx: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Declared against summed amounts of each report: matched, mismatched or skipped (nothing declared)."""
    s = tx.groupBy("report_ident").agg(F.sum("amount").alias("summed"))
    df = reports.join(s, "report_ident", "left").withColumn("summed", F.coalesce("summed", F.lit(0).cast("decimal(25,2)")))
    gap = F.abs(F.col("declared") - F.col("summed"))
    return df.withColumn("outcome", F.when(F.col("declared").isNull(), "skipped").when(gap <= tolerance, "matched").otherwise("mismatched"))


def crosstab(df: DataFrame, row: str, column: str, value: str, columns: list[str]) -> DataFrame:
    """Sums by two columns, with a Total column and a Total row."""
    each = [F.coalesce(F.sum(F.when(F.col(column) == c, F.col(value))), F.lit(0)).alias(c) for c in columns]
    total = F.coalesce(F.sum(value), F.lit(0)).alias("Total")
    return df.groupBy(F.col(row).cast("string").alias(row)).agg(*each, total).unionByName(df.agg(*each, total).withColumn(row, F.lit("Total")))


def waterfall(steps: DataFrame, key: str, order: str, weight: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn("running", F.sum(weight).over(w))


def cluster_agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """How two clusterings (uid, cluster) agree: same, over_split, over_merge or other, counted over the clusters of a."""
    both = a.toDF("uid", "ca").join(b.toDF("uid", "cb"), "uid")
    sizes = both.groupBy("ca", "cb").agg(F.count("*").alias("n"))
    na, nb = both.groupBy("ca").agg(F.count("*").alias("na")), both.groupBy("cb").agg(F.count("*").alias("nb"))
    j = sizes.join(na, "ca").join(nb, "cb")
    by = j.groupBy("ca").agg(F.max((F.col("n") == F.col("na")).cast("int")).alias("inside"), F.min((F.col("n") == F.col("nb")).cast("int")).alias("covers"))
    kind = F.when((F.col("inside") == 1) & (F.col("covers") == 1), "same").when(F.col("covers") == 1, "over_merge").when(F.col("inside") == 1, "over_split").otherwise("other")
    return by.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def prune_runs(tables: dict[str, DataFrame], runs: DataFrame, keep: int) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables without the rows of all but the latest ``keep`` runs, and how many rows went from each."""
    latest = runs.orderBy(F.desc("run_id")).limit(keep).select("run_id")
    kept = {n: t.join(F.broadcast(latest), "run_id", "left_semi") for n, t in tables.items()}
    counts = None
    for n, t in tables.items():
        c = t.join(F.broadcast(latest), "run_id", "left_anti").agg(F.count("*").alias("removed")).withColumn("table", F.lit(n))
        counts = c if counts is None else counts.unionByName(c)
    return kept, counts


def unmerge(table: DataFrame, run_id: int, latest: int) -> DataFrame:
    """The table without one run; only the latest completed run can be undone."""
    if run_id != latest:
        raise ValueError("only the latest completed run can be undone")
    return table.where(F.col("run_id") != run_id)


def review(queue: DataFrame, pair_id: int, status: str, reviewer: str) -> DataFrame:
    """The queue with one pending pair decided; a decided pair raises when read."""
    if status not in ("approved", "rejected"):
        raise ValueError(status)
    hit = F.col("id") == pair_id
    once = F.when(hit & (F.col("status") != "pending"), F.raise_error(F.lit("this review is decided"))).when(hit, F.lit(status)).otherwise(F.col("status"))
    return queue.withColumns({"status": once, "reviewer": F.when(hit, F.lit(reviewer)).otherwise(F.col("reviewer"))})


def master_chain(entities: DataFrame, max_depth: int = 20) -> DataFrame:
    """``id, root, depth``: pointers followed to their end; a longer chain (or a cycle) raises when read."""
    spark = entities.sparkSession
    entities.createOrReplaceTempView("_entities")
    return spark.sql(f"""
        WITH RECURSIVE c(id, at, depth) AS (
          SELECT id, id, 0 FROM _entities
          UNION ALL SELECT c.id, e.master_id, c.depth + 1 FROM c JOIN _entities e ON e.id = c.at WHERE e.master_id IS NOT NULL AND c.depth < {max_depth})
        SELECT id, max_by(at, depth) AS root, CASE WHEN max(depth) >= {max_depth} THEN raise_error('a chain of masters does not end') ELSE max(depth) END AS depth FROM c GROUP BY id""")
