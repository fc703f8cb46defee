"""Entity resolution end to end: features, blocking, scoring by type, classification, clusters, golden records, crosswalk.

Records are ``source_type, source_id, entity_type, organization, first_name, middle_name, last_name, suffix, street, city,
state, zip_code, employer, filer_id, created_at, first_date, last_date``; entity types are person, organization and committee.
Pairs come from the default blocking rules, the weights of each type's model from EM, and what leaves a stage is
written to the shared folder, so that a lost executor costs tasks of one stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.functions.strings import metaphone_udf
from tallyforge.operators import matching as M
from tallyforge.operators.publishing import hash_sample
from tallyforge.plans.scratch import staged
from tallyforge.plans.surface import merge_edges, merge_methods


def features(records: DataFrame) -> DataFrame:
    """One shape for all source types; uid is ``type:id``, blank text is empty but for the employer, which stays null."""
    text = lambda c: F.coalesce(F.lower(C.clean_str(c)), F.lit(""))
    name = C.full_name("first_name", "middle_name", "last_name", "suffix", "organization")
    zip5 = F.coalesce(F.substring(C.zip_format("zip_code"), 1, 5), F.lit(""))
    rows = records.select(
        F.concat_ws(":", "source_type", F.col("source_id").cast("string")).alias("uid"), "source_type", "source_id", "entity_type",
        name.alias("raw_name"), *(text(c).alias(c) for c in ("first_name", "middle_name", "last_name", "suffix", "city")), text("street").alias("line_1"),
        F.coalesce(C.normalize_org_name("organization"), F.lit("")).alias("normalized_org"), F.upper(text("state")).alias("state"), zip5.alias("zip5"),
        F.lower(C.clean_str("employer")).alias("employer"), C.clean_str("filer_id").alias("filer_id"), "created_at", "first_date", "last_date",
        C.one_line_address("street", "city", "state", "zip_code").alias("address"))
    rows = rows.where("raw_name IS NOT NULL AND raw_name <> ''")
    phonetic = lambda c: F.when(F.col(c) != "", metaphone_udf(c)).otherwise("")
    parsed = F.when((F.col("line_1") != "") & (F.col("city") != "") & (F.col("zip5") != ""), "parsed").otherwise("partial")
    done = C.name_completeness(*(F.nullif(F.col(c), F.lit("")) for c in ("first_name", "middle_name", "last_name", "suffix", "normalized_org")))
    return rows.withColumns({"first_name_phonetic": phonetic("first_name"), "last_name_phonetic": phonetic("last_name"), "address_status": parsed, "completeness": done})


def exact_edges(rows: DataFrame) -> DataFrame:
    """Each record to the smallest one of the same committee id, or of the same type, whole name and parsed address."""
    name = F.concat_ws("|", *(F.col(c) for c in ("normalized_org", "first_name", "middle_name", "last_name", "suffix")))
    by = None
    for key, ok in ((F.concat_ws("|", F.lit("f"), "filer_id"), F.col("filer_id").isNotNull()), (F.concat_ws("|", F.lit("n"), "entity_type", name, "address"), F.col("address_status") == "parsed")):
        part = rows.where(ok).select(key.alias("key"), "uid")
        by = part if by is None else by.union(part)
    low = by.groupBy("key").agg(F.min("uid").alias("a"))
    return by.join(low, "key").where("a <> uid").select("a", F.col("uid").alias("b")).distinct()


def random_pairs(rows: DataFrame, seed: int, most: int = 1_000_000) -> DataFrame:
    """About ``most`` chance pairs of a type at most: each record meets the next ones in a hashed order, so no product is built."""
    order = F.xxhash64(F.lit(seed), "uid")
    n = rows.count()
    steps = max(1, min(20, most // max(n, 1)))
    cells = max(1, n // 1000)
    keyed = rows.select("uid", F.pmod(order, F.lit(cells)).alias("cell"), order.alias("luck"))
    ahead = Window.partitionBy("cell").orderBy("luck", "uid").rowsBetween(1, steps)
    met = keyed.select(F.col("uid").alias("a"), F.collect_list("uid").over(ahead).alias("next")).select("a", F.explode("next").alias("b"))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return hash_sample(pairs, min(1.0, most / max(1, n * steps)), seed)


def chance_levels(compared: DataFrame, model: tuple[M.Comparison, ...]) -> dict[str, list[float]]:
    """How often each level of each comparison comes by chance; never 0."""
    cols = [f"g_{c.column}" for c in model]
    counts = compared.groupBy(*cols).count().collect()
    out = {}
    for c, col in zip(model, cols, strict=True):
        n = [sum(r["count"] for r in counts if r[col] == k) + 0.5 for k in range(c.levels)]
        out[c.column] = [x / sum(n) for x in n]
    return out


@dataclass
class Resolved:
    features: DataFrame
    decisions: DataFrame
    clusters: DataFrame
    golden: DataFrame
    crosswalk: DataFrame


def score_type(rows: DataFrame, pairs: DataFrame, kind: str, seed: int = 1) -> DataFrame:
    """``a, b, score`` of one entity type's pairs: u from chance pairs, m and the prior by EM with u held."""
    model = M.MODELS[kind]
    compared = staged(M.compare(pairs, rows, model), "compared")
    u = chance_levels(M.compare(random_pairs(rows, seed), rows, model), model)
    weights = M.expectation_maximisation(compared, model, held_u=u)
    tf = {c.column: M.term_frequencies(rows.where(F.col(c.column) != ""), c.column) for c in model if c.tf}
    return M.score(compared, model, weights, tf)


def resolve(records: DataFrame, prior_decisions: DataFrame | None = None, run_id: int = 1, auto: float = 0.99, review: float = 0.80, most: int = 200, block: int = 100) -> Resolved:
    """All stages.  ``prior_decisions`` (a, b, status) of any run: approved pairs merge, rejected ones never do.
    Clusters of more than ``most`` members are held: their members stay apart."""
    spark = records.sparkSession
    rows = staged(features(records).withColumn("source_id", F.when(F.col("entity_type") == "committee", F.coalesce("filer_id", F.col("source_id").cast("string"))).otherwise(F.col("source_id").cast("string"))), "features")
    prior = prior_decisions if prior_decisions is not None else spark.createDataFrame([], "a string, b string, status string")
    keys = M.keyed(rows, M.default_rules())
    pairs = staged(M.candidate_pairs(keys, most=block), "pairs")
    kinds = rows.select(F.col("uid").alias("a"), "entity_type", F.col("first_name").alias("first_a"))
    other = rows.select(F.col("uid").alias("b"), F.col("first_name").alias("first_b"))
    scored = None
    for kind in sorted(M.MODELS):
        own = rows.where(F.col("entity_type") == kind)
        mine = pairs.join(own.select(F.col("uid").alias("a")), "a", "left_semi").select("a", "b")
        if mine.take(1):
            part = score_type(own, mine, kind)
            scored = part if scored is None else scored.unionByName(part)
    scored = scored if scored is not None else spark.createDataFrame([], "a string, b string, score double")
    decided = staged(M.classify(scored.join(kinds, "a").join(other, "b"), prior, auto, review).select("a", "b", "entity_type", "score", "band"), "decided")
    exact = exact_edges(rows)
    edges = merge_edges(decided.where("band = 'auto'").select("a", "b").union(exact), prior)
    never = prior.where("status = 'rejected'").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = staged(edges.join(never, ["a", "b"], "left_anti"), "edges")
    clusters = staged(M.clusters(rows, edges, most), "clusters")
    cluster = F.when(F.col("held"), F.concat_ws("#", "cluster_id", "uid")).otherwise(F.col("cluster_id"))
    members = rows.join(clusters.select("uid", cluster.alias("cluster_id"), "held"), "uid")
    golden = M.survivorship(members.withColumnRenamed("raw_name", "name").withColumn("uid", F.xxhash64("uid")))
    how = decided.select("a", "b", F.lit("probabilistic").alias("method"), "score").join(edges, ["a", "b"], "left_semi")
    how = how.union(exact.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit("exact"), F.lit(1.0)))
    how = how.union(merge_edges(edges.limit(0), prior).select("a", "b", F.lit("approved_review"), F.lit(1.0)))
    best = merge_methods(how.withColumn("edge_id", F.xxhash64("a", "b")))
    cross = members.select("uid", "source_type", "source_id", "cluster_id", "held").join(best, "uid", "left")
    lone = F.col("held") | F.col("method").isNull()
    cross = cross.select(F.lit(run_id).alias("run_id"), "uid", "source_type", "source_id", "cluster_id", F.when(lone, "singleton").otherwise(F.col("method")).alias("method"), F.when(lone, 1.0).otherwise(F.col("score")).alias("score"))
    return Resolved(rows, decided, clusters, golden, cross)
