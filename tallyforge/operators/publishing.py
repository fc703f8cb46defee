"""Deterministic edges, canonical addresses and campaigns, decision explanations, the run ledger and report links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.operators.dedup import keep_first, star_edges


def fast_path(records: DataFrame, links: DataFrame) -> DataFrame:
    """``a, b, reason`` of exact matches: entity to its source record, same filer id, same name at the same parsed address.

    Pairs are unordered and unique; the first reason in that order counts."""
    filer = star_edges(records.where("filer_id IS NOT NULL"), ["filer_id"], "uid")
    same = records.where("address_status = 'parsed' AND name_key <> ''")
    named = star_edges(same, ["entity_type", "name_key", "address"], "uid")
    every = links.select("a", "b", F.lit(0).alias("p")).union(filer.select("a", "b", F.lit(1))).union(named.select("a", "b", F.lit(2)))
    low, high = C.pair(F.col("a"), F.col("b"))
    best = every.where("a <> b").groupBy(low.alias("a"), high.alias("b")).agg(F.min("p").alias("p"))
    return best.select("a", "b", F.element_at(F.array(F.lit("link"), F.lit("filer_id"), F.lit("name_address")), F.col("p") + 1).alias("reason"))


def canonical_addresses(rows: DataFrame, parts: list[str]) -> DataFrame:
    """One row for each standardized address with its frequency; rows without any part go."""
    there = F.coalesce(*parts).isNotNull()
    return rows.where(there).groupBy(*parts).agg(F.count("*").alias("frequency"))


def most_frequent(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The value that each key has most often; ties to the smaller value."""
    by = rows.groupBy(key, value).agg(F.count("*").alias("n"))
    return by.groupBy(key).agg(F.min_by(value, F.struct((-F.col("n")).alias("n"), value)).alias(value))


def canonical_campaigns(rows: DataFrame) -> DataFrame:
    """By committee, office and cycle: the first row's name, and the first candidate that isn't null, in order of id."""
    df = rows.withColumns({"office": C.office_normalized("office"), "cycle": F.coalesce("cycle", F.lit(0))})
    return df.groupBy("committee", "office", "cycle").agg(F.min_by("name", "id").alias("name"), F.min_by("candidate", F.when(F.col("candidate").isNotNull(), F.col("id"))).alias("candidate"))


def explanation(scored: DataFrame, columns: list[str]) -> DataFrame:
    """``a, b, explanation``: a JSON object of column to Bayes factor, in order of name."""
    items = F.array_sort(F.array(*(F.struct(F.lit(c).alias("k"), F.col(f"bf_{c}").alias("v")) for c in columns)))
    return scored.select("a", "b", F.to_json(F.map_from_entries(items)).alias("explanation"))


def link_reports(tx: DataFrame, reports: DataFrame) -> DataFrame:
    """Sets report_id by (state, identifier) where it is null; one report for each key, the smallest id."""
    r = reports.groupBy(F.col("state_id").alias("_s"), F.col("report_ident").alias("_i")).agg(F.min("id").alias("_r"))
    j = tx.join(r, (F.col("state_id") == F.col("_s")) & (F.col("report_ident") == F.col("_i")), "left")
    return j.withColumn("report_id", F.coalesce("report_id", "_r")).drop("_s", "_i", "_r")


def mark_final(reports: DataFrame, finals: DataFrame) -> DataFrame:
    f = finals.select(F.col("report_ident").alias("_i")).distinct().withColumn("_f", F.lit(True))
    return reports.join(f, F.col("report_ident") == F.col("_i"), "left").withColumn("is_final", F.coalesce("_f", "is_final")).drop("_i", "_f")


def match_officers(officers: DataFrame, people: DataFrame) -> DataFrame:
    """Officers linked to the person of the same ``first last`` without regard to case; the smallest id; else null."""
    name = lambda df: F.lower(F.concat_ws(" ", df["first_name"], df["last_name"]))
    p = people.groupBy(name(people).alias("_n")).agg(F.min("person_id").alias("person_id"))
    return officers.join(p, name(officers) == F.col("_n"), "left").drop("_n")


def spac_links(df: DataFrame, positions: dict[str, str]) -> DataFrame:
    """Support links: candidate or measure, the supported name, and the position spelled out."""
    m = F.create_map(*[F.lit(x) for kv in positions.items() for x in kv])
    kind = F.when(C.clean_str("candidateFilerIdent").isNotNull(), "candidate").otherwise("measure")
    return df.select(C.clean_str("spacFilerIdent").alias("spac_filer_id"), kind.alias("support_type"), C.clean_str("candidateFilerIdent").alias("candidate_filer_id"), m[F.upper(C.strip("spacPositionCd"))].alias("position"))


def run_ledger(events: DataFrame) -> DataFrame:
    """The state of each run from its events (run_id, seq, status, counters as a map): the last status, counters overwritten in order."""
    w = Window.partitionBy("run_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    each = events.select("run_id", "seq", "status", F.explode_outer("counters").alias("k", "v"))
    last = keep_first(each.where("k IS NOT NULL"), ["run_id", "k"], [F.col("seq").desc()])
    counters = last.groupBy("run_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("counters"))
    state = events.select("run_id", F.last("status", ignorenulls=True).over(w).alias("status")).distinct()
    return state.join(counters, "run_id", "left")


def hash_sample(pairs: DataFrame, share: float, seed: int, a: str = "a", b: str = "b") -> DataFrame:
    """A deterministic sample of pairs, the same on every run."""
    return pairs.where(F.pmod(F.xxhash64(F.lit(seed), a, b), F.lit(1 << 20)) < int(share * (1 << 20)))
