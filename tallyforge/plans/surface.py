"""Look-ups, review queues, officer reports, link tables and checks over the unified tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.operators.dedup import filter_new_rows, keep_first, pad_columns, union_by_name


def find(rows: DataFrame, **values: object) -> DataFrame:
    """Rows whose columns equal the given values; a null value finds nulls."""
    for name, value in values.items():
        rows = rows.where(F.col(name).eqNullSafe(F.lit(value)))
    return rows


def by_origin(rows: DataFrame, prefix: str | None = None, suffix: str | None = None, column: str = "file_origin") -> DataFrame:
    """Rows of the files whose name begins or ends so."""
    rows = rows.where(F.col(column).startswith(prefix)) if prefix else rows
    return rows.where(F.col(column).endswith(suffix)) if suffix else rows


def active_officers(officers: DataFrame, role: str | None = None, unlinked: bool = False) -> DataFrame:
    """Officers without an end date, of one role or all, or only those without a person."""
    out = officers.where("is_active AND end_date IS NULL")
    out = out.where(F.col("role") == role) if role else out
    return out.where("person_id IS NULL") if unlinked else out


def pending_reviews(queue: DataFrame, run_id: int | None = None, source_type: str | None = None, limit: int | None = None) -> DataFrame:
    """Pending pairs, the highest score first, nulls last, then by id."""
    out = queue.where("status = 'pending'")
    out = out.where(F.col("run_id") == run_id) if run_id is not None else out
    out = out.where(F.col("source_type") == source_type) if source_type else out
    out = out.orderBy(F.col("score").desc_nulls_last(), "id")
    return out.limit(limit) if limit is not None else out


def role_pick(participants: DataFrame, key: str = "transaction_id") -> DataFrame:
    """The smallest entity of each transaction and role."""
    return participants.groupBy(key, "role").agg(F.min("entity_id").alias("entity_id"))


def representatives(persons: DataFrame) -> DataFrame:
    """``entity_id, person_id, address_id``: the smallest person of an entity, with that person's address."""
    return persons.where("entity_id IS NOT NULL").groupBy("entity_id").agg(F.min("person_id").alias("person_id"), F.min_by("address_id", "person_id").alias("address_id"))


#: How much each way of merging counts.
PRIORITY = {"approved_review": 3, "probabilistic": 2, "exact": 1}


def merge_methods(edges: DataFrame) -> DataFrame:
    """``uid, method, score`` of the strongest edge at each node, from (edge_id, a, b, method, score); ties to the first edge."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv])[F.col("method")], F.lit(0))
    ends = edges.select(F.explode(F.array("a", "b")).alias("uid"), "method", "score", rank.alias("rank"), "edge_id")
    return ends.groupBy("uid").agg(F.max_by(F.struct("method", "score"), F.struct("rank", (-F.col("edge_id")).alias("first"))).alias("best")).select("uid", "best.*")


def financial_summary(links: DataFrame, tx: DataFrame) -> DataFrame:
    """Per person: count, total, totals by role and the roles as JSON in order of role, from (person_id, role, committee_id)."""
    by = links.join(tx, "committee_id").groupBy("person_id", "role").agg(F.count("*").alias("n"), F.coalesce(F.sum("amount"), F.lit(0)).alias("total"))
    items = F.sort_array(F.collect_list(F.struct("role", "n", F.col("total").cast("double").alias("total"))))
    return by.groupBy("person_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.to_json(F.transform(items, lambda x: F.struct(x["role"].alias("role"), x["n"].alias("n")))).alias("roles"))


def band_counts(decisions: DataFrame) -> DataFrame:
    """Decisions by entity type and band."""
    return decisions.groupBy("entity_type", "band").agg(F.count("*").alias("n"))


def verification(tx: DataFrame, state: str = "state") -> DataFrame:
    """Per state: transactions, those without a date, without an amount, and types seen."""
    lack = lambda c: F.count_if(F.col(c).isNull())
    return tx.groupBy(F.coalesce(F.col(state), F.lit("UNKNOWN")).alias(state)).agg(F.count("*").alias("n"), lack("date").alias("no_date"), lack("amount").alias("no_amount"), F.countDistinct("type").alias("types"))


def entity_ids(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """Rows with the id of the entity of their type and normalized name; committees and empty names are no partners."""
    e = entities.where("entity_type <> 'COMMITTEE' AND normalized_name <> ''").groupBy("entity_type", "normalized_name").agg(F.min("entity_id").alias("entity_id"))
    return rows.join(e, ["entity_type", "normalized_name"], "left")


def campaign_lookup(tx: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The campaign of the committee, the year (0 for none) and the office (empty for none); the smallest id."""
    key = lambda df: [F.col("committee_id"), F.coalesce("year", F.lit(0)).alias("_y"), F.coalesce(C.office_normalized("office"), F.lit("")).alias("_o")]
    best = campaigns.select(*key(campaigns), "campaign_id").groupBy("committee_id", "_y", "_o").agg(F.min("campaign_id").alias("campaign_id"))
    rows = tx.withColumns({"_y": F.coalesce("year", F.lit(0)), "_o": F.coalesce(C.office_normalized("office"), F.lit(""))})
    return rows.join(best, ["committee_id", "_y", "_o"], "left").drop("_y", "_o")


def latest_run(rows: DataFrame) -> DataFrame:
    """The rows of the latest run; one number is compared, whatever the table's size."""
    return rows.join(F.broadcast(rows.agg(F.max("run_id").alias("run_id"))), "run_id")


def address_links(entity_cross: DataFrame, address_cross: DataFrame, homes: DataFrame) -> DataFrame:
    """``canonical_id, address_id, n``: how often each canonical entity and address of the latest runs meet, from homes (source_id, source_address)."""
    e = latest_run(entity_cross).select("source_id", "canonical_id")
    a = latest_run(address_cross).select("source_address", "address_id")
    return homes.join(e, "source_id").join(a, "source_address").groupBy("canonical_id", "address_id").agg(F.count("*").alias("n"))


def route_missing(pairs: DataFrame, predictions: DataFrame) -> DataFrame:
    """Pairs with their score and ``routed`` for those that were not predicted and need scoring one by one."""
    return pairs.join(predictions, ["a", "b"], "left").withColumn("routed", F.col("score").isNull())


def json_entries(rows: DataFrame, key: str, column: str) -> DataFrame:
    """``key, name, value`` for each entry of a JSON object of texts."""
    return rows.select(key, F.explode(F.from_json(column, "map<string,string>")).alias("name", "value"))


def head_share(rows: DataFrame, share: float, order: list[str]) -> DataFrame:
    """The first ceil(n * share) rows in order."""
    n = rows.count()
    return rows.orderBy(*order).limit(-int(-n * share // 1))


def committee_ids(*sources: DataFrame) -> DataFrame:
    """Distinct committee ids of several sources."""
    out = sources[0].select("committee_id")
    for s in sources[1:]:
        out = out.union(s.select("committee_id"))
    return out.where("committee_id IS NOT NULL").distinct()


def fill_links(rows: DataFrame, links: DataFrame, key: str, target: str) -> DataFrame:
    """Sets ``target`` from links (key, target) where it is null; what is set stays."""
    new = links.groupBy(key).agg(F.min(target).alias("_new"))
    return rows.join(new, key, "left").withColumn(target, F.coalesce(target, "_new")).drop("_new")


def inline_committees(*sources: tuple[int, DataFrame]) -> DataFrame:
    """``committee_id, name`` from transaction rows: sources by priority, then row order; the first name wins."""
    rows = None
    for priority, df in sources:
        part = df.select(C.clean_str("committee_id").alias("committee_id"), C.clean_str("name").alias("name"), F.lit(priority).alias("_p"), "ord")
        rows = part if rows is None else rows.union(part)
    return keep_first(rows.where("committee_id IS NOT NULL AND name IS NOT NULL"), ["committee_id"], ["_p", "ord"]).select("committee_id", "name")


def suppress_known(second: DataFrame, first: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Persons of the second source that the first doesn't have, null-safe on the keys, one for each key."""
    return filter_new_rows(second, first, keys, order)


def address_set(rows: DataFrame, person: list[str], parts: list[str], order: list[str]) -> DataFrame:
    """The first address of each person, then one row for each address."""
    own = keep_first(rows.where(F.coalesce(*parts).isNotNull()), person, order)
    return keep_first(own, parts, order).select(*parts)


def candidate_persons(rows: DataFrame, order: str) -> DataFrame:
    """Candidates: one for each organization or first and last name; those with less stay one for each row."""
    whole = F.col("organization").isNotNull() | (F.col("first_name").isNotNull() & F.col("last_name").isNotNull())
    keys = ["organization", "first_name", "last_name"]
    one = keep_first(rows.where(whole), keys, [order])
    return one.unionByName(rows.where(~F.coalesce(whole, F.lit(False))))


def person_ids(rows: DataFrame, persons: DataFrame, identity: list[str]) -> DataFrame:
    """Rows with the smallest person of exactly the same identity, nulls equal to nulls."""
    p = persons.groupBy(*(F.col(c).alias(f"_{c}") for c in identity)).agg(F.min("person_id").alias("person_id"))
    same = F.lit(True)
    for c in identity:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(p, same, "left").drop(*(f"_{c}" for c in identity))


def backfill(existing: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Existing rows with null columns filled from new ones."""
    n = new.groupBy(key).agg(*(F.min(c).alias(f"_{c}") for c in columns))
    out = existing.join(n, key, "left")
    return out.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*(f"_{c}" for c in columns))


def assertions(suggested: DataFrame, accepted: DataFrame) -> DataFrame:
    """Accepted suggestions as ``co_located_with`` rows, low id first; a pair of one with itself raises when read."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    same = F.when(F.col("a") == F.col("b"), F.raise_error(F.lit("a party can't be associated with itself"))).otherwise(F.lit("co_located_with"))
    both = suggested.join(accepted, ["a", "b"], "left_semi")
    return both.select(low.alias("source_id"), high.alias("target_id"), same.alias("kind")).distinct()


def merge_edges(edges: DataFrame, reviews: DataFrame) -> DataFrame:
    """Unordered pairs of merge edges and of approved reviews of any run, each once."""
    pair = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pair(edges).union(pair(reviews.where("status = 'approved'"))).where("a <> b").distinct()


def decision_report(decisions: DataFrame) -> DataFrame:
    """One line of text for each entity type: its bands and counts in order of band."""
    by = band_counts(decisions)
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("band", "n"))), lambda x: F.format_string("%s=%d", x["band"], x["n"])), ", ")
    return by.groupBy("entity_type").agg(lines.alias("line"))


def participants(rows: DataFrame) -> DataFrame:
    """Junction rows (transaction_id, person_id, role): never the recipient, each once."""
    return rows.where("person_id IS NOT NULL AND role <> 'RECIPIENT'").select("transaction_id", "person_id", "role").distinct()


def display_name(kind: Column, organization: Column, first: Column, last: Column) -> Column:
    """An entity's organization, or first and last name of a person; null if empty."""
    return F.when(kind == "ENTITY", organization).otherwise(F.nullif(F.concat_ws(" ", first, last), F.lit("")))


def notices(rows: DataFrame, mapped: list[str]) -> DataFrame:
    """Notices: who they are from by the notifier's type, the date, and all unmapped columns as JSON."""
    who = display_name(F.col("notifierPersentTypeCd"), C.clean_str("notifierNameOrganization"), C.clean_str("notifierNameFirst"), C.clean_str("notifierNameLast"))
    rest = [c for c in rows.columns if c not in mapped]
    return rows.select(C.clean_str("filerIdent").alias("committee_id"), who.alias("notice_from"), C.tec_date("receivedDt").alias("received"), F.to_json(F.struct(*rest)).alias("metadata_json"))


def pledge_detail(rows: DataFrame) -> DataFrame:
    """Pledges with the transaction's amount and date where they have none."""
    return rows.select("transaction_id", F.coalesce("pledge_amount", "amount").alias("amount"), F.coalesce("pledge_date", "date").alias("date"))


def first_field(rows: DataFrame, names: list[str]) -> Column:
    """The first value that isn't blank among those of the named columns that there are."""
    there = [C.clean_str(n) for n in names if n in rows.columns]
    return F.coalesce(*there) if there else F.lit(None).cast("string")


def filers(*files: DataFrame, columns: list[str]) -> DataFrame:
    """Filer rows of all files, the given columns, one for each filerIdent: the first by file, then by row order ``ord``."""
    parts = [pad_columns(f, columns).select(*columns, F.lit(i).alias("_f"), "ord") for i, f in enumerate(files)]
    return keep_first(union_by_name(*parts).where("filerIdent IS NOT NULL"), ["filerIdent"], ["_f", "ord"]).select(*columns)


def officer_links(officers: DataFrame, people: DataFrame) -> DataFrame:
    """Unlinked officers get the smallest person of the same first and last name, without regard to case."""
    name = F.lower(F.concat_ws(" ", "first_name", "last_name"))
    p = people.groupBy(name.alias("_n")).agg(F.min("person_id").alias("_p"))
    return officers.withColumn("_n", name).join(p, "_n", "left").withColumn("person_id", F.coalesce("person_id", "_p")).drop("_n", "_p")
