"""Registered queries of the look-ups, link tables and checks in ``plans.surface``, with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.plans import surface as V
from tallyforge.queries import LINES, TX, dbl, lines, query, table, tx


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey = 7 OR o_custkey = 370")
def find_transactions(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return V.find(o, o_orderkey=7).union(V.find(o, o_custkey=370).where("o_orderkey <> 7"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE starts_with(c_mktsegment, 'MA') AND ends_with(c_mktsegment, 'Y')")
def by_origin(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("file_origin"))
    return V.by_origin(c, "MA", "Y").withColumnRenamed("file_origin", "c_mktsegment")


OFFICERS = "off AS (SELECT s_suppkey AS officer_id, CASE s_suppkey % 3 WHEN 0 THEN 'TREASURER' WHEN 1 THEN 'CHAIR' ELSE 'ASSISTANT' END AS role, s_suppkey % 4 <> 0 AS is_active, CASE WHEN s_suppkey % 5 = 0 THEN DATE '2020-01-01' END AS end_date, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey * 10 END AS person_id, 'F' || (s_suppkey % 7) AS first_name, 'L' || (s_suppkey % 3) AS last_name FROM supplier)"


def _officers(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    role = F.when(k % 3 == 0, "TREASURER").when(k % 3 == 1, "CHAIR").otherwise("ASSISTANT")
    return table(spark, sf, "supplier").select(k.alias("officer_id"), role.alias("role"), (k % 4 != 0).alias("is_active"), F.when(k % 5 == 0, F.to_date(F.lit("2020-01-01"))).alias("end_date"), F.when(k % 2 == 0, k * 10).alias("person_id"), F.concat(F.lit("F"), k % 7).alias("first_name"), F.concat(F.lit("L"), k % 3).alias("last_name"))


@query(f"WITH {OFFICERS} SELECT officer_id, role FROM off WHERE is_active AND end_date IS NULL AND role = 'CHAIR' AND person_id IS NULL")
def active_officers(spark: SparkSession, sf: str) -> DataFrame:
    return V.active_officers(_officers(spark, sf), "CHAIR", unlinked=True).select("officer_id", "role")


@query(f"WITH {OFFICERS}, p AS (SELECT lower('f' || (c_custkey % 7) || ' l' || (c_custkey % 2)) AS n, MIN(c_custkey) AS p FROM customer GROUP BY 1) SELECT officer_id, COALESCE(person_id, p) AS person_id FROM off LEFT JOIN p ON n = lower(first_name || ' ' || last_name)")
def officer_links(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    people = table(spark, sf, "customer").select(k.alias("person_id"), F.concat(F.lit("f"), k % 7).alias("first_name"), F.concat(F.lit("l"), k % 2).alias("last_name"))
    return V.officer_links(_officers(spark, sf), people).select("officer_id", "person_id")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 100 AS DOUBLE) / 100 END AS score FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 3 = 2 ORDER BY score DESC NULLS LAST, id LIMIT 50")
def pending_reviews(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    queue = table(spark, sf, "orders").select(k.alias("id"), F.when(k % 9 != 0, (k % 100).cast("double") / 100).alias("score"), F.when(F.col("o_orderstatus") == "P", "pending").otherwise("approved").alias("status"), (k % 3).alias("run_id"), F.lit("person").alias("source_type"))
    return V.pending_reviews(queue, 2, "person", 50).select("id", "score")


@query(f"WITH {LINES} SELECT tx_id AS transaction_id, CASE WHEN l_linenumber % 2 = 0 THEN 'PAYEE' ELSE 'PAYOR' END AS role, MIN(entity_id) AS entity_id FROM li GROUP BY 1, 2")
def role_pick(spark: SparkSession, sf: str) -> DataFrame:
    li = lines(spark, sf).withColumn("role", F.when(F.col("l_linenumber") % 2 == 0, "PAYEE").otherwise("PAYOR"))
    return V.role_pick(li.withColumnRenamed("tx_id", "transaction_id"))


@query("SELECT c_nationkey AS entity_id, MIN(c_custkey) AS person_id, arg_min(c_mktsegment, c_custkey) AS address_id FROM customer GROUP BY 1")
def representatives(spark: SparkSession, sf: str) -> DataFrame:
    return V.representatives(table(spark, sf, "customer").select(F.col("c_nationkey").alias("entity_id"), F.col("c_custkey").alias("person_id"), F.col("c_mktsegment").alias("address_id")))


@query("WITH e AS (SELECT o_orderkey AS edge_id, o_custkey AS a, o_custkey % 97 + 5000 AS b, CASE o_orderkey % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'probabilistic' WHEN 2 THEN 'other' ELSE 'exact' END AS method, CAST(o_orderkey % 100 AS DOUBLE) / 100 AS score FROM orders), n AS (SELECT a AS uid, * FROM e UNION ALL SELECT b, * FROM e), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY uid ORDER BY CASE method WHEN 'probabilistic' THEN 2 WHEN 'exact' THEN 1 ELSE 0 END DESC, edge_id) AS rn FROM n) SELECT uid, method, score FROM r WHERE rn = 1")
def merge_methods(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    method = F.when(k % 4 == 1, "probabilistic").when(k % 4 == 2, "other").otherwise("exact")
    return V.merge_methods(table(spark, sf, "orders").select(k.alias("edge_id"), F.col("o_custkey").alias("a"), (F.col("o_custkey") % 97 + 5000).alias("b"), method.alias("method"), ((k % 100).cast("double") / 100).alias("score")))


@query(f"WITH {OFFICERS}, {LINES}, b AS (SELECT officer_id % 20 AS person_id, role, COUNT(*) AS n, SUM(amount) AS total FROM off JOIN li ON entity_id = officer_id GROUP BY 1, 2) SELECT person_id, CAST(SUM(n) AS BIGINT) AS n, CAST(SUM(total) AS DOUBLE) AS total, '[' || string_agg('{{\"role\":\"' || role || '\",\"n\":' || n || '}}', ',' ORDER BY role) || ']' AS roles FROM b GROUP BY 1")
def financial_summary(spark: SparkSession, sf: str) -> DataFrame:
    o = _officers(spark, sf).select((F.col("officer_id") % 20).alias("person_id"), "role", F.col("officer_id").alias("committee_id"))
    return dbl(V.financial_summary(o, lines(spark, sf).withColumnRenamed("entity_id", "committee_id")), "total")


@query("SELECT o_orderstatus AS entity_type, o_orderpriority AS band, COUNT(*) AS n FROM orders GROUP BY 1, 2")
def band_counts(spark: SparkSession, sf: str) -> DataFrame:
    return V.band_counts(table(spark, sf, "orders").select(F.col("o_orderstatus").alias("entity_type"), F.col("o_orderpriority").alias("band")))


@query("WITH b AS (SELECT o_orderstatus AS entity_type, o_orderpriority AS band, COUNT(*) AS n FROM orders GROUP BY 1, 2) SELECT entity_type, string_agg(band || '=' || n, ', ' ORDER BY band) AS line FROM b GROUP BY 1")
def decision_report(spark: SparkSession, sf: str) -> DataFrame:
    return V.decision_report(table(spark, sf, "orders").select(F.col("o_orderstatus").alias("entity_type"), F.col("o_orderpriority").alias("band")))


@query(f"WITH {TX}, x AS (SELECT c_mktsegment AS state, CASE WHEN tx_id % 5 <> 0 THEN date END AS date, CASE WHEN tx_id % 7 <> 0 THEN amount END AS amount, type FROM tx LEFT JOIN customer ON c_custkey = entity_id AND c_custkey % 10 <> 0) SELECT COALESCE(state, 'UNKNOWN') AS state, COUNT(*) AS n, COUNT(*) FILTER (WHERE date IS NULL) AS no_date, COUNT(*) FILTER (WHERE amount IS NULL) AS no_amount, COUNT(DISTINCT type) AS types FROM x GROUP BY 1")
def verification(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("state"))
    t = tx(spark, sf).join(c, "entity_id", "left")
    return V.verification(t.withColumns({"date": F.expr("CASE WHEN tx_id % 5 <> 0 THEN date END"), "amount": F.expr("CASE WHEN tx_id % 7 <> 0 THEN amount END")}))


@query("WITH e AS (SELECT c_mktsegment AS entity_type, lower(c_name) AS normalized_name, MIN(c_custkey) AS entity_id FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1, 2) SELECT c.c_custkey, entity_id FROM customer c LEFT JOIN e ON entity_type = c_mktsegment AND normalized_name = lower(c_name)")
def entity_ids(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("c_mktsegment") == "MACHINERY", "COMMITTEE").otherwise(F.col("c_mktsegment"))
    rows = table(spark, sf, "customer").select("c_custkey", kind.alias("entity_type"), F.lower("c_name").alias("normalized_name"))
    return V.entity_ids(rows, rows.withColumnRenamed("c_custkey", "entity_id")).select("c_custkey", "entity_id")


@query(f"WITH {TX}, c AS (SELECT o_custkey AS committee_id, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE year(o_orderdate) END AS y, lower(o_orderpriority) AS o, MIN(o_orderkey) AS campaign_id FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2, 3) SELECT o_orderkey AS tx_id, campaign_id FROM orders LEFT JOIN c ON committee_id = o_custkey AND y = year(o_orderdate) AND o = lower(o_orderpriority)")
def campaign_lookup(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("committee_id"), F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("office"))
    campaigns = o.where("o_orderkey % 2 = 0").withColumn("year", F.expr("CASE WHEN o_orderkey % 4 <> 0 THEN year END")).withColumnRenamed("o_orderkey", "campaign_id")
    return V.campaign_lookup(o, campaigns).select(F.col("o_orderkey").alias("tx_id"), "campaign_id")


@query("WITH e AS (SELECT c_custkey AS source_id, c_custkey % 50 AS canonical_id FROM customer WHERE c_custkey % 3 = 2), a AS (SELECT s_suppkey AS source_address, s_nationkey AS address_id FROM supplier WHERE s_suppkey % 2 = 1), h AS (SELECT o_custkey AS source_id, o_orderkey % 100 AS source_address FROM orders) SELECT canonical_id, address_id, COUNT(*) AS n FROM h JOIN e USING (source_id) JOIN a USING (source_address) GROUP BY 1, 2")
def address_links(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "customer").select(F.col("c_custkey").alias("source_id"), (F.col("c_custkey") % 50).alias("canonical_id"), (F.col("c_custkey") % 3).alias("run_id"))
    a = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("source_address"), F.col("s_nationkey").alias("address_id"), (F.col("s_suppkey") % 2).alias("run_id"))
    h = table(spark, sf, "orders").select(F.col("o_custkey").alias("source_id"), (F.col("o_orderkey") % 100).alias("source_address"))
    return V.address_links(e, a, h)


@query("SELECT o_orderkey AS a, o_custkey AS b, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS score, o_orderstatus <> 'F' AS routed FROM orders")
def route_missing(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_custkey").alias("b"), F.col("o_totalprice").alias("score"), "o_orderstatus")
    return V.route_missing(o.select("a", "b"), o.where("o_orderstatus = 'F'").select("a", "b", "score"))


@query("SELECT o_orderkey, unnest(['status', 'priority']) AS name, unnest([o_orderstatus, o_orderpriority]) AS value FROM orders")
def json_entries(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))).alias("j"))
    return V.json_entries(o, "o_orderkey", "j")


@query("SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT (SELECT CAST(ceil(COUNT(*) * 0.07::DOUBLE) AS BIGINT) FROM customer)")
def head_share(spark: SparkSession, sf: str) -> DataFrame:
    return V.head_share(table(spark, sf, "customer").select("c_custkey"), 0.07, ["c_custkey"])


@query("SELECT DISTINCT committee_id FROM (SELECT s_suppkey AS committee_id FROM supplier UNION SELECT l_suppkey FROM lineitem UNION SELECT o_custkey FROM orders)")
def committee_ids(spark: SparkSession, sf: str) -> DataFrame:
    of = lambda t, c: table(spark, sf, t).select(F.col(c).alias("committee_id"))
    return V.committee_ids(of("supplier", "s_suppkey"), of("lineitem", "l_suppkey"), of("orders", "o_custkey"))


@query("WITH n AS (SELECT o_custkey, MIN(o_orderkey) AS m FROM orders GROUP BY 1) SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE m END AS address_id FROM customer LEFT JOIN n ON o_custkey = c_custkey")
def fill_links(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 3 = 0 THEN c_custkey END").alias("address_id"))
    return V.fill_links(c, table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("address_id")), "c_custkey", "address_id")


@query("WITH r AS (SELECT CAST(o_custkey % 300 AS VARCHAR) AS committee_id, 'R' || o_orderstatus AS name, 0 AS p, o_orderkey AS ord FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT CAST(o_custkey % 400 AS VARCHAR), 'E' || o_orderpriority, 1, o_orderkey FROM orders) SELECT committee_id, arg_min(name, p * 1000000000000 + ord) AS name FROM r GROUP BY 1")
def inline_committees(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    part = lambda m, c, x: o.select((F.col("o_custkey") % m).cast("string").alias("committee_id"), F.concat(F.lit(x), c).alias("name"), F.col("o_orderkey").alias("ord"))
    return V.inline_committees((0, part(300, "o_orderstatus", "R").where("ord % 2 = 0")), (1, part(400, "o_orderpriority", "E")))


PEOPLE = "pp AS (SELECT c_custkey AS ord, CASE WHEN c_custkey % 4 = 0 THEN 'O' || (c_custkey % 9) END AS organization, CASE WHEN c_custkey % 5 <> 0 THEN 'f' || (c_custkey % 11) END AS first_name, CASE WHEN c_custkey % 3 <> 0 THEN 'l' || (c_custkey % 13) END AS last_name, c_mktsegment AS city, CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS state FROM customer)"


def _people(spark: SparkSession, sf: str) -> DataFrame:
    e = ["c_custkey AS ord", "CASE WHEN c_custkey % 4 = 0 THEN 'O' || (c_custkey % 9) END AS organization", "CASE WHEN c_custkey % 5 <> 0 THEN 'f' || (c_custkey % 11) END AS first_name", "CASE WHEN c_custkey % 3 <> 0 THEN 'l' || (c_custkey % 13) END AS last_name", "c_mktsegment AS city", "CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_nationkey AS STRING) END AS state"]
    return table(spark, sf, "customer").selectExpr(*e)


KEYS3 = ["organization", "first_name", "last_name"]


@query(f"WITH {PEOPLE}, s AS (SELECT * FROM pp WHERE ord % 2 = 1), f AS (SELECT * FROM pp WHERE ord % 2 = 0) SELECT MIN(s.ord) AS ord FROM s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.organization IS NOT DISTINCT FROM s.organization AND f.first_name IS NOT DISTINCT FROM s.first_name AND f.last_name IS NOT DISTINCT FROM s.last_name) GROUP BY organization, first_name, last_name")
def suppress_known(spark: SparkSession, sf: str) -> DataFrame:
    p = _people(spark, sf)
    return V.suppress_known(p.where("ord % 2 = 1"), p.where("ord % 2 = 0"), KEYS3, ["ord"]).select("ord")


@query(f"WITH {PEOPLE}, a AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY organization, first_name, last_name ORDER BY ord) AS rn FROM pp WHERE COALESCE(city, state) IS NOT NULL) SELECT DISTINCT city, state FROM a WHERE rn = 1")
def address_set(spark: SparkSession, sf: str) -> DataFrame:
    return V.address_set(_people(spark, sf), KEYS3, ["city", "state"], ["ord"])


@query(f"WITH {PEOPLE}, w AS (SELECT *, organization IS NOT NULL OR (first_name IS NOT NULL AND last_name IS NOT NULL) AS whole FROM pp) SELECT MIN(ord) AS ord FROM w WHERE whole GROUP BY organization, first_name, last_name UNION ALL SELECT ord FROM w WHERE NOT whole")
def candidate_persons(spark: SparkSession, sf: str) -> DataFrame:
    return V.candidate_persons(_people(spark, sf), "ord").select("ord")


@query(f"WITH {PEOPLE}, i AS (SELECT organization, first_name, last_name, MIN(ord) AS person_id FROM pp WHERE ord % 3 = 1 GROUP BY 1, 2, 3) SELECT ord, person_id FROM pp LEFT JOIN i ON i.organization IS NOT DISTINCT FROM pp.organization AND i.first_name IS NOT DISTINCT FROM pp.first_name AND i.last_name IS NOT DISTINCT FROM pp.last_name")
def person_ids(spark: SparkSession, sf: str) -> DataFrame:
    p = _people(spark, sf)
    return V.person_ids(p, p.where("ord % 3 = 1").select(*KEYS3, F.col("ord").alias("person_id")), KEYS3).select("ord", "person_id")


@query(f"WITH {PEOPLE}, n AS (SELECT ord - 1 AS ord, first_name AS f, last_name AS l FROM pp) SELECT pp.ord, COALESCE(first_name, f) AS first_name, COALESCE(last_name, l) AS last_name FROM pp LEFT JOIN n ON n.ord = pp.ord")
def backfill(spark: SparkSession, sf: str) -> DataFrame:
    p = _people(spark, sf).select("ord", "first_name", "last_name")
    return V.backfill(p, p.withColumn("ord", F.col("ord") - 1), "ord", ["first_name", "last_name"])


@query("SELECT DISTINCT least(s_suppkey, s_nationkey + 1000) AS source_id, greatest(s_suppkey, s_nationkey + 1000) AS target_id, 'co_located_with' AS kind FROM supplier WHERE s_suppkey % 2 = 0")
def colocation_assertions(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("a"), (F.col("s_nationkey").cast("long") + 1000).alias("b"))
    return V.assertions(s, s.where("a % 2 = 0"))


@query("SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM (SELECT o_custkey AS a, o_orderkey % 1500 AS b FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_orderkey % 1500, o_custkey FROM orders WHERE o_orderstatus = 'F') WHERE a <> b")
def cluster_edges(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 1500).alias("b"), F.when(F.col("o_orderstatus") == "F", "approved").otherwise("pending").alias("status"), "o_orderstatus")
    return V.merge_edges(o.where("o_orderstatus = 'P'"), o.where("o_orderstatus <> 'P'"))


@query(f"WITH {LINES} SELECT DISTINCT tx_id AS transaction_id, entity_id AS person_id, CASE WHEN l_linenumber % 2 = 0 THEN 'PAYEE' ELSE 'PAYOR' END AS role FROM li WHERE l_linenumber % 3 <> 0")
def transaction_participants(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_linenumber")
    role = F.when(n % 3 == 0, "RECIPIENT").when(n % 2 == 0, "PAYEE").otherwise("PAYOR")
    return V.participants(lines(spark, sf).select(F.col("tx_id").alias("transaction_id"), F.col("entity_id").alias("person_id"), role.alias("role")))


@query(f"WITH {PEOPLE} SELECT CAST(ord AS VARCHAR) AS committee_id, CASE WHEN organization IS NOT NULL THEN organization ELSE nullif(concat_ws(' ', first_name, last_name), '') END AS notice_from, '1996-02-29' AS received, '{{\"noticeType\":\"' || city || '\"}}' AS metadata_json FROM pp")
def notices(spark: SparkSession, sf: str) -> DataFrame:
    p = _people(spark, sf)
    rows = p.select(F.col("ord").cast("string").alias("filerIdent"), F.when(F.col("organization").isNotNull(), "ENTITY").otherwise("INDIVIDUAL").alias("notifierPersentTypeCd"), F.col("organization").alias("notifierNameOrganization"), F.col("first_name").alias("notifierNameFirst"), F.col("last_name").alias("notifierNameLast"), F.lit("19960229").alias("receivedDt"), F.col("city").alias("noticeType"))
    return V.notices(rows, rows.columns[:6]).withColumn("received", F.col("received").cast("string"))


@query(f"WITH {TX} SELECT tx_id AS transaction_id, CAST(CASE WHEN tx_id % 3 = 0 THEN 5 ELSE amount END AS DOUBLE) AS amount, CAST(CASE WHEN tx_id % 4 = 0 THEN DATE '2001-01-01' ELSE date END AS VARCHAR) AS date FROM tx")
def pledge_detail(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf).select(F.col("tx_id").alias("transaction_id"), "amount", "date", F.expr("CASE WHEN tx_id % 3 = 0 THEN CAST(5 AS DECIMAL(15,2)) END").alias("pledge_amount"), F.expr("CASE WHEN tx_id % 4 = 0 THEN DATE '2001-01-01' END").alias("pledge_date"))
    return dbl(V.pledge_detail(t), "amount").withColumn("date", F.col("date").cast("string"))


@query(f"WITH {PEOPLE} SELECT ord, COALESCE(first_name, last_name, organization) AS name FROM pp")
def first_field(spark: SparkSession, sf: str) -> DataFrame:
    p = _people(spark, sf)
    return p.select("ord", V.first_field(p, ["officer_name", "first_name", "last_name", "organization"]).alias("name"))


@query("WITH f AS (SELECT CAST(s_suppkey AS VARCHAR) AS filerIdent, s_name AS filerName, 0 AS f, s_suppkey AS ord FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT CAST(s_nationkey AS VARCHAR), s_name, 1, s_suppkey FROM supplier) SELECT filerIdent, arg_min(filerName, f * 1000000000 + ord) AS filerName, CAST(NULL AS VARCHAR) AS filerTypeCd FROM f GROUP BY 1")
def filers(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    of = lambda c: s.select(F.col(c).cast("string").alias("filerIdent"), F.col("s_name").alias("filerName"), F.col("s_suppkey").alias("ord"))
    return V.filers(of("s_suppkey").where("ord % 2 = 0"), of("s_nationkey"), columns=["filerIdent", "filerName", "filerTypeCd"])


@query()
def resolve_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """All stages of resolution over customers as organizations and suppliers as committees."""
    from tallyforge.operators.resolve import resolve

    null, day = F.lit(None).cast("string"), F.to_date(F.lit("2020-01-01"))

    def records(df: DataFrame, kind: str, key: str, name: Column, nation: str, filer: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("source_type"), F.col(key).alias("source_id"), F.lit(kind).alias("entity_type"), name.alias("organization"), *(null.alias(c) for c in ("first_name", "middle_name", "last_name", "suffix")), F.concat(F.col(key) % 50, F.lit(" Main St")).alias("street"), F.concat(F.lit("City "), F.col(nation)).alias("city"), F.lit("TX").alias("state"), F.format_string("%05d", F.col(nation) * 100 + 10000).alias("zip_code"), null.alias("employer"), filer.alias("filer_id"), *(day.alias(c) for c in ("created_at", "first_date", "last_date")))

    c = records(table(spark, sf, "customer"), "organization", "c_custkey", F.concat("c_mktsegment", F.lit(" Partners "), F.col("c_custkey") % 60), "c_nationkey", null)
    s = records(table(spark, sf, "supplier"), "committee", "s_suppkey", F.concat(F.lit("Friends of "), F.col("s_suppkey") % 30), "s_nationkey", (F.col("s_suppkey") % 80).cast("string"))
    return resolve(c.unionByName(s)).crosswalk
