"""Registered queries over the driver's tables, each with SQL for the same rows where SQL can express it.

Orders stand for transactions, customers for persons and donors, suppliers for committees, nations for states,
line items for contribution details, parts for organizations with repeated names, events for dated activity.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.functions import strings as S
from tallyforge.operators import dedup as D
from tallyforge.operators import families as P
from tallyforge.operators import gold as G
from tallyforge.operators import matching as M
from tallyforge.operators import publishing as U
from tallyforge.operators import validate as V
from tallyforge.operators.components import connected_components
from tallyforge.plans import analytics as A
from tallyforge.sources import files as IO

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tx(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("tx_id"), F.col("o_totalprice").cast("decimal(15,2)").alias("amount"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderstatus").alias("type"), F.col("o_custkey").alias("entity_id"))


TX = "tx AS (SELECT o_orderkey AS tx_id, CAST(o_totalprice AS DECIMAL(15,2)) AS amount, CAST(o_orderdate AS DATE) AS date, o_orderstatus AS type, o_custkey AS entity_id FROM orders)"


def lines(spark: SparkSession, sf: str) -> DataFrame:
    amount = (F.col("l_extendedprice").cast("decimal(15,2)")).alias("amount")
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("tx_id"), "l_linenumber", F.col("l_suppkey").alias("entity_id"), F.col("l_partkey").alias("part_id"), amount, F.col("l_shipdate").cast("date").alias("date"))


LINES = "li AS (SELECT l_orderkey AS tx_id, l_linenumber, l_suppkey AS entity_id, l_partkey AS part_id, CAST(l_extendedprice AS DECIMAL(15,2)) AS amount, CAST(l_shipdate AS DATE) AS date FROM lineitem)"


def dbl(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# --- analytics -----------------------------------------------------------------------------------------------------


@query(f"WITH {TX} SELECT COALESCE(n_name, 'UNKNOWN') AS state, COUNT(*) AS n, CAST(COALESCE(SUM(amount) FILTER (WHERE amount <> 0), 0) AS DOUBLE) AS total FROM tx LEFT JOIN customer ON c_custkey = entity_id LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def summary_by_state(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    rows = tx(spark, sf).join(c, F.col("entity_id") == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    return dbl(A.summary(rows, "state"), "total")


@query(f"WITH {TX} SELECT COALESCE(type, 'UNKNOWN') AS type, COUNT(*) AS n, CAST(COALESCE(SUM(amount) FILTER (WHERE amount <> 0), 0) AS DOUBLE) AS total FROM tx GROUP BY 1")
def summary_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return dbl(A.summary(tx(spark, sf), "type"), "total")


@query(f"WITH {TX} SELECT CAST(COUNT(*) FILTER (WHERE amount <= 100) AS BIGINT) AS up_to_100, COUNT(*) FILTER (WHERE amount > 100 AND amount <= 1000) AS up_to_1000, COUNT(*) FILTER (WHERE amount > 1000 AND amount <= 10000) AS up_to_10000, COUNT(*) FILTER (WHERE amount > 10000) AS above_10000 FROM tx")
def amount_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return A.histogram(tx(spark, sf))


@query(f"WITH {TX} SELECT c_custkey AS id, c_name AS name, CAST(SUM(amount) AS DOUBLE) AS total, COUNT(*) AS n FROM tx JOIN customer ON c_custkey = entity_id GROUP BY 1, 2 HAVING c_name IS NOT NULL ORDER BY SUM(amount) DESC, 1 LIMIT 10")
def top_contributors(spark: SparkSession, sf: str) -> DataFrame:
    return dbl(A.top(table(spark, sf, "customer"), tx(spark, sf), "c_custkey", "entity_id", C.clean_str("c_name"), how="inner"), "total")


@query(f"WITH {LINES} SELECT s_suppkey AS id, s_name AS name, CAST(COALESCE(SUM(amount), 0) AS DOUBLE) AS total, COUNT(tx_id) AS n FROM supplier LEFT JOIN li ON s_suppkey = entity_id GROUP BY 1, 2 ORDER BY COALESCE(SUM(amount), 0) DESC, 1 LIMIT 10")
def top_committees(spark: SparkSession, sf: str) -> DataFrame:
    return dbl(A.top(table(spark, sf, "supplier"), lines(spark, sf), "s_suppkey", "entity_id", F.col("s_name")), "total")


@query(f"WITH {TX} SELECT tx_id, CAST(amount AS DOUBLE) AS amount FROM tx WHERE amount BETWEEN 1000 AND 25000")
def txn_filter_range(spark: SparkSession, sf: str) -> DataFrame:
    return dbl(tx(spark, sf).where(F.col("amount").between(1000, 25000)).select("tx_id", "amount"), "amount")


@query(f"WITH {TX} SELECT tx_id, CAST(date AS VARCHAR) AS date FROM tx WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'")
def txn_filter_date(spark: SparkSession, sf: str) -> DataFrame:
    return tx(spark, sf).where(F.col("date").between(F.to_date(F.lit("1996-01-01")), F.to_date(F.lit("1996-03-31")))).select("tx_id", F.col("date").cast("string").alias("date"))


@query(f"WITH {TX} SELECT tx_id, type FROM tx JOIN customer ON c_custkey = entity_id JOIN nation ON n_nationkey = c_nationkey WHERE lower(n_name) = 'nation_7' AND type = 'F'")
def txn_by_state(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").where(F.lower("n_name") == "nation_7")
    c = table(spark, sf, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey")
    return tx(spark, sf).where("type = 'F'").join(c, F.col("entity_id") == F.col("c_custkey")).select("tx_id", "type")


@query("SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%#00000%7' OR c_mktsegment ILIKE '%mach%'")
def search_ilike(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").where(F.col("c_name").ilike("%#00000%7") | F.col("c_mktsegment").ilike("%mach%")).select("c_custkey", "c_name")


@query(f"WITH {TX}, y AS (SELECT CAST(year(date) AS VARCHAR) AS year, type, amount FROM tx) SELECT year, CAST(SUM(CASE WHEN type = 'F' THEN amount ELSE 0 END) AS DOUBLE) AS F, CAST(SUM(CASE WHEN type = 'O' THEN amount ELSE 0 END) AS DOUBLE) AS O, CAST(SUM(CASE WHEN type = 'P' THEN amount ELSE 0 END) AS DOUBLE) AS P, CAST(SUM(amount) AS DOUBLE) AS Total FROM y GROUP BY 1 UNION ALL SELECT 'Total', CAST(SUM(CASE WHEN type = 'F' THEN amount ELSE 0 END) AS DOUBLE), CAST(SUM(CASE WHEN type = 'O' THEN amount ELSE 0 END) AS DOUBLE), CAST(SUM(CASE WHEN type = 'P' THEN amount ELSE 0 END) AS DOUBLE), CAST(SUM(amount) AS DOUBLE) FROM y")
def crosstab_by_year(spark: SparkSession, sf: str) -> DataFrame:
    rows = tx(spark, sf).withColumn("year", F.year("date").cast("string"))
    return dbl(A.crosstab(rows, "year", "type", "amount", ["F", "O", "P"]), "F", "O", "P", "Total")


@query(f"WITH {TX}, {LINES} , s AS (SELECT tx_id, SUM(amount) AS summed FROM li GROUP BY 1), r AS (SELECT tx.tx_id AS report_ident, CASE WHEN tx.tx_id % 11 = 0 THEN NULL WHEN tx.tx_id % 3 = 0 THEN COALESCE(s.summed, 0) + 0.5 ELSE tx.amount END AS declared, COALESCE(s.summed, 0) AS summed FROM tx LEFT JOIN s USING (tx_id)) SELECT report_ident, CAST(declared AS DOUBLE) AS declared, CAST(summed AS DOUBLE) AS summed, CASE WHEN declared IS NULL THEN 'skipped' WHEN abs(declared - summed) <= 1.0 THEN 'matched' ELSE 'mismatched' END AS outcome FROM r")
def report_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    li = lines(spark, sf).withColumnRenamed("tx_id", "report_ident")
    s = li.groupBy("report_ident").agg(F.sum("amount").alias("_s"))
    declared = F.when(F.col("report_ident") % 11 == 0, None).when(F.col("report_ident") % 3 == 0, F.coalesce("_s", F.lit(0).cast("decimal(25,2)")) + F.lit(0.5).cast("decimal(25,2)")).otherwise(F.col("amount"))
    r = tx(spark, sf).withColumnRenamed("tx_id", "report_ident").join(s, "report_ident", "left").select("report_ident", declared.alias("declared"))
    return dbl(A.reconcile(r, li), "declared", "summed").select("report_ident", "declared", "summed", "outcome")


@query(f"WITH {TX}, {LINES}, g AS (SELECT entity_id, COUNT(*) AS n_given, SUM(amount) AS given FROM tx GROUP BY 1), r AS (SELECT entity_id, COUNT(*) AS n_received, SUM(amount) AS received FROM li GROUP BY 1) SELECT entity_id, n_given, CAST(given AS DOUBLE) AS given, n_received, CAST(received AS DOUBLE) AS received, CAST(given + received AS DOUBLE) AS total_activity FROM g JOIN r USING (entity_id)")
def cross_role_entities(spark: SparkSession, sf: str) -> DataFrame:
    return dbl(A.cross_role(tx(spark, sf), lines(spark, sf)), "given", "received", "total_activity")


@query(f"WITH {TX} SELECT c_nationkey AS address_id, COUNT(DISTINCT entity_id) AS n_entities, COUNT(DISTINCT tx_id) AS n_transactions FROM tx JOIN customer ON c_custkey = entity_id GROUP BY 1")
def address_occupancy(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("address_id"))
    return A.occupancy(tx(spark, sf).join(c, F.col("entity_id") == c.c_custkey).withColumnRenamed("tx_id", "transaction_id"))


HISTORY = "h AS (SELECT user_id AS entity_id, event_type AS name, CAST(min(ts) AS DATE) AS first_seen, CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(max(ts) AS DATE) END AS last_seen, COUNT(*) AS occurrences FROM events GROUP BY user_id, event_type)"
EVENTS = "e AS (SELECT event_id AS tx_id, user_id AS entity_id, CAST(ts AS DATE) AS date FROM events)"


def _history(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    last = F.when(F.col("user_id") % 5 != 0, F.max("ts").cast("date"))
    return e.groupBy("user_id", "event_type").agg(F.min("ts").cast("date").alias("first_seen"), last.alias("last_seen"), F.count("*").alias("occurrences")).withColumnsRenamed({"user_id": "entity_id", "event_type": "name"})


@query(f"WITH {HISTORY}, {EVENTS} SELECT tx_id, (SELECT name FROM h WHERE h.entity_id = e.entity_id AND (first_seen IS NULL OR first_seen <= e.date) AND (last_seen IS NULL OR last_seen >= e.date) ORDER BY occurrences DESC, name LIMIT 1) AS name_as_of FROM e")
def name_as_of(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.col("event_id").alias("tx_id"), F.col("user_id").alias("entity_id"), F.col("ts").cast("date").alias("date"))
    return A.name_as_of(e, _history(spark, sf)).select("tx_id", "name_as_of")


@query(f"WITH {HISTORY} SELECT entity_id, name, CAST(first_seen AS VARCHAR) AS first_seen, CAST(last_seen AS VARCHAR) AS last_seen, occurrences FROM h")
def name_history(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf).select("entity_id", "name", F.col("first_seen").cast("string").alias("first_seen"), F.col("last_seen").cast("string").alias("last_seen"), "occurrences")


@query(f"WITH {TX}, w AS (SELECT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + INTERVAL 90 DAY AS stop, o_orderkey AS officer FROM orders WHERE o_orderkey % 4 = 0) SELECT tx_id, (SELECT officer FROM w WHERE w.entity_id = tx.entity_id AND start <= date AND (stop IS NULL OR stop >= date) ORDER BY start DESC, officer LIMIT 1) AS officer FROM tx")
def interval_treasurer(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf)
    w = t.where("tx_id % 4 = 0").select("entity_id", F.col("date").alias("start"), F.date_add("date", 90).alias("stop"), F.col("tx_id").alias("officer"))
    return A.interval_pick(t, w, "entity_id", "date", "officer", "tx_id").select("tx_id", "officer")


@query(f"WITH {TX} SELECT entity_id, CAST(MIN(date) AS VARCHAR) AS first_date, CAST(MAX(date) AS VARCHAR) AS last_date, COUNT(*) AS n FROM tx GROUP BY 1")
def activity_windows(spark: SparkSession, sf: str) -> DataFrame:
    return tx(spark, sf).groupBy("entity_id").agg(F.min("date").cast("string").alias("first_date"), F.max("date").cast("string").alias("last_date"), F.count("*").alias("n"))


@query(f"WITH {TX} SELECT entity_id, date_part('year', date) * 0 + tx_id AS tx_id, CAST(SUM(amount) OVER (PARTITION BY entity_id ORDER BY tx_id) AS DOUBLE) AS running FROM tx")
def waterfall_running_total(spark: SparkSession, sf: str) -> DataFrame:
    return dbl(A.waterfall(tx(spark, sf), "entity_id", "tx_id", "amount"), "running").select("entity_id", "tx_id", "running")


@query(f"WITH {LINES} SELECT entity_id, CAST(SUM(CASE WHEN l_linenumber = 1 THEN amount ELSE 0 END) AS DOUBLE) AS lead, CAST(SUM(CASE WHEN l_linenumber > 1 THEN amount ELSE 0 END) AS DOUBLE) AS other, COUNT(DISTINCT tx_id) AS n_tx FROM li GROUP BY 1")
def officer_summary(spark: SparkSession, sf: str) -> DataFrame:
    lead = F.col("l_linenumber") == 1
    zero = F.lit(0).cast("decimal(15,2)")
    return dbl(lines(spark, sf).groupBy("entity_id").agg(F.sum(F.when(lead, F.col("amount")).otherwise(zero)).alias("lead"), F.sum(F.when(~lead, F.col("amount")).otherwise(zero)).alias("other"), F.countDistinct("tx_id").alias("n_tx")), "lead", "other")


# --- scalar functions over dirty text -------------------------------------------------------------------------------

AMOUNTS = "CASE o_orderkey % 14 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN ' $1,234.50 ' WHEN 4 THEN '1e5' WHEN 5 THEN '(100)' WHEN 6 THEN 'Prime Rate' WHEN 7 THEN '.' WHEN 8 THEN '-.' WHEN 9 THEN '-7.25' WHEN 10 THEN '.5' WHEN 11 THEN '12.' ELSE CAST(o_totalprice AS DECIMAL(15,2)) || '' END"
DATES = "CASE o_orderkey % 12 WHEN 0 THEN NULL WHEN 1 THEN '20010229' WHEN 2 THEN '00041110' WHEN 3 THEN '7/2/2012' WHEN 4 THEN '2012-07-02T00:00:00' WHEN 5 THEN '12-31-1999' WHEN 6 THEN '1999/2/3' WHEN 7 THEN 'soon' WHEN 8 THEN '07/02/2012 10:11:12' WHEN 9 THEN '2001-02-29' ELSE replace(CAST(o_orderdate AS DATE) || '', '-', '') END"
NAMES = "CASE p_partkey % 12 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'AT&T ' || p_name || ', Inc.' WHEN 3 THEN 'A & B ' || p_name || ' L.L.C.' WHEN 4 THEN 'O''Brien, ' || p_name || ' Jr.' WHEN 5 THEN p_name || ' Co and Company' WHEN 6 THEN ' The ' || p_name || '  (PAC)' ELSE p_name || ' Corporation' END"


def _dirty(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.expr(AMOUNTS).alias("raw"), F.expr(DATES).alias("day"))


def _named(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.expr(NAMES).alias("raw"))


DIRTY = f"d AS (SELECT o_orderkey AS id, {AMOUNTS} AS raw, {DATES} AS day FROM orders)"
NAMED = f"d AS (SELECT p_partkey AS id, {NAMES} AS raw FROM part)"
STRIP = r"regexp_replace(raw, '^\s+|\s+$', '', 'g')"
DAY = r"regexp_replace(day, '^\s+|\s+$', '', 'g')"


@query(f"WITH {DIRTY} SELECT id, NULLIF({STRIP}, '') AS v FROM d")
def clean_str(spark: SparkSession, sf: str) -> DataFrame:
    return _dirty(spark, sf).select("id", C.clean_str("raw").alias("v"))


@query(rf"WITH {DIRTY}, s AS (SELECT id, regexp_replace({STRIP}, '[,$]', '', 'g') AS s FROM d) SELECT id, CASE WHEN regexp_matches(s, '^-?[0-9]+(\.[0-9]*)?$|^-?\.[0-9]+$') THEN CAST(TRY_CAST(s AS DECIMAL(38,4)) AS DOUBLE) END AS v FROM s")
def tec_amount(spark: SparkSession, sf: str) -> DataFrame:
    return dbl(_dirty(spark, sf).select("id", C.tec_amount("raw").alias("v")), "v")


@query(rf"WITH {DIRTY}, s AS (SELECT id, regexp_replace(raw, '[^0-9.\-]', '', 'g') AS s FROM d) SELECT id, CASE WHEN s NOT IN ('', '.', '-', '-.') THEN CAST(TRY_CAST(s AS DECIMAL(38,4)) AS DOUBLE) END AS v FROM s")
def builder_amount(spark: SparkSession, sf: str) -> DataFrame:
    return dbl(_dirty(spark, sf).select("id", C.builder_amount("raw").alias("v")), "v")


_TEC = rf"CASE WHEN regexp_matches(s, '^[0-9]{{8}}$') THEN CAST(try_strptime(s, '%Y%m%d') AS DATE) ELSE COALESCE(CASE WHEN regexp_matches(s, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') THEN CAST(try_strptime(s, '%Y-%m-%d') AS DATE) END, CASE WHEN regexp_matches(s, '^[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}$') THEN CAST(try_strptime(s, '%Y/%m/%d') AS DATE) END, CASE WHEN regexp_matches(s, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$') THEN CAST(try_strptime(s, '%m/%d/%Y') AS DATE) END, CASE WHEN regexp_matches(s, '^[0-9]{{1,2}}-[0-9]{{1,2}}-[0-9]{{4}}$') THEN CAST(try_strptime(s, '%m-%d-%Y') AS DATE) END) END"


@query(f"WITH {DIRTY}, s AS (SELECT id, {DAY} AS s FROM d) SELECT id, CAST({_TEC} AS VARCHAR) AS v FROM s")
def tec_date(spark: SparkSession, sf: str) -> DataFrame:
    return _dirty(spark, sf).select("id", C.tec_date("day").cast("string").alias("v"))


@query(f"WITH {DIRTY}, s AS (SELECT id, {DAY} AS s FROM d), p AS (SELECT id, COALESCE({_TEC}, CAST(try_strptime(s, '%m/%d/%Y %H:%M:%S') AS DATE), CAST(try_strptime(s, '%Y-%m-%dT%H:%M:%S') AS DATE)) AS v FROM s) SELECT id, CASE WHEN year(v) BETWEEN 1900 AND 2100 THEN CAST(v AS VARCHAR) END AS v FROM p")
def builder_date(spark: SparkSession, sf: str) -> DataFrame:
    return _dirty(spark, sf).select("id", C.builder_date("day").cast("string").alias("v"))


@query(r"SELECT event_id AS id, COALESCE(lower(CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN ' Yes ' WHEN 2 THEN 'T' WHEN 3 THEN '1' WHEN 4 THEN 'N' WHEN 5 THEN 'true' ELSE event_type END) IN ('true', 'yes', 'y', '1', 't', ' yes '), FALSE) AS v FROM events")
def bool_expr(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN ' Yes ' WHEN 2 THEN 'T' WHEN 3 THEN '1' WHEN 4 THEN 'N' WHEN 5 THEN 'true' ELSE event_type END")
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), C.bool_expr(raw).alias("v"))


@query(rf"WITH {NAMED} SELECT id, COALESCE(trim(regexp_replace(lower({STRIP}), '[^a-z0-9]+', ' ', 'g')), '') AS v FROM d")
def normalize_entity_name(spark: SparkSession, sf: str) -> DataFrame:
    return _named(spark, sf).select("id", C.normalize_entity_name("raw").alias("v"))


@query(rf"WITH {NAMED}, a AS (SELECT id, regexp_replace(lower({STRIP}), '\b(and|&)\b', ' and ', 'g') AS s FROM d), b AS (SELECT id, regexp_replace(s, '\b(llc|l\.l\.c|inc|incorporated|corp|corporation|co|company|lp|l\.p|llp|l\.l\.p|pllc|p\.l\.l\.c)\b', ' ', 'g') AS s FROM a), c AS (SELECT id, regexp_replace(s, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g') AS s FROM b) SELECT id, COALESCE(trim(regexp_replace(s, '\s+', ' ', 'g')), '') AS v FROM c")
def normalize_org_name(spark: SparkSession, sf: str) -> DataFrame:
    return _named(spark, sf).select("id", C.normalize_org_name("raw").alias("v"))


PEOPLE = "p AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment || ' LLC' END AS org, CASE WHEN c_custkey % 3 > 0 THEN 'Ann' || (c_custkey % 50) END AS first, CASE WHEN c_custkey % 7 > 0 THEN ' ' || c_mktsegment || ' ' ELSE '' END AS last, CASE WHEN c_custkey % 5 = 0 THEN 'Jr' END AS suffix, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 100) || ' Main St' END AS street, CASE WHEN c_custkey % 3 = 0 THEN 'Austin' END AS city, CASE WHEN c_custkey % 6 > 1 THEN 'TX' END AS state, CASE WHEN c_custkey % 10 > 2 THEN '787' || (10 + c_nationkey) END AS zip, c_nationkey AS nation FROM customer)"


def _people(spark: SparkSession, sf: str) -> DataFrame:
    inner = PEOPLE.split("(SELECT ", 1)[1].rsplit(" FROM customer)", 1)[0]
    return table(spark, sf, "customer").selectExpr(*_split(inner))


def _split(text: str) -> list[str]:
    """The expressions of a select list: commas outside brackets and quotes part them."""
    out, depth, quoted, now = [], 0, False, ""
    for c in text:
        quoted ^= c == "'"
        depth += (c == "(") - (c == ")") if not quoted else 0
        if c == "," and not depth and not quoted:
            out.append(now)
            now = ""
        else:
            now += c
    return [*out, now]


@query(f"WITH {PEOPLE} SELECT id, COALESCE(org, concat_ws(' ', first, NULLIF(trim(last), ''), suffix)) AS v FROM p")
def full_name(spark: SparkSession, sf: str) -> DataFrame:
    return _people(spark, sf).select("id", C.full_name("first", F.lit(None), "last", "suffix", "org").alias("v"))


@query(f"WITH {PEOPLE} SELECT id, CASE WHEN (street IS NOT NULL)::INT + (city IS NOT NULL)::INT + (state IS NOT NULL)::INT + (zip IS NOT NULL)::INT >= 2 THEN concat_ws('|', COALESCE(lower(street), ''), COALESCE(lower(city), ''), COALESCE(lower(state), ''), COALESCE(zip, '')) END AS v FROM p")
def addr_key(spark: SparkSession, sf: str) -> DataFrame:
    return _people(spark, sf).select("id", C.person_addr_key("street", "city", "state", "zip").alias("v"))


@query(f"WITH {PEOPLE} SELECT id, CASE WHEN org IS NOT NULL AND upper(org) = 'BUILDING LLC' THEN 'UNKNOWN' WHEN org IS NOT NULL THEN 'ORGANIZATION' WHEN first IS NOT NULL AND NULLIF(trim(last), '') IS NOT NULL THEN 'INDIVIDUAL' ELSE 'UNKNOWN' END AS v FROM p")
def person_type(spark: SparkSession, sf: str) -> DataFrame:
    return _people(spark, sf).select("id", C.person_type("org", "first", "last", ["BUILDING LLC"]).alias("v"))


@query("WITH z AS (SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '78701-1234' WHEN 2 THEN ' 2139' WHEN 3 THEN '787' ELSE (78000 + c_nationkey) || '' END AS raw FROM customer), d AS (SELECT id, regexp_replace(raw, '[^0-9]', '', 'g') AS d FROM z) SELECT id, CASE length(d) WHEN 4 THEN '0' || d WHEN 5 THEN d WHEN 9 THEN substr(d, 1, 5) || '-' || substr(d, 6, 4) END AS v FROM d")
def zip_format(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '78701-1234' WHEN 2 THEN ' 2139' WHEN 3 THEN '787' ELSE (78000 + c_nationkey) || '' END")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), C.zip_format(raw).alias("v"))


@query("SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN 'LOAN' WHEN 1 THEN 'CONTRIBUTION' WHEN 2 THEN 'EXPENDITURE' WHEN 3 THEN 'TRAVEL' WHEN 4 THEN 'PLEDGE' ELSE 'OTHER' END AS v FROM orders")
def tx_type_infer(spark: SparkSession, sf: str) -> DataFrame:
    said = F.expr("CASE o_orderkey % 6 WHEN 0 THEN 'a loan' WHEN 1 THEN ' Donation' WHEN 2 THEN 'payment' END")
    kind = F.expr("CASE o_orderkey % 6 WHEN 3 THEN 'TRVL' WHEN 4 THEN 'pldg' ELSE 'XX' END")
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), C.transaction_type(said, kind).alias("v"))


@query(f"WITH {PEOPLE} SELECT id, md5(concat_ws('-', COALESCE(org, '_dbt_utils_surrogate_key_null_'), COALESCE(first, '_dbt_utils_surrogate_key_null_'))) AS sk, substr(sha256(concat_ws('_', id || '', state)), 1, 16) AS st, sha256('TX:' || id) AS fo FROM p")
def hashed_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _people(spark, sf).select("id", C.surrogate_key("org", "first").alias("sk"), C.static_key("id", "state").alias("st"), C.file_origin_key(F.lit("TX"), F.col("id").cast("string")).alias("fo"))


@query(f"WITH {NAMED}, w AS (SELECT id, lower(COALESCE(split_part(raw, ' ', 1), '')) AS a, lower(COALESCE(split_part(raw, ' ', 2), '')) AS b FROM d) SELECT id, length(a) >= 2 AND length(b) >= 2 AND NOT starts_with(a, b) AND NOT starts_with(b, a) AND substr(a, 1, 1) <> substr(b, 1, 1) AS v FROM w")
def name_conflict(spark: SparkSession, sf: str) -> DataFrame:
    w = F.split(F.col("raw"), " ")
    return _named(spark, sf).select("id", C.first_name_conflict(F.get(w, F.lit(0)), F.get(w, F.lit(1))).alias("v"))


@query("SELECT event_id AS id, '{\"a\":\"' || event_type || '\",\"k\":\"' || json_extract_string(props, '$.k') || '\"}' AS v FROM events")
def json_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), C.json_sorted(F.concat(F.lit('{"k":"'), F.get_json_object("props", "$.k"), F.lit('","a":"'), F.col("event_type"), F.lit('"}'))).alias("v"))


PAIRS = "SELECT a.p_partkey AS a, b.p_partkey AS b, a.p_name AS x, b.p_name AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1"


def _neighbours(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("a"), F.col("p_name").alias("x")).join(p.select(F.col("p_partkey").alias("b"), F.col("p_name").alias("y")), F.col("b") == F.col("a") + 1)


@query(f"SELECT a, b, round(jaro_winkler_similarity(x, y), 9) AS v FROM ({PAIRS})")
def jaro_winkler(spark: SparkSession, sf: str) -> DataFrame:
    return _neighbours(spark, sf).select("a", "b", F.round(S.jaro_winkler_udf("x", "y"), 9).alias("v"))


@query()
def metaphone(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", S.metaphone_udf("p_name").alias("code"))


@query()
def parse_name(spark: SparkSession, sf: str) -> DataFrame:
    return _named(spark, sf).select("id", S.parse_name_udf("raw").alias("n")).select("id", "n.*")


@query()
def parse_address(spark: SparkSession, sf: str) -> DataFrame:
    return _people(spark, sf).select("id", S.parse_address_udf(C.one_line_address("street", "city", F.concat_ws(" ", "state", "zip"))).alias("n")).select("id", "n.*")


@query()
def html_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", S.fingerprint_udf("html").alias("fingerprint"))


@query()
def record_ids(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat_ws("_", "c_custkey", "c_name")
    return table(spark, sf, "customer").select("c_custkey", S.record_id_udf(raw).alias("record_id"), S.blake_key_udf(raw).alias("blake_key"))


# --- dedup, upserts, registries -------------------------------------------------------------------------------------


@query(f"WITH {LINES} SELECT tx_id, part_id, CAST(amount AS DOUBLE) AS amount FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY tx_id ORDER BY l_linenumber, part_id, amount, entity_id) AS rn FROM li) WHERE rn = 1")
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return dbl(D.keep_first(lines(spark, sf), ["tx_id"], ["l_linenumber", "part_id", "amount", "entity_id"]).select("tx_id", "part_id", "amount"), "amount")


@query(f"WITH {LINES}, m AS (SELECT p_partkey, MIN(p_partkey) OVER (PARTITION BY p_name) AS s FROM part) SELECT COALESCE(m.s, li.part_id) AS part_id, COUNT(*) AS n FROM li LEFT JOIN m ON m.p_partkey = li.part_id GROUP BY 1")
def dedup_survivor_repoint(spark: SparkSession, sf: str) -> DataFrame:
    m = D.survivors(table(spark, sf, "part"), ["p_name"], "p_partkey")
    return D.repoint(lines(spark, sf), "part_id", m, "p_partkey").groupBy("part_id").agg(F.count("*").alias("n"))


NEW = "old AS (SELECT CASE WHEN p_partkey % 5 > 0 THEN upper(p_name) END AS name, p_brand AS brand FROM part WHERE p_partkey % 2 = 0), b AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 > 0 THEN p_name END AS name, p_brand AS brand FROM part WHERE p_partkey % 2 = 1)"


def _old_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf, "part")
    old = p.where("p_partkey % 2 = 0").selectExpr("CASE WHEN p_partkey % 5 > 0 THEN upper(p_name) END AS name", "p_brand AS brand")
    return old, p.where("p_partkey % 2 = 1").selectExpr("p_partkey AS id", "CASE WHEN p_partkey % 7 > 0 THEN p_name END AS name", "p_brand AS brand")


@query(f"WITH {NEW}, f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lower(name), brand ORDER BY id) AS rn FROM b) SELECT id, name, brand FROM f WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM old WHERE lower(old.name) IS NOT DISTINCT FROM lower(f.name) AND old.brand IS NOT DISTINCT FROM f.brand)")
def filter_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_new(spark, sf)
    return D.filter_new_rows(new, old, ["name", "brand"], ["id"], lower=["name"])


@query(f"WITH {NEW}, f AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY lower(name), brand ORDER BY id) AS rn FROM b) SELECT id, name, brand FROM f WHERE (rn = 1 OR name IS NULL OR brand IS NULL) AND NOT EXISTS (SELECT 1 FROM old WHERE lower(old.name) = lower(f.name) AND old.brand = f.brand)")
def filter_new_rows_strict(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _old_new(spark, sf)
    return D.filter_new_rows(new, old, ["name", "brand"], ["id"], lower=["name"], join_nulls=False)


@query("WITH o AS (SELECT o_custkey AS k, MIN(o_orderkey) AS v FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1), i AS (SELECT o_custkey AS k, MIN(o_orderkey) AS v FROM orders WHERE o_orderkey % 3 = 1 GROUP BY 1) SELECT k, v FROM o UNION ALL SELECT k, v FROM i WHERE k NOT IN (SELECT k FROM o)")
def upsert_do_nothing(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    old = o.where("v % 3 = 0").groupBy("k").agg(F.min("v").alias("v"))
    return D.upsert_do_nothing(old, o.where("v % 3 = 1"), ["k"], ["v"])


@query("WITH o AS (SELECT o_custkey AS k, MIN(o_orderkey) AS v FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1), i AS (SELECT o_custkey AS k, MAX(o_orderkey) AS v FROM orders WHERE o_orderkey % 3 = 1 GROUP BY 1) SELECT COALESCE(i.k, o.k) AS k, COALESCE(i.v, o.v) AS v, COALESCE(o.v, i.v) AS created_at FROM o FULL JOIN i ON i.k = o.k")
def upsert_do_update(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), F.col("o_orderkey").alias("created_at"))
    old = o.where("v % 3 = 0").groupBy("k").agg(F.min("v").alias("v"), F.min("v").alias("created_at"))
    return D.upsert_do_update(old, o.where("v % 3 = 1"), ["k"], ["v"])


@query("WITH r AS (SELECT p_name || '/' || p_brand AS nk, MIN(p_partkey) AS id FROM part WHERE p_partkey % 4 = 0 GROUP BY 1), n AS (SELECT DISTINCT p_name || '/' || p_brand AS nk FROM part WHERE p_name || '/' || p_brand NOT IN (SELECT nk FROM r)) SELECT nk, id FROM r UNION ALL SELECT nk, (SELECT MAX(id) FROM r) + ROW_NUMBER() OVER (ORDER BY nk) FROM n")
def surrogate_registry(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").withColumn("nk", F.concat_ws("/", "p_name", "p_brand"))
    known = p.where("p_partkey % 4 = 0").groupBy("nk").agg(F.min("p_partkey").alias("id"))
    return D.register_keys(known, p, "nk")


@query("SELECT user_id, CAST(min(event_id) FILTER (WHERE value > 50) AS BIGINT) AS first_large, arg_min(event_type, event_id) FILTER (WHERE event_type <> 'view') AS first_action FROM events GROUP BY 1")
def backfill_first_non_null(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.groupBy("user_id").agg(F.min(F.when(F.col("value") > 50, F.col("event_id"))).alias("first_large"), F.min_by("event_type", F.when(F.col("event_type") != "view", F.col("event_id"))).alias("first_action"))


@query("SELECT user_id, arg_max(NULLIF(event_type, 'view'), event_id) FILTER (WHERE event_type <> 'view') AS kind, arg_min(props, event_id) FILTER (WHERE value > 20) AS props FROM events GROUP BY 1")
def collapse_committee(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumn("kind", F.nullif("event_type", F.lit("view")))
    return P.collapse_committees(e, "user_id", "event_id", ["kind"], ["props"], F.col("value") > 20)


@query("SELECT p_name AS anchor, p_brand AS brand, a, b FROM (SELECT p_name, p_brand, MIN(p_partkey) OVER (PARTITION BY p_name, p_brand) AS a, p_partkey AS b FROM part) WHERE a <> b")
def star_edges(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    e = D.star_edges(p, ["p_name", "p_brand"], "p_partkey")
    return e.join(p.select(F.col("p_partkey").alias("b"), F.col("p_name").alias("anchor"), F.col("p_brand").alias("brand")), "b").select("anchor", "brand", "a", "b")


@query("SELECT CAST(COUNT(*) FILTER (WHERE k) AS BIGINT) AS known, CAST(COUNT(*) FILTER (WHERE NOT k) AS BIGINT) AS orphans FROM (SELECT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F') AS k FROM lineitem)")
def orphan_split(spark: SparkSession, sf: str) -> DataFrame:
    known, orphans = D.split_known(table(spark, sf, "lineitem").select("l_orderkey"), table(spark, sf, "orders").where("o_orderstatus = 'F'"), "l_orderkey", "o_orderkey")
    return known.agg(F.count("*").alias("known")).crossJoin(orphans.agg(F.count("*").alias("orphans")))


@query("SELECT COUNT(*) AS total, COUNT(DISTINCT (l_orderkey, l_partkey)) AS distinct_keys, (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1)) AS dup_groups FROM lineitem")
def duplicate_check(spark: SparkSession, sf: str) -> DataFrame:
    by = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").count()
    return by.agg(F.sum("count").alias("total"), F.count("*").alias("distinct_keys"), F.sum((F.col("count") > 1).cast("long")).alias("dup_groups"))


@query("WITH a AS (SELECT p_name, p_brand FROM part WHERE p_partkey % 3 > 0), b AS (SELECT p_name, p_brand FROM part WHERE p_partkey % 3 < 2) SELECT *, 'a' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'b' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    return D.snapshot_diff(p.where("p_partkey % 3 > 0"), p.where("p_partkey % 3 < 2"), ["p_partkey"])


@query("SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS version_number, '{\"event_type\":\"' || event_type || '\"}' AS data FROM events")
def version_history(spark: SparkSession, sf: str) -> DataFrame:
    return D.versions(table(spark, sf, "events"), "user_id", "event_id", ["event_type"]).withColumn("version_number", F.col("version_number").cast("long"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, NULL AS segment FROM supplier UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name, c_mktsegment FROM customer")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return D.union_by_name(s, c)


# --- record families and validation ---------------------------------------------------------------------------------

SOURCE = f"src AS (SELECT o_orderkey || '' AS contributionInfoId, {AMOUNTS} AS contributionAmount, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {DATES} END AS contributionDt, replace(CAST(o_orderdate AS DATE) || '', '-', '') AS receivedDt, ' ' || (o_custkey % 40) AS filerIdent, 'filer ' || (o_custkey % 40) AS filerName, CASE WHEN o_orderkey % 3 = 0 THEN 'ENTITY' WHEN o_orderkey % 17 = 0 THEN 'x' ELSE 'INDIVIDUAL' END AS contributorPersentTypeCd, CASE WHEN o_orderkey % 6 = 0 THEN 'Org ' || (o_custkey % 30) END AS contributorNameOrganization, CASE WHEN o_orderkey % 3 > 0 THEN 'Last' || (o_custkey % 25) END AS contributorNameLast, CASE WHEN o_orderkey % 4 > 0 THEN 'First' || (o_custkey % 9) END AS contributorNameFirst, CASE WHEN o_orderkey % 8 = 1 THEN 'Works ' || o_orderkey END AS contributorEmployer, 'Austin' AS contributorStreetCity, 'TX' AS contributorStreetStateCd, o_orderkey AS ord FROM orders)"


def _source(spark: SparkSession, sf: str) -> DataFrame:
    inner = SOURCE.split("(SELECT ", 1)[1].rsplit(" FROM orders)", 1)[0]
    return table(spark, sf, "orders").selectExpr(*_split(inner))


@query(rf"WITH {SOURCE}, s AS (SELECT *, regexp_replace(contributionAmount, '[^0-9.\-]', '', 'g') AS a FROM src), d AS (SELECT *, contributionDt AS s FROM s), e AS (SELECT *, COALESCE({_TEC}, CAST(try_strptime(s, '%m/%d/%Y %H:%M:%S') AS DATE), CAST(try_strptime(s, '%Y-%m-%dT%H:%M:%S') AS DATE)) AS v FROM d) SELECT contributionInfoId AS transaction_id, CASE WHEN a NOT IN ('', '.', '-', '-.') THEN CAST(CAST(TRY_CAST(a AS DECIMAL(38,4)) AS DECIMAL(15,2)) AS DOUBLE) END AS amount, CAST(CASE WHEN year(v) BETWEEN 1900 AND 2100 THEN v ELSE CAST(strptime(receivedDt, '%Y%m%d') AS DATE) END AS VARCHAR) AS transaction_date, trim(filerIdent) AS committee_id FROM e")
def transactions_family(spark: SparkSession, sf: str) -> DataFrame:
    out = P.transactions(_source(spark, sf), "RCPT", 44)
    return dbl(out, "amount").select("transaction_id", "amount", F.col("transaction_date").cast("string").alias("transaction_date"), "committee_id")


@query(f"WITH {SOURCE}, p AS (SELECT *, CASE WHEN contributorNameOrganization IS NULL THEN lower(contributorNameFirst) END AS f, CASE WHEN contributorNameOrganization IS NULL THEN lower(contributorNameLast) END AS l, lower(contributorNameOrganization) AS g FROM src WHERE COALESCE(contributorNameOrganization, contributorNameLast, contributorNameFirst) IS NOT NULL) SELECT COALESCE(arg_min(contributorNameOrganization, ord) FILTER (WHERE g IS NOT NULL), '') AS organization, COALESCE(f, '') AS first_name, COALESCE(l, '') AS last_name, arg_min(contributorEmployer, ord) FILTER (WHERE contributorEmployer IS NOT NULL) AS employer, CAST(MIN(ord) AS BIGINT) AS ord FROM p GROUP BY g, f, l")
def persons_family(spark: SparkSession, sf: str) -> DataFrame:
    people = P.persons(P.parties(_source(spark, sf), "RCPT", "ord"))
    blank = lambda c: F.coalesce(F.when(F.col("organization").isNull(), F.lower(c)), F.lit(""))
    return people.select(F.coalesce("organization", F.lit("")).alias("organization"), blank("first_name").alias("first_name"), blank("last_name").alias("last_name"), "employer", "ord")


@query(f"WITH {SOURCE} SELECT e AS error, COUNT(*) AS n FROM (SELECT unnest([CASE WHEN contributorPersentTypeCd NOT IN ('INDIVIDUAL', 'ENTITY') THEN 'type:contributorPersentTypeCd' END, CASE WHEN contributorPersentTypeCd = 'INDIVIDUAL' AND contributorNameLast IS NULL THEN 'missing:contributorNameLast' END, CASE WHEN contributorPersentTypeCd = 'ENTITY' AND contributorNameOrganization IS NULL THEN 'missing:contributorNameOrganization' END, CASE WHEN contributionDt IS NOT NULL AND (NOT regexp_matches(contributionDt, '^[0-9]{{8}}$') OR try_strptime(contributionDt, '%Y%m%d') IS NULL) THEN 'date:contributionDt' END]) AS e FROM src) WHERE e IS NOT NULL GROUP BY 1")
def validate_errors(spark: SparkSession, sf: str) -> DataFrame:
    found = V.errors(_source(spark, sf), V.rules_for("RCPT"))
    return found.groupBy(F.concat_ws(":", "type", "column").alias("error")).agg(F.count("*").alias("n"))


@query("SELECT COALESCE(o_orderpriority, 'Total') AS o_orderpriority, CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS F, COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS O, COUNT(*) AS Total FROM orders GROUP BY ROLLUP (o_orderpriority)")
def error_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return V.cross_tab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O"])


@query("SELECT o_orderkey || '' AS parent_id, CAST(i AS INT) AS position, 'G' || (o_custkey + i) AS last_name FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS i) WHERE o_orderkey % (i + 1) = 0")
def guarantor_explode(spark: SparkSession, sf: str) -> DataFrame:
    cols = [F.expr(f"CASE WHEN o_orderkey % {i + 1} = 0 THEN 'G' || (o_custkey + {i}) END").alias(f"guarantorNameLast{i}") for i in range(1, 6)]
    src = table(spark, sf, "orders").select(F.expr("o_orderkey || ''").alias("loanInfoId"), *cols)
    return P.guarantors(src, "loanInfoId").select("parent_id", "position", "last_name")


@query("SELECT s_suppkey || '' AS filer_id, 'TREASURER' AS role, 'T' || s_nationkey AS last_name FROM supplier UNION ALL SELECT s_suppkey || '', 'CHAIR', 'C' || s_nationkey FROM supplier WHERE s_suppkey % 3 = 0")
def officer_unfold(spark: SparkSession, sf: str) -> DataFrame:
    src = table(spark, sf, "supplier").selectExpr("s_suppkey || '' AS filerIdent", "'T' || s_nationkey AS treasNameLast", "CASE WHEN s_suppkey % 3 = 0 THEN 'C' || s_nationkey END AS chairNameLast")
    return P.officers(src, {"treas": "TREASURER", "chair": "CHAIR", "assttreas": "ASSISTANT_TREASURER"}).select("filer_id", "role", "last_name")


@query("WITH t AS (SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS d, o_custkey % 40 AS committee_id, 'Campaign ' || (o_custkey % 7) AS name FROM orders) SELECT name, trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS normalized_name, committee_id, CAST(year(d) AS INT) AS election_year FROM t GROUP BY 1, 2, 3, 4")
def campaign_dedup(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "orders").selectExpr("o_orderkey AS transaction_id", "CAST(o_orderdate AS DATE) AS transaction_date", "o_custkey % 40 AS committee_id", "CAST(NULL AS STRING) AS campaign_name", "'Campaign ' || (o_custkey % 7) AS candidate_name", "'x' AS committee_name", "CAST(NULL AS STRING) AS office_src")
    return P.campaigns(t).select("name", "normalized_name", "committee_id", "election_year")


@query(f"WITH {PEOPLE}, a AS (SELECT lower(city) AS c, lower(state) AS s, zip AS z, arg_min(COALESCE(street, '!'), id) AS b FROM p WHERE city IS NOT NULL AND state IS NOT NULL AND zip IS NOT NULL GROUP BY 1, 2, 3) SELECT id, COALESCE(street, NULLIF(a.b, '!')) AS street FROM p LEFT JOIN a ON lower(city) = c AND lower(state) = s AND zip = z")
def partial_address_match(spark: SparkSession, sf: str) -> DataFrame:
    p = _people(spark, sf).withColumnRenamed("zip", "zip_code")
    known = p.withColumn("street", F.coalesce("street", F.lit("!")))
    best = P.enrich_partial_addresses(p, known)
    return best.select("id", F.nullif("street", F.lit("!")).alias("street"))


@query("SELECT CASE WHEN s IN ('contribs_01', 'cont_ss') THEN 'RCPT' WHEN s = 'cover_ss_2' THEN 'CVR1' WHEN s = 'expn_catg' THEN 'EXCAT' ELSE 'UNKNOWN' END AS record_type, COUNT(*) AS n FROM (SELECT CASE o_orderkey % 5 WHEN 0 THEN 'contribs_01' WHEN 1 THEN 'cont_ss' WHEN 2 THEN 'cover_ss_2' WHEN 3 THEN 'expn_catg' ELSE 'contribsx' END AS s FROM orders) GROUP BY 1")
def record_routing(spark: SparkSession, sf: str) -> DataFrame:
    s = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'contribs_01' WHEN 1 THEN 'cont_ss' WHEN 2 THEN 'cover_ss_2' WHEN 3 THEN 'expn_catg' ELSE 'contribsx' END")
    return table(spark, sf, "orders").groupBy(IO.record_type_column(s).alias("record_type")).agg(F.count("*").alias("n"))


@query("SELECT r AS record_type, CAST(COALESCE(n, 0) AS BIGINT) AS rows, CASE WHEN n IS NULL THEN 'missing' WHEN n = 0 THEN 'empty' ELSE 'present' END AS status FROM (SELECT unnest(['F', 'O', 'P', 'X']) AS r) LEFT JOIN (SELECT o_orderstatus AS t, COUNT(*) AS n FROM orders GROUP BY 1) ON t = r")
def coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("record_type")).agg(F.count("*").alias("rows"))
    return IO.coverage(counts, ("F", "O", "P", "X"))


@query(f"WITH {PEOPLE}, n AS (SELECT COUNT(*) AS n, COUNT(org) AS org, COUNT(NULLIF(trim(last), '')) AS last, COUNT(city) AS city, COUNT(suffix) AS suffix FROM p) SELECT c AS source_column, round(100.0 * k / n, 6) AS fill_pct, CASE c WHEN 'org' THEN 'MAPPED' WHEN 'last' THEN 'STRUCTURAL' WHEN 'city' THEN 'HANDLED' ELSE 'UNMAPPED_POPULATED' END AS status FROM (SELECT n, unnest(['org', 'last', 'city', 'suffix']) AS c, unnest([org, last, city, suffix]) AS k FROM n)")
def field_coverage(spark: SparkSession, sf: str) -> DataFrame:
    df = _people(spark, sf).select("org", "last", "city", "suffix")
    return IO.field_coverage(df, {"org": "organization"}, {"last"}, {"city"}).select("source_column", F.round("fill_pct", 6).alias("fill_pct"), "status")


# --- entity resolution ----------------------------------------------------------------------------------------------

KEYS = "k AS (SELECT p_partkey AS uid, 'name_brand' AS rule_name, lower(p_name) || '|' || lower(p_brand) AS block_key FROM part UNION ALL SELECT p_partkey, 'name_size', lower(p_name) || '|' || p_size FROM part)"


def _keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("uid"), F.lit("organization").alias("entity_type"), "p_name", "p_brand", F.col("p_size").cast("string").alias("p_size"))
    return M.keyed(rows, [M.Rule("name_brand", ("organization",), ("p_name", "p_brand")), M.Rule("name_size", ("organization",), ("p_name", "p_size"))])


@query(f"WITH {KEYS}, ok AS (SELECT rule_name, block_key FROM k GROUP BY 1, 2 HAVING COUNT(*) BETWEEN 2 AND 100) SELECT x.uid AS a, y.uid AS b, MIN(rule_name) AS rule_name FROM k x JOIN k y USING (rule_name, block_key) JOIN ok USING (rule_name, block_key) WHERE x.uid < y.uid GROUP BY 1, 2")
def blocking_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return M.candidate_pairs(_keys(spark, sf))


@query(f"WITH {KEYS} SELECT rule_name, block_key, COUNT(*) AS size FROM k GROUP BY 1, 2")
def block_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return M.block_sizes(_keys(spark, sf))


@query(f"WITH {KEYS} SELECT rule_name, block_key, COUNT(*) AS size FROM k GROUP BY 1, 2 HAVING COUNT(*) > 3")
def oversized_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return M.oversized(_keys(spark, sf), 3)


@query(f"WITH {KEYS}, p AS (SELECT DISTINCT x.uid AS a, y.uid AS b FROM k x JOIN k y USING (rule_name, block_key) WHERE x.uid < y.uid) SELECT a, b FROM p ORDER BY a, b LIMIT 500")
def pair_cap(spark: SparkSession, sf: str) -> DataFrame:
    return M.candidate_pairs(_keys(spark, sf), most=1 << 30).select("a", "b").orderBy("a", "b").limit(500)


COMPONENTS = "n AS (SELECT p_partkey AS id, p_name || p_brand AS x, p_name || (p_size % 40) || p_type AS y FROM part), e AS (SELECT a.id AS a, b.id AS b FROM n a JOIN n b ON a.x = b.x UNION SELECT a.id, b.id FROM n a JOIN n b ON a.y = b.y), r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b), c AS (SELECT a AS uid, MIN(b) AS root FROM r GROUP BY 1)"


def _part_edges(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").selectExpr("p_partkey AS uid", "p_name || p_brand AS x", "p_name || (p_size % 40) || p_type AS y")
    return D.star_edges(p, ["x"], "uid").union(D.star_edges(p, ["y"], "uid"))


@query(f"WITH RECURSIVE {COMPONENTS} SELECT uid, root FROM c")
def connected_components_(spark: SparkSession, sf: str) -> DataFrame:
    comp = connected_components(_part_edges(spark, sf), "a", "b")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("uid"))
    return p.join(comp, p.uid == comp.node, "left").select("uid", F.coalesce("component", "uid").alias("root"))


@query(f"WITH RECURSIVE {COMPONENTS}, s AS (SELECT root, COUNT(*) AS size, 'cluster_' || lpad(CAST(ROW_NUMBER() OVER (ORDER BY root) AS VARCHAR), 6, '0') AS cluster_id FROM c GROUP BY 1) SELECT uid, cluster_id, size, size > 20 AS held FROM c JOIN s USING (root)")
def mega_cluster_guard(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("uid"))
    return M.clusters(p, _part_edges(spark, sf), 20)


SCORED = "s AS (SELECT o_orderkey AS a, o_orderkey + 1 AS b, (o_custkey % 101) / 100.0 AS score, CASE WHEN o_orderkey % 3 = 0 THEN 'person' ELSE 'organization' END AS entity_type, CASE o_custkey % 4 WHEN 0 THEN 'Jon' WHEN 1 THEN 'J' WHEN 2 THEN 'mary' ELSE NULL END AS first_a, CASE o_custkey % 5 WHEN 0 THEN 'jonathan' WHEN 1 THEN 'Pete' ELSE 'M' END AS first_b FROM orders), d AS (SELECT o_orderkey + 1 AS a, o_orderkey AS b, CASE WHEN o_orderkey % 50 = 0 THEN 'approved' ELSE 'rejected' END AS status FROM orders WHERE o_orderkey % 25 = 0)"


@query(f"WITH {SCORED}, j AS (SELECT s.*, d.status, entity_type = 'person' AND length(COALESCE(first_a, '')) >= 2 AND length(COALESCE(first_b, '')) >= 2 AND NOT starts_with(lower(first_a), lower(first_b)) AND NOT starts_with(lower(first_b), lower(first_a)) AND lower(substr(first_a, 1, 1)) <> lower(substr(first_b, 1, 1)) AS c FROM s LEFT JOIN d ON least(d.a, d.b) = s.a AND greatest(d.a, d.b) = s.b) SELECT a, b, CASE WHEN status = 'rejected' THEN 'reject' WHEN status = 'approved' THEN 'auto' WHEN score >= 0.99 AND NOT c THEN 'auto' WHEN score >= 0.8 THEN 'review' ELSE 'reject' END AS band FROM j")
def classify_bands(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    s = o.selectExpr(*_split(SCORED.split("(SELECT ", 1)[1].split(" FROM orders)")[0]))
    d = o.where("o_orderkey % 25 = 0").selectExpr("o_orderkey + 1 AS a", "o_orderkey AS b", "CASE WHEN o_orderkey % 50 = 0 THEN 'approved' ELSE 'rejected' END AS status")
    return M.classify(s, d).select("a", "b", "band")


def _linkage(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, tuple[M.Comparison, ...]]:
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("uid"), F.col("p_name").alias("normalized_org"), F.col("p_brand").alias("line_1"), F.col("p_type").alias("city"), F.col("p_size").cast("string").alias("zip5"))
    return M.candidate_pairs(_keys(spark, sf)), rows, M.MODELS["organization"]


@query("WITH k AS (SELECT p_partkey AS uid, 'b' AS r, lower(p_name) || '|' || lower(p_brand) AS k FROM part UNION ALL SELECT p_partkey, 's', lower(p_name) || '|' || p_size FROM part), ok AS (SELECT r, k FROM k GROUP BY 1, 2 HAVING COUNT(*) BETWEEN 2 AND 100), p AS (SELECT DISTINCT x.uid AS a, y.uid AS b FROM k x JOIN k y USING (r, k) JOIN ok USING (r, k) WHERE x.uid < y.uid), l AS (SELECT a, b, ln(0.1 / 0.9) + ln(CASE WHEN x.p_brand = y.p_brand THEN 0.8 / 0.05 ELSE 0.2 / 0.95 END) + ln(CASE WHEN x.p_type = y.p_type THEN 0.9 / 0.3 ELSE 0.1 / 0.7 END) + ln(CASE WHEN x.p_size = y.p_size THEN 0.7 / 0.02 ELSE 0.3 / 0.98 END) AS w FROM p JOIN part x ON x.p_partkey = a JOIN part y ON y.p_partkey = b) SELECT a, b, round(exp(w) / (1 + exp(w)), 9) AS score FROM l")
def fellegi_sunter_score(spark: SparkSession, sf: str) -> DataFrame:
    pairs, rows, _ = _linkage(spark, sf)
    model = (M.Comparison("line_1"), M.Comparison("city"), M.Comparison("zip5"))
    w = M.Weights(0.1, {"line_1": [0.2, 0.8], "city": [0.1, 0.9], "zip5": [0.3, 0.7]}, {"line_1": [0.95, 0.05], "city": [0.7, 0.3], "zip5": [0.98, 0.02]})
    return M.score(M.compare(pairs, rows, model), model, w).select("a", "b", F.round("score", 9).alias("score"))


@query()
def em_train_score(spark: SparkSession, sf: str) -> DataFrame:
    pairs, rows, model = _linkage(spark, sf)
    compared = M.compare(pairs, rows, model)
    return M.score(compared, model, M.expectation_maximisation(compared, model), {"line_1": M.term_frequencies(rows, "line_1")})


@query(f"WITH {TX} SELECT entity_id AS cluster_id, MIN(tx_id) AS canonical_id, COUNT(*) AS source_record_count, CAST(MIN(date) AS VARCHAR) AS first_seen, CAST(MAX(date) AS VARCHAR) AS last_seen, arg_max('N' || tx_id, (tx_id % 3) * 1000000000 - tx_id) AS canonical_name FROM tx GROUP BY 1")
def golden_record(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf)
    members = t.select(F.col("entity_id").alias("cluster_id"), F.col("tx_id").alias("uid"), F.concat(F.lit("N"), "tx_id").alias("name"), (F.col("tx_id") % 3).alias("completeness"), F.to_date(F.lit("2020-01-01")).alias("created_at"), F.lit("a").alias("address"), F.lit("parsed").alias("address_status"), F.lit(None).cast("string").alias("employer"), F.col("date").alias("first_date"), F.col("date").alias("last_date"))
    return M.survivorship(members).select("cluster_id", "canonical_id", "source_record_count", F.col("first_seen").cast("string").alias("first_seen"), F.col("last_seen").cast("string").alias("last_seen"), "canonical_name")


@query("WITH b AS (SELECT user_id, event_type AS v, CAST(MIN(ts) AS DATE) AS f, CAST(MAX(ts) AS DATE) AS l FROM events GROUP BY 1, 2) SELECT user_id, '[' || string_agg('{\"first_seen\":\"' || f || '\",\"employer\":\"' || v || '\",\"last_seen\":\"' || l || '\"}', ',' ORDER BY f, v) || ']' AS history FROM b GROUP BY 1")
def employer_history(spark: SparkSession, sf: str) -> DataFrame:
    return M.employer_history(table(spark, sf, "events").withColumn("d", F.col("ts").cast("date")), "user_id", "event_type", "d")


@query("WITH x AS (SELECT o_custkey AS source_id, o_orderkey % 3 AS run_id, MIN(o_orderkey) AS canonical_id FROM orders GROUP BY 1, 2) SELECT c_custkey, canonical_id FROM customer LEFT JOIN x ON source_id = c_custkey AND run_id = (SELECT MAX(run_id) FROM x)")
def crosswalk_latest_run(spark: SparkSession, sf: str) -> DataFrame:
    x = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("source_id"), (F.col("o_orderkey") % 3).alias("run_id")).agg(F.min("o_orderkey").alias("canonical_id"))
    latest = x.join(F.broadcast(x.agg(F.max("run_id").alias("run_id"))), "run_id")
    c = table(spark, sf, "customer").select("c_custkey")
    return c.join(latest, F.col("c_custkey") == F.col("source_id"), "left").select("c_custkey", "canonical_id")


@query("SELECT x.s_suppkey AS a, y.s_suppkey AS b, x.s_nationkey AS address_id FROM supplier x JOIN supplier y ON x.s_nationkey = y.s_nationkey AND x.s_suppkey < y.s_suppkey WHERE x.s_nationkey IN (SELECT s_nationkey FROM supplier GROUP BY 1 HAVING COUNT(*) <= 5)")
def colocated_pairs(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("uid"), F.col("s_nationkey").alias("address_id"))
    few = s.groupBy("address_id").count().where("count <= 5").select("address_id")
    s = s.join(few, "address_id", "left_semi")
    return s.withColumnRenamed("uid", "a").join(s.withColumnRenamed("uid", "b"), "address_id").where("a < b").select("a", "b", "address_id")


@query("WITH RECURSIVE e AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey - 1 END AS master_id FROM supplier), c AS (SELECT id, id AS here, 0 AS depth FROM e UNION ALL SELECT c.id, e.master_id, c.depth + 1 FROM c JOIN e ON e.id = c.here WHERE e.master_id IS NOT NULL) SELECT id, arg_max(here, depth) AS root, CAST(MAX(depth) AS INT) AS depth FROM c GROUP BY 1")
def master_chain(spark: SparkSession, sf: str) -> DataFrame:
    return A.master_chain(table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey - 1 END AS master_id"))


@query("WITH c AS (SELECT p_partkey AS uid, p_name AS a, CASE WHEN p_partkey % 9 = 0 THEN p_brand ELSE p_name END AS b FROM part), s AS (SELECT a, b, COUNT(*) AS n FROM c GROUP BY 1, 2), x AS (SELECT a, SUM(n) AS na FROM s GROUP BY 1), y AS (SELECT b, SUM(n) AS nb FROM s GROUP BY 1), k AS (SELECT a, MAX((n = na)::INT) AS i, MIN((n = nb)::INT) AS o FROM s JOIN x USING (a) JOIN y USING (b) GROUP BY 1) SELECT CASE WHEN i = 1 AND o = 1 THEN 'same' WHEN o = 1 THEN 'over_merge' WHEN i = 1 THEN 'over_split' ELSE 'other' END AS kind, COUNT(*) AS n FROM k GROUP BY 1")
def cluster_agreement(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return A.cluster_agreement(p.select("p_partkey", "p_name"), p.select("p_partkey", F.when(F.col("p_partkey") % 9 == 0, F.col("p_brand")).otherwise(F.col("p_name"))))


@query("SELECT SUM((l AND p)::INT) / SUM(p::INT) AS precision, SUM((l AND p)::INT) / SUM(l::INT) AS recall FROM (SELECT quality = 1 AS l, doc_id % 4 > 0 AS p FROM labels)")
def match_precision(spark: SparkSession, sf: str) -> DataFrame:
    return M.precision_recall(table(spark, sf, "labels").selectExpr("quality = 1 AS label", "doc_id % 4 > 0 AS predicted"))


@query(f"WITH {LINES}, {TX} SELECT DISTINCT tx.entity_id AS source_id, li.entity_id AS target_id, 'DONOR_TO' AS association_type FROM tx JOIN li USING (tx_id) WHERE tx.entity_id <> li.entity_id")
def associations_distinct(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf).select("tx_id", F.col("entity_id").alias("source_id"))
    return t.join(lines(spark, sf).select("tx_id", F.col("entity_id").alias("target_id")), "tx_id").where("source_id <> target_id").select("source_id", "target_id", F.lit("DONOR_TO").alias("association_type")).distinct()


@query("SELECT 'crosswalk' AS \"table\", COUNT(*) AS removed FROM orders WHERE o_orderkey % 7 NOT IN (5, 6)")
def prune_runs(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select((F.col("o_orderkey") % 7).alias("run_id"))
    return A.prune_runs({"crosswalk": rows}, rows.distinct(), 2)[1].select("table", "removed")


@query("SELECT o_orderkey % 7 AS run_id, COUNT(*) AS n FROM orders WHERE o_orderkey % 7 <> 6 GROUP BY 1")
def unmerge_run(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select((F.col("o_orderkey") % 7).alias("run_id"))
    return A.unmerge(rows, 6, rows.agg(F.max("run_id")).first()[0]).groupBy("run_id").agg(F.count("*").alias("n"))


@query("SELECT MAX(n) AS most FROM (SELECT COUNT(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY l_orderkey)")
def phantom_invariant(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.countDistinct("l_suppkey").alias("n")).agg(F.max("n").alias("most"))


@query("SELECT n_nationkey, COALESCE(n_name, 'Committee ' || n_nationkey) AS name, s.n AS suppliers, c.n AS customers FROM nation FULL JOIN (SELECT s_nationkey, COUNT(*) AS n FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey LEFT JOIN (SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey")
def committees_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))
    c = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    n = table(spark, sf, "nation")
    j = n.join(s, n.n_nationkey == s.s_nationkey, "full_outer").join(c, n.n_nationkey == c.c_nationkey, "left")
    return j.select("n_nationkey", P.committee_name("n_name", F.lit(None).cast("string"), F.col("n_nationkey").cast("string")).alias("name"), "suppliers", "customers")


# --- the name-only grain and publishing -----------------------------------------------------------------------------

_KEY = "md5(COALESCE(lower(COALESCE(contributorNameOrganization, concat_ws(' ', contributorNameFirst, contributorNameLast))), '_dbt_utils_surrogate_key_null_'))"


def _party(spark: SparkSession, sf: str) -> DataFrame:
    return G.parties(G.staging(_source(spark, sf), "RCPT"))


@query(f"WITH {SOURCE} SELECT {_KEY} AS person_nk, MAX(contributorNameFirst) AS first_name, MAX(contributorNameLast) AS last_name, MAX(contributorNameOrganization) AS organization FROM src WHERE COALESCE(contributorNameOrganization, contributorNameFirst, contributorNameLast) IS NOT NULL GROUP BY 1")
def gold_persons(spark: SparkSession, sf: str) -> DataFrame:
    return G.dim_persons(_party(spark, sf)).select("person_nk", "first_name", "last_name", "organization")


@query(f"WITH {SOURCE}, m AS (SELECT lpad(s_suppkey || '', 8, '0') AS id, s_name AS name FROM supplier WHERE s_suppkey < 20), t AS (SELECT lpad(trim(filerIdent), 8, '0') AS id, MIN(filerName) AS name FROM src GROUP BY 1) SELECT COALESCE(m.id, t.id) AS filer_id, COALESCE(m.name, t.name) AS name FROM m FULL JOIN t ON m.id = t.id")
def gold_committees(spark: SparkSession, sf: str) -> DataFrame:
    master = table(spark, sf, "supplier").where("s_suppkey < 20").select(F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("filer_id"), F.col("s_name").alias("name"))
    return G.dim_committees(master, G.staging(_source(spark, sf), "RCPT"))


@query(f"WITH {SOURCE} SELECT DISTINCT {_KEY} AS source, md5(filerName) AS target, 'DONOR_TO' AS association_type FROM src WHERE COALESCE(contributorNameOrganization, contributorNameFirst, contributorNameLast) IS NOT NULL")
def gold_associations(spark: SparkSession, sf: str) -> DataFrame:
    return G.associations(_party(spark, sf))


@query("WITH r AS (SELECT c_custkey AS uid, 'person' AS t, CASE WHEN c_custkey % 20 = 0 THEN c_nationkey END AS f, c_mktsegment || (c_custkey % 30) AS n, c_nationkey AS ad, c_custkey % 4 > 0 AS ok FROM customer), e AS (SELECT c_custkey - 1 AS a, c_custkey AS b, 0 AS p FROM customer WHERE c_custkey % 50 = 1 UNION ALL SELECT a, uid, 1 FROM (SELECT uid, MIN(uid) OVER (PARTITION BY f) AS a FROM r WHERE f IS NOT NULL) WHERE a <> uid UNION ALL SELECT a, uid, 2 FROM (SELECT uid, MIN(uid) OVER (PARTITION BY t, n, ad) AS a FROM r WHERE ok) WHERE a <> uid) SELECT a, b, ['link', 'filer_id', 'name_address'][MIN(p) + 1] AS reason FROM e GROUP BY 1, 2")
def fast_path_edges(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    r = c.select(F.col("c_custkey").alias("uid"), F.lit("person").alias("entity_type"), F.when(F.col("c_custkey") % 20 == 0, F.col("c_nationkey")).alias("filer_id"), F.concat("c_mktsegment", (F.col("c_custkey") % 30).cast("string")).alias("name_key"), F.col("c_nationkey").alias("address"), F.when(F.col("c_custkey") % 4 > 0, "parsed").otherwise("partial").alias("address_status"))
    return U.fast_path(r, c.where("c_custkey % 50 = 1").selectExpr("c_custkey - 1 AS a", "c_custkey AS b"))


@query(f"WITH {PEOPLE} SELECT city, state, zip, COUNT(*) AS frequency FROM p WHERE COALESCE(city, state, zip) IS NOT NULL GROUP BY 1, 2, 3")
def canonical_addresses(spark: SparkSession, sf: str) -> DataFrame:
    return U.canonical_addresses(_people(spark, sf), ["city", "state", "zip"])


@query("WITH b AS (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM b) WHERE rn = 1")
def most_frequent_address(spark: SparkSession, sf: str) -> DataFrame:
    return U.most_frequent(table(spark, sf, "events"), "user_id", "event_type")


@query("SELECT o_custkey % 30 AS committee, NULLIF(lower(trim(CASE WHEN o_orderkey % 3 = 0 THEN ' Governor' WHEN o_orderkey % 3 = 1 THEN ' ' END)), '') AS office, COALESCE(CASE WHEN o_orderkey % 4 > 0 THEN CAST(year(o_orderdate) AS INT) END, 0) AS cycle, arg_min('Campaign ' || o_orderkey, o_orderkey) AS name, arg_min('C' || o_orderkey, o_orderkey) FILTER (WHERE o_orderkey % 5 = 0) AS candidate FROM orders GROUP BY 1, 2, 3")
def canonical_campaigns(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_custkey % 30 AS committee", "CASE WHEN o_orderkey % 3 = 0 THEN ' Governor' WHEN o_orderkey % 3 = 1 THEN ' ' END AS office", "CASE WHEN o_orderkey % 4 > 0 THEN year(o_orderdate) END AS cycle", "'Campaign ' || o_orderkey AS name", "CASE WHEN o_orderkey % 5 = 0 THEN 'C' || o_orderkey END AS candidate")
    return U.canonical_campaigns(rows)


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN -1 ELSE o_orderkey END AS report_id FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 3 > 0")
def report_link(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.lit(44).alias("state_id"), F.col("l_orderkey").alias("report_ident"), F.when(F.col("l_linenumber") == 1, F.lit(-1).cast("long")).alias("report_id"))
    r = table(spark, sf, "orders").where("o_orderkey % 3 > 0").select(F.lit(44).alias("state_id"), F.col("o_orderkey").alias("report_ident"), F.col("o_orderkey").alias("id"))
    return U.link_reports(t, r).select("l_orderkey", "l_linenumber", "report_id")


@query("SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS is_final FROM orders")
def final_reports(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("report_ident"), F.lit(False).alias("is_final"))
    return U.mark_final(r, table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("report_ident"))).select("o_orderkey", "is_final")


from tallyforge import queries_surface as _surface  # noqa: E402, F401  registers its queries here
