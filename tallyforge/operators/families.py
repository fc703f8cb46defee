"""Record-type families: source rows to unified transactions, parties, details and reports.

A ``Spec`` names the columns of a record type; projections are built from it, so every family is one select.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.operators.dedup import keep_first, pad_columns


@dataclass(frozen=True)
class Spec:
    """A record type: its role, party prefix, id, amount, date and description columns, with fallbacks."""

    kind: str
    role: str | None
    party: str | None
    id: str
    amount: tuple[str, ...] = ()
    date: tuple[str, ...] = ("receivedDt",)
    description: str | None = None


# The columns of each record type.
SPECS: dict[str, Spec] = {
    "RCPT": Spec("CONTRIBUTION", "CONTRIBUTOR", "contributor", "contributionInfoId", ("contributionAmount",), ("contributionDt", "receivedDt"), "contributionDescr"),
    "EXPN": Spec("EXPENDITURE", "PAYEE", "payee", "expendInfoId", ("expendAmount",), ("expendDt", "receivedDt"), "expendDescr"),
    "LOAN": Spec("LOAN", "LENDER", "lender", "loanInfoId", ("loanAmount",), ("loanDt", "receivedDt"), "loanDescr"),
    "DEBT": Spec("DEBT", "CREDITOR", "lender", "loanInfoId"),
    "PLDG": Spec("PLEDGE", "PLEDGER", "pledger", "pledgeInfoId", ("pledgeAmount",), ("pledgeDt", "receivedDt"), "pledgeDescr"),
    "CRED": Spec("CREDIT", "PAYOR", "payor", "creditInfoId", ("creditAmount",), ("creditDt", "receivedDt"), "creditDescr"),
    "TRVL": Spec("TRAVEL", "TRAVELLER", "traveller", "travelInfoId", ("travelAmount", "parentAmount"), ("parentDt", "receivedDt"), "travelPurpose"),
    "ASSET": Spec("ASSET", None, None, "assetInfoId", (), ("receivedDt",), "assetDescr"),
}
# Names that stand for nobody.
PLACEHOLDERS = ["NON-ITEMIZED CONTRIBUTOR", "UNITEMIZED", "ANONYMOUS", "UNKNOWN"]


def _first(df: DataFrame, names: tuple[str, ...], parse) -> Column:
    there = [parse(n) for n in names if n in df.columns]
    return F.coalesce(*there) if there else parse(F.lit(None).cast("string"))


def transactions(df: DataFrame, record_type: str, state_id: int) -> DataFrame:
    """Unified transactions of a record type: id and text as they are, amount and dates parsed, office from hold then seek."""
    s = SPECS[record_type]
    df = pad_columns(df, [s.id, "receivedDt", "filerIdent", "reportInfoIdent", *([s.description] if s.description else [])])
    hold = [f"{s.party}{x}OfficeCd" for x in ("Hold", "Seek")] if s.party else []
    return df.select(
        F.col(s.id).alias("transaction_id"),
        _first(df, s.amount, C.builder_amount).cast("decimal(15,2)").alias("amount"),
        _first(df, s.date, C.builder_date).alias("transaction_date"),
        (F.col(s.description) if s.description else F.lit(None).cast("string")).alias("description"),
        F.lit(s.kind).alias("transaction_type"),
        C.clean_str("filerIdent").alias("committee_id"),
        F.lit(state_id).alias("state_id"),
        C.clean_str("reportInfoIdent").alias("report_ident"),
        C.builder_date("receivedDt").alias("filed_date"),
        F.lit(False).alias("amended"),
        _first(df, tuple(hold), C.clean_str).alias("office_src"),
    )


def parties(df: DataFrame, record_type: str, order: str) -> DataFrame:
    """The party of each row with its person key, type and normalized name; rows without any name go."""
    p = SPECS[record_type].party
    names = {k: f"{p}Name{v}" for k, v in (("organization", "Organization"), ("last_name", "Last"), ("first_name", "First"), ("suffix", "SuffixCd"))}
    where = {k: f"{p}Street{v}" for k, v in (("street", "Addr1"), ("city", "City"), ("state", "StateCd"), ("zip_code", "PostalCode"))}
    extra = {"employer": f"{p}Employer", "occupation": f"{p}Occupation"}
    df = pad_columns(df, [*names.values(), *where.values(), *extra.values(), SPECS[record_type].id])
    out = df.select(F.col(SPECS[record_type].id).alias("transaction_id"), F.col(order).alias("ord"), *(C.clean_str(v).alias(k) for k, v in {**names, **where, **extra}.items()))
    out = out.where("coalesce(organization, first_name, last_name) IS NOT NULL")
    key = C.collapse_for_org("organization", C.person_addr_key("street", "city", "state", "zip_code"))
    out = out.withColumns({"dedup_addr_key": key, "person_type": C.person_type("organization", "first_name", "last_name", PLACEHOLDERS), "full_name": C.full_name("first_name", F.lit(None), "last_name", "suffix", "organization")})
    return out.withColumn("normalized_name", C.normalize_entity_name("full_name")).withColumn("entity_type", F.when(F.col("organization").isNotNull(), "ORGANIZATION").otherwise("PERSON"))


PERSON_KEY = ["p_org", "p_first", "p_last", "dedup_addr_key"]


def persons(party_rows: DataFrame, fill: tuple[str, ...] = ("employer", "occupation", "suffix")) -> DataFrame:
    """One row for each person key in order of first appearance, with the first value of the fill columns that isn't null."""
    org = F.lower("organization")
    keyed = party_rows.withColumns({"p_org": org, "p_first": F.when(org.isNull(), F.lower("first_name")), "p_last": F.when(org.isNull(), F.lower("last_name"))})
    filled = keyed.groupBy(*PERSON_KEY).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("ord", "transaction_id"))).alias(f"f_{c}") for c in fill))
    first = keep_first(keyed, PERSON_KEY, ["ord", "transaction_id"]).drop(*fill)
    on = [first[k].eqNullSafe(filled[k]) for k in PERSON_KEY]
    cond = on[0] & on[1] & on[2] & on[3]
    return first.join(filled, cond).select(*(first[c] for c in first.columns if c not in PERSON_KEY[:3]), *(filled[f"f_{c}"].alias(c) for c in fill))


def enrich_partial_addresses(rows: DataFrame, addresses: DataFrame) -> DataFrame:
    """A row with city, state and zip but no street takes the street of the smallest-id address there, if that has one."""
    low = lambda df: [F.lower(df["city"]), F.lower(df["state"]), df["zip_code"]]
    best = addresses.groupBy(F.lower("city").alias("bc"), F.lower("state").alias("bs"), F.col("zip_code").alias("bz")).agg(F.min_by("street", "id").alias("b_street"))
    a, b, c = low(rows)
    out = rows.join(best, (a == F.col("bc")) & (b == F.col("bs")) & (c == F.col("bz")), "left")
    return out.withColumn("street", F.coalesce("street", "b_street")).drop("bc", "bs", "bz", "b_street")


def guarantors(df: DataFrame, parent_id: str, slots: int = 5) -> DataFrame:
    """A row for each guarantor slot that has a name, with its position."""
    fields = {"organization": "NameOrganization", "last_name": "NameLast", "first_name": "NameFirst", "city": "StreetCity"}
    df = pad_columns(df, [f"guarantor{v}{i}" for i in range(1, slots + 1) for v in fields.values()])
    slot = [F.struct(F.lit(i).alias("position"), *(C.clip(C.clean_str(f"guarantor{v}{i}"), 200).alias(k) for k, v in fields.items())) for i in range(1, slots + 1)]
    return df.select(F.col(parent_id).alias("parent_id"), F.explode(F.array(*slot)).alias("g")).select("parent_id", "g.*").where("parent_id IS NOT NULL AND coalesce(organization, last_name, first_name) IS NOT NULL")


def officers(df: DataFrame, roles: dict[str, str], id_col: str = "filerIdent") -> DataFrame:
    """The officers of filer rows, unfolded: one row for each prefix that has a name."""
    df = pad_columns(df, [f"{p}Name{x}" for p in roles for x in ("First", "Last")])
    each = [F.struct(F.lit(role).alias("role"), C.clean_str(f"{p}NameFirst").alias("first_name"), C.clean_str(f"{p}NameLast").alias("last_name")) for p, role in roles.items()]
    return df.select(F.col(id_col).alias("filer_id"), F.inline(F.array(*each))).where("coalesce(first_name, last_name) IS NOT NULL")


def collapse_committees(df: DataFrame, key: str, order: str, last_value: list[str], anchored: list[str], anchor: Column) -> DataFrame:
    """A row for each filer: the last value that isn't null of some columns, and the address columns of the first row with an anchor."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in last_value]
    first = F.min_by(F.struct(*anchored), F.when(anchor, F.col(order))).alias("_a")
    return df.groupBy(key).agg(*last, first).select(key, *last_value, *(F.col(f"_a.{c}").alias(c) for c in anchored))


def reports(df: DataFrame, totals: list[str]) -> DataFrame:
    """Cover sheets as reports; rows without an identifier go."""
    df = pad_columns(df, ["reportInfoIdent", "filerIdent", "filedDt", "periodStartDt", "periodEndDt", *totals])
    out = df.select(C.clean_str("reportInfoIdent").alias("report_ident"), C.clean_str("filerIdent").alias("committee_id"), C.tec_date("filedDt").alias("filed_date"), C.tec_date("periodStartDt").alias("period_start"), C.tec_date("periodEndDt").alias("period_end"), *(C.tec_amount(t).cast("decimal(15,2)").alias(t) for t in totals))
    return out.where("report_ident IS NOT NULL")


def detail(facts: DataFrame, need: list[str], fallback: dict[str, str] | None = None, key: str = "transaction_id") -> DataFrame:
    """A 1:1 detail table: rows that have all needed ids, missing others taken from a fallback column, one for each transaction."""
    df = facts.withColumns({a: F.coalesce(a, b) for a, b in (fallback or {}).items()})
    for n in need:
        df = df.where(F.col(n).isNotNull())
    return keep_first(df, [key], [*need, "ord"] if "ord" in df.columns else need)


def campaigns(tx: DataFrame) -> DataFrame:
    """A campaign for each (normalized name, committee, year), the first by date and id, from campaign, candidate or committee name."""
    name = F.coalesce(C.clean_str("campaign_name"), C.clean_str("candidate_name"), C.clean_str("committee_name"))
    df = tx.withColumns({"name": name, "normalized_name": C.normalize_entity_name(name), "election_year": F.year("transaction_date")}).where("name IS NOT NULL")
    return keep_first(df, ["normalized_name", "committee_id", "election_year"], ["transaction_date", "transaction_id"]).select("name", "normalized_name", "committee_id", "election_year", "office_src")


def committee_name(name: Column | str, candidate: Column | str, filer_id: Column | str) -> Column:
    return F.coalesce(C.clean_str(name), F.concat(F.lit("Candidate Committee - "), C.clean_str(candidate)), F.concat(F.lit("Committee "), C.clean_str(filer_id)))


def link_candidates(cand: DataFrame, expenditures: DataFrame) -> DataFrame:
    """Candidate rows whose expenditure exists; they make no transaction of their own."""
    return cand.join(expenditures.select(F.col("transaction_id").alias("expendInfoId")).distinct(), "expendInfoId", "left_semi")
