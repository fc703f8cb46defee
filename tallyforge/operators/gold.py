"""The name-only grain: staging in one wide party shape, dimensions by natural key, facts and associations by joins.

This grain differs from the families on purpose: persons are keyed by name alone, attributes are maxima, candidates make an
expenditure of their own, and travel takes its parent's amount and the departure date.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import columns as C
from tallyforge.operators.dedup import keep_first, pad_columns

# Transaction type, role, party prefix, and id, amount, date and description columns of each staging model.
STAGING: dict[str, tuple[str, str | None, str | None, str, str | None, str | None, str | None]] = {
    "RCPT": ("CONTRIBUTION", "CONTRIBUTOR", "contributor", "contributionInfoId", "contributionAmount", "contributionDt", "contributionDescr"),
    "EXPN": ("EXPENDITURE", "PAYEE", "payee", "expendInfoId", "expendAmount", "expendDt", "expendDescr"),
    "LOAN": ("LOAN", "CONTRIBUTOR", "lender", "loanInfoId", "loanAmount", "loanDt", "loanDescr"),
    "DEBT": ("DEBT", "CONTRIBUTOR", "lender", "loanInfoId", None, None, None),
    "PLDG": ("PLEDGE", "CONTRIBUTOR", "pledger", "pledgeInfoId", "pledgeAmount", "pledgeDt", "pledgeDescr"),
    "CRED": ("CREDIT", "CONTRIBUTOR", "payor", "creditInfoId", "creditAmount", "creditDt", "creditDescr"),
    "TRVL": ("TRAVEL", "PAYEE", "traveller", "travelInfoId", "parentAmount", "departureDt", "travelPurpose"),
    "CAND": ("EXPENDITURE", "PAYEE", "candidate", "expendInfoId", "expendAmount", "expendDt", "expendDescr"),
    "ASSET": ("ASSET", None, None, "assetInfoId", None, "receivedDt", "assetDescr"),
}


def filer_id(x: Column | str) -> Column:
    return F.lpad(C.clean_str(x), 8, "0")


def staging(df: DataFrame, record_type: str) -> DataFrame:
    """One row in the wide party shape for each source row."""
    kind, role, party, id_, amount, date, description = STAGING[record_type]
    parts = {"first_name": "NameFirst", "last_name": "NameLast", "suffix": "NameSuffixCd", "organization": "NameOrganization", "city": "StreetCity", "state": "StreetStateCd", "zip_code": "StreetPostalCode"}
    need = [id_, "filerIdent", "filerName", *(x for x in (amount, date, description) if x), *(f"{party}{v}" for v in parts.values() if party)]
    df = pad_columns(df, need)
    none = F.lit(None).cast("string")
    return df.select(
        F.lit(record_type).alias("record_type"), F.lit(kind).alias("transaction_type"), F.lit(role).cast("string").alias("role"), C.clean_str(id_).alias("transaction_id"),
        (C.safe_numeric(amount) if amount else F.lit(None)).cast("decimal(15,2)").alias("amount"), (C.safe_date(date) if date else F.lit(None).cast("date")).alias("transaction_date"),
        (C.clean_str(description) if description else none).alias("description"), filer_id("filerIdent").alias("filer_id"), C.clean_str("filerName").alias("filer_name"),
        *((C.clean_str(f"{party}{v}") if party else none).alias(k) for k, v in parts.items()),
    )


def person_nk() -> Column:
    return C.surrogate_key(F.lower(F.coalesce("organization", F.concat_ws(" ", "first_name", "last_name", "suffix"))))


def address_nk() -> Column:
    return F.when(F.coalesce("city", "state", "zip_code").isNotNull(), C.surrogate_key(F.lower("city"), F.lower("state"), "zip_code"))


def parties(*stages: DataFrame) -> DataFrame:
    """All party occurrences with their natural keys; rows without a name go."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stages)
    return every.where("coalesce(first_name, last_name, organization) IS NOT NULL").withColumns({"person_nk": person_nk(), "address_nk": address_nk()})


def dim_persons(party: DataFrame) -> DataFrame:
    cols = ["first_name", "last_name", "suffix", "organization"]
    return party.groupBy("person_nk").agg(*(F.max(c).alias(c) for c in cols), F.min("address_nk").alias("address_nk"))


def dim_addresses(party: DataFrame) -> DataFrame:
    return party.where("address_nk IS NOT NULL").groupBy("address_nk").agg(*(F.max(c).alias(c) for c in ("city", "state", "zip_code")))


def dim_committees(filers: DataFrame, stages: DataFrame) -> DataFrame:
    """The filer master and every filer that a transaction names; the master's name wins, else the first by name."""
    named = keep_first(stages.select("filer_id", "filer_name").where("filer_id IS NOT NULL"), ["filer_id"], [F.col("filer_name").asc_nulls_last()])
    f = filers.select(F.col("filer_id").alias("m_id"), F.col("name").alias("m_name"))
    j = f.join(named, F.col("m_id") == F.col("filer_id"), "full_outer")
    return j.select(F.coalesce("m_id", "filer_id").alias("filer_id"), F.coalesce("m_name", "filer_name").alias("name"))


def associations(party: DataFrame) -> DataFrame:
    """Distinct DONOR_TO and VENDOR_FOR links between party and committee, without self-loops."""
    kind = F.when(F.col("role") == "CONTRIBUTOR", "DONOR_TO").when(F.col("role") == "PAYEE", "VENDOR_FOR")
    return party.select(F.col("person_nk").alias("source"), C.surrogate_key(F.lower("filer_name")).alias("target"), kind.alias("association_type")).where("association_type IS NOT NULL AND source <> target").distinct()


def one_person_per_transaction(party: DataFrame) -> DataFrame:
    """Transactions that break the rule of one party; the table is empty for a good build."""
    return party.groupBy("transaction_type", "transaction_id").agg(F.countDistinct("person_nk").alias("n")).where("n > 1")
