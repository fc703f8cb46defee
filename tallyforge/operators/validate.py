"""Validation rules as columns: a row gets an array of (type, column, value) errors, and is passed or failed by it.

Bad rows are split off before a write, so no batch is retried or bisected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import columns as C


@dataclass(frozen=True)
class Check:
    """A rule: the error's type, the column it is about, and the condition of a good row."""

    type: str
    column: str
    good: Column


def required(*names: str) -> list[Check]:
    return [Check("missing", n, C.blank_to_null(n).isNotNull()) for n in names]


def party(prefix: str) -> list[Check]:
    """Individuals need a last name, entities an organization, and the type is one of the two."""
    t = F.upper(C.clean_str(f"{prefix}PersentTypeCd"))
    return [
        Check("type", f"{prefix}PersentTypeCd", F.coalesce(t.isin("INDIVIDUAL", "ENTITY"), F.lit(False))),
        Check("missing", f"{prefix}NameLast", ~(t == "INDIVIDUAL") | C.clean_str(f"{prefix}NameLast").isNotNull()),
        Check("missing", f"{prefix}NameOrganization", ~(t == "ENTITY") | C.clean_str(f"{prefix}NameOrganization").isNotNull()),
    ]


def dates(*names: str) -> list[Check]:
    """Null or a valid yyyyMMdd."""
    return [Check("date", n, C.blank_to_null(n).isNull() | (C.strip(n).rlike("^[0-9]{8}$") & C.tec_date(n).isNotNull())) for n in names]


def flags(*names: str) -> list[Check]:
    return [Check("flag", n, C.blank_to_null(n).isNull() | F.upper(C.strip(n)).isin("Y", "N")) for n in names]


RULES: dict[str, list] = {
    "RCPT": [("required", "receivedDt", "filerName"), ("party", "contributor"), ("dates", "contributionDt", "receivedDt")],
    "EXPN": [("required", "receivedDt", "filerName", "expendInfoId"), ("party", "payee"), ("dates", "expendDt", "receivedDt")],
    "DEBT": [("party", "lender"), ("dates", "receivedDt")],
    "PLDG": [("party", "pledger"), ("dates", "pledgeDt", "receivedDt")],
    "TRVL": [("party", "traveller"), ("dates", "receivedDt")],
    "ASSET": [("required", "assetDescr", "receivedDt", "filerName"), ("flags", "infoOnlyFlag")],
}


def rules_for(record_type: str) -> list[Check]:
    kinds = {"required": required, "party": party, "dates": dates, "flags": flags}
    return [c for name, *args in RULES[record_type] for c in kinds[name](*args)]


def _each(checks: list[Check]) -> Column:
    return F.array(*(F.when(~F.coalesce(c.good, F.lit(False)), F.struct(F.lit(c.type).alias("type"), F.lit(c.column).alias("column"), F.col(c.column).cast("string").alias("value"))) for c in checks))


def validated(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Adds ``errors``."""
    return df.withColumn("errors", F.array_compact(_each(checks)))


def errors(df: DataFrame, checks: list[Check], keep: tuple[str, ...] = ()) -> DataFrame:
    """The ``keep`` columns with type, column and value of each error; every check is evaluated once."""
    return df.select(*keep, F.inline(_each(checks))).where("type IS NOT NULL")


def split(df: DataFrame, checks: list[Check]) -> tuple[DataFrame, DataFrame]:
    """Passed rows, and failed rows with their errors."""
    out = validated(df, checks)
    return out.where(F.size("errors") == 0).drop("errors"), out.where(F.size("errors") > 0)


def quarantine(failed: DataFrame, record_type: str, source_file: Column) -> DataFrame:
    """Failed rows as ingest errors: one row for each error, the source row as JSON."""
    cols = [c for c in failed.columns if c != "errors"]
    return failed.select(F.lit(record_type).alias("record_type"), source_file.alias("source_file"), F.to_json(F.struct(*cols)).alias("raw_data"), F.posexplode("errors")).select("record_type", "source_file", (F.col("pos") + 1).alias("error_number"), F.col("col.type").alias("error_type"), F.concat_ws(": ", "col.column", "col.value").alias("error_message"), "raw_data")


def cross_tab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of rows by two columns with Total margins."""
    counts = [F.sum(F.when(F.col(column) == v, 1).otherwise(0)).cast("long").alias(v) for v in values]
    total = F.count("*").alias("Total")
    return df.groupBy(row).agg(*counts, total).unionByName(df.agg(*counts, total).withColumn(row, F.lit("Total")))
