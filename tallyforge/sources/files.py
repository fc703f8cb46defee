"""Scans, discovery, coverage and sinks for all-string extracts.

Rows are read and written by Spark on the executors; only listings and small reports are driver work, through Hadoop's file
system, so any store that Spark reads will do.
"""

from __future__ import annotations

import json
import re
import tomllib
import zipfile
from dataclasses import dataclass
from pathlib import Path, PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.columns import clean_str
from tallyforge.operators.dedup import union_by_name

ENCODINGS = ("UTF-8", "windows-1252", "ISO-8859-1")
METADATA = ("CFS-Codes", "CFS-ReadMe")
# File-name prefixes of the record types; the longest that fits counts.
PREFIXES = {"contribs": "RCPT", "cont_ss": "RCPT", "cont_t": "RCPT", "expend": "EXPN", "expn_t": "EXPN", "loans": "LOAN", "debts": "DEBT", "pledges": "PLDG", "pldg_ss": "PLDG", "pldg_t": "PLDG", "credits": "CRED", "travel": "TRVL", "assets": "ASSET", "cover": "CVR1", "cover_ss": "CVR1", "cover_t": "CVR1", "final": "FINL", "finals": "FINL", "filers": "FILER", "cand": "CAND", "spacs": "SPAC", "notices": "CVR2", "purpose": "CVR3", "expn_catg": "EXCAT"}
REQUIRED = ("RCPT", "EXPN", "FILER", "CVR1", "LOAN")


def is_metadata(path: str) -> bool:
    return PurePosixPath(path).name.startswith(METADATA)


def files(spark: SparkSession, folder: str) -> list[str]:
    """Paths in a folder, sorted, in any store; a parquet folder is one path."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    return sorted(s.getPath().toString() for s in found)


def record_type(stem: str) -> str:
    s = stem.lower()
    fits = [p for p in PREFIXES if s == p or s.startswith(p + "_")]
    return PREFIXES[max(fits, key=len)] if fits else "UNKNOWN"


def record_type_column(stem: Column) -> Column:
    """The same as a column: prefixes from the longest to the shortest."""
    s = F.lower(stem)
    out = F.lit("UNKNOWN")
    for p in sorted(PREFIXES, key=len):
        out = F.when((s == p) | s.startswith(p + "_"), PREFIXES[p]).otherwise(out)
    return out


def discover(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Paths by record type; a parquet file wins over a text file of the same stem; metadata files are left out."""
    by_stem: dict[str, str] = {}
    for p in files(spark, folder):
        path = PurePosixPath(p)
        if path.suffix in (".parquet", ".csv", ".txt") and not is_metadata(p):
            key = str(path.with_suffix(""))
            if key not in by_stem or path.suffix == ".parquet":
                by_stem[key] = p
    out: dict[str, list[str]] = {}
    for p in sorted(by_stem.values()):
        out.setdefault(record_type(PurePosixPath(p).stem), []).append(p)
    return out


def encoding_of(spark: SparkSession, path: str) -> str:
    """UTF-8 if every line is valid, else cp1252 if no byte is undefined there, else latin-1; decided by the executors."""
    lines = spark.read.text(path)
    if not lines.where(~F.is_valid_utf8("value")).take(1):
        return ENCODINGS[0]
    undefined = F.hex(F.expr("CAST(value AS BINARY)")).rlike("^(..)*(81|8D|8F|90|9D)")
    return ENCODINGS[2] if lines.where(undefined).take(1) else ENCODINGS[1]


def read_delimited(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Every column a string; short and long lines are padded and cut.

    Spark's reader knows no cp1252, which is latin-1 but for 0x80 to 0x9F; those are translated after the scan."""
    encoding = encoding or encoding_of(spark, path)
    latin = encoding == ENCODINGS[1]
    df = spark.read.options(header=True, inferSchema=False, mode="PERMISSIVE", encoding=ENCODINGS[2] if latin else encoding, quote='"', escape='"').csv(path)
    if not latin:
        return df
    known = [i for i in range(0x80, 0xA0) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    old, new = "".join(map(chr, known)), bytes(known).decode("cp1252")
    return df.select(*(F.translate(F.col(f"`{c}`"), old, new).alias(c.translate(str.maketrans(old, new))) for c in df.columns))


def read_parquet(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several files by name, with types relaxed to string where they differ."""
    return union_by_name(*(spark.read.parquet(p) for p in paths))


def scan(spark: SparkSession, path: str) -> DataFrame | None:
    """By extension; null for others."""
    kind = PurePosixPath(path).suffix
    return spark.read.parquet(path) if kind == ".parquet" else read_delimited(spark, path) if kind in (".csv", ".txt") else None


def tidy(df: DataFrame, with_origin: bool = True) -> DataFrame:
    """Lower-case headers with underscores, and where and when a row came from."""
    out = df.withColumns({"file_origin": F.col("_metadata.file_name"), "download_date": F.current_date()}) if with_origin else df
    return out.toDF(*(c.strip().lower().replace(" ", "_") for c in out.columns))


def convert(spark: SparkSession, folder: str, overwrite: bool = False) -> dict[str, list[str]]:
    """Text files to parquet beside them; existing ones are skipped, failures listed."""
    out: dict[str, list[str]] = {"converted": [], "skipped": [], "failed": []}
    every = files(spark, folder)
    for p in every:
        path = PurePosixPath(p)
        if path.suffix not in (".csv", ".txt") or is_metadata(p):
            continue
        to = str(path.with_suffix(".parquet"))
        if not overwrite and to in every:
            out["skipped"].append(p)
            continue
        try:
            read_delimited(spark, p).write.mode("overwrite").parquet(to)
            out["converted"].append(p)
        except Exception as e:  # a bad file is reported and the others go on
            out["failed"].append(f"{p}: {type(e).__name__}")
    return out


def coverage(counts: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """``record_type, rows, status``: present, empty or missing for each required type, from (record_type, rows)."""
    spark = counts.sparkSession
    need = spark.createDataFrame([(r,) for r in required], "record_type string")
    return need.join(counts, "record_type", "left").select("record_type", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.when(F.col("rows").isNull(), "missing").when(F.col("rows") == 0, "empty").otherwise("present").alias("status"))


def row_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    df = spark.read.option("header", True).csv(paths)
    return df.select(F.col("_metadata.file_name").alias("file_name")).groupBy("file_name").agg(F.count("*").alias("rows"))


def field_coverage(df: DataFrame, mapped: dict[str, str], structural: set[str], handled: set[str], threshold_pct: float = 1.0) -> DataFrame:
    """Fill percentage and status of every column, in one pass."""
    filled = [(100.0 * F.count(clean_str(c)) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias(c) for c in df.columns]
    one = df.agg(*filled)
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("source_column"), F.lit(mapped.get(c)).alias("unified_field"), F.col(c).alias("fill_pct")) for c in df.columns)))
    c = F.col("source_column")
    status = F.when(F.col("unified_field").isNotNull(), "MAPPED").when(c.isin(list(structural)), "STRUCTURAL").when(c.isin(list(handled)), "HANDLED").when(F.col("fill_pct") >= threshold_pct, "UNMAPPED_POPULATED").otherwise("UNMAPPED_EMPTY")
    return one.select(pairs.alias("p")).select("p.*").withColumn("status", status)


def missing_columns(df: DataFrame, needed: list[str]) -> list[str]:
    return sorted(set(needed) - set(df.columns))


def safe_extract(archive: str, to: str) -> list[str]:
    """Unpacks a zip file; an entry that would land outside raises."""
    root = Path(to).resolve()
    with zipfile.ZipFile(archive) as z:
        for name in z.namelist():
            if not (root / name).resolve().is_relative_to(root):
                raise ValueError(f"entry outside the target: {name}")
        z.extractall(root)
        return z.namelist()


def write_nested_json(tx: DataFrame, people: DataFrame, path: str) -> None:
    """Transactions with their people nested, one JSON object a line."""
    nested = people.groupBy("transaction_id").agg(F.sort_array(F.collect_list(F.struct("role", "name"))).alias("persons"))
    tx.join(nested, "transaction_id", "left").write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 500_000) -> None:
    df.write.mode("overwrite").option("header", True).option("maxRecordsPerFile", rows_per_file).csv(path)


def publish(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Replaces each table as a whole, parents first."""
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(name)


def read_toml(text: str) -> dict:
    return tomllib.loads(text)


@dataclass
class FieldLibrary:
    """Source columns of a state to unified fields, with confidence; exported and imported as JSON."""

    mappings: dict[str, dict[str, tuple[str, float]]]

    def unified(self, state: str, column: str) -> str | None:
        own = self.mappings.get(state, {})
        if column in own:
            return own[column][0]
        words = set(re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", column).lower()))
        fits = [(len(words & set(u.split("_"))), u) for u in {v[0] for v in own.values()}]
        n, best = max(fits, default=(0, None))
        return best if n >= 2 else None

    def dumps(self) -> str:
        return json.dumps(self.mappings, sort_keys=True)

    @classmethod
    def loads(cls, text: str) -> FieldLibrary:
        return cls({s: {c: (u, float(p)) for c, (u, p) in m.items()} for s, m in json.loads(text).items()})
