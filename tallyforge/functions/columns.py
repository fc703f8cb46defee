"""Scalar functions as native column expressions: nothing here leaves the JVM.

Every function takes columns (or column names) and returns a column.  Dirty text never raises: what can't be
parsed becomes null.  Null in gives null out unless the docstring says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str
MONEY = "decimal(38,4)"

# Words that don't distinguish one organization from another.
LEGAL_WORDS = ["llc", "l\\.l\\.c", "inc", "incorporated", "corp", "corporation", "co", "company", "lp", "l\\.p", "llp", "l\\.l\\.p", "pllc", "p\\.l\\.l\\.c"]
# Words for true.
TRUE_WORDS = ["true", "yes", "y", "1", "t"]
PLEDGE_TRUE_WORDS = ["Y", "YES", "TRUE", "1"]

# Fixed value: what stands for null inside a hashed surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: ColumnOrName) -> Column:
    """Leading and trailing white space of any kind goes (trim() takes spaces only)."""
    return F.regexp_replace(_c(x).cast("string"), r"^\s+|\s+$", "")


def clean_str(x: ColumnOrName) -> Column:
    """Stripped text; empty becomes null."""
    return F.nullif(strip(x), F.lit(""))


def upper_str(x: ColumnOrName) -> Column:
    return F.upper(clean_str(x))


def clip(x: ColumnOrName, width: int) -> Column:
    return F.substring(_c(x), 1, width)


def tec_amount(x: ColumnOrName) -> Column:
    """Amounts with commas and dollar signs; exponents and words are null."""
    s = F.regexp_replace(strip(x), "[,$]", "")
    return F.when(s.rlike(r"^-?[0-9]+(\.[0-9]*)?$|^-?\.[0-9]+$"), s.try_cast(MONEY))


def builder_amount(x: ColumnOrName) -> Column:
    """What is left of digits, dots and minus signs, if it is a number."""
    s = F.regexp_replace(_c(x).cast("string"), r"[^0-9.\-]", "")
    return F.when(~s.isin("", ".", "-", "-."), s.try_cast(MONEY))


def safe_numeric(x: ColumnOrName, kind: str = MONEY) -> Column:
    s = strip(x)
    return F.when(s.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), s.try_cast(kind))


def _dated(s: Column, shape: str, form: str) -> Column:
    """try_to_date pads and truncates freely, so the shape is checked first."""
    return F.when(s.rlike(shape), F.try_to_date(s, form))


def tec_date(x: ColumnOrName) -> Column:
    """yyyyMMdd if eight digits, else ISO, else US order, with dashes or slashes; any year."""
    s = strip(x)
    iso = F.coalesce(_dated(s, r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"), _dated(s, r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"))
    us = F.coalesce(_dated(s, r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"), _dated(s, r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "M-d-yyyy"))
    return F.when(s.rlike(r"^[0-9]{8}$"), F.try_to_date(s, "yyyyMMdd")).otherwise(F.coalesce(iso, us))


def builder_date(x: ColumnOrName) -> Column:
    """As tec_date, also with a time of day, and years 1900 to 2100 only."""
    s = strip(x)
    us_time = F.when(s.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}:[0-9]{2}$"), F.try_to_date(F.split(s, " ")[0], "M/d/yyyy"))
    iso_time = F.when(s.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$"), F.try_to_date(F.split(s, "T")[0], "yyyy-M-d"))
    d = F.coalesce(tec_date(s), us_time, iso_time)
    return F.when(F.year(d).between(1900, 2100), d)


def pledge_date(x: ColumnOrName) -> Column:
    """Three formats: yyyyMMdd, ISO with dashes, US with slashes."""
    s = strip(x)
    return F.coalesce(_dated(s, r"^[0-9]{8}$", "yyyyMMdd"), _dated(s, r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"), _dated(s, r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"))


def safe_date(x: ColumnOrName) -> Column:
    """Eight digits, or an ISO prefix."""
    s = strip(x)
    return F.coalesce(_dated(s, r"^[0-9]{8}$", "yyyyMMdd"), F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd")))


def bool_expr(x: ColumnOrName) -> Column:
    """True for the usual words; null and anything else are false."""
    return F.coalesce(F.lower(strip(x)).isin(TRUE_WORDS), F.lit(False))


def pledge_flag(x: ColumnOrName) -> Column:
    return F.coalesce(F.upper(strip(x)).isin(PLEDGE_TRUE_WORDS), F.lit(False))


def normalize_entity_name(x: ColumnOrName, empty_as_null: bool = False) -> Column:
    """Lower case, runs of anything but a-z and 0-9 become one space; null becomes '' (or null)."""
    s = F.trim(F.regexp_replace(F.lower(strip(x)), "[^a-z0-9]+", " "))
    return F.nullif(s, F.lit("")) if empty_as_null else F.coalesce(s, F.lit(""))


def normalize_org_name(x: ColumnOrName) -> Column:
    """Lower case without legal words, wherever they stand, and without punctuation; null becomes ''.

    ``&`` counts as "and" only directly between word characters, as in AT&T; elsewhere it is punctuation.
    """
    s = F.lower(strip(x))
    s = F.regexp_replace(s, r"\b(and|&)\b", " and ")
    s = F.regexp_replace(s, r"\b(" + "|".join(LEGAL_WORDS) + r")\b", " ")
    s = F.regexp_replace(s, r"[^\p{L}\p{N}_\s]", " ")
    return F.coalesce(F.trim(F.regexp_replace(s, r"\s+", " ")), F.lit(""))


def full_name(first: ColumnOrName, middle: ColumnOrName, last: ColumnOrName, suffix: ColumnOrName, organization: ColumnOrName) -> Column:
    """The organization if there is one, else the parts that are not blank; '' if there is nothing."""
    return F.coalesce(clean_str(organization), F.concat_ws(" ", *(clean_str(p) for p in (first, middle, last, suffix))))


def person_addr_key(street: ColumnOrName, city: ColumnOrName, state: ColumnOrName, zip_code: ColumnOrName) -> Column:
    """``street|city|state|zip`` in lower case but for the zip, if at least two of the four are there."""
    parts = [F.lower(clean_str(p)) for p in (street, city, state)] + [clean_str(zip_code)]
    there = reduce(lambda a, b: a + b, (p.isNotNull().cast("int") for p in parts))
    return F.when(there >= 2, F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts)))


def one_line_address(*parts: ColumnOrName) -> Column:
    return F.concat_ws(", ", *(clean_str(p) for p in parts))


def collapse_for_org(organization: ColumnOrName, key: ColumnOrName) -> Column:
    """A person's key, null for organizations."""
    return F.when(clean_str(organization).isNull(), _c(key))


def state_code(x: ColumnOrName) -> Column:
    s = upper_str(x)
    return F.when(s.rlike("^[A-Z]{2}$"), s)


def person_type(organization: ColumnOrName, first: ColumnOrName, last: ColumnOrName, placeholders: list[str] | None = None) -> Column:
    org = clean_str(organization)
    placeholder = F.upper(org).isin(placeholders) if placeholders else F.lit(False)
    rule = F.when(F.coalesce(placeholder, F.lit(False)), "UNKNOWN").when(org.isNotNull(), "ORGANIZATION")
    return rule.when(clean_str(first).isNotNull() & clean_str(last).isNotNull(), "INDIVIDUAL").otherwise("UNKNOWN")


def zip3(x: ColumnOrName) -> Column:
    return F.substring(strip(x), 1, 3)


def first_initial(x: ColumnOrName) -> Column:
    return F.lower(F.substring(strip(x), 1, 1))


def blocking_key(*parts: ColumnOrName) -> Column:
    """Parts in lower case joined by ``|``; null if any is blank."""
    cleaned = [F.lower(clean_str(p)) for p in parts]
    return F.when(reduce(lambda a, b: a & b, (p.isNotNull() for p in cleaned)), F.concat_ws("|", *cleaned))


def name_completeness(*parts: ColumnOrName) -> Column:
    return reduce(lambda a, b: a + b, (clean_str(p).isNotNull().cast("int") for p in parts))


def office_normalized(x: ColumnOrName) -> Column:
    return F.nullif(F.lower(strip(x)), F.lit(""))


def year_of(x: ColumnOrName) -> Column:
    return F.substring(_c(x).cast("string"), 1, 4).try_cast("int")


def zip_format(x: ColumnOrName) -> Column:
    """Five digits, or five and four with a dash; four digits get a leading zero; else null."""
    d = F.regexp_replace(strip(x), "[^0-9]", "")
    return F.when(F.length(d) == 4, F.concat(F.lit("0"), d)).when(F.length(d) == 5, d).when(F.length(d) == 9, F.concat(F.substring(d, 1, 5), F.lit("-"), F.substring(d, 6, 4)))


def phone_e164(x: ColumnOrName, country: str = "1") -> Column:
    """``+`` and digits for national numbers of ten digits and international ones of 8 to 15; else null."""
    s = strip(x)
    d = F.regexp_replace(s, "[^0-9]", "")
    own = d.rlike("^[2-9][0-9]{9}$")
    return F.when(s.startswith("+") & F.length(d).between(8, 15), F.concat(F.lit("+"), d)).when(own, F.concat(F.lit("+" + country), d)).when(d.rlike("^" + country + "[2-9][0-9]{9}$"), F.concat(F.lit("+"), d))


def blank_to_null(x: ColumnOrName) -> Column:
    """Blank, a lone quote and the word null count as nothing."""
    s = clean_str(x)
    return F.when(~F.lower(s).isin('"', "null"), s)


def static_key(*parts: ColumnOrName) -> Column:
    """The first 16 hex digits of a SHA-256 over the parts joined by ``_``."""
    return F.substring(F.sha2(F.concat_ws("_", *(_c(p).cast("string") for p in parts)), 256), 1, 16)


def file_origin_key(state: ColumnOrName, filename: ColumnOrName) -> Column:
    return F.sha2(F.concat(_c(state), F.lit(":"), _c(filename)), 256)


def surrogate_key(*parts: ColumnOrName) -> Column:
    return F.md5(F.concat_ws("-", *(F.coalesce(_c(p).cast("string"), F.lit(NULL_KEY)) for p in parts)))


def canonical_entity_type(x: ColumnOrName) -> Column:
    """Vendors and others are organizations; a campaign is not an entity and raises."""
    s = F.lower(strip(x))
    return F.when(s.isin("vendor", "other"), "organization").when(s == "campaign", F.raise_error(F.lit("a campaign is not a canonical entity"))).otherwise(s)


def first_name_conflict(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Two first names of two letters or more that differ in their first letter and are no prefix of each other."""
    x, y = (F.coalesce(F.lower(strip(v)), F.lit("")) for v in (a, b))
    both = (F.length(x) >= 2) & (F.length(y) >= 2)
    return both & ~F.startswith(x, y) & ~F.startswith(y, x) & (F.substring(x, 1, 1) != F.substring(y, 1, 1))


def match_probability(*factors: ColumnOrName) -> Column:
    """b / (1 + b) for the product b of the positive factors, clamped to [0, 1]."""
    log = reduce(lambda a, b: a + b, (F.when(_c(f) > 0, F.ln(_c(f))).otherwise(F.lit(0.0)) for f in factors))
    b = F.exp(F.least(log, F.lit(700.0)))
    return clamp(b / (1 + b))


def clamp(x: ColumnOrName) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _c(x)))


def pair(a: Column, b: Column) -> tuple[Column, Column]:
    """An unordered pair as (least, greatest); structs compare field by field."""
    return F.least(a, b), F.greatest(a, b)


def json_sorted(x: ColumnOrName) -> Column:
    """A flat JSON object of scalars with its keys in order, so equal objects have equal text."""
    entries = F.array_sort(F.map_entries(F.from_json(_c(x), "map<string,string>")))
    return F.to_json(F.map_from_entries(entries))


def currency(x: ColumnOrName) -> Column:
    return F.concat(F.lit("$"), F.format_number(_c(x), 2))


def raw_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns))


def split_full_name(x: ColumnOrName) -> Column:
    """The first word, and the rest or null."""
    s = F.regexp_replace(clean_str(x), r"\s+", " ")
    return F.struct(F.substring_index(s, " ", 1).alias("first"), F.when(s.contains(" "), F.regexp_replace(s, r"^[^ ]+ ", "")).alias("rest"))


def oklahoma_zip(x: ColumnOrName) -> Column:
    """zip5 and zip4 of a US code; anything else is foreign and kept as it is."""
    s = clean_str(x)
    us = s.rlike("^[0-9]{5}(-?[0-9]{4})?$")
    return F.struct(F.when(us, F.substring(s, 1, 5)).alias("zip5"), F.when(us & (F.length(s) > 5), F.substring(F.regexp_replace(s, "-", ""), 6, 4)).alias("zip4"), F.when(~us, s).alias("foreign"))


def transaction_type(declared: ColumnOrName, record_type: ColumnOrName) -> Column:
    """From a declared word, then from the record type, else OTHER."""
    d, r = F.upper(strip(declared)), F.upper(strip(record_type))
    out = F.lit(None).cast("string")
    kinds = ["CONTRIBUTION", "EXPENDITURE", "LOAN", "DEBT", "PLEDGE", "CREDIT", "TRAVEL", "ASSET"]
    for k in reversed(kinds):
        out = F.when(d.contains(k), k).otherwise(out)
    out = F.when(d.isin("DONATION", "RECEIPT"), "CONTRIBUTION").when(d.isin("PAYMENT", "EXPENSE"), "EXPENDITURE").otherwise(out)
    by_record = {"RCPT": "CONTRIBUTION", "EXPN": "EXPENDITURE", "LOAN": "LOAN", "DEBT": "DEBT", "PLDG": "PLEDGE", "CRED": "CREDIT", "TRVL": "TRAVEL", "ASSET": "ASSET"}
    from_record = F.create_map(*[F.lit(v) for kv in by_record.items() for v in kv])[r]
    return F.coalesce(out, from_record, F.lit("OTHER"))
