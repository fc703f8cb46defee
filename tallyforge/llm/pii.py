"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them.

Base spans follow fixed patterns and always stay:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, each part at most 255
* card ``[0-9]([\\x20-]?[0-9])+``, 12 to 19 digits that pass Luhn's check
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 9 to 15 digits

each leftmost and non-overlapping within its kind; a match that fails its condition is dropped and not tried again.
The scans below find exactly these matches in time linear in the text, also on long runs of digits or letters.

Looser patterns propose further candidates (masked e-mail addresses, phone numbers without a country code, cards with
other separators or a failed check, IPv6).  Six labelers vote yes, no or abstain on every candidate: strict pattern,
checksum or range, gazetteer (country codes, issuer prefixes, top-level domains, address blocks), words before the
span, shape, and neighbouring characters.  Dawid-Skene EM over the counts of all vote patterns of the corpus gives each
labeler's reliability and each pattern's probability.  A logistic span classifier is trained on these
probabilities from a bounded sample and adds the candidates it accepts that touch no base span.

Scale: two scans without a shuffle of text.  EM sees one row for each distinct (kind, votes), at most 4 * 3^6, from
all candidates, partially aggregated; the classifier's sample is bounded by ``SAMPLE``.

Defined cases: null text is empty and has no spans; texts without digits, ``@`` or masked signs are skipped; offsets
are code points with the end exclusive; repeated rows are treated each; no rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.kernels import owner, pieces, texts
from tallyforge.plans.scratch import staged

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 8_000
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
MASKED = re.compile(r" ?(?:\(at\)|\[at\]|\{at\}|@) ?", re.I)
MASKED_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[A-Za-z0-9-]{1,63}){0,4}", re.I)
LOOSE = {
    "ip": re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./-]?[0-9]{4}){2}[ ./-]?[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?[ ./-]?[0-9]{3,4}[ ./-][0-9]{3,4}(?![0-9])"),
}
WORTH = np.zeros(256, bool)
WORTH[list(b"0123456789@")] = True
# Fixed values of the gazetteer labeler.
TOP_LEVEL = frozenset("com org net edu gov mil int info biz io dev app de fr es uk it nl eu us ca mx br jp cn in au ch at be se no dk fi pl pt test example".split())
COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
ISSUERS = ("34", "35", "36", "37", "38", "4", "50", "51", "52", "53", "54", "55", "56", "57", "58", "60", "62", "63", "64", "65", "67")
# Fixed values of the context labeler: words that speak for each kind, and words that speak for other numbers.
CONTEXT = {
    "email": frozenset("mail email e-mail contact write reply correo courriel kontakt mailto".split()),
    "ip": frozenset("ip host server address client from node gateway adresse direccion".split()),
    "card": frozenset("card credit visa mastercard amex payment debit karte carte tarjeta".split()),
    "phone": frozenset("phone call tel telephone mobile cell fax telefon telefono appel anruf".split()),
}
OTHER = frozenset("order invoice version isbn issn page serial token key hash id sku ref no nr section chapter figure".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _octet(digits: str) -> bool:
    """At most 255, with any number of zeros in front."""
    p = digits.lstrip("0")
    return len(p) < 3 or len(p) == 3 and p <= "255"


def emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, in order."""
    found = [(s, 0, e) for s, e in emails(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_octet, m.group().split(".")))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= m.end() - m.start() and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(found)


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates that touch no span of taken, nor each other."""
    found = []
    for m in MASKED.finditer(text):
        start = m.start()
        while start > 0 and m.start() - start < 64 and text[start - 1] in LOCAL:
            start -= 1
        d = MASKED_DOMAIN.match(text, m.end())
        if start < m.start() and d:
            found.append((start, 0, d.end()))
    for kind, pattern in LOOSE.items():
        found += [(m.start(), KINDS.index(kind), m.end()) for m in pattern.finditer(text)]
    out, end, busy = [], -1, sorted((s, e) for s, _, e in taken)
    k = 0
    for s, kind, e in sorted(found):
        while k < len(busy) and busy[k][1] <= s:
            k += 1
        if s >= end and not (k < len(busy) and busy[k][0] < e):
            out.append((s, kind, e))
            end = e
    return out


def votes(text: str, start: int, kind: int, end: int, base: bool) -> list[int]:
    """1 yes, -1 no, 0 abstain, by each labeler."""
    s, name = text[start:end], KINDS[kind]
    digits = _digits(s)
    before = re.findall(r"[^\W\d_][\w-]*", text[max(0, start - 48) : start].lower())[-5:]
    if name == "email":
        top = re.split(r"[^A-Za-z0-9-]+", s)[-1].lower()
        check = 1 if re.search(r"\.|dot", s.split("@")[-1], re.I) else -1
        gazette = 1 if top in TOP_LEVEL else 0
        shape = 1 if 5 <= len(s) <= 80 else -1
    elif name == "ip":
        check = (1 if all(map(_octet, s.split("."))) else -1) if "." in s else 1
        gazette = -1 if s.startswith(("0.", "1.0.0.", "2.0.0.")) else 1 if s.startswith(("10.", "172.", "192.168.", "127.", "fe80", "2001")) else 0
        shape = 1 if len(s) >= 7 else -1
    elif name == "card":
        check = 1 if 12 <= len(digits) <= 19 and luhn(digits) else -1
        gazette = 1 if digits.startswith(ISSUERS) else -1
        shape = 1 if len(digits) in (13, 15, 16, 19) else -1
    else:
        check = 1 if 9 <= len(digits) <= 15 else -1
        gazette = 1 if s.startswith("+") and any(digits[:k] in COUNTRY_CODES for k in (1, 2)) else 0
        shape = 1 if re.search(r"[() .-]", s) else -1
    context = 1 if CONTEXT[name] & set(before) else -1 if OTHER & set(before) else 0
    edge = text[start - 1 : start] + text[end : end + 1]
    beside = -1 if re.search(r"[\w@/#=]", edge) else 1
    return [1 if base else 0, check, gazette, context, shape, beside]


def features(text: str, start: int, kind: int, end: int, vote: list[int]) -> list[float]:
    s = text[start:end]
    n = max(1, len(s))
    return [1.0, *(float(kind == k) for k in range(4)), *map(float, vote[1:]), len(_digits(s)) / 16, len(s) / 32, sum(c.isalpha() for c in s) / n, sum(not c.isalnum() for c in s) / n]


def dawid_skene(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Probability of yes for each pattern of one kind; the yes class is the one the labelers call yes."""
    p = np.clip(0.5 + 0.12 * patterns.sum(1), 0.05, 0.95)
    for _ in range(rounds):
        prior = np.clip((counts * p).sum() / counts.sum(), 1e-4, 1 - 1e-4)
        logit = np.full(len(p), np.log(prior / (1 - prior)))
        for j in range(patterns.shape[1]):
            for v in (-1, 0, 1):
                here = patterns[:, j] == v
                yes, no = (counts * p)[here].sum() + 1, (counts * (1 - p))[here].sum() + 1
                logit[here] += np.log(yes / ((counts * p).sum() + 3)) - np.log(no / ((counts * (1 - p)).sum() + 3))
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return p


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Newton's method on soft labels."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _worthy(b: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    """Rows that can hold a span, with their text."""
    buf, off = texts(b.column("text"))
    rows = np.unique(owner(off, np.flatnonzero(WORTH[buf])))
    masked = np.flatnonzero(buf == 40) if len(buf) else rows
    masked = np.concatenate([masked, np.flatnonzero(buf == 91), np.flatnonzero(buf == 123)]).astype(np.int64)
    for i in np.union1d(rows, np.unique(owner(off, masked))):
        yield int(i), buf[off[i] : off[i + 1]].tobytes().decode()


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        kinds, all_votes, all_features = [], [], []
        for _, text in _worthy(b):
            base = base_spans(text)
            for span, strict in [(x, True) for x in base] + [(x, False) for x in loose_spans(text, base)]:
                vote = votes(text, *span, strict)
                kinds.append(span[1])
                all_votes.append(vote)
                all_features.append(features(text, *span, vote))
        if kinds:
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(all_votes, pa.list_(pa.int32())), pa.array(all_features, pa.list_(pa.float64()))], ["kind", "votes", "features"])


def fit(docs: DataFrame) -> tuple[np.ndarray | None, list[dict]]:
    """The span classifier's weights, and the probability of every vote pattern."""
    found = staged(docs.select("text").mapInArrow(_candidates, "kind int, votes array<int>, features array<double>"), "candidates")
    table = found.groupBy("kind", "votes").count().orderBy("kind", "votes").collect()
    if not table:
        return None, []
    soft: dict[tuple, float] = {}
    for kind in {r["kind"] for r in table}:
        own = [r for r in table if r["kind"] == kind]
        p = dawid_skene(np.array([r["votes"] for r in own]), np.array([r["count"] for r in own], float))
        soft |= {(kind, *r["votes"]): float(x) for r, x in zip(own, p, strict=True)}
    luck = F.pmod(F.xxhash64("kind", "votes", "features"), F.lit(1 << 30))
    share = int(min(1.0, 0.8 * SAMPLE / sum(r["count"] for r in table)) * (1 << 30))
    sample = found.select("kind", "votes", "features", luck.alias("luck")).where(F.col("luck") < share).orderBy("luck").limit(SAMPLE).collect()
    weights = logistic(np.array([r["features"] for r in sample]), np.array([soft[(r["kind"], *r["votes"])] for r in sample]))
    return weights, [{"kind": KINDS[r["kind"]], "votes": r["votes"], "count": r["count"], "p": soft[(r["kind"], *r["votes"])]} for r in table]


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, weights: np.ndarray | None, threshold: float = 0.5) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans`` for every document; the counts are of base spans."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            n, base_said, said = np.zeros((4, b.num_rows), np.int64), [""] * b.num_rows, [""] * b.num_rows
            for i, text in _worthy(b):
                base = base_spans(text)
                more = []
                for span in loose_spans(text, base) if weights is not None else []:
                    if np.dot(features(text, *span, votes(text, *span, False)), weights) > np.log(threshold / (1 - threshold)):
                        more.append(span)
                for _, kind, _ in base:
                    n[kind, i] += 1
                base_said[i], said[i] = _said(base), _said(sorted(base + more))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, n), pa.array(base_said), pa.array(said)], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def digest(docs: DataFrame) -> DataFrame:
    weights, _ = fit(docs)
    out = find(docs, weights)
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")
