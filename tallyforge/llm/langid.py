"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Gates use the piecewise linear sigmoid ``clip(x/4 + 1/2, 0, 1)`` and candidates ``x / (1 + |x|)``,
which cost a quarter of exact ones in numpy.  The network reads segments of ``SEGMENT`` bytes in both directions, labels every byte position
with a distribution over languages, and a document's probabilities are the mean over all its
positions.  It is trained by backpropagation through time on a bounded sample: at most
2 * ``sample_docs`` labelled rows (about ``sample_docs``, as luck has it) with one passage of at most ``PASSAGE``
characters each, spread evenly over the ``max_langs`` most frequent languages.  Prediction reads every byte of every document.

Scale: after two small training jobs the prediction is one scan without a shuffle; the model
(a few kB) travels with the tasks.  Rows of any length are cut into segments, so memory depends
on the batch and not on the longest text.

``fit_sieve`` trains the same network with one more output, for text in no language, on as much gibberish as text, and
``in_no_language`` judges texts of any length by it.  How sure the network is of one language says nothing there: languages
that are hard to tell apart share their probability, while gibberish may look like one of them.

Defined cases: null text, or text without a letter, is ``und`` with score 0; without labelled
rows every row is ``und``; a null id counts as empty text for the fold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.kernels import pieces, texts

SEGMENT = 128
PASSAGE = 1200
STEP = np.float32
#: So many neighbouring bytes are one witness for or against a language.
WITNESS = 16
#: First code point and length of a run of letters, script by script.
SCRIPTS = [(0x3B1, 25), (0x430, 32), (0x561, 38), (0x5D0, 27), (0x628, 35), (0x905, 53), (0xE01, 46), (0x10D0, 33), (0x3041, 86), (0x4E00, 20902), (0xAC00, 11172)]


def fold(id_col: str, folds: int) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0)) % folds


def glorot(rng: np.random.Generator, *shape: int) -> np.ndarray:
    return (rng.standard_normal(shape) * np.sqrt(2.0 / sum(shape))).astype(STEP)


def new_model(n_out: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {"b": np.zeros((n_out, 1), STEP)}
    for d in "fb":
        model |= {f"x{d}": glorot(rng, 3 * hidden, 256) * 2, f"u{d}": glorot(rng, 3 * hidden, hidden), f"c{d}": np.zeros((3 * hidden, 1), STEP), f"w{d}": glorot(rng, n_out, hidden)}
    return model


def _forward(model: dict[str, np.ndarray], d: str, steps: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states after each step, and what the backward pass needs."""
    x, u, c = model[f"x{d}"], model[f"u{d}"], model[f"c{d}"]
    n, h = u.shape[1], np.zeros((u.shape[1], steps.shape[1]), STEP)
    states, tape = np.empty((len(steps), *h.shape), STEP), []
    for t, byte in enumerate(steps):
        a, g = x[:, byte], u @ h + c
        zr = np.clip(0.25 * (a[: 2 * n] + g[: 2 * n]) + 0.5, 0, 1)
        raw = a[2 * n :] + zr[n:] * g[2 * n :]
        new = raw / (1 + np.abs(raw))
        tape.append((h, zr, g[2 * n :], new))
        states[t] = h = new + zr[:n] * (h - new)
    return states, tape


def _backward(model: dict[str, np.ndarray], d: str, steps: np.ndarray, tape: list, into: np.ndarray, grad: dict[str, np.ndarray]) -> None:
    u = model[f"u{d}"]
    n = u.shape[1]
    dh = np.zeros_like(into[0])
    das = np.empty((len(steps), 3 * n, dh.shape[1]), STEP)
    for t in range(len(steps) - 1, -1, -1):
        h, zr, gn, new = tape[t]
        z, r = zr[:n], zr[n:]
        dh = dh + into[t]
        da = das[t]
        dn = dh * (1 - z) * (1 - np.abs(new)) ** 2
        open_ = (zr > 0) & (zr < 1)
        da[:n] = dh * (h - new) * 0.25 * open_[:n]
        da[n : 2 * n] = dn * gn * 0.25 * open_[n:]
        da[2 * n :] = dn
        dg = da.copy()
        dg[2 * n :] *= r
        grad[f"u{d}"] += dg @ h.T
        grad[f"c{d}"] += dg.sum(1, keepdims=True)
        dh = dh * z + u.T @ dg
    flat = steps.reshape(-1)
    for k in range(3 * n):
        grad[f"x{d}"][k] += np.bincount(flat, das[:, k].reshape(-1), 256)


def train(segments: np.ndarray, labels: np.ndarray, n_out: int, hidden: int = 6, rounds: int = 200, batch: int = 128, rate: float = 0.02, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam over random batches of (segments, bytes); every position has its segment's label."""
    model, rng = new_model(n_out, hidden, seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in model.items()}
    s = {k: np.zeros_like(v) for k, v in model.items()}
    for i in range(1, rounds + 1):
        pick = rng.integers(0, len(segments), batch)
        steps, y = np.ascontiguousarray(segments[pick].T), labels[pick]
        sf, tf = _forward(model, "f", steps)
        sb, tb = _forward(model, "b", steps[::-1])
        p = np.exp(model["wf"] @ sf + model["wb"] @ sb[::-1] + model["b"])
        p /= p.sum(1, keepdims=True)
        p[:, y, np.arange(batch)] -= 1
        p *= (steps != 0)[:, None, :] / np.float32(max(1, (steps != 0).sum()))
        grad = {k: np.zeros_like(v) for k, v in model.items()}
        grad["b"] = p.sum((0, 2))[:, None]
        grad["wf"] = np.einsum("tos,ths->oh", p, sf)
        grad["wb"] = np.einsum("tos,ths->oh", p, sb[::-1])
        _backward(model, "f", steps, tf, model["wf"].T @ p, grad)
        _backward(model, "b", steps[::-1], tb, (model["wb"].T @ p)[::-1], grad)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m[k] += 0.1 * (g - m[k])
            s[k] += 0.01 * (g * g - s[k])
            lr = rate * min(1.0, 2 * (1 - i / (rounds + 1)))
            model[k] = (model[k] - lr * (m[k] / (1 - 0.9**i)) / (np.sqrt(s[k] / (1 - 0.99**i)) + 1e-8)).astype(STEP)
    return model


class Reader:
    """The trained network laid out for prediction: gate scales are folded in and buffers reused."""

    def __init__(self, model: dict[str, np.ndarray], width: int = 2048):
        self.out, self.width, self.parts = model["b"], width, {}
        for d in "fb":
            n = model[f"u{d}"].shape[1]
            scale = np.ones((3 * n, 1), STEP)
            scale[: 2 * n] = 0.25
            x, u, c = model[f"x{d}"] * scale, model[f"u{d}"] * scale, model[f"c{d}"] * scale
            x[: 2 * n] += 0.5 + c[: 2 * n]
            self.parts[d] = (x.astype(STEP), u.astype(STEP), c[2 * n :].astype(STEP), model[f"w{d}"], n)

    def _read(self, d: str, steps: np.ndarray) -> Iterator[np.ndarray]:
        x, u, c, _, n = self.parts[d]
        h = np.zeros((n, steps.shape[1]), STEP)
        a, g, new, raw = np.empty((3 * n, steps.shape[1]), STEP), np.empty((3 * n, steps.shape[1]), STEP), np.empty_like(h), np.empty_like(h)
        for byte in steps:
            np.take(x, byte, axis=1, out=a, mode="clip")
            np.matmul(u, h, out=g)
            zr = a[: 2 * n]
            zr += g[: 2 * n]
            np.clip(zr, 0, 1, out=zr)
            np.add(g[2 * n :], c, out=new)
            new *= zr[n:]
            new += a[2 * n :]
            np.abs(new, out=raw)
            raw += 1
            new /= raw
            h -= new
            h *= zr[:n]
            h += new
            yield h

    def sums(self, steps: np.ndarray) -> np.ndarray:
        """(languages, segments): the positions' probabilities summed over each segment."""
        (*_, wf, n), (*_, wb, _) = self.parts["f"], self.parts["b"]
        states = np.empty((len(steps), n, steps.shape[1]), STEP)
        for t, h in enumerate(self._read("f", steps)):
            states[t] = h
        total = np.zeros((len(self.out), steps.shape[1]), STEP)
        for t, h in enumerate(self._read("b", steps[::-1])):
            p = wf @ states[-1 - t]
            p += wb @ h
            p += self.out
            np.exp(p, out=p)
            p *= (steps[-1 - t] != 0) / p.sum(0)
            total += p
        return total

    def documents(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(documents, languages): the mean over all positions; zeros for empty texts."""
        size = np.diff(off)
        count = -(-size // SEGMENT)
        doc = np.repeat(np.arange(len(size)), count)
        start = off[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * SEGMENT
        total = np.zeros((len(size), len(self.out)))
        buf = np.where(buf == 0, np.uint8(32), buf)
        buf = np.append(buf, np.zeros(1, np.uint8))
        for i in range(0, len(doc), self.width):
            at = start[i : i + self.width] + np.arange(SEGMENT)[:, None]
            steps = buf[np.where(at < off[1:][doc[i : i + self.width]], at, len(buf) - 1)]
            sums = self.sums(steps)
            for k in range(len(self.out)):
                total[:, k] += np.bincount(doc[i : i + self.width], sums[k], len(size))
        return total / np.maximum(total.sum(1, keepdims=True), 1e-9)


def segments_of(passages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Segments as rows of bytes, zero at the end, and the passage of each."""
    rows, at = [], []
    for i, text in enumerate(passages):
        raw = text.encode().replace(b"\0", b" ")
        for j in range(0, len(raw), SEGMENT):
            rows.append(np.frombuffer(raw[j : j + SEGMENT].ljust(SEGMENT, b"\0"), np.uint8))
            at.append(i)
    return np.array(rows, np.uint8).reshape(len(rows), SEGMENT), np.array(at, np.int64)


def _passages(labelled: DataFrame, sample_docs: int, max_langs: int, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """Language and passage of the sampled rows, in an order of their own."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(max_langs).collect()}
    if not counts:
        return []
    share = sample_docs / len(counts)
    odds = F.coalesce(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.3 * share / n))])[F.col(lang_col)], F.lit(0.0))
    luck = F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1 << 30))
    passage = F.substring(F.col(text_col), (F.pmod(luck, F.greatest(F.length(text_col) - PASSAGE, F.lit(0)) + 1) + 1).cast("int"), F.lit(PASSAGE))
    sample = rows.where(luck < odds * float(1 << 30)).select(luck.alias("luck"), F.col(lang_col).alias("lang"), passage.alias("passage")).orderBy("luck", "lang", "passage").limit(2 * sample_docs).collect()
    return [(r["lang"], r["passage"]) for r in sample]


def fit(labelled: DataFrame, sample_docs: int = 1600, max_langs: int = 256, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options: float) -> tuple[list[str], dict[str, np.ndarray] | None]:
    """Languages and model, from rows whose text and language are not null."""
    sample = _passages(labelled, sample_docs, max_langs, id_col, text_col, lang_col)
    langs = sorted({x for x, _ in sample})
    segs, at = segments_of([x for _, x in sample])
    if not len(segs):
        return [], None
    return langs, train(segs, np.array([langs.index(x) for x, _ in sample])[at], len(langs), **options)


def gibberish(passages: list[str], seed: int = 7) -> list[str]:
    """A text in no language for each passage: its characters shuffled, its letters drawn anew from those of all passages, any
    printable ASCII, or its letters replaced by those of a script that no passage uses."""
    rng = np.random.default_rng(seed)
    own = np.array(sorted({ord(c) for p in passages for c in p if c.isalpha()}), np.int64)
    strange = [(low, n) for low, n in SCRIPTS if not ((own >= low) & (own < low + n)).any()]
    out = []
    for p in passages:
        codes, letter, kind = np.array([ord(c) for c in p], np.int64), np.array([c.isalpha() for c in p], bool), rng.integers(4)
        if kind == 0:
            rng.shuffle(codes)
        elif kind == 1 and len(own):
            codes[letter] = rng.choice(own, int(letter.sum()))
        elif kind == 3 and strange:
            low, n = strange[rng.integers(len(strange))]
            codes[letter] = low + rng.integers(0, n, int(letter.sum()))
        else:
            gap = rng.random(len(codes)) < 0.15 * rng.integers(2)
            codes = np.where(gap, 32, rng.integers(33, 127, len(codes)))
        out.append("".join(map(chr, codes)))
    return out


def fit_sieve(labelled: DataFrame, sample_docs: int = 1600, max_langs: int = 256, hidden: int = 8, rounds: int = 400, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options: float) -> tuple[dict[str, np.ndarray], np.ndarray] | None:
    """A network with one more output, for text in no language, and the room that each language's texts get; None without a
    labelled row.  Every language has as many passages as the most frequent one, repeated if need be, and gibberish as many as
    all.  Each eighth passage of a language is kept from training: at most one in 100 of these may be rejected, or the room grows.
    A language of under eight passages gets all room."""
    sample = _passages(labelled, sample_docs, max_langs, id_col, text_col, lang_col)
    if not sample:
        return None
    langs, kept, own = sorted({x for x, _ in sample}), [], []
    for k in langs:
        at = [p for x, p in sample if x == k]
        kept.append(at[7::8])
        own.append([p for i, p in enumerate(at) if i % 8 != 7])
    most = max(map(len, own))
    real = [x[i % len(x)] for x in own for i in range(most)]
    segs, at = segments_of(real + gibberish(real))
    model = train(segs, np.repeat(np.arange(len(langs) + 1), [*[most] * len(langs), len(real)])[at], len(langs) + 1, hidden=hidden, rounds=rounds, **options)
    reader = Reader(model)
    over = [np.sort(excess(reader.documents(*texts(pa.array(x, pa.string())))[:, -1], np.array([len(p.encode()) for p in x]))) for x in kept]
    return model, np.array([max(0.0, x[-1 - len(x) // 100]) if len(x) else np.inf for x in over])


def excess(none: np.ndarray, size: np.ndarray) -> np.ndarray:
    """By how much the share of no language is above one half and a margin, two standard errors of the mean over ``size`` bytes
    at their most, if ``WITNESS`` neighbours count as one."""
    return none - 0.5 - np.sqrt(WITNESS / np.maximum(size, 1))


def in_no_language(text: Column, sieve: tuple[dict[str, np.ndarray], np.ndarray]) -> Column:
    """Whether the sieve rejects a text, from all its bytes."""
    model, room = sieve

    def read(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(model)
        for c in columns:
            out = [np.zeros(0, bool)]
            for b in pieces([pa.RecordBatch.from_arrays([c], ["text"])]):
                buf, off = texts(b.column("text"))
                p = reader.documents(buf, off)
                out.append(excess(p[:, -1], np.diff(off)) > room[p[:, :-1].argmax(1)])
            yield pa.array(np.concatenate(out))

    return F.arrow_udf(read, T.BooleanType())(text)


def predict(docs: DataFrame, langs: list[str], model: dict[str, np.ndarray] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held, lang_pred, score`` for each row."""
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col("held"), F.when(letters, F.col(text_col)).alias("text"), letters.alias("letters"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model) if model else None
        for b in pieces(batches):
            ok = b.column("letters").to_numpy(zero_copy_only=False)
            p = reader.documents(*texts(b.column("text"))) if reader else np.zeros((b.num_rows, 1))
            best = p.argmax(1)
            ok = ok & (p.max(1) > 0)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held"), pa.array([langs[k] if y else "und" for k, y in zip(best, ok, strict=True)], pa.string()), pa.array(np.where(ok, np.minimum(p.max(1), 1.0), 0.0))], ["id", "held", "lang_pred", "score"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("held", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(read, schema).withColumnRenamed("id", id_col)


def learn(docs: DataFrame, folds: int = 4, held: int = 2, **options: float) -> tuple[list[str], dict[str, np.ndarray] | None]:
    """Languages and model from all folds but ``held``."""
    return fit(docs.select("doc_id", "text", "lang").where(fold("doc_id", folds) != held), **options)


def learn_sieve(docs: DataFrame, folds: int = 4, held: int = 2, **options: float) -> tuple[dict[str, np.ndarray], np.ndarray] | None:
    """The sieve of all folds but ``held``."""
    return fit_sieve(docs.select("doc_id", "text", "lang").where(fold("doc_id", folds) != held), **options)


def identify(docs: DataFrame, folds: int = 4, held: int = 2, **options: float) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learns from the other folds, predicts all rows."""
    langs, model = learn(docs, folds, held, **options)
    return predict(docs.select("doc_id", "text", (fold("doc_id", folds) == held).alias("held")), langs, model).withColumnRenamed("held", "held_out")
