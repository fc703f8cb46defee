"""Language-model scoring with a hidden Markov model trained by Baum-Welch.

Tokens are words (A-Z as a-z) and one end for each document.  A hidden state emits a word's class (one of
``CLASSES`` by hash, and a class for the end), and the class emits the word by its smoothed share of the class's
training tokens, with one slot for unknown words in every class.  So the state tables have a fixed size at any
corpus size, while word counts cover the whole vocabulary.

* Counting: every training word is counted, partially aggregated in each task.
* Training: at most 600 passages of 2,500 characters at hashed offsets give starting values; then each of ``ROUNDS``
  Baum-Welch rounds reads all training text and adds up expected counts across partitions.  Texts are read in segments of
  ``SEGMENT`` tokens: a segment that goes on from another starts from the states' mean occupancy, and counts no start and
  no move between the two.
* Scoring: the scaled forward recursion runs over the whole text of a document, so its likelihood is exact; the
  documents of a block take their steps together.

Looking up counts at scale: each scan task gathers documents into blocks of about ``BLOCK`` bytes and asks once for
each distinct word of a block.  Requests travel as sorted arrays, one for each block and range of word hashes, and
meet that range of the vocabulary in a cogroup; ranges hold about ``RANGE`` words, and where many blocks ask, blocks
are spread over several copies of the range, so no group grows with the corpus.  Nothing is broadcast but the state
tables and class totals, whose size is fixed.

Defined cases: null text is empty and has the end token only; without training documents every count is 0 and the
base score is 0; a null id is in the training fold like an empty string's; words are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.kernels import U, mix, pieces, signed, texts, words
from tallyforge.llm.langid import fold
from tallyforge.plans.scratch import staged

STATES, CLASSES, ROUNDS, SEGMENT = 8, 1 << 14, 3, 128
BLOCK, RANGE, ASKED = 8 << 20, 500_000, 4_000_000
END = -1


def class_of(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ U(0x94D049BB133111EB)) >> U(50)).astype(np.int64) % CLASSES


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    docs = size = 0

    def out() -> pa.RecordBatch:
        w, c = np.unique(np.concatenate([*held, np.full(docs, END, np.int64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(w), pa.array(c)], ["w", "c"])

    for b in pieces(batches):
        h = signed(words(*texts(b.column("text")))[2])
        held.append(np.where(h == END, 0, h))
        docs, size = docs + b.num_rows, size + len(h)
        if size > 2_000_000:
            yield out()
            held, docs, size = [], 0, 0
    if docs:
        yield out()


def vocabulary(train: DataFrame) -> DataFrame:
    """``(w, c)`` for every distinct training token; the end is -1."""
    return train.mapInArrow(_count, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


class Model:
    """Start, transition and emission probabilities; class CLASSES is the end."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, usual: np.ndarray | None = None):
        self.start, self.move, self.emit = start, move, emit
        self.usual = np.full(len(start), 1 / len(start)) if usual is None else usual

    @classmethod
    def random(cls, usual: np.ndarray, seed: int = 3) -> Model:
        rng = np.random.default_rng(seed)
        emit = usual[:, None] * np.exp(rng.standard_normal((len(usual), STATES)))
        return cls(np.full(STATES, 1 / STATES), 0.9 * np.eye(STATES) + 0.1 / STATES, emit / emit.sum(0))

    @classmethod
    def counted(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, usual: np.ndarray, strength: float = 20.0) -> Model:
        held = emit.sum(0) + 0.1
        emit = emit + strength * usual[:, None]
        return cls((start + 0.1) / (start + 0.1).sum(), (move + 0.1) / (move + 0.1).sum(1, keepdims=True), emit / emit.sum(0), held / held.sum())

    def expect(self, steps: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected start, transition and emission counts of (time, segments) classes; -1 is padding at the end.

        ``first`` tells which segments begin a text."""
        live = steps >= 0
        e = self.emit[np.where(live, steps, 0)]
        e[~live] = 1.0
        alpha, scale = np.empty_like(e), np.empty(steps.shape)
        a = np.where(first[:, None], self.start, self.usual) * e[0]
        for t in range(len(steps)):
            if t:
                a = (a @ self.move) * e[t]
            scale[t] = a.sum(1)
            a = a / scale[t][:, None]
            alpha[t] = a
        move, gamma = np.zeros_like(self.move), np.empty_like(e)
        beta = np.ones_like(a)
        gamma[-1] = alpha[-1]
        for t in range(len(steps) - 2, -1, -1):
            ahead = e[t + 1] * beta / scale[t + 1][:, None]
            move += self.move * (alpha[t].T @ (ahead * live[t + 1][:, None]))
            beta = np.where(live[t + 1][:, None], ahead @ self.move.T, 1.0)
            gamma[t] = alpha[t] * beta
        gamma /= np.maximum(gamma.sum(2, keepdims=True), 1e-300)
        at = steps[live]
        emit = np.stack([np.bincount(at, gamma[:, :, k][live], CLASSES + 1) for k in range(STATES)], 1)
        return gamma[0][first].sum(0), move, emit

    def log10(self, classes: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Exact log10 likelihood of each sequence classes[edge[i]:edge[i+1]], by the scaled forward recursion."""
        size = np.diff(edge)
        order = np.argsort(-size, kind="stable")
        first, size = edge[:-1][order], size[order]
        total = np.zeros(len(order))
        n = int(np.searchsorted(-size, 0))
        a = self.start * self.emit[classes[first[:n]]]
        for t in range(int(size[0]) if len(size) else 0):
            if t:
                n = int(np.searchsorted(-size, -t))
                a = (a[:n] @ self.move) * self.emit[classes[first[:n] + t]]
            s = a.sum(1)
            a /= s[:, None]
            total[:n] += np.log10(s)
        out = np.empty(len(order))
        out[order] = total
        return out


def _sequences(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the tokens of each row, the end included, and offsets."""
    _, _, h, row = words(*texts(b.column("text")))
    edge = np.searchsorted(row, np.arange(b.num_rows + 1))
    return np.insert(class_of(h), edge[1:], CLASSES), edge + np.arange(b.num_rows + 1)


def _segments(classes: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(SEGMENT, segments), padded with -1, and which of them begin a text."""
    count = -(-np.diff(edge) // SEGMENT)
    doc = np.repeat(np.arange(len(count)), count)
    start = edge[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * SEGMENT
    at = start + np.arange(SEGMENT)[:, None]
    return np.where(at < edge[1:][doc], np.append(classes, -1)[np.minimum(at, len(classes))], -1), start == edge[:-1][doc]


def _start(train: DataFrame, usual: np.ndarray, n: int, sample: int = 600, passage: int = 2500, rounds: int = 25) -> Model:
    """Starting values from at most ``sample`` passages."""
    luck = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    at = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.greatest(F.length("text") - passage, F.lit(0)) + 1).cast("int")
    rows = train.where(luck < int(min(1.0, 1.5 * sample / max(n, 1)) * (1 << 30)))
    rows = rows.select(luck.alias("luck"), F.substring("text", at + 1, F.lit(passage)).alias("text"), at.alias("at")).orderBy("luck", "text").limit(sample).toArrow()
    model = Model.random(usual)
    if rows.num_rows:
        steps, first = _segments(*_sequences(pa.RecordBatch.from_arrays([rows.column("text").combine_chunks()], ["text"])))
        first[first] = rows.column("at").to_numpy() == 0
        for _ in range(rounds):
            model = Model.counted(*model.expect(steps, first), usual)
    return model


def baum_welch(train: DataFrame, model: Model, usual: np.ndarray) -> Model:
    """One round over all training text."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES + 1, STATES))
        for b in pieces(batches):
            steps, first = _segments(*_sequences(b))
            for at in range(0, steps.shape[1], 512):
                s, m, e = model.expect(steps[:, at : at + 512], first[at : at + 512])
                start += s
                move += m
                emit += e
        seen = np.flatnonzero(emit.any(1))
        counts = np.concatenate([start[None], move, emit[seen]])
        keys = np.concatenate([[-1], -2 - np.arange(STATES), seen])
        yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(counts[:, k]) for k in range(STATES))], ["key", *(f"s{k}" for k in range(STATES))])

    fields = ", ".join(f"s{k} double" for k in range(STATES))
    got = train.mapInArrow(expect, f"key long, {fields}").groupBy("key").agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(STATES))).orderBy("key").toArrow()
    key, value = got.column("key").to_numpy(), np.stack([got.column(f"s{k}").to_numpy() for k in range(STATES)], 1)
    start, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES + 1, STATES))
    start[:] = value[key == -1].sum(0)
    move[-2 - key[key < -1]] = value[key < -1]
    emit[key[key >= 0]] = value[key >= 0]
    return Model.counted(start, move, emit, usual)


def _blocks(model: Model, deficit: np.ndarray, n_ranges: int):
    """Blocks of documents: rows of kind 0 are documents, rows of kind 1 requests for the counts of sorted words."""

    def block(number: int, held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        h = np.concatenate([x[1] for x in held])
        distinct, local = np.unique(h, return_inverse=True)
        counts = np.concatenate([np.bincount(row, minlength=b.num_rows) for b, _, row in held])
        stops = np.cumsum(counts)
        classes = class_of(h)
        docs = np.repeat(np.arange(len(counts)), counts)
        scores = model.log10(np.insert(classes, stops, CLASSES), np.concatenate(([0], stops)) + np.arange(len(counts) + 1)) - np.bincount(docs, deficit[classes], len(counts))
        done = upto = 0
        for b, own, row in held:
            idx = local[done : done + len(own)]
            done += len(own)
            pair, tf = np.unique(row * (1 << 32) + idx, return_counts=True)
            edge = np.searchsorted(pair >> 32, np.arange(b.num_rows + 1)).astype(np.int32)
            score, n = scores[upto : upto + b.num_rows], pa.array(counts[upto : upto + b.num_rows] + 1)
            upto += b.num_rows
            lists = [pa.ListArray.from_arrays(pa.array(edge), pa.array(x)) for x in ((pair & 0xFFFFFFFF).astype(np.int32), tf.astype(np.int32))]
            yield _rows(b.num_rows, block=pa.array(np.full(b.num_rows, number)), doc_id=b.column("doc_id"), held_out=b.column("held_out"), n_tokens=n, score=pa.array(score), idx=lists[0], tf=lists[1])
        part = ((distinct >> U(32)) * U(n_ranges) >> U(32)).astype(np.int32)
        edge = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else np.empty(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.append(edge, len(part)).astype(np.int32)), pa.array(signed(distinct)))
        yield _rows(len(edge), block=pa.array(np.full(len(edge), number)), part=pa.array(part[edge]), w=lists)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number, held, size = (context.partitionId() if context else 0) << 32, [], 0
        for b in pieces(batches):
            buf, off = texts(b.column("text"))
            _, _, h, row = words(buf, off)
            held.append((b.drop_columns(["text"]), h, row))
            size += len(buf)
            if size >= BLOCK:
                yield from block(number, held)
                number, held, size = number + 1, [], 0
        if held:
            yield from block(number, held)

    return run


_KINDS = {"block": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "score": pa.float64(), "idx": pa.list_(pa.int32()), "tf": pa.list_(pa.int32()), "part": pa.int32(), "w": pa.list_(pa.int64())}


def _rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[k].cast(t) if k in columns else pa.nulls(n, t) for k, t in _KINDS.items()], list(_KINDS))


def _answer(asked: pa.Table, vocab: pa.Table) -> pa.Table:
    """Counts of the requested words, 0 for unknown ones."""
    w = vocab.column("w").to_numpy()
    order = np.argsort(w)
    w, c = np.append(w[order], 0), np.append(vocab.column("c").to_numpy()[order], 0)
    lists = asked.column("w").combine_chunks()
    want = lists.flatten().to_numpy(zero_copy_only=False)
    at = np.searchsorted(w[:-1], want)
    counts = np.where(w[at] == want, c[at], 0) if len(w) > 1 else np.zeros(len(want), np.int64)
    counts = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy())))).astype(np.int32)), pa.array(counts))
    return pa.table({"block": asked.column("block"), "part": asked.column("part"), "c": counts})


def score(docs: DataFrame, folds: int = 10, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (fold("doc_id", folds) == 0).alias("held_out"))
    train = docs.where("NOT held_out").select("doc_id", "text")
    vocab = staged(vocabulary(train), "vocab")
    ends, total, size = vocab.agg(F.coalesce(F.sum(F.when(F.col("w") == END, F.col("c"))), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    def classed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, v = np.zeros(CLASSES), np.zeros(CLASSES)
        for b in batches:
            w = b.column("w").to_numpy()
            k = class_of(w[w != END].view(U))
            c += np.bincount(k, b.column("c").to_numpy()[w != END], CLASSES)
            v += np.bincount(k, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(c), pa.array(v)], ["k", "c", "v"])

    sums = vocab.mapInArrow(classed, "k long, c double, v double").groupBy("k").agg(F.sum("c").alias("c"), F.sum("v").alias("v")).toArrow()
    mass = np.full(CLASSES + 1, 0.1)
    for k, c, v in zip(*(sums.column(x).to_numpy() for x in "kcv"), strict=True):
        mass[k] = c + 0.1 * (v + 1)
    mass[CLASSES] += ends
    usual = mass / mass.sum()
    model = _start(train, usual, ends)
    for _ in range(rounds):
        model = baum_welch(train, model, usual)

    n_ranges = max(1, -(-size // RANGE))
    kinds = "block long, doc_id long, held_out boolean, n_tokens long, score double, idx array<int>, tf array<int>, part int, w array<long>"
    both = staged(docs.mapInArrow(_blocks(model, np.log10(mass[:CLASSES]), n_ranges), kinds), "blocks")
    asked = both.where("part IS NOT NULL").select("block", "part", "w")
    n_asked = asked.agg(F.coalesce(F.sum(F.size("w")), F.lit(0))).first()[0]
    copies = max(1, -(-n_asked // (n_ranges * ASKED)))
    part = F.shiftrightunsigned(F.shiftrightunsigned("w", 32) * n_ranges, 32).cast("int")
    known = vocab.where(F.col("w") != END).select("w", "c", part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    asked = asked.withColumn("copy", F.pmod(F.xxhash64("block"), F.lit(copies)).cast("int"))
    answers = asked.groupBy("part", "copy").cogroup(known.groupBy("part", "copy")).applyInArrow(_answer, "block long, part int, c array<long>")
    spread = float(np.log10(total + 0.1 * (size + 1)))
    end_log = float(np.log10(ends + 0.1))

    def finish(rows: pa.Table, got: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows.select([]).from_arrays([pa.array([], t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names)
        got = got.sort_by("part")
        c = got.column("c").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        lists = rows.column("idx").combine_chunks()
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        c = c[lists.flatten().to_numpy()]
        tf = rows.column("tf").combine_chunks().flatten().to_numpy()
        logs = np.bincount(row, tf * np.log10(c + 0.1), len(lists))
        n = rows.column("n_tokens").to_numpy()
        known_n = np.bincount(row, tf * (c > 0), len(lists)).astype(np.int64) + (ends > 0)
        return pa.table([rows.column("doc_id"), rows.column("held_out"), rows.column("n_tokens"), pa.array(known_n), pa.array(np.full(len(n), total, np.int64)), pa.array(logs + end_log - n * spread), pa.array(rows.column("score").to_numpy() + logs)], names=names)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = both.where("part IS NULL").select("block", "doc_id", "held_out", "n_tokens", "score", "idx", "tf")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
