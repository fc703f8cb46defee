"""Each operator against brute force on small tables with nulls, empty and long texts, copies, ties and clashing columns."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import ann, blocks, decontaminate, hmm_lm, kernels, langid, line_dedup, mixing, ngram_join, pii, sentence_spans, suffix_dedup

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, h string, n long"


def corpus(seed=1, n=60):
    """Random texts with copies, near copies, a shared passage and line, and odd cases."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7)))
    sentence = lambda: " ".join(word() for _ in range(r.randint(1, 14))).capitalize() + r.choice([".", "!", ".\n", "\n"])
    texts = [" ".join(sentence() for _ in range(r.randint(1, 12))) for _ in range(n)]
    passage = " ".join(sentence() for _ in range(9)) + " " + " ".join(word() for _ in range(60)) + "."
    for i in range(0, n, 6):
        texts[i] = texts[i] + "\n" + passage
    for i in range(3, n, 7):
        texts[i] = texts[i - 1]
    for i in range(5, n, 9):
        words = texts[i - 2].split(" ")
        words[len(words) // 2] = "changed"
        texts[i] = " ".join(words)
    base = [word() for _ in range(70)]
    for i in range(14):  # near copies, some of them linked with others only
        words = [word() if r.random() < 0.02 * (i % 5) else w for w in base]
        texts.append(" ".join(words[:40]) + "\n" + " ".join(words[40:]))
    odd = [None, "", "   \n\t ", "one", "a b c d", "x" * 3000, "aa " * 900, "\x0b\x0c.!?\n", "No word here? 1234", "Übergrößenträger " * 12]
    return list(enumerate(texts + odd + ["one", "x" * 3000]))


def frame(spark, rows, copies=True):
    data = [(i, t, "en" if i % 2 else "de", None if i % 11 == 0 else f"s{i % 3}", 1, 2, "clash", 3) for i, t in rows]
    return spark.createDataFrame(data, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    kernels.narrow_batches(spark)
    return frame(spark, corpus())


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def words_of(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x20\x09-\x0d]+", low)


def test_kernels_split_like_the_pattern():
    import pyarrow as pa

    texts = [t for _, t in corpus()]
    buf, off = kernels.texts(pa.array(texts))
    start, end, h, row = kernels.words(buf, off)
    raw = buf.tobytes()
    got = [[] for _ in texts]
    for s, e, i in zip(start, end, row, strict=True):
        got[i].append(raw[s:e].translate(decontaminate.FOLD).decode())
    assert got == [words_of(t) for t in texts]
    by_hash = {}
    for s, e, x in zip(start, end, h, strict=True):
        assert by_hash.setdefault(int(x), raw[s:e].translate(decontaminate.FOLD)) == raw[s:e].translate(decontaminate.FOLD)
    assert len(set(by_hash.values())) == len(by_hash)


@pytest.mark.parametrize("rows", [2048, 3])
def test_ngram_join(docs, monkeypatch, rows):
    monkeypatch.setattr(blocks, "ROWS", rows)
    sets = {}
    for i, t in corpus():
        w = words_of(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.components(docs).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("rows", [2048, 3])
def test_line_dedup(docs, monkeypatch, rows):
    monkeypatch.setattr(blocks, "ROWS", rows)
    got = {r.doc_id: r.removed for r in line_dedup.digest(docs).collect()}
    want = line_dedup.brute_force(corpus())
    assert got == {i: want.get(i, []) for i, _ in corpus()} and want


def test_line_dedup_text(docs):
    got = {r.doc_id: r for r in line_dedup.deduplicate(docs.withColumnRenamed("size", "gone").withColumnRenamed("n", "_gone")).collect()}
    want = line_dedup.brute_force(corpus())
    for i, t in corpus():
        assert got[i].h == "clash"
        assert got[i].text == (t if i not in want else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i]))


def test_line_dedup_short_lines(spark):
    rows = [(1, "All rights reserved.\nOne two three four five six\n\n  \nYes"), (2, "ALL  rights reserved.\nYes indeed\nall rights\none two three four five"), (3, "All rights reserved.\nOne two three four five six\n\n  \nYes"), (4, "Yes\nyes\nall rights reserved. one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.removed) for r in line_dedup.digest(df).collect()}
    assert got == {1: (3, []), 2: (4, [0]), 3: (3, [0, 1, 4]), 4: (3, [0, 1])}


@pytest.mark.parametrize("big", [4096, 1])
def test_suffix_dedup(docs, monkeypatch, big):
    monkeypatch.setattr(suffix_dedup, "BIG", big)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digest(docs).collect()}
    want = suffix_dedup.brute_force(corpus())
    assert got == want and sum(v[1] for v in want.values()) > 0


def test_suffix_array():
    r = random.Random(2)
    for _ in range(600):
        s = [r.randint(0, r.choice([0, 1, 3, 9])) for _ in range(r.randint(0, 40))]
        assert suffix_dedup.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_sentence_spans(docs):
    rows, seen, gone = [], set(), {}
    for i, t in corpus():
        own = [w for p in re.findall(r"[^.!?\n]+", t or "") if (w := re.findall("[^\x20\x09-\x0d.!?]+", p.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))))]
        rows.append((i, own))
    for i, own in rows:
        for p in range(len(own)):
            size = lambda k: sum(map(len, own[p : p + k])) if p + k <= len(own) else -1
            ks = {min((k for k in range(2, 20) if size(k) >= 16), default=0), 3 if size(3) >= 12 else 0, 1 if size(1) >= 20 else 0} - {0}
            for k in ks:
                key = tuple(map(tuple, own[p : p + k]))
                if key in seen:
                    gone.setdefault(i, set()).update(range(p, p + k))
                seen.add(key)
    got = {r.doc_id: (r.n_sentences, r.n_removed) for r in sentence_spans.digest(docs).collect()}
    assert got == {i: (len(own), len(gone.get(i, ()))) for i, own in rows} and gone


def test_sentence_spans_of_short_and_of_single_sentences(spark):
    short = " ".join(f"{a}{i} b{i} c{i}." for i in range(20) for a in "a")
    single = " ".join(f"w{i}" for i in range(55))
    rows = [(1, f"Begin here. {short} End."), (2, f"Other start one. {short} Other end."), (3, f"Say {single}. {single}. Stop"), (4, f"{single}. Go on")]
    got = {r.doc_id: r.n_removed_words for r in sentence_spans.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 60, 3: 0, 4: 55}


def test_mixing(spark, docs):
    for frame_ in (docs, docs.union(docs.where("doc_id < 20"))):
        out = mixing.mix_to_targets(frame_).collect()
        assert len(out) == frame_.count()
        by = {}
        for r in out:
            assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
            by.setdefault((r.source_size, r.target), []).append(r)
        for (_, target), rs in by.items():
            assert abs(sum(r.taken for r in rs) - target) <= max(r.size for r in rs) * 2
    again = sorted(map(tuple, mixing.mix_to_targets(docs.repartition(5)).collect()))
    assert again == sorted(map(tuple, mixing.mix_to_targets(docs).collect()))


def test_mixing_prefers_longer_documents(spark):
    """Inclusion follows the bits of the size within a source, and Pareto keys give each class its expected share."""
    rows = [(i, "w " * (15 if i % 2 else 16), "a") for i in range(6000)] + [(10_000, "w " * 400_000, "b")]
    out = mixing.mix_to_targets(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 9)).collect()
    n = Counter(r.size for r in out if r.taken and r.size < 400_000)
    assert abs(n[16] / n[15] - 5 / 4) < 0.15 and 0.3 * 3000 < n[15] + n[16] < 6000


def test_mixing_with_clashing_columns(docs):
    out = mixing.mix_to_targets(docs.withColumnRenamed("h", "taken").withColumnRenamed("n", "key"), keep=["doc_id", "text", "size", "taken", "key"])
    assert out.columns == ["doc_id", "text", "key", "size", "source_size", "target", "taken"]
    assert all(r.key == 3 and r.size == len(words_of(r.text)) for r in out.collect())


def test_mixing_with_preference(docs):
    out = mixing.mix_to_targets(docs.withColumn("p", F.col("doc_id") % 3), preference="p").collect()
    assert all(r.taken == 0 for r in out if r.doc_id % 3 == 0)


def test_lm_scores(docs):
    rows = corpus()
    tokens = {i: [*words_of(t), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for r in hmm_lm.score(docs, rounds=1).collect():
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens[r.doc_id]), sum(c[w] > 0 for w in tokens[r.doc_id]), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0


def test_forward_recursion_is_exact():
    rng = np.random.default_rng(0)
    emit = rng.random((hmm_lm.CLASSES + 1, hmm_lm.STATES))
    move = rng.random((hmm_lm.STATES, hmm_lm.STATES))
    model = hmm_lm.Model(np.full(hmm_lm.STATES, 1 / hmm_lm.STATES), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    seqs = [rng.integers(0, hmm_lm.CLASSES, k) for k in (1, 4, 2, 3)]
    got = model.log10(np.concatenate(seqs), np.concatenate(([0], np.cumsum([len(s) for s in seqs]))))
    for s, g in zip(seqs, got, strict=True):
        a = model.start * model.emit[s[0]]
        for x in s[1:]:
            a = (a @ model.move) * model.emit[x]
        assert math.isclose(g, math.log10(a.sum()), rel_tol=1e-9)


def test_baum_welch_climbs():
    rng = np.random.default_rng(1)
    usual = np.full(hmm_lm.CLASSES + 1, 1 / (hmm_lm.CLASSES + 1))
    steps = np.where(rng.random((30, 40)) < 0.5, rng.integers(0, 20, (30, 40)), rng.integers(100, 120, (30, 40)))
    model = hmm_lm.Model.random(usual)
    edge = np.arange(0, 30 * 40 + 1, 30)
    likelihood = []
    for _ in range(4):
        likelihood.append(model.log10(steps.T.reshape(-1), edge).sum())
        model = hmm_lm.Model.counted(*model.expect(steps, np.ones(40, bool)), usual, strength=1e-6)
    assert likelihood == sorted(likelihood)


PII = ["mail a.b+c@x.example.com, or @no, or a@b", "ip 1.2.3.4.5.6.7.8 and 300.1.1.1 and 10.0.0.255", "card 4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (017) 555-7713, +44 20 7946 0958 and +12", "call (512) 555-0100 now; bob (at) mail (dot) com", "9" * 5000, "1." * 3000, "+" * 50 + "1 " * 200, "aé 1.2.3.4 ü a@b.cd", None, "", "@" * 100 + "a.b", "0" * 5000 + ".1.01.255", "1" * 5000 + ".1.1.1", "1.1.1." + "0" * 9 + "256"]


def test_pii_base_spans(spark):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, s):
        d = re.sub("[^0-9]", "", s)
        return {"email": lambda: True, "ip": lambda: all(int(p.lstrip("0")[:9] or "0") <= 255 for p in s.split(".")), "card": lambda: 12 <= len(d) <= 19 and pii.luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()

    df = spark.createDataFrame(list(enumerate(PII)), "doc_id long, text string")
    weights, patterns_ = pii.fit(df)
    for r in pii.find(df, weights).collect():
        t = PII[r.doc_id] or ""
        want = sorted((m.start(), pii.KINDS.index(k), m.end()) for k, p in patterns.items() for m in re.finditer(p, t) if good(k, m.group()))
        assert r.base == ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert set(filter(None, r.base.split(","))) <= set(filter(None, r.spans.split(",")))
    assert patterns_


def test_language_id(spark):
    r = random.Random(3)
    make = lambda letters: " ".join("".join(r.choice(letters) for _ in range(5)) for _ in range(r.randint(1, 60)))
    rows = [(i, make("abcd" if i % 2 else "wxyz"), "aa" if i % 2 else "zz") for i in range(120)] + [(500, None, "aa"), (501, "123 !", "zz"), (502, "", None), (503, make("abcd") * 40, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {x.doc_id: x for x in langid.identify(df, rounds=60).collect()}
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (500, 501, 502))
    assert sum(out[i].lang_pred == lang for i, _, lang in rows[:120] if out[i].held_out) >= 0.9 * sum(out[i].held_out for i in range(120))
    assert out[503].lang_pred == "aa" and all(0 <= x.score <= 1 for x in out.values())
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in out.values())


def test_gradients():
    rng = np.random.default_rng(4)
    steps, y = rng.integers(97, 101, (6, 3)).astype(np.uint8), np.array([0, 1, 1])
    model = {k: v.astype(np.float64) for k, v in langid.new_model(2, 3, 5).items()}

    def loss(m):
        sf, _ = langid._forward(m, "f", steps)
        sb, _ = langid._forward(m, "b", steps[::-1])
        z = m["wf"] @ sf + m["wb"] @ sb[::-1] + m["b"]
        p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
        return -np.log(p[:, y, np.arange(3)]).mean()

    sf, tf = langid._forward(model, "f", steps)
    sb, tb = langid._forward(model, "b", steps[::-1])
    p = np.exp(model["wf"] @ sf + model["wb"] @ sb[::-1] + model["b"])
    p /= p.sum(1, keepdims=True)
    p[:, y, np.arange(3)] -= 1
    p /= 18
    grad = {k: np.zeros_like(v) for k, v in model.items()}
    langid._backward(model, "f", steps, tf, model["wf"].T @ p, grad)
    langid._backward(model, "b", steps[::-1], tb, (model["wb"].T @ p)[::-1], grad)
    for k in ("uf", "ub", "cf", "cb"):
        for at in [(0, 0), (4, 0), (8, 0)]:
            up, down = ({**model, k: model[k].copy()} for _ in range(2))
            up[k][at] += 3e-3
            down[k][at] -= 3e-3
            assert abs((loss(up) - loss(down)) / 6e-3 - grad[k][at]) < 3e-3


def test_nearest(spark):
    rng = np.random.default_rng(6)
    v = rng.standard_normal((400, 24)).astype(np.float32)
    v[50:90] = v[20]
    rows = [(i, [float(x) for x in v[i]]) for i in range(400)] + [(1000, None), (1020, [0.0] * 24), (1040, [float("nan")] * 24), (1060, [1.0] * 3), (1080, [None] * 24), (None, [1.0] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = ann.brute_force(df.where("vec_id < 1000").toPandas(), 20, 20)
    hits = [len(set(got[q]) & set(want[q])) / 20 for q in want]
    assert set(got) == set(want) and np.mean(hits) >= 0.95 and got[20] == want[20]
    assert ann.nearest(df.where("vec_id < 5"), F.col("vec_id") % 20 == 0).count() == 4


def test_decontamination_recall(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("etaoinshr") for _ in range(r.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(r.randint(20, 50)))) for i in range(20)] + [(90, "too short"), (91, None), (92, "")]
    docs, leaks = [], set()
    for d in range(200):
        text = [word() for _ in range(r.randint(20, 200))]
        if d % 4 == 0:
            i = d % 20
            chars = list(items[i][1].upper() if d % 8 else items[i][1])
            for _ in range(r.randint(0, len(chars) // 12)):
                k = r.randrange(len(chars))
                chars[k] = r.choice(["", "q", chars[k] + "z"])
            at = r.randrange(len(text))
            text[at:at] = ["".join(chars)]
            leaks.add((d, i))
        docs.append((d, "  ".join(text)))
    docs += [(900, None), (901, ""), (902, "a\n" * 4000)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(df, bench).collect()}
    assert got <= leaks and len(got) >= 0.97 * len(leaks)
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_decontamination_at_the_bound(spark):
    """Items with floor(0.2 n) letters replaced, all behind the first four words: none may be lost."""
    r = random.Random(11)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(2, 8)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([20, 35, 60] * 10)]
    docs = []
    for i, t in items:
        chars = list(t)
        start = len(" ".join(t.split(" ")[:4])) + 1
        for k in r.sample(range(start, len(chars)), len(chars) // 5):
            chars[k] = "q"
        docs.append((i, " ".join([word(), word(), "".join(chars), word()])))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): (x.distance, x.item_chars) for x in decontaminate.contaminated(df, bench).collect()}
    assert set(got) == {(i, i) for i, _ in items} and all(d <= n // 5 for d, n in got.values())


def test_decontamination_without_common_words(spark):
    """Edits in every third word, in each word, joined and split words, short items word for word."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("etaoinshrdlu") for _ in range(r.randint(5, 7)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 5, 18, 18, 40, 40, 30, 30])] + [(50, "Yes  Indeed"), (51, "no"), (52, " ")]
    cut = lambda t, step: " ".join(w[:2] + "q" + w[3:] if k % step == 1 else w for k, w in enumerate(t.split(" ")))
    text = dict(items)
    docs = [(0, text[0][:14] + "q" + text[0][15:]), (1, text[1].replace(" ", "")), (2, cut(text[2], 3)), (3, cut(text[3], 2)), (4, cut(text[4], 1)), (5, cut(text[5], 3)), (6, text[6].replace(" ", "")), (7, " ".join(w[:3] + " " + w[3:] for w in text[7].split(" ")))]
    docs = [(i, f"{word()} {t} {word()}") for i, t in docs] + [(20, "oh yes\nindeed so"), (21, "yes so indeed"), (22, "NO"), (23, "know nothing")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.distance for x in decontaminate.contaminated(df, bench).collect()}
    want = {(d, i) for d, t in docs for i, x in items if i < 50 and decontaminate.substring_distance([x], [t])[0] <= len(x) // 5}
    assert want == {(i, i) for i in range(8)} and set(got) == want | {(20, 50), (22, 51)}
    assert got[20, 50] == got[22, 51] == 0


def test_distances_of_long_patterns():
    r = random.Random(13)
    pairs = []
    for n in [0, 1, 63, 64, 65, 127, 128, 129, 200] * 4:
        p = "".join(r.choice("abé一") for _ in range(n))
        t = "".join(r.choice(["", "a", c + "b", c, c, c, c]) for c in p)
        pairs += [(p, "aé" + t + "b"), (p, "")]

    def slow(p, t):
        row = [0] * (len(t) + 1)
        for i, a in enumerate(p):
            new = [i + 1]
            for j, b in enumerate(t):
                new.append(min(new[j] + 1, row[j + 1] + 1, row[j] + (a != b)))
            row = new
        return min(row)

    assert decontaminate.substring_distance(*map(list, zip(*pairs, strict=True))).tolist() == [slow(p, t) for p, t in pairs]


def test_substring_distance():
    got = decontaminate.substring_distance(["abc", "kitten", "xyz"], ["zzabcz", "a sitting b", ""])
    assert got.tolist() == [0, 2, 3]


def test_empty_tables(spark, empty):
    assert ngram_join.components(empty).count() == 0
    assert line_dedup.digest(empty).count() == 0
    assert suffix_dedup.digest(empty).count() == 0
    assert sentence_spans.digest(empty).count() == 0
    assert mixing.mix_to_targets(empty).count() == 0
    assert hmm_lm.score(empty, rounds=1).count() == 0
    assert langid.identify(empty).count() == 0
    assert pii.digest(empty).count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0
