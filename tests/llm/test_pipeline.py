"""Every stage of the pipeline against brute force, with null ids, repeated rows, clashing columns and empty tables."""

import random
import re

import corpus_pipeline as pipeline
import pytest
from tallyforge.llm import decontaminate, line_dedup, mixing
from tests.llm.test_operators import corpus, words_of

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, gone string, component_id long, row string, row_number long"


def frame(spark, rows):
    data = [(i, t, "en" if (i or 0) % 2 else "de", None if (i or 0) % 11 == 0 else f"s{(i or 0) % 3}", len(t or ""), "clash", 5, "r", 6) for i, t in rows]
    return spark.createDataFrame(data, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def rows():
    own = corpus()
    return own + [own[0], own[7], (None, "no id here"), (None, None), (None, "12 34")]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    items = [(1, " ".join(words_of(corpus()[2][1])[:12])), (2, "one"), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def texts_of(df):
    assert df.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and set(df.columns) >= set(COLUMNS.replace(" long", "").replace(" string", "").split(", ")) - {"text"}
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_language_id(spark, rows, sf_dir):
    got = texts_of(pipeline.language_id(spark, frame(spark, rows), sf_dir))
    letters = sorted(((i, t) for i, t in rows if re.search(r"[^\W\d_]", t or "")), key=str)
    assert {x for x in letters if len(x[1]) < pipeline.LONG} <= set(got) <= set(letters)
    unlabelled = frame(spark, rows).withColumn("lang", pipeline.F.lit(None).cast("string"))
    assert texts_of(pipeline.language_id(spark, unlabelled, sf_dir)) == letters


def test_language_id_judges_each_text(spark, sf_dir):
    """Texts in a language stay though their two labels can't be told apart; gibberish goes, without an id or beside a text of its id too."""
    r = random.Random(5)
    syllables = ["the", "an", "er", "on", "re", "st", "in", "ou", "ed", "ha"]
    text = lambda: " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(r.randint(80, 160)))
    letters = lambda: " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(90))
    real = [(i, text()) for i in range(160)] + [(None, text()), (3, text())]
    junk = [(1000 + i, letters()) for i in range(20)] + [(None, letters()), (7, letters())]
    docs = frame(spark, real).unionByName(frame(spark, junk).withColumn("lang", pipeline.F.lit(None).cast("string")))
    assert texts_of(pipeline.language_id(spark, docs, sf_dir)) == sorted(real, key=str)


def test_line_dedup(spark, rows, sf_dir):
    got = texts_of(pipeline.line_deduplication(spark, frame(spark, rows), sf_dir))
    gone = line_dedup.brute_force(corpus())
    cut = lambda i, t: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, []))
    assert got == sorted(((i, cut(i, t)) for i, t in rows if t and words_of(cut(i, t))), key=str)


def test_near_duplicates(spark, rows, sf_dir):
    got = texts_of(pipeline.near_duplicates(spark, frame(spark, rows), sf_dir))
    sets = {}
    for i, t in corpus():
        w = words_of(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    low = {i: i for i in sets}
    for _ in range(len(sets)):
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
    assert got == sorted([(i, t) for i, t in corpus() if low[i] == i] + [x for x in rows if x[0] is None], key=str)


def test_decontamination(spark, rows, sf_dir):
    got = texts_of(pipeline.decontamination(spark, frame(spark, rows), sf_dir))
    item = " ".join(words_of(corpus()[2][1])[:12])

    def held(t):
        near = decontaminate.substring_distance([item], [decontaminate.normal((t or "").encode())])[0] <= len(item) // 5
        return near or "one" in words_of(t)

    assert got == sorted(((i, t) for i, t in rows if i is None or not held(t)), key=str) and any(held(t) for _, t in rows)


def test_mixing(spark, rows, sf_dir):
    out = pipeline.mixing_to_targets(spark, frame(spark, rows), sf_dir)
    assert out.columns[-4:] == mixing.RESULT
    by = {}
    for r in out.collect():
        assert 0 < r.taken <= 3 * r.size and r.size == len(words_of(r.text)) and r.row_number == 6
        by.setdefault((r.source_size, r.target), []).append(r)
    assert all(abs(sum(r.taken for r in x) - target) <= 2 * max(r.size for r in x) for (_, target), x in by.items())


def test_empty_tables(spark, rows, sf_dir):
    for _, stage in pipeline.STAGES:
        assert stage(spark, frame(spark, rows).limit(0), sf_dir).count() == 0
