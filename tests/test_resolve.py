"""Resolution end to end over synthetic filings with known truth."""

import datetime
import random

from tallyforge.operators import matching, resolve

FIELDS = "source_type string, source_id long, entity_type string, organization string, first_name string, middle_name string, last_name string, suffix string, street string, city string, state string, zip_code string, employer string, filer_id string, created_at date, first_date date, last_date date"


def records(n=120, seed=4):
    """People and organizations, each two or three times with typing errors, and committees by filer id; the truth by uid."""
    r = random.Random(seed)
    day = datetime.date(2020, 1, 1)
    syllable = lambda: r.choice("bcdfglmnprst") + r.choice("aeiou") + r.choice("lnrst")
    name = lambda k: "".join(syllable() for _ in range(k)).title()
    typo = lambda s: s[:3] + s[4:] if len(s) > 6 and r.random() < 0.3 else s
    rows, truth, i = [], {}, 0
    for who in range(n):
        kind = ["person", "organization", "committee"][who % 3]
        first, last, org, street, city, zip_code = name(2), name(3), f"{name(3)} {name(3)} {name(2)}", f"{who + 10} {name(2)} St", name(3), f"{10000 + who * 37}"
        for copy in range(r.randint(2, 3)):
            i += 1
            person = kind == "person"
            rows.append((kind, i, kind, None if person else (org + " LLC" if copy == 1 and kind == "organization" else org), first if person else None, None, typo(last) if person else None, None, street, city, "TX", zip_code, "Acme" if person else None, f"F{who}" if kind == "committee" else None, day, day, day))
            truth[f"{kind}:{i}"] = who
    return rows, truth


def test_end_to_end(spark):
    rows, truth = records()
    found = resolve.resolve(spark.createDataFrame(rows, FIELDS).repartition(3), run_id=7)
    cross = {r.uid: r for r in found.crosswalk.collect()}
    by = {}
    for uid, who in truth.items():
        by.setdefault(who, []).append(uid)
    assert set(cross) == {k if not k.startswith("committee") else k for k in truth}
    good = bad = 0
    uids = sorted(truth)
    for k, a in enumerate(uids):
        for b in uids[k + 1 :]:
            if cross[a].cluster_id == cross[b].cluster_id:
                good, bad = good + (truth[a] == truth[b]), bad + (truth[a] != truth[b])
    pairs = sum(len(x) * (len(x) - 1) // 2 for x in by.values())
    assert good / (good + bad) >= 0.95 and good / pairs >= 0.8
    assert {r.method for r in cross.values()} <= {"probabilistic", "exact", "singleton"} and all(r.run_id == 7 for r in cross.values())
    golden = found.golden.collect()
    assert len(golden) == len({r.cluster_id for r in cross.values()}) and sum(r.source_record_count for r in golden) == len(rows)


def test_prior_decisions_and_held_clusters(spark):
    rows, truth = records(9)
    df = spark.createDataFrame(rows, FIELDS)
    a, b = (next(u for u in sorted(truth) if truth[u] == who) for who in (0, 3))
    prior = spark.createDataFrame([(b, a, "approved")], "a string, b string, status string")
    cross = {r.uid: r for r in resolve.resolve(df, prior).crosswalk.collect()}
    assert cross[a].cluster_id == cross[b].cluster_id and cross[a].method == "approved_review"
    held = {r.uid: r for r in resolve.resolve(df, most=1).crosswalk.collect()}
    assert len({r.cluster_id for r in held.values()}) == len(rows) and all(r.method == "singleton" for r in held.values())


def test_empty(spark):
    found = resolve.resolve(spark.createDataFrame([], FIELDS))
    assert found.crosswalk.count() == found.golden.count() == 0


def test_em_keeps_the_given_chance_levels(spark):
    model = (matching.Comparison("x"),)
    rows = spark.createDataFrame([(1,)] * 30 + [(0,)] * 70, "g_x int")
    w = matching.expectation_maximisation(rows, model, held_u={"x": [0.9, 0.1]})
    assert w.u["x"] == [0.9, 0.1] and w.m["x"][1] > 0.5 and 0 < w.prior < 1
