from pyspark.sql import functions as F

from tallyforge.operators import gold as G
from tallyforge.operators import publishing as U


def test_run_ledger(spark):
    e = spark.createDataFrame([(1, 1, "running", {"pairs": 1}), (1, 2, "completed", {"pairs": 5, "auto": 2}), (2, 1, "running", None)], "run_id long, seq int, status string, counters map<string,long>")
    got = {r.run_id: (r.status, r.counters) for r in U.run_ledger(e).collect()}
    assert got == {1: ("completed", {"auto": 2, "pairs": 5}), 2: ("running", None)}


def test_officers_and_explanations(spark):
    o = spark.createDataFrame([("Ann", "Lee"), ("X", None)], "first_name string, last_name string")
    p = spark.createDataFrame([(7, "ann", "LEE"), (3, "ANN", "lee")], "person_id long, first_name string, last_name string")
    assert sorted((r.first_name, r.person_id) for r in U.match_officers(o, p).collect()) == [("Ann", 3), ("X", None)]
    s = spark.createDataFrame([(1, 2, 4.0, 0.5)], "a long, b long, bf_z double, bf_c double")
    assert U.explanation(s, ["z", "c"]).first().explanation == '{"c":0.5,"z":4.0}'


def test_spac_and_sample(spark):
    df = spark.createDataFrame([(" 1 ", "9", "s"), ("2", "", "O")], "spacFilerIdent string, candidateFilerIdent string, spacPositionCd string")
    assert [tuple(r) for r in U.spac_links(df, {"S": "SUPPORT", "O": "OPPOSE"}).orderBy("spac_filer_id").collect()] == [("1", "candidate", "9", "SUPPORT"), ("2", "measure", None, "OPPOSE")]
    pairs = spark.range(1000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert sorted(map(tuple, U.hash_sample(pairs, 0.1, 42).collect())) == sorted(map(tuple, U.hash_sample(pairs.repartition(3), 0.1, 42).collect()))


def test_one_person_per_transaction(spark):
    src = spark.createDataFrame([("1", "A"), ("1", "B"), ("2", "C")], "contributionInfoId string, contributorNameLast string")
    assert [r.transaction_id for r in G.one_person_per_transaction(G.parties(G.staging(src, "RCPT"))).collect()] == ["1"]
