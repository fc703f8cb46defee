import pytest
from pyspark.sql import functions as F

from tallyforge.operators import dedup as D
from tallyforge.operators import families as P
from tallyforge.operators import matching as M
from tallyforge.operators import validate as V
from tallyforge.operators.components import connected_components
from tallyforge.plans import analytics as A
from tallyforge.sources import files as IO
from tallyforge.streaming import feed


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_filter_new_rows_nulls(spark):
    old = spark.createDataFrame([("A", None)], "k string, z string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "B", None), (4, None, None)], "id int, k string, z string")
    assert rows(D.filter_new_rows(new, old, ["k", "z"], ["id"], lower=["k"]), "id") == [(2,), (4,)]
    assert rows(D.filter_new_rows(new, old, ["k", "z"], ["id"], lower=["k"], join_nulls=False), "id") == [(1,), (2,), (3,), (4,)]


def test_upserts_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    once = D.upsert_do_nothing(old, new, ["k"], ["v"])
    assert rows(once) == rows(D.upsert_do_nothing(once, new, ["k"], ["v"])) == [(1, "a"), (2, "c")]
    assert rows(D.upsert_do_update(old, new, ["k"], ["v"])) == [(1, "b"), (2, "c")]


def test_partial_index_predicate(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (None, "c"), (None, "d")], "k int, v string")
    assert rows(D.upsert_do_nothing(old, new, ["k"], ["v"], where="k IS NOT NULL"), "v") == [("a",), ("c",), ("d",)]


def test_registry_keeps_ids(spark):
    reg = spark.createDataFrame([("b", 7)], "nk string, id long")
    out = D.register_keys(reg, spark.createDataFrame([("c",), ("a",), ("b",), (None,)], "nk string"), "nk")
    assert rows(out, "nk", "id") == [("a", 8), ("b", 7), ("c", 9)]


def test_components_and_guard(spark):
    nodes = spark.createDataFrame([(i,) for i in range(1, 9)], "uid long")
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 4), (4, 6), (7, 7), (8, None)], "a long, b long")
    assert rows(connected_components(edges, "a", "b")) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 4)]
    out = {r.uid: r for r in M.clusters(nodes, edges, 2).collect()}
    assert out[3].cluster_id == out[1].cluster_id == "cluster_000001" and out[1].held and not out[8].held
    assert not any(r.held for r in M.clusters(nodes, edges, 0).collect())


def test_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert connected_components(edges, "a", "b").select("component").distinct().collect() == [(0,)]


def test_blocks_of_addresses_alone_are_refused():
    with pytest.raises(ValueError):
        M.check_rule(M.Rule("x", ("person",), ("city", "zip5")))


def test_linkage_separates(spark):
    people = [(i, f"ann{i % 20}", f"smith{i % 20}", "1 main", "austin", f"{78700 + i % 20}", "works") for i in range(60)]
    df = spark.createDataFrame(people, "uid long, first_name string, last_name string, line_1 string, city string, zip5 string, employer string")
    pairs = df.select(F.col("uid").alias("a")).crossJoin(df.select(F.col("uid").alias("b"))).where("a < b AND (b - a) % 20 < 2")
    compared = M.compare(pairs, df, M.MODELS["person"])
    w = M.expectation_maximisation(compared, M.MODELS["person"])
    scored = M.score(compared, M.MODELS["person"], w)
    same = scored.where("(b - a) % 20 = 0").agg(F.min("score")).first()[0]
    other = scored.where("(b - a) % 20 = 1").agg(F.max("score")).first()[0]
    assert same > 0.9 > 0.5 > other


def test_classify(spark):
    s = spark.createDataFrame([(1, 2, 0.995, "person", "Jon", "Pete"), (3, 4, 0.995, "person", "Jon", "Jonathan"), (5, 6, 0.5, "organization", None, None), (7, 8, 0.1, "person", None, None)], "a long, b long, score double, entity_type string, first_a string, first_b string")
    prior = spark.createDataFrame([(8, 7, "approved")], "a long, b long, status string")
    assert rows(M.classify(s, prior), "a", "band") == [(1, "review"), (3, "auto"), (5, "reject"), (7, "auto")]
    with pytest.raises(ValueError):
        M.classify(s, prior, auto=0.5, review=0.9)


def test_quarantine(spark):
    df = spark.createDataFrame([("1", "20240101", "x"), ("2", None, "INDIVIDUAL")], "contributionInfoId string, receivedDt string, contributorPersentTypeCd string")
    df = df.selectExpr("*", "'f' AS filerName", "NULL AS contributorNameLast", "NULL AS contributorNameOrganization", "'20240230' AS contributionDt")
    good, bad = V.split(df, V.rules_for("RCPT"))
    assert good.count() == 0
    q = V.quarantine(bad, "RCPT", F.lit("contribs.csv"))
    assert {(r.error_type, r.error_number > 0) for r in q.collect()} == {("type", True), ("date", True), ("missing", True)}


def test_families_and_guarantors(spark):
    src = spark.createDataFrame([("9", "$5.00", "20240110", None, "Smith", "LLC")], "loanInfoId string, loanAmount string, loanDt string, guarantorNameLast1 string, guarantorNameLast2 string, lenderNameOrganization string")
    t = P.transactions(src, "LOAN", 1).first()
    assert (t.transaction_id, float(t.amount), str(t.transaction_date)) == ("9", 5.0, "2024-01-10")
    assert rows(P.guarantors(src, "loanInfoId"), "position", "last_name") == [(2, "Smith")]


def test_review_once(spark):
    q = spark.createDataFrame([(1, "pending", None), (2, "approved", "x")], "id int, status string, reviewer string")
    assert rows(A.review(q, 1, "approved", "me"), "id", "status") == [(1, "approved"), (2, "approved")]
    with pytest.raises(Exception, match="decided"):
        A.review(q, 2, "rejected", "me").collect()


def test_cycle_of_masters_raises(spark):
    e = spark.createDataFrame([(1, 2), (2, 1)], "id long, master_id long")
    with pytest.raises(Exception, match="does not end"):
        A.master_chain(e).collect()


def test_files(spark, tmp_path):
    (tmp_path / "contribs_01.csv").write_bytes("id,Who X\n1,Zoë\n".encode("cp1252"))
    (tmp_path / "CFS-ReadMe.txt").write_text("no")
    out = IO.convert(spark, str(tmp_path))
    assert len(out["converted"]) == 1 and not out["failed"]
    found = IO.discover(spark, str(tmp_path))
    assert list(found) == ["RCPT"]
    assert rows(IO.tidy(spark.read.csv(str(tmp_path / "contribs_01.csv"), header=True), False)) and IO.record_type("cover_ss_9") == "CVR1" and IO.record_type("coverage") == "UNKNOWN"
    assert spark.read.parquet(str(tmp_path / "contribs_01.parquet")).first()[1] == "Zoë"
    lib = IO.FieldLibrary({"TX": {"contributionAmount": ("amount", 0.9), "x": ("contributor_last_name", 1.0)}})
    assert IO.FieldLibrary.loads(lib.dumps()).unified("TX", "contributorLastName") == "contributor_last_name"


def test_stream_first_write_wins(spark, tmp_path):
    src, to, at = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string").write.parquet(src)
    feed.first_write_wins(spark.readStream.schema("k int, v string").parquet(src), to, at, ["k"], ["v"]).awaitTermination()
    spark.createDataFrame([(1, "c"), (2, "d")], "k int, v string").write.mode("append").parquet(src)
    feed.first_write_wins(spark.readStream.schema("k int, v string").parquet(src), to, at, ["k"], ["v"]).awaitTermination()
    assert rows(spark.read.parquet(to)) == [(1, "a"), (2, "d")]
    assert [n for n, _ in feed.run_stages([(2, "b", dict), (1, "a", dict)])] == ["a", "b"]


def test_last_write_wins_keeps_a_whole_version(spark, tmp_path):
    src, to, at = (str(tmp_path / x) for x in ("src", "to", "at"))
    assert feed.latest(spark, to) is None
    for n, rows in enumerate([[(1, "a", 1), (2, "b", 1)], [(2, "c", 2), (3, "d", 2)], [(1, "e", 3)]]):
        spark.createDataFrame(rows, "k int, v string, n int").coalesce(1).write.mode("append").parquet(src)
        feed.last_write_wins(spark.readStream.schema("k int, v string, n int").parquet(src), to, at, ["k"], ["n"]).awaitTermination()
        if n == 1:  # a write that broke off leaves no success mark and is not read
            (tmp_path / "to" / "v9").mkdir()
    assert sorted(map(tuple, feed.latest(spark, to).collect())) == [(1, "e", 3), (2, "c", 2), (3, "d", 2)]


def test_feed_does_not_take_an_error_for_an_empty_table(spark, tmp_path):
    (tmp_path / "to").mkdir()
    (tmp_path / "to" / "part-0.parquet").write_text("not a table")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(str(tmp_path / "src"))
    q = feed.first_write_wins(spark.readStream.schema("k int, v string").parquet(str(tmp_path / "src")), str(tmp_path / "to"), str(tmp_path / "at"), ["k"], ["v"])
    try:
        q.awaitTermination()
        raise AssertionError("the broken table was read as empty")
    except Exception as e:
        assert "the broken table" not in str(e)
