"""Operators that go on in rounds never return an unfinished state."""

from itertools import islice

import pytest

from tidewell import session
from tidewell.operators import behaviour, similarity
from tidewell.session import rounds_of


def test_rounds():
    assert len(list(islice(rounds_of(None, "x"), 5_000))) == 5_000 and next(rounds_of(1, "x")) == 0
    with pytest.raises(RuntimeError):
        list(rounds_of(3, "x"))


def test_too_few_rounds(spark):
    chain = spark.createDataFrame([(f"u{k}", f"i{j}") for k in range(12) for j in (k, k + 1)], "user_id string, item_id string")
    with pytest.raises(RuntimeError):
        behaviour.k_core(chain, 2, rounds=2)
    assert behaviour.k_core(chain, 2).count() == 0
    edges = spark.createDataFrame([(f"n{k:02}", f"n{k + 1:02}") for k in range(30)], "a string, b string")
    with pytest.raises(RuntimeError):
        similarity.connected_components(edges, rounds=2)
    ranked = spark.createDataFrame([(f"n{k:02}", k) for k in range(7)], "name string, rank int")
    with pytest.raises(RuntimeError):
        similarity.greedy_groups(ranked, edges.where("b < 'n07'"), rounds=2)
    got = similarity.greedy_groups(ranked, edges.where("b < 'n07'"))
    assert {tuple(r) for r in got.collect()} == {(f"n{k:02}", f"n{k - k % 2:02}") for k in range(7)}


def test_long_paths(spark):
    path = [(f"u{k:03}", f"i{j:03}") for k in range(12) for j in (k, k + 1)]
    ring = [(f"r{k:03}", f"s{j % 50:03}") for k in range(50) for j in (k, k + 1)]
    rows = spark.createDataFrame(path + ring + [(None, "s000"), ("r000", None)], "user_id string, item_id string")
    assert {tuple(r) for r in behaviour.k_core(rows, 2).collect()} == set(ring)
    edges = spark.createDataFrame([(f"n{k:03}", f"n{k + 1:03}") for k in range(70)] + [("z1", "z2")], "a string, b string")
    got = {r.node: r.component for r in similarity.connected_components(edges).collect()}
    assert len(got) == 73 and {c for n, c in got.items() if n[0] == "n"} == {"n000"} and got["z2"] == "z1"


def test_shared_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    Context.master = "local[2]"
    assert session.shared_dir(Session()).startswith("file:")


def test_superseded_cut_goes(spark):
    import os

    one = session.cut(spark.range(3), "x")
    path = one._cut_path.removeprefix("file://")
    two = session.cut(one.where("id > 0"), "x", instead_of=one)
    assert not os.path.exists(path) and two.count() == 2


def test_spread_moves_small_scans_only(spark, monkeypatch):
    df = session.cut(spark.range(100), "x")
    assert session.spread(df, "id").rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(session, "SMALL_SCAN", 10)
    assert "Exchange" not in session.spread(df, "id")._jdf.queryExecution().executedPlan().toString()
