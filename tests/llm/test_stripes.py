import math
import random
from itertools import combinations

from pyspark.sql import functions as F

from tidewell.llm import stripes


def brute(rows, least=4, lift=5.0):
    baskets = {}
    for u, d, s in rows:
        if None not in (u, d, s):
            baskets.setdefault((u, d), set()).add(s)
    n, one, two = len(baskets), {}, {}
    for b in baskets.values():
        for s in b:
            one[s] = one.get(s, 0) + 1
        for p in combinations(sorted(b), 2):
            two[p] = two.get(p, 0) + 1
    return {(a, b, k, one[a], one[b], n) for (a, b), k in two.items() if k >= least and k * n >= lift * one[a] * one[b]}


def made(seed=1):
    random.seed(seed)
    rows = []
    for k in range(400):
        basket = {f"s{random.randrange(60)}" for _ in range(random.randrange(1, 5))} | ({"hot"} if k % 2 else set())
        if k % 30 == 0:
            basket |= {"x1", "x2", "x3"}
        rows += [(f"u{k % 50}", k // 50, s) for s in basket for _ in range(random.randrange(1, 3))]
    return rows + [(None, 1, "s1"), ("u", None, "s1"), ("u", 1, None)] * 3


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "who string, day int, shop string").withColumn("item", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("k0", F.lit(2))
    return stripes.co_occurrence(df, ["who", "day"], "shop", **kw)


def keyed(df):
    return {(r.item_a, r.item_b, r.n_both, r.n_a, r.n_b, r.n_baskets) for r in df.collect()}


def test_brute(spark):
    got = keyed(run(spark, made()))
    assert got == brute(made()) and {("x1", "x2"), ("x1", "x3"), ("x2", "x3")} <= {g[:2] for g in got}


def test_weaker_bounds(spark):
    rows = made(2)
    assert keyed(run(spark, rows, least=2, lift=1.5)) == brute(rows, 2, 1.5)


def test_large_baskets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(stripes, "BLOCK", 10)
    rows = made(3) + [("bot", k, f"s{j}") for k in range(4) for j in range(60)]
    assert keyed(run(spark, rows, least=3, lift=1.2)) == brute(rows, 3, 1.2)


def test_edges(spark):
    assert run(spark, []).count() == 0 and run(spark, [(None, None, None)]).count() == 0
    assert run(spark, [("u", d, s) for d in range(9) for s in ("a", "b")]).count() == 0  # together always, but no more than chance


def test_llr(spark):
    n, a, b, k = 1000, 40, 30, 20
    table = [(k, a * b / n), (a - k, a * (n - b) / n), (b - k, (n - a) * b / n), (n - a - b + k, (n - a) * (n - b) / n)]
    want = 2 * sum(o * math.log(o / e) for o, e in table if o)
    one = spark.range(1).select(stripes.log_likelihood_ratio(*(F.lit(float(x)) for x in (k, a, b, n)))).first()[0]
    zero = spark.range(1).select(stripes.log_likelihood_ratio(*(F.lit(float(x)) for x in (10, 100, 100, 1000)))).first()[0]
    assert abs(one - want) < 1e-9 and abs(zero) < 1e-9


def test_significance_cuts(spark):
    rows = made(2)
    free = run(spark, rows, least=2, lift=1.5, least_llr=0.0).collect()
    bound = sorted(r.llr for r in free)[len(free) // 2]
    want = {(r.item_a, r.item_b) for r in free if r.llr >= bound}
    got = {(r.item_a, r.item_b) for r in run(spark, rows, least=2, lift=1.5, least_llr=bound).collect()}
    assert got == want and 0 < len(want) < len(free)
    assert keyed(run(spark, rows, least=2, lift=1.5)) == {(r.item_a, r.item_b, r.n_both, r.n_a, r.n_b, r.n_baskets) for r in free}


def test_implied_ratio_is_a_lower_bound():
    rng = random.Random(5)
    for _ in range(3_000):
        n = rng.randrange(50, 5_000)
        a, b = rng.randrange(4, n // 5 + 4), rng.randrange(4, n // 5 + 4)
        k = rng.randrange(4, min(a, b) + 1)
        if k * n < 5 * a * b or n - a - b + k < 0:
            continue
        cells = [(k, a * b / n), (a - k, a * (n - b) / n), (b - k, (n - a) * b / n), (n - a - b + k, (n - a) * (n - b) / n)]
        assert 2 * sum(o * math.log(o / e) for o, e in cells if o) >= stripes.implied_llr(4, 5.0) - 1e-9


def test_many_items_are_joined_in_shards(spark, monkeypatch):
    monkeypatch.setattr(stripes, "SMALL_COUNTS", 0)
    assert keyed(run(spark, made())) == brute(made())
