"""Heavy keys, sessions and nearness against brute force, and their edge cases."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.functions.events import epoch_ms, event_name, position, shop_key, strip
from tidewell.operators import scan, sessions, skew, spatial
from tidewell.operators.ranking import numbered


def brute_sessions(events, gap):
    by = {}
    for u, t, i in {(u, t, i if i is not None else f"none{k}") for k, (u, t, i) in enumerate(events) if u is not None and t is not None}:
        by.setdefault(u, []).append(t)
    out = []
    for u, ts in by.items():
        ts.sort()
        begin, last, n = ts[0], ts[0], 0
        for t in ts:
            if t - last > gap:
                out.append((u, begin, last, n))
                begin, n = t, 0
            last, n = t, n + 1
        out.append((u, begin, last, n))
    return sorted(out)


def sessions_of(spark, events, gap=100):
    df = spark.createDataFrame(events, "who string, ms long, eid string").withColumn("user", F.lit("clash")).withColumn("t", F.lit(1)).withColumn("id", F.lit("x"))
    got = sessions.sessionize(df, "who", "ms", gap, "eid")
    return sorted((r.who, r.start_ms, r.end_ms, r.n_events) for r in got.collect())


def test_sessions_brute(spark):
    random.seed(1)
    events = [(random.choice(["hot"] * 6 + [f"u{k}" for k in range(8)] + [None]), random.choice([None] + list(range(20_000)) * 1), None if random.random() < 0.05 else str(random.randrange(4_000))) for _ in range(5_000)]
    events = [(u, t if i is None else int(i) * 5, i) for u, t, i in events] + [("tie", 7, "1")] * 4 + [("tie", 7, "2")]
    assert sessions_of(spark, events) == brute_sessions(events, 100)


def test_sessions_small_batches(spark):
    """Groups that go on over Arrow batches and range partitions."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        random.seed(2)
        events = [("hot", random.randrange(3_000), str(k)) for k in range(300)] + [("a", k * 1_000, str(k)) for k in range(20)]
        assert sessions_of(spark, events) == brute_sessions(events, 100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sessions_edges(spark):
    assert sessions_of(spark, []) == []
    assert sessions_of(spark, [(None, 1, "a"), ("u", None, "b")]) == []
    assert sessions_of(spark, [("u", 5, None), ("u", 5, None), ("u", 5, "x" * 100_000)]) == [("u", 5, 5, 3)]
    plain = sessions.sessionize(spark.createDataFrame([("u", 1), ("u", 1), ("u", 500)], "u string, ms long"), "u", "ms", 100).collect()
    assert sorted((r.start_ms, r.duration_ms, r.n_events) for r in plain) == [(1, 0, 2), (500, 0, 1)]


def test_join_ends_keeps_apart_what_something_lies_between(spark):
    rows = [("u", "A", 0, 0, 1, True, 0, 0), ("u", "A", 20, 20, 1, True, 0, 2), ("u", "A", 30, 30, 1, True, 1, 0), ("v", "A", 30, 30, 1, True, 1, 1), ("v", "B", 40, 50, 2, False, 2, 1)]
    df = spark.createDataFrame(rows, "user string, key string, start_ms long, end_ms long, n_events long, edge boolean, part int, place long")
    got = sorted((r.user, r.key, r.start_ms, r.end_ms, r.n_events) for r in scan.join_ends(df, ["user"], ["key"], 100, ["n_events"]).collect())
    assert got == [("u", "A", 0, 0, 1), ("u", "A", 20, 30, 2), ("v", "A", 30, 30, 1), ("v", "B", 40, 50, 2)]


def test_plan_load(spark):
    rows = [("hot", k) for k in range(3_000)] + [("warm", k) for k in range(900)] + [(f"k{k % 500}", k) for k in range(5_000)] + [(None, k) for k in range(1_100)]
    df = spark.createDataFrame(rows, "key string, id long")
    plan = skew.plan_load(df, "key", bins=8, share=0.05)
    assert plan.total == 10_000 and dict(plan.over(0.05)) == {"hot": 3_000, "warm": 900} and dict(plan.over(0.3)) == {"hot": 3_000}
    assert max(plan.loads) <= 1.35 * sum(plan.loads) / 8
    placed = skew.spread(df, plan, "id").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(placed) == 8 and max(r["count"] for r in placed) <= 1.4 * 8_900 / 8
    match = spark.createDataFrame([("hot", 1, "x"), ("hot", 2, "y"), ("k1", 3, "z"), ("none", 4, "w"), (None, 5, "v")], "key string, m int, id string")
    got = sorted(map(tuple, skew.balanced_join(df, match, plan, "id").groupBy("key").agg(F.count(F.lit(1)), F.sum("m")).where("key in ('hot', 'k1', 'k2')").collect()))
    assert got == [("hot", 6_000, 9_000), ("k1", 10, 30), ("k2", 10, None)]
    assert skew.balanced_join(df, match, plan, "id", "inner").count() == 6_010
    with pytest.raises(ValueError):
        skew.balanced_join(df, match, plan, "id", "outer")


def test_plan_load_edges(spark):
    empty = spark.createDataFrame([], "key string, id long")
    plan = skew.plan_load(empty, "key", bins=4)
    assert plan.total == 0 and plan.heavy == {} and skew.balanced_join(empty, empty, plan, "id").count() == 0
    one = spark.createDataFrame([(7, k) for k in range(100)], "key long, id long")
    assert skew.plan_load(one, "key", bins=100, share=0.02).over(1.0) == [(7, 100)]


def metres(a, b):
    p, q = (np.radians(x) for x in (a, b))
    h = math.sin((q[1] - p[1]) / 2) ** 2 + math.cos(p[1]) * math.cos(q[1]) * math.sin((q[0] - p[0]) / 2) ** 2
    return 2 * spatial.RADIUS_M * math.asin(math.sqrt(h))


def test_points_within_brute(spark, monkeypatch):
    monkeypatch.setattr(spatial, "CELL", 40)
    random.seed(3)
    pts = []
    for _ in range(60):
        x, y = random.uniform(100, 101), random.uniform(30, 31)
        pts += [(x + random.gauss(0, 3e-4), y + random.gauss(0, 3e-4)) for _ in range(6)]
    pts += [(110.0, 30.0)] * 5 + [(0.0, 89.9999), (180.0, 89.9999), (179.9999, 0.0), (-179.9999, 0.0), (500.0, 0.0)][:4]
    rows = [(f"s{k}", *p, "x") for k, p in enumerate(pts)] + [("n", None, 1.0, "x"), (None, 1.0, 1.0, "x"), ("s0", *pts[0], "again")]
    df = spark.createDataFrame(rows, "shop string, lng double, lat double, key string").withColumn("rep", F.lit(1)).withColumn("cell", F.lit(2))
    got = {tuple(r) for r in spatial.points_within(df, "shop", "lng", "lat", 50).collect()}
    want = {tuple(sorted((f"s{i}", f"s{j}"))) for i in range(len(pts)) for j in range(i) if metres(pts[i], pts[j]) <= 50}
    assert got == want and len(want) > 100


@pytest.mark.parametrize("cell, dense, block, hot", [(15, 3, 4, 1), (10, 1, 3, 100)])
def test_points_within_dense_cells_and_hot_positions(spark, monkeypatch, cell, dense, block, hot):
    for name, v in (("CELL", cell), ("DENSE", dense), ("BLOCK", block), ("HOT", hot), ("BATCH", 20)):
        monkeypatch.setattr(spatial, name, v)
    random.seed(8)
    pts = [(105 + random.gauss(0, 1e-4), 30 + random.gauss(0, 1e-4)) for _ in range(150)] + [(100.0, 20.0)] * 40 + [(random.uniform(100, 120), random.uniform(20, 40)) for _ in range(60)]
    df = spark.createDataFrame([(f"s{k}", *p) for k, p in enumerate(pts)], "shop string, lng double, lat double")
    near, members = spatial.near_places(df, "shop", "lng", "lat", 12)
    want = {tuple(sorted((f"s{i}", f"s{j}"))) for i in range(len(pts)) for j in range(i) if metres(pts[i], pts[j]) <= 12}
    got = [tuple(r) for r in spatial.key_pairs(near, members).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 1_000
    assert members.where("copies = 40").count() == 40 and near.count() == near.distinct().count() == len(want) - 40 * 39 // 2


def test_cells_of_clustered_points():
    """The largest cell stays within three times the median where points cluster, whatever their number."""
    rng = np.random.default_rng(1)
    centres = rng.uniform(0, 40, (400, 2))
    at = rng.choice(400, 2_000_000, p=(w := 1 / np.arange(1, 401)) / w.sum())
    p = spatial.unit_vectors(*(centres[at] + rng.normal(0, 0.05, (len(at), 2))).T)
    cells = len(p) // 5_000
    nodes = spatial._splits(p[rng.random(len(p)) < spatial.PER_CELL * cells / len(p)], cells, spatial.chord(50))
    _, cell, _ = spatial._place(nodes, p, 0.0)
    sizes = np.bincount(cell)
    assert len(sizes) == cells and sizes.max() <= 3 * np.median(sizes)


def test_points_within_edges(spark):
    empty = spark.createDataFrame([], "k string, lng double, lat double")
    assert spatial.points_within(empty, "k", "lng", "lat", 50).count() == 0
    same = spark.createDataFrame([(f"k{i}", 100.0, 30.0) for i in range(30)], "k string, lng double, lat double")
    assert spatial.points_within(same, "k", "lng", "lat", 50).count() == 435


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.floats(-1, 1), st.floats(-1, 1)), max_size=120), st.floats(0.01, 0.5))
def test_kd_tree(points, radius):
    p = np.column_stack([np.array(points).reshape(-1, 2), np.zeros(len(points))])
    got = {tuple(sorted((int(a), int(b)))) for i, j in spatial.near_pairs(p, radius) for a, b in zip(i, j)}
    d = ((p[:, None] - p[None]) ** 2).sum(2)
    assert got == {(i, j) for i in range(len(p)) for j in range(i + 1, len(p)) if d[i, j] <= radius * radius}


def inside(x, y, ring):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (x1 > x) != (x2 > x) and y < (y2 - y1) * (x - x1) / (x2 - x1) + y1:
            hit = not hit
    return hit


def test_regions_brute(spark, monkeypatch):
    random.seed(4)
    rings = []
    for k in range(12):
        cx, cy, n = random.uniform(0, 10), random.uniform(0, 10), random.randrange(3, 12)
        rings.append([(cx + random.uniform(0.5, 3) * math.cos(2 * math.pi * i / n), cy + random.uniform(0.5, 3) * math.sin(2 * math.pi * i / n)) for i in range(n)])
    rings.append([(1, 1), (4, 1), (4, 4), (3, 4), (3, 2), (2, 2), (2, 4), (1, 4)])  # upright edges, concave
    regions = spark.createDataFrame([(k, [p[0] * 1.0 for p in r], [p[1] * 1.0 for p in r]) for k, r in enumerate(rings)] + [(99, [1.0, 2.0], [1.0, 2.0]), (98, None, None)], "aid long, xs array<double>, ys array<double>")
    pts = [(f"p{i}", random.uniform(-2, 12), random.uniform(-2, 12)) for i in range(800)]
    df = spark.createDataFrame(pts + pts[:10] + [("n", None, 1.0)], "pid string, lng double, lat double")
    want = {(p, str(k)) for p, x, y in pts for k, r in enumerate(rings) if inside(x, y, r)}
    for corners, cell in ((200_000, 20_000), (10, 20_000), (10, 50), (10, 5)):
        monkeypatch.setattr(spatial, "CORNERS", corners)
        monkeypatch.setattr(spatial, "CELL", cell)
        got = [tuple(r) for r in spatial.points_in_regions(df, "pid", "lng", "lat", regions, "aid", "xs", "ys").collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert spatial.points_in_regions(df, "pid", "lng", "lat", regions.limit(0), "aid", "xs", "ys").count() == 0


POSITIONS = [
    ("112.5", "30.25", (112.5, 30.25)), (" 112.5 ", "　30.25", (112.5, 30.25)), ("１１２．５", "３０．２５", (112.5, 30.25)), ("112,500000", "30,250000", (112.5, 30.25)), ("112500000", "30250000", (112.5, 30.25)),
    ("112.5°E", "30.25°N", (112.5, 30.25)), ("E112.5", "N30.25", (112.5, 30.25)), ("112.5° E", "30.25N", (112.5, 30.25)), ("112°30'0.0\"E", "30°15'0.0\"N", (112.5, 30.25)), ("30.25", "112.5", (112.5, 30.25)),
    ("0", "0", None), ("", "30", None), ("NULL", "NULL", None), ("-", "-", None), ("999.9", "30", None), (None, "30", None), ("112.5", "60", None), ("112.5W", "30", None),
]


def test_positions(spark):
    df = spark.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(POSITIONS)], "k int, a string, b string")
    got = {r.k: r.p and (round(r.p.lng, 9), round(r.p.lat, 9)) for r in df.select("k", position(F.col("a"), F.col("b")).alias("p")).collect()}
    assert got == {k: p for k, (_, _, p) in enumerate(POSITIONS)}


def test_event_fields(spark):
    df = spark.createDataFrame([(" 123\t", "shopId=123", "$Page_View ", 1_700_000_000), ("　", "0123.0", "page view", 1_700_000_000_000), (None, "１２３", "PAGE-VIEW", None), ("a b", " ", "é", 0), ("x", "abc", "", 1)], "u string, s string, e string, t long")
    got = df.select(strip(F.col("u")), shop_key(F.col("s")), event_name(F.col("e")), epoch_ms(F.col("t"))).collect()
    assert [r[0] for r in got] == ["123", None, None, "a b", "x"] and [r[1] for r in got] == ["123", "123", "123", None, "abc"]
    assert [r[2] for r in got] == ["pageview"] * 3 + ["é", ""] and [r[3] for r in got][:3] == [1_700_000_000_000, 1_700_000_000_000, None]


def test_numbered(spark):
    df = spark.createDataFrame([("a" if k % 3 else "b", k * 7 % 1_000) for k in range(1_000)] + [(None, 5)], "g string, v long")
    got = numbered(df, ["g"], ["v"])
    for g in ("a", "b"):
        assert [r.n for r in got.where(F.col("g") == g).orderBy("v").collect()] == list(range(1, df.where(F.col("g") == g).count() + 1))
    assert got.where("g is null").first().n == 1
