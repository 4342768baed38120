import pytest

from tidewell.analytics import audit, detectors, reviews
from tidewell.operators import features, sequences


@pytest.fixture
def inter(spark):
    spiky = [(f"u{i}", "hot", 1_700_000_000 + i, "impression") for i in range(200)]
    calm = [(f"u{i}", "calm", 1_700_000_000 + i * 86_400, "impression") for i in range(20)]
    one = [("bot", f"x{i % 40}", 1_700_000_000 + i * 10, "click") for i in range(120)]
    return spark.createDataFrame(spiky + calm + one, "user_id string, item_id string, timestamp long, action string")


def test_detectors(inter):
    burst = {r.item_id: r for r in detectors.item_time_burst(inter).collect()}
    assert burst["hot"].flag_burst and not burst["calm"].flag_burst
    pop = {r.item_id: r for r in detectors.item_popularity_anomaly(inter, least=150).collect()}
    assert pop["hot"].flag_popularity and pop["x0"].flag_popularity and not pop["calm"].flag_popularity  # x0: three rows by one user
    velocity = {r.user_id: r for r in detectors.user_velocity_anomaly(inter).collect()}
    assert velocity["bot"].flag_velocity and not velocity["u1"].flag_velocity and velocity["bot"].distinct_items == 40
    scored = {r.item_id: r for r in detectors.score_items(detectors.item_time_burst(inter), detectors.item_popularity_anomaly(inter, least=150)).collect()}
    assert scored["hot"].reason == "popularity|burst" and scored["hot"].campaign_score == 2 and scored["calm"].reason == "" and not scored["calm"].is_campaign_item
    assert {r.user_id for r in detectors.score_users(detectors.user_velocity_anomaly(inter)).where("is_abnormal_user").collect()} == {"bot"}


def test_funnel(spark):
    rows = [("a", "impression")] * 300 + [("a", "click")] * 10 + [("b", "impression")] * 250 + [("b", "click")] * 260 + [("c", "click")] * 210
    out = {r.item_id: r for r in detectors.item_funnel_stats(spark.createDataFrame(rows, "item_id string, action string")).collect()}
    assert not out["a"].flag_funnel and out["b"].flag_funnel and out["c"].flag_funnel and out["c"].ctr is None


def test_geo(spark):
    df = spark.createDataFrame([("a", 40.0, 116.0)] * 60 + [("b", 31.0, 121.0)] * 60, "item_id string, user_lat double, user_lon double")
    items = spark.createDataFrame([("a", 31.0, 121.0), ("b", 31.0, 121.0)], "item_id string, item_lat double, item_lon double")
    out = {r.item_id: r for r in detectors.geo_mismatch(df, items).collect()}
    assert out["a"].flag_geo and not out["b"].flag_geo and 1000 < out["a"].p90_km < 1100
    assert not any(r.flag_geo for r in detectors.geo_mismatch(df, items.select("item_id")).collect())


def test_reviews_empty_and_registry(spark):
    empty = reviews.derive(spark.createDataFrame([], "rating float, title string, text string, parent_asin string, user_id string, timestamp long, helpful_vote int, verified_purchase string"))
    assert len(reviews.ANALYZERS) == 18
    plans, errors = reviews.run_all(empty)
    assert not errors and all(reviews.shown(n, p).count() in (0, len(empty.columns)) for n, p in plans.items())
    _, errors = reviews.run_all(spark.range(1), ["user_review_count", "null_statistics"])
    assert set(errors) == {"user_review_count"}


def test_trend_needs_two(spark):
    df = reviews.derive(spark.createDataFrame([(5.0, "a", 1), (3.0, "a", 2), (1.0, "b", 1), (2.0, None, 1), (2.0, None, 2)], "rating double, user_id string, timestamp long").selectExpr("*", "'t' title", "'x' text", "'p' parent_asin", "0 helpful_vote", "'false' verified_purchase"))
    out = {r.review_number: r.avg_rating for r in reviews.ANALYZERS["user_rating_trend"](df).collect()}
    assert out == {1: 5.0, 2: 3.0}
    assert df.where("is_verified").count() == 0


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (-1, 0, 4, 5, 9.9, 10)] + [(None,)], "v double")
    assert {r.bin: r.n for r in reviews.histogram(df, "v", 0, 10, 2).collect()} == {0: 1, 1: 2, 2: 2, 3: 1}


def test_audit(spark):
    df = spark.createDataFrame([("a", 1, 10), ("", 2, 20), (None, 2, None)], "k string, n int, timestamp long")
    assert {r.field: (r.present, r.complete) for r in audit.field_completeness(df, ["k", "n", "x"]).collect()} == {"k": (True, 1), "n": (True, 3), "x": (False, 0)}
    keys = {r.key: (r.distinct_keys, r.duplicates) for r in audit.key_uniqueness(df, ["k", ["k", "n"], "n"]).collect()}
    assert keys == {"k": (3, 0), "k+n": (3, 0), "n": (2, 1)}
    assert {r.field: r.outliers for r in audit.outlier_check(df, {"n": (2, None), "timestamp": (0, 15)}).collect()} == {"n": 1, "timestamp": 1}
    assert audit.time_range(df).first().span_seconds == 10
    none = audit.time_range(df.limit(0)).first()
    assert none.is_empty and audit.field_completeness(df.limit(0), ["k"]).first().completeness_pct == 0
    report = audit.audit({"t": df, "off": df}, {"t": {"fields": ["k"], "keys": ["n"], "time": "timestamp", "bounds": {"n": (0, 1)}}, "off": {"enabled": False}})
    assert set(report) == {"t"} and set(report["t"]) == {"row_count", "field_completeness", "key_uniqueness", "time_range", "outlier_check"}


def test_features(spark):
    items = spark.createDataFrame([("i1", "v", "food"), ("i2", "v", "tea"), ("i3", "w", "tea"), ("i4", "w", "x")], "item_id string, content_type string, category string")
    users = spark.createDataFrame([("u1", "A"), ("u2", "B"), ("u3", "C")], "user_id string, name string")
    inter = spark.createDataFrame([("u1", "i1", 100, "view"), ("u1", "i2", 200, "view"), ("u1", "i3", 86_500, "buy"), ("u2", "i1", 50, "view"), ("u2", "i1", 60, "view")], "user_id string, item_id string, timestamp long, action string")
    f = {r.item_id: r for r in features.item_features(items, inter).collect()}
    assert f["i1"].interaction_count == 3 and f["i1"].unique_buyers == 2 and f["i4"].interaction_count == 0 and f["i4"].is_cold and "avg_rating" not in f["i1"]
    u = {r.user_id: r for r in features.user_features(users, inter, items).collect()}
    assert u["u1"].top_categories == "tea,food" and u["u1"].active_days == 1.0 and not u["u1"].is_new_user and u["u3"].is_new_user and u["u3"].interaction_count == 0
    assert set(features.extract(users, items, inter, {"impression_log": False})) == {"item_features", "user_features", "user_interaction_history", "co_purchase"}
    assert features.impression_log(spark).count() == 0


def test_sequences(spark):
    df = spark.createDataFrame([("u", "b", 2, "x"), ("u", "a", 1, "y"), ("u", "c", 2, "x"), ("v", "a", 1, None)], "user_id string, item_id string, timestamp long, action string")
    seq = {r.user_id: [(e.timestamp, e.item_id) for e in r.interaction_history] for r in sequences.user_sequences(df).collect()}
    assert seq == {"u": [(1, "a"), (2, "b"), (2, "c")], "v": [(1, "a")]}
    assert [len(r.interaction_history) for r in sequences.user_sequences(df, most=2).where("user_id = 'u'").collect()] == [2]
    hist = {r.user_id: [e.item_id for e in r.history] for r in sequences.user_history(df, 2).collect()}
    assert hist == {"u": ["a", "b"], "v": ["a"]}


def test_co_occurrence_brute(spark):
    import random

    random.seed(5)
    data = [(f"u{random.randrange(6)}", f"i{random.randrange(8)}", random.randrange(10) * 86_400) for _ in range(150)]
    df = spark.createDataFrame(data, "user_id string, item_id string, timestamp long")
    first, want = {}, {}
    for u, i, t in data:
        first[u, i] = min(t, first.get((u, i), t))
    for (u, i), t in first.items():
        for (v, j), s in first.items():
            if u == v and i != j and abs(t - s) <= 2 * 86_400:
                want[i, j] = want.get((i, j), 0) + 1
    got = {(r.item_id, r.related): r.n for r in sequences.pair_counts(df, 2).collect()}
    assert got == want
    items = spark.createDataFrame([("i1",), ("i2",), ("i3",)], "item_id string")
    clean = {r.item_id: r.related_items for r in sequences.clean_related(sequences.co_occurrence(df, 2), items).collect()}
    assert set(clean) <= {"i1", "i2", "i3"} and all(set(v or []) <= {"i1", "i2", "i3"} for v in clean.values())
