import pytest
from pyspark.sql import functions as F

from tidewell.contracts import align
from tidewell.functions import predicates, text
from tidewell.operators import behaviour, dedup, filters


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, 10, "ab", "x"), (2, None, "abc", ""), (3, 30, None, "y"), (4, 40, "", None), (5, 50, "abcd1", "x")], "id long, value long, name string, status string")


CASES = [
    ("not_null", {"field": "value"}, [1, 3, 4, 5]), ("is_null", {"field": "value"}, [2]), ("eq", {"field": "value", "value": 30}, [3]), ("neq", {"field": "value", "value": 30}, [1, 4, 5]),
    ("gt", {"field": "value", "value": 30}, [4, 5]), ("gte", {"field": "value", "value": 30}, [3, 4, 5]), ("lt", {"field": "value", "value": 30}, [1]), ("lte", {"field": "value", "value": 30}, [1, 3]),
    ("range", {"field": "value", "min": 20, "max": 40}, [3, 4]), ("range", {"field": "value", "min": 40}, [4, 5]), ("range", {"field": "value"}, [1, 2, 3, 4, 5]),
    ("length_lt", {"field": "name", "value": 3}, [1, 4]), ("length_lte", {"field": "name", "value": 3}, [1, 2, 4]), ("length_gt", {"field": "name", "value": 3}, [5]), ("length_gte", {"field": "name", "value": 3}, [2, 5]), ("length_eq", {"field": "name", "value": 2}, [1]), ("length_range", {"field": "name", "min": 2, "max": 3}, [1, 2]),
    ("contains", {"field": "name", "value": "bc"}, [2, 5]), ("not_contains", {"field": "name", "value": "bc"}, [1, 4]), ("startswith", {"field": "name", "value": "ab"}, [1, 2, 5]), ("endswith", {"field": "name", "value": "1"}, [5]),
    ("is_in", {"field": "status", "values": ["x"]}, [1, 5]), ("is_in", {"field": "status", "values": []}, []), ("not_in", {"field": "status", "values": ["x"]}, [2, 3]), ("not_in", {"field": "status", "values": []}, [1, 2, 3, 4, 5]),
    ("matches", {"field": "name", "pattern": "[0-9]$"}, [5]), ("not_matches", {"field": "name", "pattern": "[0-9]$"}, [1, 2, 4]), ("is_empty", {"field": "status"}, [2, 4]), ("is_not_empty", {"field": "status"}, [1, 3, 5]),
]


@pytest.mark.parametrize("op,rule,ids", CASES)
def test_rule(people, op, rule, ids):
    assert sorted(r.id for r in predicates.rule_filter(people, [{"operator": op, **rule}]).collect()) == ids


def test_all_rule_operators_have_a_case():
    assert {c[0] for c in CASES} == set(predicates.OPERATORS) and len(predicates.OPERATORS) == 25


def test_invalid_rules_are_skipped(people):
    bad = [{"field": "none", "operator": "eq", "value": 1}, {"field": "value", "operator": "what"}, {"field": "value", "operator": "gt"}, {}]
    assert predicates.rule_filter(people, bad).count() == 5
    assert predicates.rule_filter(people, [*bad, {"field": "value", "operator": "gt", "value": 30}], "OR").count() == 2


def test_groups_and_switch(people):
    config = {"rules": [{"field": "value", "operator": "gte", "value": 10}], "rule_groups": [{"logic": "OR", "rules": [{"field": "status", "operator": "eq", "value": "y"}, {"field": "name", "operator": "eq", "value": "ab"}]}]}
    assert sorted(r.id for r in predicates.dynamic_filter(people, config).collect()) == [1, 3]
    assert predicates.dynamic_filter(people, config | {"enabled": False}).count() == 5


def test_simple_filters(spark):
    df = spark.createDataFrame([("u", "i", 1_700_000_000, "long enough text", 5.0), ("", "i", 1_700_000_000, "short", 9.0), ("u", None, 1_000, "   padded  ", 1.0), ("u", "i", None, None, 3.0)], "user_id string, item_id string, timestamp long, review_text string, rating double")
    assert filters.field_completeness(df).count() == 1
    assert filters.recent(df, 1, as_of=1_700_000_100).count() == 2
    assert filters.min_length(df, least=9).count() == 2 and filters.min_length(df, least=9, trim=True).count() == 1
    assert filters.max_length(df, most=11).count() == 2
    assert filters.outliers(df, as_of=1_700_000_100).count() == 1
    assert filters.spam(df.withColumn("review_text", F.lit("Click  Here now"))).count() == 0
    assert filters.spam(df.withColumn("review_text", F.lit("whatsapp +12")), patterns=filters.SPAM_FOUR_STEP, fold_case=False).count() == 0
    assert filters.blank_keys(df).count() == 2
    for f in (filters.recent, filters.min_length, filters.max_length, filters.spam):
        assert f(spark.range(3)).count() == 3  # no such column


def test_known_keys_and_cascade(spark):
    inter = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", None)], "user_id string, item_id string")
    items = spark.createDataFrame([("x", 1), ("x", 2), ("z", 3)], "item_id string, n int")
    assert filters.known_keys(inter, items).count() == 1
    users, left = filters.cascade(spark.createDataFrame([("a",), ("c",)], "user_id string"), items, inter)
    assert [r.user_id for r in users.collect()] == ["a"] and left.count() == 2


def test_normalizers(spark):
    df = spark.createDataFrame([("<b>A</b> &amp; &lt;i&gt;x", ["<p>a  b</p>", None, " ", "&lt;"], "café 日本", "é", " a \t b ", "$1,234 off")], "h string, arr array<string>, s string, u string, w string, p string")
    out = text.normalize(df, [
        {"normalizer": "html_normalizer", "columns": ["h", "arr", "none"]}, {"normalizer": "special_char_normalizer", "columns": ["s"]}, {"normalizer": "unicode_normalizer", "columns": ["u"]},
        {"normalizer": "whitespace_normalizer", "columns": ["w"]}, {"normalizer": "regex_extract_normalizer", "columns": [{"name": "p", "pattern": r"\$([\d,]+)", "remove": ",", "default": "0"}]}, {"normalizer": "unknown", "columns": ["s"]},
    ]).first()
    assert out.h == "A & x" and out.arr == ["a b", "<"] and out.s == "caf" + " " * 4 and out.u == "é" and out.w == "a b" and out.p == "1234"
    assert df.select(text.special_chars(F.col("s"), unicode=True)).first()[0] == "café 日本"
    assert df.select(text.strip_html_array(F.lit(None).cast("array<string>"))).first()[0] is None
    twice = text.normalize(df, [{"normalizer": "regex_replace_normalizer", "columns": [{"name": "p", "rules": [{"pattern": "[0-9]", "replacement": "#"}, {"pattern": "(", "replacement": ""}]}, {"name": "w", "rules": [{"pattern": "a", "replacement": "b"}]}]}]).first()
    assert twice.p == "$#,### off" and twice.w == " b \t b "  # rules belong to their column


def test_dedup(spark, rows):
    df = spark.createDataFrame([("u", "A", 1), ("u", "A", 2), ("u", "B", 3), ("u", "A", 4), ("v", "A", 1), ("v", None, 2), ("v", None, 3)], "user_id string, item_id string, timestamp long")
    assert rows(dedup.drop_repeats(df)) == [("u", "A", 1), ("u", "A", 4), ("u", "B", 3), ("v", "A", 1)]
    assert rows(dedup.drop_repeats(df, keep="last"), "user_id", "timestamp") == [("u", 2), ("u", 3), ("u", 4), ("v", 3)]
    assert dedup.drop_all_repeats(df).count() == 4
    long = spark.createDataFrame([("hot" if k % 4 else None, "AB"[k // 5 % 2] if k % 97 else None, k * 37 % 1_009) for k in range(1_000)], "user_id string, item_id string, timestamp long")
    for keep in ("first", "last"):
        assert rows(dedup.drop_repeats(long, keep=keep, spread=True)) == rows(dedup.drop_repeats(long, keep=keep, spread=False))
    assert rows(dedup.deduplicate(df, "item_id", ["timestamp"]), "item_id", "timestamp") == [("A", 1), ("B", 3), (None, 2)]
    assert dedup.deduplicate(df, ["user_id", "item_id"]).count() == 4
    assert dedup.deduplicate(df, "none").count() == 7 and dedup.deduplicate(df.union(df)).count() == 7


def test_burst(spark):
    many = [("u1", i * 3) for i in range(100)] + [("u2", i * 360) for i in range(10)] + [("u3", i * 3600) for i in range(5)] + [(None, i) for i in range(200)]
    df = spark.createDataFrame(many, "user_id string, timestamp long")
    assert {r[0] for r in behaviour.drop_bursts(df).select("user_id").distinct().collect()} == {"u2", "u3", None}
    assert {r[0] for r in behaviour.drop_bursts(df, exact=True).select("user_id").distinct().collect()} == {"u2", "u3", None}
    assert behaviour.drop_bursts(spark.range(2)).count() == 2


def test_k_core(spark):
    from collections import Counter

    pairs = [(f"u{i % 7}", f"i{(i * i) % 11}") for i in range(60)] + [("lone", "i1"), ("u1", "rare"), (None, "i1"), ("u1", None)]
    df = spark.createDataFrame(pairs, "user_id string, item_id string")
    for k in (1, 2, 4, 50):
        got = behaviour.k_core(df, k).collect()
        left = [p for p in pairs if None not in p] if k > 1 else pairs
        while k > 1:
            u, i = Counter(a for a, _ in left), Counter(b for _, b in left)
            kept = [p for p in left if u[p[0]] >= k and i[p[1]] >= k]
            if len(kept) == len(left):
                break
            left = kept
        assert Counter(map(tuple, got)) == Counter(left)


def test_campaign_filter(spark):
    df = spark.createDataFrame([("u", "a", t) for t in range(5)] + [("bad", "b", 1), ("u", "b", 2)], "user_id string, item_id string, timestamp long")
    items = spark.createDataFrame([("a", True), ("b", False)], "item_id string, is_campaign_item boolean")
    users = spark.createDataFrame([("bad", True)], "user_id string, is_abnormal_user boolean")
    assert behaviour.campaign_filter(df, items, users).count() == 1
    assert behaviour.campaign_filter(df, items, users, drop_items=False).count() == 6
    capped = behaviour.campaign_filter(df, items, drop_items=False, downsample=True, cap=2)
    assert sorted(r.timestamp for r in capped.where("item_id = 'a'").collect()) == [0, 1]


def test_align(spark):
    df = spark.createDataFrame([("1", "x")], "A string, extra string")
    assert align(df, "a int, b string").first().asDict() == {"a": 1, "b": None}
