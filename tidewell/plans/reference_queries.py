"""Queries over the driver's tables for the operators of the engine, with their SQL twins.

"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.analytics import audit, detectors, reviews
from tidewell.functions import predicates, text
from tidewell.operators import behaviour, dedup, features, filters, sequences
from tidewell.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def put(f):
        QUERIES[name or f.__name__] = f
        if sql is not None:
            ORACLES[name or f.__name__] = sql
        return f

    return put


def _seconds(c: str):
    """Unix seconds of a timestamp without zone."""
    return F.timestamp_diff("SECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col(c).cast("timestamp_ntz")).cast("long")


# ---- views of the tables in the engine's contract


def events(spark: SparkSession, d: str) -> DataFrame:
    """events as interactions: item from the JSON, seconds."""
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("user_id"), F.get_json_object("props", "$.k").alias("item_id"), _seconds("ts").alias("timestamp"), F.when(F.col("event_type") == "view", "impression").otherwise(F.col("event_type")).alias("action"), "event_id", "value")


E_SQL = "ev AS (SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id, epoch_us(ts) // 1000000 AS \"timestamp\", CASE WHEN event_type = 'view' THEN 'impression' ELSE event_type END AS action, event_id, value FROM events)"


def orders(spark: SparkSession, d: str) -> DataFrame:
    """orders with line items as interactions."""
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    return o.select("o_orderkey", "o_custkey").join(li.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_quantity"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").cast("string").alias("user_id"), F.col("l_partkey").cast("string").alias("item_id"), _seconds("l_shipdate").alias("timestamp"), F.col("l_returnflag").alias("action"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), F.least(F.lit(5.0), F.ceil(F.col("l_quantity") / 10).cast("double")).alias("rating"))


O_SQL = "od AS (SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id, epoch_us(l_shipdate) // 1000000 AS \"timestamp\", l_returnflag AS action, l_orderkey * 10 + l_linenumber AS line_id, least(5.0, CAST(ceil(l_quantity / 10) AS DOUBLE)) AS rating FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"


def review_rows(spark: SparkSession, d: str) -> DataFrame:
    return reviews.derive(table(spark, d, "amazon_new_review"))


R_SQL = """rv AS (SELECT *, strftime(CAST(at_ts AS DATE), '%Y-%m') AS review_year_month, strftime(CAST(at_ts AS DATE), '%a') AS review_weekday, length(text) AS text_length, length(title) AS title_length, coalesce(lower(verified_purchase) = 'true', false) AS is_verified
  FROM (SELECT *, CASE WHEN "timestamp" < 1000000000000 THEN "timestamp" * 1000 ELSE "timestamp" END AS review_ms, make_timestamp((CASE WHEN "timestamp" < 1000000000000 THEN "timestamp" * 1000 ELSE "timestamp" END) * 1000) AS at_ts FROM amazon_new_review))"""


# ---- rule operators: one query each, over part (ids keep the rows apart)

_RULES: list[tuple[str, dict, str]] = [
    ("not_null", {"field": "lang"}, "lang IS NOT NULL"),
    ("is_null", {"field": "lang"}, "lang IS NULL"),
    ("eq", {"field": "lang", "value": "zh"}, "lang = 'zh'"),
    ("neq", {"field": "lang", "value": "zh"}, "lang <> 'zh'"),
    ("gt", {"field": "n_chars", "value": 200}, "n_chars > 200"),
    ("gte", {"field": "n_chars", "value": 200}, "n_chars >= 200"),
    ("lt", {"field": "n_chars", "value": 200}, "n_chars < 200"),
    ("lte", {"field": "n_chars", "value": 200}, "n_chars <= 200"),
    ("range", {"field": "n_chars", "min": 50, "max": 300}, "n_chars BETWEEN 50 AND 300"),
    ("length_lt", {"field": "text", "value": 60}, "length(text) < 60"),
    ("length_lte", {"field": "text", "value": 60}, "length(text) <= 60"),
    ("length_gt", {"field": "text", "value": 60}, "length(text) > 60"),
    ("length_gte", {"field": "text", "value": 60}, "length(text) >= 60"),
    ("length_eq", {"field": "lang", "value": 2}, "length(lang) = 2"),
    ("length_range", {"field": "text", "min": 10, "max": 100}, "length(text) BETWEEN 10 AND 100"),
    ("contains", {"field": "text", "value": "the"}, "contains(text, 'the')"),
    ("not_contains", {"field": "text", "value": "the"}, "NOT contains(text, 'the')"),
    ("startswith", {"field": "text", "value": "The"}, "starts_with(text, 'The')"),
    ("endswith", {"field": "text", "value": "."}, "ends_with(text, '.')"),
    ("is_in", {"field": "source", "values": ["review", "notice"]}, "source IN ('review', 'notice')"),
    ("not_in", {"field": "source", "values": ["review", "notice"]}, "source NOT IN ('review', 'notice')"),
    ("matches", {"field": "text", "pattern": "[0-9]{2,} min"}, "regexp_matches(text, '[0-9]{2,} min')"),
    ("not_matches", {"field": "text", "pattern": "[0-9]{2,} min"}, "NOT regexp_matches(text, '[0-9]{2,} min')"),
    ("is_empty", {"field": "text"}, "text IS NULL OR text = ''"),
    ("is_not_empty", {"field": "text"}, "text IS NOT NULL AND text <> ''"),
]


def _rule_query(op: str, rule: dict):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return predicates.rule_filter(table(spark, d, "documents"), [{"operator": op, **rule}]).select("doc_id")

    run.__name__ = f"rule_{op}"
    return run


for _op, _rule, _sql in _RULES:
    query(f"SELECT doc_id FROM documents WHERE {_sql}", f"rule_{_op}")(_rule_query(_op, _rule))


@query("SELECT doc_id FROM documents WHERE (lang = 'en' OR n_chars > 400) AND (source <> 'notice' AND length(text) >= 20)")
def rule_groups(spark, d):
    config = {"rules": [{"field": "lang", "operator": "eq", "value": "en"}, {"field": "n_chars", "operator": "gt", "value": 400}, {"field": "none", "operator": "eq", "value": 1}], "logic": "OR", "rule_groups": [{"rules": [{"field": "source", "operator": "neq", "value": "notice"}, {"field": "text", "operator": "length_gte", "value": 20}]}]}
    return predicates.dynamic_filter(table(spark, d, "documents"), config).select("doc_id")


# ---- filters

_AS_OF = 1_735_689_600  # 2025-01-01


@query("SELECT review_id FROM amazon_new_review WHERE user_id IS NOT NULL AND user_id <> '' AND parent_asin IS NOT NULL AND parent_asin <> '' AND \"timestamp\" IS NOT NULL AND text IS NOT NULL AND text <> ''")
def filter_completeness(spark, d):
    return filters.field_completeness(table(spark, d, "amazon_new_review"), ("user_id", "parent_asin", "timestamp", "text", "absent")).select("review_id")


@query(f"SELECT review_id FROM amazon_old_review WHERE unixReviewTime >= {_AS_OF} - 365 * 86400")
def filter_recent(spark, d):
    return filters.recent(table(spark, d, "amazon_old_review"), 1, "unixReviewTime", _AS_OF).select("review_id")


@query("SELECT doc_id FROM documents WHERE length(text) >= 30")
def filter_min_length(spark, d):
    return filters.min_length(table(spark, d, "documents"), "text", 30).select("doc_id")


@query("SELECT review_id FROM amazon_new_review WHERE length(trim(text, ' ')) >= 12")
def filter_min_length_trimmed(spark, d):
    return filters.min_length(table(spark, d, "amazon_new_review"), "text", 12, trim=True).select("review_id")


@query("SELECT doc_id FROM documents WHERE length(text) <= 150")
def filter_max_length(spark, d):
    return filters.max_length(table(spark, d, "documents"), "text", 150).select("doc_id")


@query(f"SELECT review_id FROM amazon_old_review WHERE overall BETWEEN 2 AND 4 AND unixReviewTime >= 1672531200 AND unixReviewTime <= {_AS_OF}")
def filter_outliers(spark, d):
    return filters.outliers(table(spark, d, "amazon_old_review"), 2, 4, 2023, "overall", "unixReviewTime", _AS_OF).select("review_id")


@query("SELECT review_id FROM amazon_new_review WHERE NOT regexp_matches(lower(text), 'bought\\s*\\d+|order\\s*\\d+') AND NOT regexp_matches(lower(title), 'bought\\s*\\d+|order\\s*\\d+')")
def filter_spam(spark, d):
    return filters.spam(table(spark, d, "amazon_new_review"), ("text", "title"), [r"bought\s*\d+", r"order\s*\d+"]).select("review_id")


@query("SELECT review_id FROM amazon_new_review WHERE parent_asin IN (SELECT item_id FROM documents)")
def filter_known_keys(spark, d):
    items = table(spark, d, "documents").select(F.col("item_id").alias("parent_asin"))
    return filters.known_keys(table(spark, d, "amazon_new_review"), items, "parent_asin").select("review_id")


@query(f"WITH {E_SQL}, keep AS (SELECT * FROM ev WHERE action IN ('purchase', 'signup') AND value > 50) SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name FROM customer WHERE CAST(c_custkey AS VARCHAR) IN (SELECT user_id FROM keep)")
def filter_cascade(spark, d):
    users = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("user_id"), "c_name")
    kept = events(spark, d).where("action in ('purchase', 'signup') and value > 50")
    return filters.cascade(users, None, kept)[0]


# ---- normalizers


@query("SELECT review_id, lower(text) AS text FROM amazon_new_review")
def text_lowercase(spark, d):
    return text.normalize(table(spark, d, "amazon_new_review"), [{"normalizer": "lowercase_normalizer", "columns": ["text"]}]).select("review_id", "text")


@query("SELECT review_id, regexp_replace(text, '[^a-zA-Z0-9_ \\t\\n\\r\\f\\v.,!?''\"-]', ' ', 'g') AS text FROM amazon_new_review")
def text_special_chars(spark, d):
    return text.normalize(table(spark, d, "amazon_new_review"), [{"normalizer": "special_char_normalizer", "columns": ["text"]}]).select("review_id", "text")


@query("SELECT doc_id, nfc_normalize(text) AS text FROM documents")
def text_unicode(spark, d):
    return text.normalize(table(spark, d, "documents"), [{"normalizer": "unicode_normalizer", "columns": ["text"]}]).select("doc_id", "text")


@query("SELECT review_id, trim(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', ' ', 'g'), ' ') AS text FROM amazon_new_review")
def text_whitespace(spark, d):
    return text.normalize(table(spark, d, "amazon_new_review"), [{"normalizer": "whitespace_normalizer", "columns": ["text"]}]).select("review_id", "text")


@query("SELECT review_id, regexp_replace(regexp_replace(text, '[0-9]+', '#', 'g'), '[!]+', '!', 'g') AS text FROM amazon_new_review")
def text_regex_replace(spark, d):
    rules = [{"pattern": "[0-9]+", "replacement": "#"}, {"pattern": "[!]+", "replacement": "!"}]
    return text.normalize(table(spark, d, "amazon_new_review"), [{"normalizer": "regex_replace_normalizer", "columns": [{"name": "text", "rules": rules}]}]).select("review_id", "text")


@query("SELECT review_id, CASE WHEN x = '' OR x IS NULL THEN 'none' ELSE x END AS text FROM (SELECT review_id, translate(regexp_extract(text, '([0-9]+) (days|weeks|months)', 1), '0', '') AS x FROM amazon_new_review)")
def text_regex_extract(spark, d):
    spec = {"name": "text", "pattern": "([0-9]+) (days|weeks|months)", "group": 1, "remove": "0", "default": "none"}
    return text.normalize(table(spark, d, "amazon_new_review"), [{"normalizer": "regex_extract_normalizer", "columns": [spec]}]).select("review_id", "text")


@query()
def text_html(spark, d):
    """All texts. SQL can't decode entities, so it has no twin and is tested against html.unescape (tests/test_html_query.py)."""
    return text.normalize(table(spark, d, "amazon_new_review"), [{"normalizer": "html_normalizer", "columns": ["text"]}]).select("review_id", "text")


@query("""SELECT review_id, list_filter(list_transform(string_split(text, '.'), lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]+>', '', 'g'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{0B}]+', ' ', 'g'), ' ')), lambda x: x <> '') AS parts FROM amazon_old_review_t""".replace("amazon_old_review_t", "(SELECT review_id, reviewText AS text FROM amazon_old_review)"))
def text_html_array(spark, d):
    rows = table(spark, d, "amazon_old_review").select("review_id", F.split("reviewText", r"\.").alias("parts"))
    return text.normalize(rows, [{"normalizer": "html_normalizer", "columns": ["parts"]}])


# ---- deduplication and behaviour


@query("SELECT text, min(review_id) AS review_id FROM amazon_new_review GROUP BY text")
def dedup_text(spark, d):
    return dedup.deduplicate(table(spark, d, "amazon_new_review"), "text", ["review_id"]).select("text", "review_id")


@query("SELECT DISTINCT user_id, parent_asin FROM amazon_new_review")
def dedup_keys(spark, d):
    return dedup.deduplicate(table(spark, d, "amazon_new_review"), ["user_id", "parent_asin"]).select("user_id", "parent_asin")


@query("SELECT DISTINCT * FROM o2o_new_gut_shop_base")
def dedup_rows(spark, d):
    return dedup.deduplicate(table(spark, d, "o2o_new_gut_shop_base"))


@query(f"WITH {E_SQL}, w AS (SELECT *, lag(action) OVER (PARTITION BY user_id ORDER BY \"timestamp\", event_id, action) AS b, row_number() OVER (PARTITION BY user_id ORDER BY \"timestamp\", event_id, action) AS n FROM ev) SELECT event_id FROM w WHERE n = 1 OR b <> action")
def dedup_runs(spark, d):
    return dedup.drop_repeats(events(spark, d), "user_id", "action", tie=("event_id",)).select("event_id")


@query(f"WITH {E_SQL}, w AS (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY \"timestamp\", event_id) AS n FROM ev) SELECT event_id FROM w WHERE n = 1")
def dedup_all_repeats(spark, d):
    return dedup.drop_all_repeats(events(spark, d), tie=("event_id",)).select("event_id")


@query(f"""WITH {E_SQL}, s AS (SELECT user_id, count(*) AS n, max("timestamp") - min("timestamp") AS span FROM ev GROUP BY 1),
bad AS (SELECT user_id FROM s WHERE (CASE WHEN span > 0 AND n > 1 THEN n / (span / 60.0) ELSE 0 END) > 5.0 / 2880 OR (span <= 172800 AND n > 5))
SELECT event_id FROM ev WHERE user_id NOT IN (SELECT user_id FROM bad)""")
def burst(spark, d):
    return behaviour.drop_bursts(events(spark, d), 2880, 5).select("event_id")


@query(f"""WITH {E_SQL}, w AS (SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY "timestamp" RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS n FROM ev)
SELECT event_id FROM ev WHERE user_id NOT IN (SELECT user_id FROM w WHERE n > 6)""")
def burst_exact(spark, d):
    return behaviour.drop_bursts(events(spark, d), 1440, 6, exact=True).select("event_id")


def _core_sql(source: str, view: str, k: int, rounds: int, key: str) -> str:
    steps, last = [source], view
    for i in range(rounds):
        steps.append(f"k{i} AS MATERIALIZED (SELECT * FROM {last} WHERE user_id IN (SELECT user_id FROM {last} GROUP BY 1 HAVING count(*) >= {k}) AND item_id IN (SELECT item_id FROM {last} GROUP BY 1 HAVING count(*) >= {k}))")
        last = f"k{i}"
    return f"WITH {', '.join(steps)} SELECT {key} FROM {last}"


@query(_core_sql(O_SQL, "od", 20, 8, "line_id"))
def k_core(spark, d):
    return behaviour.k_core(orders(spark, d), 20).select("line_id")


_REVIEW_SQL = "rw AS (SELECT user_id, parent_asin AS item_id, review_id FROM amazon_new_review WHERE user_id IS NOT NULL AND parent_asin IS NOT NULL)"


@query(_core_sql(_REVIEW_SQL, "rw", 3, 25, "review_id"))
def k_core_reviews(spark, d):
    rows = table(spark, d, "amazon_new_review").select("user_id", F.col("parent_asin").alias("item_id"), "review_id")
    return behaviour.k_core(rows, 3).select("review_id")


# ---- detectors

_BURST_SQL = """b AS (SELECT item_id, "timestamp" // 86400 AS b, count(*) AS n FROM ev GROUP BY 1, 2), burst AS (
  SELECT item_id, CAST(sum(n) AS BIGINT) AS total, max(n) AS busiest, count(*) AS active_buckets, max(n) * count(*) / sum(n) AS spike_ratio, max(n) / sum(n) AS top_bucket_share,
         max(n) >= 8 AND (max(n) * count(*) / sum(n) >= 2.5 OR max(n) / sum(n) >= 0.5) AS flag_burst FROM b GROUP BY 1)"""
_POP_SQL = """pi AS (SELECT item_id, count(*) AS interaction_count, count(DISTINCT user_id) AS unique_users, count(*) / count(DISTINCT user_id) AS per_user FROM ev GROUP BY 1), pop AS (
  SELECT *, interaction_count >= (SELECT greatest(quantile_disc(interaction_count, 0.95), 100) FROM pi) OR per_user >= 1.6 AS flag_popularity FROM pi)"""
_FUNNEL_SQL = """f AS (SELECT item_id, count(*) FILTER (action = 'impression') AS impressions, count(*) FILTER (action IN ('click', 'purchase')) AS clicks FROM ev GROUP BY 1),
  fc AS (SELECT *, CASE WHEN impressions > 0 THEN clicks / impressions END AS ctr FROM f), fs AS (SELECT avg(ctr) AS m, stddev_samp(ctr) AS s FROM fc WHERE impressions >= 15), funnel AS (
  SELECT item_id, impressions, clicks, ctr, CASE WHEN coalesce(s, 0) = 0 THEN 0 ELSE (ctr - m) / s END AS ctr_z FROM fc, fs)"""
_FUNNEL_FLAG = "coalesce((impressions >= 15 AND (ctr_z >= 2.0 OR ctr >= 4.0)) OR (impressions < 15 AND clicks >= 15), false) AS flag_funnel"


def _burst(spark, d):
    return detectors.item_time_burst(events(spark, d), "day", 2.5, 8, 0.5)


def _popularity(spark, d):
    return detectors.item_popularity_anomaly(events(spark, d), 0.95, 100, 1.6)


def _funnel(spark, d):
    return detectors.item_funnel_stats(events(spark, d), ("impression", "click", "purchase"), 15, 2.0, 4.0)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"WITH {E_SQL}, {_BURST_SQL} SELECT item_id, total, busiest, active_buckets, round(spike_ratio, 6) AS spike_ratio, round(top_bucket_share, 6) AS top_bucket_share, flag_burst FROM burst")
def detect_burst(spark, d):
    return _rounded(_burst(spark, d), "spike_ratio", "top_bucket_share")


@query(f"WITH {E_SQL}, {_POP_SQL} SELECT item_id, interaction_count, unique_users, round(per_user, 6) AS per_user, flag_popularity FROM pop")
def detect_popularity(spark, d):
    return _rounded(_popularity(spark, d), "per_user")


@query(f"WITH {E_SQL}, {_FUNNEL_SQL} SELECT item_id, impressions, clicks, round(ctr, 6) AS ctr, round(ctr_z, 6) AS ctr_z, {_FUNNEL_FLAG} FROM funnel")
def detect_funnel(spark, d):
    return _rounded(_funnel(spark, d), "ctr", "ctr_z")


_VELOCITY_SQL = """vh AS (SELECT user_id, "timestamp" // 86400 AS d, "timestamp" // 3600 AS h, count(*) AS n FROM ev GROUP BY 1, 2, 3), vd AS (SELECT user_id, d, sum(n) AS n, max(n) AS h FROM vh GROUP BY 1, 2),
  vu AS (SELECT user_id, CAST(sum(n) AS BIGINT) AS total, count(*) AS active_days, CAST(max(n) AS BIGINT) AS max_daily, max(h) AS max_hourly FROM vd GROUP BY 1), vi AS (SELECT user_id, count(DISTINCT item_id) AS distinct_items FROM ev GROUP BY 1), velocity AS (
  SELECT user_id, total, distinct_items, active_days, max_daily, max_hourly, total >= 1 AND (max_daily >= 7 OR max_hourly >= 3) AS flag_velocity FROM vu JOIN vi USING (user_id))"""


def _velocity(spark, d):
    return detectors.user_velocity_anomaly(events(spark, d), 7, 3)


@query(f"WITH {E_SQL}, {_VELOCITY_SQL} SELECT * FROM velocity")
def detect_velocity(spark, d):
    return _velocity(spark, d)


@query(f"WITH {E_SQL}, {_VELOCITY_SQL} SELECT user_id, flag_velocity, flag_velocity AS is_abnormal_user, CASE WHEN flag_velocity THEN 'velocity' ELSE '' END AS reason FROM velocity")
def score_users(spark, d):
    return detectors.score_users(_velocity(spark, d))


_GEO_ITEM = "2.0 + (p_partkey * 37) % 120"


@query("""WITH i AS (SELECT p_partkey, CAST((p_partkey * 37) % 120 - 60 AS DOUBLE) AS item_lat, CAST((p_partkey * 91) % 300 - 150 AS DOUBLE) AS item_lon FROM part),
k AS (SELECT CAST(l_partkey AS VARCHAR) AS item_id, 2 * 6371.0 * asin(sqrt(least(1.0, greatest(0.0, pow(sin(radians(item_lat - ulat) / 2), 2) + cos(radians(ulat)) * cos(radians(item_lat)) * pow(sin(radians(item_lon - ulon) / 2), 2))))) AS km
  FROM (SELECT l_partkey, CAST((l_suppkey * 53) % 120 - 60 AS DOUBLE) AS ulat, CAST((l_orderkey * 17) % 300 - 150 AS DOUBLE) AS ulon FROM lineitem) JOIN i ON p_partkey = l_partkey)
SELECT item_id, count(*) AS geo_count, round(avg(CASE WHEN km >= 8000 THEN 1.0 ELSE 0.0 END), 6) AS far_share, round(quantile_disc(km, 0.9), 3) AS p90_km, count(*) >= 20 AND (avg(CASE WHEN km >= 8000 THEN 1.0 ELSE 0.0 END) >= 0.65 OR quantile_disc(km, 0.9) >= 17000) AS flag_geo FROM k GROUP BY 1""")
def detect_geo(spark, d):
    deg = lambda c, f, m, o: (F.col(c) * f % m - o).cast("double")
    items = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"), deg("p_partkey", 37, 120, 60).alias("item_lat"), deg("p_partkey", 91, 300, 150).alias("item_lon"))
    rows = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("item_id"), deg("l_suppkey", 53, 120, 60).alias("user_lat"), deg("l_orderkey", 17, 300, 150).alias("user_lon"))
    out = detectors.geo_mismatch(rows, items, 8000, 0.65, 17000, 20)
    return out.withColumns({"far_share": F.round("far_share", 6), "p90_km": F.round("p90_km", 3)})


_SCORE_SQL = f"""{_BURST_SQL}, {_POP_SQL}, {_FUNNEL_SQL}, ff AS (SELECT item_id, {_FUNNEL_FLAG} FROM funnel), sc AS (
  SELECT item_id, coalesce(flag_popularity, false) AS flag_popularity, coalesce(flag_burst, false) AS flag_burst, coalesce(flag_funnel, false) AS flag_funnel, false AS flag_geo
  FROM pop FULL JOIN burst USING (item_id) FULL JOIN ff USING (item_id)), scored AS (
  SELECT *, CAST(flag_popularity AS INT) + CAST(flag_burst AS INT) + CAST(flag_funnel AS INT) AS campaign_score,
         CAST(flag_popularity AS INT) + CAST(flag_burst AS INT) + CAST(flag_funnel AS INT) >= 1 AS is_campaign_item,
         concat_ws('|', CASE WHEN flag_popularity THEN 'popularity' END, CASE WHEN flag_burst THEN 'burst' END, CASE WHEN flag_funnel THEN 'funnel' END) AS reason FROM sc)"""


@query(f"WITH {E_SQL}, {_SCORE_SQL} SELECT * FROM scored")
def score_items(spark, d):
    return detectors.score_items(_popularity(spark, d), _burst(spark, d), _funnel(spark, d))


@query(f"WITH {E_SQL}, {_SCORE_SQL}, {_VELOCITY_SQL} SELECT event_id FROM ev WHERE user_id NOT IN (SELECT user_id FROM velocity WHERE flag_velocity) AND item_id NOT IN (SELECT item_id FROM scored WHERE is_campaign_item)")
def campaign_drop(spark, d):
    return behaviour.campaign_filter(events(spark, d), score_items(spark, d), score_users(spark, d)).select("event_id")


@query(f"""WITH {E_SQL}, {_SCORE_SQL}, h AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY "timestamp", event_id) AS n FROM ev WHERE item_id IN (SELECT item_id FROM scored WHERE is_campaign_item))
SELECT event_id FROM ev WHERE item_id NOT IN (SELECT item_id FROM scored WHERE is_campaign_item) UNION ALL SELECT event_id FROM h WHERE n <= 20""")
def campaign_cap(spark, d):
    return behaviour.campaign_filter(events(spark, d), score_items(spark, d), drop_items=False, downsample=True, cap=20, tie=("event_id",)).select("event_id")


@query(f"""WITH {E_SQL}, {_SCORE_SQL}, {_VELOCITY_SQL}, a AS (SELECT count(*) AS n_after FROM ev WHERE user_id NOT IN (SELECT user_id FROM velocity WHERE flag_velocity) AND item_id NOT IN (SELECT item_id FROM scored WHERE is_campaign_item)), bb AS (SELECT count(*) AS n_before FROM ev)
SELECT n_before, n_after, (SELECT count(*) FROM scored WHERE is_campaign_item) AS campaign_items, (SELECT count(*) FROM scored WHERE flag_popularity) AS n_flag_popularity, (SELECT count(*) FROM scored WHERE flag_burst) AS n_flag_burst, (SELECT count(*) FROM scored WHERE flag_funnel) AS n_flag_funnel, CAST(0 AS BIGINT) AS n_flag_geo,
 (SELECT count(*) FROM velocity WHERE flag_velocity) AS abnormal_users, round((n_before - n_after) * 100.0 / n_before, 4) AS removed_pct FROM a, bb""")
def campaign_summary(spark, d):
    e, i, u = events(spark, d), score_items(spark, d), score_users(spark, d)
    return detectors.campaign_summary(e, behaviour.campaign_filter(e, i, u), i, u)


# ---- review analyzers

_ANALYZER_SQL = {
    "user_review_count": "SELECT user_id, count(*) AS review_count FROM rv GROUP BY 1",
    "product_review_count": "SELECT parent_asin, count(*) AS review_count FROM rv GROUP BY 1",
    "product_rating_stats": "SELECT parent_asin, max(rating) AS max_rating, min(rating) AS min_rating, round(avg(rating), 6) AS avg_rating, count(*) AS rating_count, quantile_disc(rating, 0.5) AS median_rating FROM rv GROUP BY 1",
    "rating_by_time": "SELECT review_year_month, round(avg(rating), 6) AS avg_rating, count(*) AS review_count, max(rating) AS max_rating, min(rating) AS min_rating FROM rv GROUP BY 1",
    "rating_distribution": "SELECT floor(a * 2) / 2 AS rating_bucket, count(*) AS product_count FROM (SELECT avg(rating) AS a FROM rv GROUP BY parent_asin) GROUP BY 1",
    "review_length_stats": "SELECT parent_asin, round(avg(text_length), 6) AS avg_length, CAST(max(text_length) AS INT) AS max_length, CAST(min(text_length) AS INT) AS min_length, count(*) AS review_count FROM rv GROUP BY 1",
    "title_length_stats": "SELECT parent_asin, round(avg(title_length), 6) AS avg_length, CAST(max(title_length) AS INT) AS max_length, CAST(min(title_length) AS INT) AS min_length, count(*) AS review_count FROM rv GROUP BY 1",
    "verified_purchase_comparison": "SELECT is_verified, round(avg(rating), 6) AS avg_rating, count(*) AS review_count, quantile_disc(rating, 0.5) AS median_rating, round(stddev_samp(rating), 6) AS stddev_rating, CASE WHEN is_verified THEN 'verified' ELSE 'unverified' END AS label FROM rv GROUP BY 1",
    "first_vs_subsequent_review": "SELECT n = 1 AS is_first_review, round(avg(rating), 6) AS avg_rating, count(*) AS review_count, quantile_disc(rating, 0.5) AS median_rating FROM num GROUP BY 1",
    "weekday_rating": "SELECT review_weekday, round(avg(rating), 6) AS avg_rating, count(*) AS review_count FROM rv GROUP BY 1",
    "length_by_rating": "SELECT rating, round(avg(text_length), 6) AS avg_text_length, round(avg(title_length), 6) AS avg_title_length, count(*) AS review_count FROM rv GROUP BY 1",
    "rating_polarization": "SELECT category, n AS \"count\", round(n * 100.0 / sum(n) OVER (), 6) AS percentage FROM (SELECT CASE WHEN rating = 1 THEN '1_star' WHEN rating = 5 THEN '5_star' ELSE 'middle' END AS category, count(*) AS n FROM rv GROUP BY 1)",
    "product_review_tail": "SELECT CASE WHEN n = 1 THEN '1' WHEN n <= 3 THEN '2-3' WHEN n <= 10 THEN '4-10' WHEN n <= 50 THEN '11-50' WHEN n <= 100 THEN '51-100' ELSE '100+' END AS count_bucket, count(*) AS product_count FROM (SELECT count(*) AS n FROM rv GROUP BY parent_asin) GROUP BY 1",
    "user_rating_trend": "SELECT CAST(n AS INT) AS review_number, round(avg(rating), 6) AS avg_rating, count(*) AS review_count FROM num WHERE n <= 10 AND user_id IN (SELECT user_id FROM rv GROUP BY 1 HAVING count(*) >= 2) GROUP BY 1",
    "helpful_vote_analysis": "SELECT helpful_vote, round(avg(rating), 6) AS avg_rating, count(*) AS review_count FROM rv GROUP BY 1",
    "popularity_comparison": "SELECT CASE WHEN n >= (SELECT quantile_disc(n, 0.5) FROM p) THEN 'Popular' ELSE 'Niche' END AS popularity, round(avg(a), 6) AS overall_avg_rating, round(avg(n), 6) AS avg_review_count, count(*) AS product_count FROM p GROUP BY 1",
    "monthly_rating_distribution": "SELECT review_year_month, rating, count(*) AS review_count FROM rv GROUP BY 1, 2",
    "null_statistics": "SELECT field, n AS null_count, printf('%.2f%%', round(n * 100.0 / t, 2)) AS null_ratio FROM (SELECT unnest([" + ", ".join(f"{{'field': '{c}', 'n': count(*) FILTER ({c} IS NULL OR {c} = '')}}" for c in ("title", "text", "user_id", "verified_purchase")) + "], recursive := true), count(*) AS t FROM rv)",
}


def _analyzer_query(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = review_rows(spark, d)
        if name == "null_statistics":
            rows = rows.select("title", "text", "user_id", "verified_purchase")
        out = reviews.ANALYZERS[name](rows)
        return out.withColumns({c: F.round(c, 6) for c, t in out.dtypes if t == "double" and c != "rating_bucket"})

    run.__name__ = f"reviews_{name}"
    return run


for _name, _sql in _ANALYZER_SQL.items():
    _with = f"WITH {R_SQL}, num AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY review_ms NULLS LAST, review_id) AS n FROM rv WHERE user_id IS NOT NULL), p AS (SELECT parent_asin, avg(rating) AS a, count(*) AS n FROM rv GROUP BY 1) "
    query(_with + _sql, f"reviews_{_name}")(_analyzer_query(_name))


@query("SELECT count(*) AS total_reviews, count(DISTINCT user_id) AS unique_users, count(DISTINCT parent_asin) AS unique_products FROM amazon_new_review")
def reviews_summary(spark, d):
    return reviews.summary(table(spark, d, "amazon_new_review"))


@query("SELECT bin, CAST((bin - 1) * 10 AS DOUBLE) AS low, CAST(bin * 10 AS DOUBLE) AS high, count(*) AS n FROM (SELECT CAST(CASE WHEN length(text) >= 300 THEN 31 ELSE length(text) // 10 + 1 END AS INT) AS bin FROM amazon_new_review WHERE text IS NOT NULL) GROUP BY 1")
def reviews_histogram(spark, d):
    return _rounded(reviews.histogram(review_rows(spark, d), "text_length", 0, 300, 30), "low", "high")


# ---- audit


@query("SELECT count(*) AS rows, 8 AS n_columns, 'doc_id,text,lang,source,n_chars,item_id,created_at' AS columns FROM documents".replace("8 AS", "7 AS"))
def audit_rows(spark, d):
    return audit.row_count(table(spark, d, "documents"))


@query("SELECT field, present, complete, round(complete * 100.0 / t, 4) AS completeness_pct FROM (SELECT unnest([{'field': 'text', 'present': true, 'complete': count(*) FILTER (text IS NOT NULL AND text <> '')}, {'field': 'n_chars', 'present': true, 'complete': count(*) FILTER (n_chars IS NOT NULL)}, {'field': 'missing', 'present': false, 'complete': 0}], recursive := true), count(*) AS t FROM documents)")
def audit_completeness(spark, d):
    return audit.field_completeness(table(spark, d, "documents"), ["text", "n_chars", "missing"])


@query("SELECT key, total, distinct_keys, total - distinct_keys AS duplicates, round((total - distinct_keys) * 100.0 / total, 4) AS duplicate_pct FROM (SELECT 'text' AS key, count(*) AS total, count(DISTINCT text) + CAST(count(*) > count(text) AS INT) AS distinct_keys FROM documents UNION ALL SELECT 'doc_id+source', count(*), (SELECT count(*) FROM (SELECT DISTINCT doc_id, source FROM documents)) FROM documents)")
def audit_uniqueness(spark, d):
    return audit.key_uniqueness(table(spark, d, "documents"), ["text", ["doc_id", "source"]])


@query(f"WITH {E_SQL} SELECT min(\"timestamp\") AS min_time, max(\"timestamp\") AS max_time, max(\"timestamp\") - min(\"timestamp\") AS span_seconds, round((max(\"timestamp\") - min(\"timestamp\")) / 86400, 2) AS span_days, false AS is_empty FROM ev")
def audit_time(spark, d):
    return audit.time_range(events(spark, d))


@query("SELECT 'l_quantity' AS field, count(*) FILTER (l_quantity < 5 OR l_quantity > 45) AS outliers, count(*) AS total, round(count(*) FILTER (l_quantity < 5 OR l_quantity > 45) * 100.0 / count(*), 4) AS outlier_pct FROM lineitem UNION ALL SELECT 'l_discount', count(*) FILTER (l_discount > 0.09), count(*), round(count(*) FILTER (l_discount > 0.09) * 100.0 / count(*), 4) FROM lineitem")
def audit_outliers(spark, d):
    return audit.outlier_check(table(spark, d, "lineitem"), {"l_quantity": (5, 45), "l_discount": (None, 0.09)})


# ---- sequences, co-occurrence, features


@query(f"WITH {E_SQL} SELECT user_id, list(event_id ORDER BY \"timestamp\", item_id, action, event_id) AS event_ids FROM ev GROUP BY 1")
def sequence_full(spark, d):
    seq = sequences.user_sequences(events(spark, d).select("user_id", "timestamp", "item_id", "action", "event_id"))
    return seq.select("user_id", F.transform("interaction_history", lambda x: x["event_id"]).alias("event_ids"))


@query(f"WITH {O_SQL}, w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY \"timestamp\", item_id, action) AS n FROM od) SELECT user_id, list(item_id ORDER BY n) AS items, count(*) AS seq_length FROM w WHERE n <= 10 GROUP BY 1")
def sequence_history(spark, d):
    out = sequences.user_history(orders(spark, d), 10)
    return out.select("user_id", F.transform("history", lambda x: x["item_id"]).alias("items"), "seq_length")


_PAIR_SQL = f"""WITH {E_SQL}, o AS (SELECT user_id, item_id, min("timestamp") AS t FROM ev WHERE item_id IS NOT NULL GROUP BY 1, 2),
p AS (SELECT a.item_id, b.item_id AS related, count(*) AS n FROM o a JOIN o b ON a.user_id = b.user_id AND a.item_id <> b.item_id AND abs(a.t - b.t) <= 172800 GROUP BY 1, 2 HAVING count(*) >= 12),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, related) AS k FROM p)"""


@query(_PAIR_SQL + " SELECT item_id, list(related ORDER BY k) AS related_items FROM r WHERE k <= 20 GROUP BY 1")
def co_occurrence(spark, d):
    return sequences.co_occurrence(events(spark, d), 2, None, 12, 20)


@query(_PAIR_SQL + ", s AS (SELECT item_id, related, k FROM r WHERE k <= 20), kn AS (SELECT DISTINCT item_id FROM ev WHERE CAST(item_id AS INT) < 60), kept AS (SELECT s.item_id, list(related ORDER BY k) AS related_items FROM s WHERE related IN (SELECT item_id FROM kn) AND item_id IN (SELECT item_id FROM kn) GROUP BY 1) SELECT item_id, related_items FROM (SELECT DISTINCT item_id FROM s WHERE item_id IN (SELECT item_id FROM kn)) LEFT JOIN kept USING (item_id)")
def related_cleanup(spark, d):
    items = events(spark, d).select("item_id").where("cast(item_id as int) < 60").distinct()
    return sequences.clean_related(co_occurrence(spark, d), items)


@query(f"""WITH {E_SQL}, p AS (SELECT a.item_id, b.item_id AS related, count(*) AS n FROM ev a JOIN ev b ON a.user_id = b.user_id AND a.item_id <> b.item_id AND abs(a."timestamp" - b."timestamp") <= 86400 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, related) AS k FROM p), pop AS (SELECT item_id AS related, count(*) AS c FROM ev GROUP BY 1)
SELECT item_id, related AS related_item_id, n AS co_count, round(n / log10(c + 10), 6) AS weight FROM r JOIN pop USING (related) WHERE k <= 50""")
def co_purchase(spark, d):
    return _rounded(sequences.co_purchase(events(spark, d), 1), "weight")


@query(f"WITH {O_SQL}, s AS (SELECT item_id, count(*) AS interaction_count, count(DISTINCT user_id) AS unique_buyers, min(\"timestamp\") AS first_ts, max(\"timestamp\") AS last_ts, round(avg(rating), 6) AS avg_rating FROM od GROUP BY 1) SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_brand, coalesce(interaction_count, 0) AS interaction_count, coalesce(unique_buyers, 0) AS unique_buyers, first_ts, last_ts, avg_rating, coalesce(interaction_count, 0) < 25 AS is_cold FROM part LEFT JOIN s ON s.item_id = CAST(p_partkey AS VARCHAR)")
def feature_items(spark, d):
    items = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"), "p_brand")
    return _rounded(features.item_features(items, orders(spark, d), 25), "avg_rating")


@query(f"""WITH {O_SQL}, s AS (SELECT user_id, count(*) AS interaction_count, count(DISTINCT item_id) AS unique_items, min("timestamp") AS first_ts, max("timestamp") AS last_ts FROM od GROUP BY 1),
c AS (SELECT user_id, p_brand, count(*) AS n FROM od JOIN part ON item_id = CAST(p_partkey AS VARCHAR) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, p_brand) AS k FROM c),
t AS (SELECT user_id, string_agg(p_brand, ',' ORDER BY k) AS top_categories FROM r WHERE k <= 3 GROUP BY 1)
SELECT CAST(c_custkey AS VARCHAR) AS user_id, coalesce(interaction_count, 0) AS interaction_count, coalesce(unique_items, 0) AS unique_items, first_ts, last_ts, coalesce(round((last_ts - first_ts) / 86400, 2), 0) AS active_days, coalesce(interaction_count, 0) < 20 AS is_new_user, top_categories
FROM customer LEFT JOIN s ON s.user_id = CAST(c_custkey AS VARCHAR) LEFT JOIN t ON t.user_id = CAST(c_custkey AS VARCHAR)""")
def feature_users(spark, d):
    users = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    items = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"), F.col("p_brand").alias("category"))
    return features.user_features(users, orders(spark, d), items, 20)


@query("SELECT 'x' AS impression_id, 'x' AS user_id, 'x' AS item_id, 1 AS position, CAST(1 AS BIGINT) AS \"timestamp\", 'x' AS scene, 'x' AS request_id, 1 AS is_clicked, 'x' AS store_id, 'x' AS ext WHERE false")
def feature_impression_log(spark, d):
    return features.impression_log(spark)
