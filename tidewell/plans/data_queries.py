"""Queries for the general data problems: heavy keys (p4), sessions (p5), nearness (p6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.events import epoch_ms, position, strip
from tidewell.operators import sessions, skew, spatial
from tidewell.session import table

HEAVY_SHARE = 0.02
EARLY_MS = 30 * 86_400_000


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and users with at least 2 % of all reviews, from the load plans of the two fields."""
    reviews = table(spark, sf_dir, "amazon_new_review")
    rows = []
    for name in ("parent_asin", "user_id"):
        keys = reviews.select(strip(F.col(name)).alias(name))
        plan = skew.plan_load(keys, name, share=HEAVY_SHARE)
        rows += [(name, k) for k, _ in plan.over(HEAVY_SHARE)]
    return spark.createDataFrame(rows, "field string, key_value string")


def _profile(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    reviews = table(spark, sf_dir, "amazon_new_review").select("review_id", strip(F.col(key)).alias(key), "rating", "helpful_vote", epoch_ms(F.col("timestamp")).alias("ms"))
    plan = skew.plan_load(reviews.select(key), key)
    first = reviews.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("ms").alias("first_ms"))
    joined = skew.balanced_join(reviews, first, plan, "review_id")
    return joined.groupBy(F.col(key).alias("key_value")).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.sum(F.col("rating").cast("long")).alias("sum_rating"),
        F.sum(F.col("helpful_vote").cast("long")).alias("sum_helpful"),
        F.count_if(F.col("ms") - F.col("first_ms") <= EARLY_MS).alias("n_early"),
        F.max("ms").alias("last_ms"),
    )


def _profile_sql(key: str) -> str:
    return f"""
WITH r AS (
  SELECT trim({key}) AS key_value, rating, helpful_vote,
         CASE WHEN "timestamp" < 1000000000000 THEN "timestamp" * 1000 ELSE "timestamp" END AS ms
  FROM amazon_new_review WHERE trim({key}) <> ''
), f AS (SELECT key_value, min(ms) AS first_ms FROM r GROUP BY 1)
SELECT r.key_value, count(*) AS n_reviews, CAST(sum(CAST(rating AS BIGINT)) AS BIGINT) AS sum_rating,
       CAST(sum(helpful_vote) AS BIGINT) AS sum_helpful,
       CAST(sum(CASE WHEN ms - first_ms <= {EARLY_MS} THEN 1 ELSE 0 END) AS BIGINT) AS n_early, max(ms) AS last_ms
FROM r JOIN f USING (key_value) GROUP BY 1"""


def p4_item_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per item: reviews, sums, reviews in the item's first 30 days; heavy items split over tasks."""
    return _profile(spark, sf_dir, "parent_asin")


def p4_user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "user_id")


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "user_seq").select(strip(F.col("custref_no")).alias("custref_no"), epoch_ms(F.col("event_time")).alias("ms"), "event_id")
    return sessions.sessionize(events, "custref_no", "ms", 1_800_000, "event_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir).select("custref_no", "start_ms", "end_ms")


def p5_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p5_found with duration and the number of different events."""
    return _sessions(spark, sf_dir)


_SESSION_SQL = r"""
WITH e AS (
  SELECT DISTINCT regexp_replace(custref_no, '^\s+|\s+$', '', 'g') AS custref_no,
         CASE WHEN event_time < 1000000000000 THEN event_time * 1000 ELSE event_time END AS ms, event_id
  FROM user_seq WHERE event_time IS NOT NULL AND regexp_replace(custref_no, '\s', '', 'g') <> ''
), g AS (
  SELECT *, CASE WHEN ms - lag(ms) OVER w <= 1800000 THEN 0 ELSE 1 END AS fresh FROM e
  WINDOW w AS (PARTITION BY custref_no ORDER BY ms, event_id)
), s AS (
  SELECT *, sum(fresh) OVER (PARTITION BY custref_no ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g
)
SELECT custref_no, min(ms) AS start_ms, max(ms) AS end_ms{} FROM s GROUP BY custref_no, k"""


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    shops = table(spark, sf_dir, "o2o_new_gut_shop_base_third").select("Str_Id", "Id", "Lng", "Lat", "etl_dt").where(F.col("Str_Id").isNotNull())
    current = shops.groupBy("Str_Id").agg(F.max_by(F.struct("Lng", "Lat"), F.struct("etl_dt", "Id")).alias("at"))
    placed = current.select("Str_Id", position(F.col("at.Lng"), F.col("at.Lat")).alias("p")).where("p is not null").select("Str_Id", "p.*")
    near = spatial.points_within(placed, "Str_Id", "lng", "lat", 50.0).select(F.lit("shop").alias("kind"), "key_a", "key_b")
    events = table(spark, sf_dir, "user_seq").select("event_id", position(F.col("user_longitude"), F.col("user_latitude")).alias("p")).where("p is not null").select("event_id", "p.*")
    inside = spatial.points_in_regions(events, "event_id", "lng", "lat", table(spark, sf_dir, "geo_area"), "area_id", "ring_lng", "ring_lat")
    return near.unionByName(inside.select(F.lit("user").alias("kind"), F.col("key").alias("key_a"), F.col("region").alias("key_b")))


_WIDE_SQL = "upper(regexp_replace(translate({c}, '０１２３４５６７８９．，＝′″’”－', '0123456789.,=''\"''\"-'), '[\\s\\p{Z}]+', '', 'g'))"
_DMS_SQL = r"""try_cast(regexp_extract({w}, '^[ENWS]?(\d{1,3})°(\d{1,2})''(\d{1,2}(?:\.\d+)?)(?:"|'''')?[ENWS]?$', {i}) AS DOUBLE)"""


def _degrees_sql(c: str) -> str:
    """functions.events.position's reading of one coordinate."""
    w = _WIDE_SQL.replace("{c}", c)
    part = lambda i: _DMS_SQL.replace("{w}", w).replace("{i}", str(i))
    fast = f"try_cast(trim({c}, ' ' || chr(9) || chr(10) || chr(13)) AS DOUBLE)"
    plain = f"try_cast(replace(regexp_extract({w}, '^[ENWS]?([-+]?\\d{{1,3}}(?:[.,]\\d+)?)°?[ENWS]?$', 1), ',', '.') AS DOUBLE)"
    whole = f"try_cast(regexp_extract({w}, '^[ENWS]?(\\d{{7,9}})[ENWS]?$', 1) AS DOUBLE) / 1e6"
    return f"CASE WHEN {fast} BETWEEN -180 AND 180 THEN {fast} ELSE CASE WHEN regexp_matches({w}, '[WS]') THEN -1 ELSE 1 END * coalesce({plain}, {part(1)} + {part(2)} / 60 + {part(3)} / 3600, {whole}) END"


_RIGHT = "x BETWEEN 90 AND 130 AND y BETWEEN 15 AND 50"
_SWAPPED = "y BETWEEN 90 AND 130 AND x BETWEEN 15 AND 50"
_PICK_SQL = f"SELECT k, CASE WHEN {_RIGHT} THEN x ELSE y END AS lng, CASE WHEN {_RIGHT} THEN y ELSE x END AS lat FROM {{}} WHERE ({_RIGHT}) OR ({_SWAPPED})"
_NEAR_SQL = f"""
WITH c AS (SELECT Str_Id AS k, Lng AS a, Lat AS b FROM o2o_new_gut_shop_base_third WHERE Str_Id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY Str_Id ORDER BY etl_dt DESC NULLS LAST, Id DESC) = 1),
cr AS (SELECT k, {_degrees_sql("a")} AS x, {_degrees_sql("b")} AS y FROM c), s AS ({_PICK_SQL.format("cr")}),
er AS (SELECT event_id AS k, {_degrees_sql("user_longitude")} AS x, {_degrees_sql("user_latitude")} AS y FROM user_seq WHERE event_id IS NOT NULL), e AS (SELECT DISTINCT * FROM ({_PICK_SQL.format("er")})),
i AS (SELECT area_id, ring_lng AS gx, ring_lat AS gy, unnest(range(1, len(ring_lng) + 1)) AS i FROM geo_area),
g AS (SELECT area_id, gx[i] AS ax, gy[i] AS ay, gx[i % len(gx) + 1] AS bx, gy[i % len(gy) + 1] AS bq FROM i),
h AS (SELECT area_id, least(ax, bx) AS x1, CASE WHEN ax < bx THEN ay ELSE bq END AS y1, greatest(ax, bx) AS x2, CASE WHEN ax < bx THEN bq ELSE ay END AS y2 FROM g WHERE ax <> bx)
SELECT 'shop' AS kind, p.k AS key_a, q.k AS key_b FROM s p JOIN s q ON p.k < q.k AND abs(p.lat - q.lat) < 0.001
WHERE 2 * 6371000 * asin(sqrt(power(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * power(sin(radians(q.lng - p.lng) / 2), 2))) <= 50
UNION ALL SELECT DISTINCT 'user', k, area_id FROM (
  SELECT e.k, e.lng, e.lat, CAST(h.area_id AS VARCHAR) AS area_id FROM e JOIN h ON x1 <= e.lng AND e.lng < x2 AND y1 + (e.lng - x1) * ((y2 - y1) / (x2 - x1)) > e.lat
  GROUP BY e.k, e.lng, e.lat, h.area_id HAVING count(*) % 2 = 1)"""

QUERIES = {f.__name__: f for f in (p4_found, p4_item_profile, p4_user_profile, p5_found, p5_sessions, p6_found)}

ORACLES = {
    "p4_found": " UNION ALL ".join(f"SELECT '{k}' AS field, trim({k}) AS key_value FROM amazon_new_review WHERE trim({k}) <> '' GROUP BY 2 HAVING count(*) >= {HEAVY_SHARE} * (SELECT count(*) FROM amazon_new_review)" for k in ("parent_asin", "user_id")),
    "p4_item_profile": _profile_sql("parent_asin"),
    "p4_user_profile": _profile_sql("user_id"),
    "p6_found": _NEAR_SQL,
    "p5_found": _SESSION_SQL.format(""),
    "p5_sessions": _SESSION_SQL.format(", max(ms) - min(ms) AS duration_ms, count(*) AS n_events"),
}
