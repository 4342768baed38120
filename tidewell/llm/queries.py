"""Queries of the subpackage, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.events import epoch_ms, event_name, shop_key, strip
from tidewell.llm import bpe, canonical, format_copies, leaks, runs, sentences, stripes
from tidewell.session import table


def _brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "o2o_new_gut_shop_base").select(F.lit("brnd_nm").alias("source_field"), F.col("shopId").alias("record_key"), F.col("brnd_nm").alias("value"))
    third = table(spark, sf_dir, "o2o_new_gut_shop_base_third")
    rows = own.unionByName(third.select(F.lit("str_nm").alias("source_field"), F.col("Id").cast("string").alias("record_key"), F.col("Str_Nm").alias("value")))
    brands = table(spark, sf_dir, "brand_list")
    known = brands.select(F.col("brand_nm").alias("value")).where("value is not null").distinct()
    typed = rows.where(F.col("value").isNotNull() & F.col("value").rlike(r"(?U)\S")).join(known, "value", "left_anti")
    found = canonical.map_values(typed, "value", brands, "brand_id", ["brand_nm", "alias_nm"], third.select("City_Nm"), "cat_nm")
    return typed.join(found, "value")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brands(spark, sf_dir).select("source_field", "record_key", F.coalesce("brand_id", F.lit(0)).cast("long").alias("brand_id")).distinct()


def p1_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that no listed brand is meant by, with the number of records."""
    return _brands(spark, sf_dir).where("brand_id is null").groupBy("source_field", "value").agg(F.countDistinct("record_key").alias("n_records"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "user_seq")
    day = F.floor(epoch_ms(F.col("event_time")) / F.lit(86_400_000))
    rows = events.select(strip(F.col("custref_no")).alias("who"), day.alias("day"), shop_key(F.col("shopid")).alias("shop"))
    return stripes.co_occurrence(rows, ["who", "day"], "shop", 4, 5.0, stripes.implied_llr(4, 5.0))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select(F.col("item_a").alias("shopid_a"), F.col("item_b").alias("shopid_b"))


def p2_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p2_found with counts, lift and log-likelihood ratio."""
    return _pairs(spark, sf_dir).withColumn("llr", F.round("llr", 3)).withColumn("lift", F.round("lift", 3))


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = table(spark, sf_dir, "amazon_new_review").select(F.lit("new").alias("source_table"), strip(F.col("user_id")).alias("user"), "asin", "review_id", "text")
    old = table(spark, sf_dir, "amazon_old_review").select(F.lit("old").alias("source_table"), strip(F.col("reviewerID")).alias("user"), "asin", "review_id", F.col("reviewText").alias("text"))
    return new.unionByName(old)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = format_copies.collapse(_reviews(spark, sf_dir), ["source_table", "user", "asin"], "text", "review_id")
    return members.select("source_table", "keep_id", "copy_id")


def p3_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each different review text of a user on a product, with the number of its copies."""
    _, sets = format_copies.collapse(_reviews(spark, sf_dir), ["source_table", "user", "asin"], "text", "review_id")
    return sets.select("source_table", "keep_id", "n_copies")


def p3_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that occur in several reviews of a table, whoever wrote them, with the number of reviews; 20 or more make a text hot."""
    _, sets = format_copies.collapse(_reviews(spark, sf_dir), ["source_table"], "text", "review_id", hot=20)
    return sets.where("n_copies > 1").select("source_table", "keep_id", "n_copies")


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "user_seq").select(strip(F.col("custref_no")).alias("custref_no"), "shopid", "event", epoch_ms(F.col("event_time")).alias("ms"), "event_id")
    same = {"shopid": shop_key, "event": lambda c: F.when(strip(c).isNotNull(), event_name(c))}
    return runs.collapse_runs(events, "custref_no", "ms", "event_id", same, breaks=["event"])


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir).select("custref_no", "shopid", "start_ms", "end_ms")


def p7_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p7_found with event, duration and count."""
    return _runs(spark, sf_dir)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document by byte_bpe_50k."""
    return bpe.encode_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of a test item's wording, with the tokens covered and the item's size."""
    return leaks.find_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text", "lang")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_leaks(spark, sf_dir).select("doc_id", "item_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences of each document as offsets."""
    return sentences.sentences(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {f.__name__: f for f in (p1_found, p1_unmatched, p2_found, p2_pairs, p3_found, p3_sets, p3_texts, p7_found, p7_runs, p8_ids, p9_found, p9_leaks, p10_found)}

_WIDE = "translate(shopid, '０１２３４５６７８９', '0123456789')"
_CLEAN = rf"""
e AS (
  SELECT event_id, regexp_replace(custref_no, '^\s+|\s+$', '', 'g') AS who,
         ltrim(regexp_replace(regexp_replace(trim({_WIDE}), '^shopId=', ''), '\.0$', ''), '0') AS shop,
         lower(regexp_replace(event, '[^\p{{L}}\p{{N}}]+', '', 'g')) AS ev,
         CASE WHEN event_time < 1000000000000 THEN event_time * 1000 ELSE event_time END AS ms
  FROM user_seq
  WHERE event_time IS NOT NULL AND regexp_replace(custref_no, '\s', '', 'g') <> '' AND trim(shopid) <> ''
)"""

_PAIR_SQL = f"""
WITH {_CLEAN}, d AS (SELECT DISTINCT who, ms // 86400000 AS day, shop FROM e),
n AS (SELECT count(*) AS n FROM (SELECT DISTINCT who, day FROM d)),
c AS (SELECT shop, count(*) AS k FROM d GROUP BY 1),
p AS (SELECT x.shop AS a, y.shop AS b, count(*) AS k FROM d x JOIN d y ON x.who = y.who AND x.day = y.day AND x.shop < y.shop GROUP BY 1, 2 HAVING count(*) >= 4)
SELECT {{}} FROM p JOIN c ca ON ca.shop = a JOIN c cb ON cb.shop = b, n WHERE p.k * n.n >= 5 * ca.k * cb.k"""

_CELL = "CASE WHEN {k} > 0 THEN {k} * ln({k} * CAST(n.n AS DOUBLE) / ({r} * CAST({c} AS DOUBLE))) ELSE 0 END"
_CELLS = " + ".join(_CELL.format(k=f"({k})", r=f"({r})", c=f"({c})") for k, r, c in (("p.k", "ca.k", "cb.k"), ("ca.k - p.k", "ca.k", "n.n - cb.k"), ("cb.k - p.k", "n.n - ca.k", "cb.k"), ("n.n - ca.k - cb.k + p.k", "n.n - ca.k", "n.n - cb.k")))
_PAIR_COLUMNS = f"a AS item_a, b AS item_b, p.k AS n_both, ca.k AS n_a, cb.k AS n_b, n.n AS n_baskets, round(p.k * CAST(n.n AS DOUBLE) / (ca.k * cb.k), 3) AS lift, round(2 * ({_CELLS}), 3) AS llr"

_RUN_SQL = f"""
WITH {_CLEAN}, u AS (SELECT DISTINCT who, ms, event_id, shop, ev FROM e), g AS (
  SELECT *, CASE WHEN ms - lag(ms) OVER w <= 600000 AND shop = lag(shop) OVER w AND ev = lag(ev) OVER w THEN 0 ELSE 1 END AS fresh FROM u
  WINDOW w AS (PARTITION BY who ORDER BY ms, length(event_id), event_id)
), s AS (SELECT *, sum(fresh) OVER (PARTITION BY who ORDER BY ms, length(event_id), event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT {{}} FROM s GROUP BY who, k HAVING count(*) >= 2"""

ORACLES = {
    "p2_found": _PAIR_SQL.replace("{}", "a AS shopid_a, b AS shopid_b"),
    "p2_pairs": _PAIR_SQL.replace("{}", _PAIR_COLUMNS),
    "p7_found": _RUN_SQL.replace("{}", "who AS custref_no, min(shop) AS shopid, min(ms) AS start_ms, max(ms) AS end_ms"),
    "p7_runs": _RUN_SQL.replace("{}", "who AS custref_no, min(shop) AS shopid, min(ev) AS event, min(ms) AS start_ms, max(ms) AS end_ms, max(ms) - min(ms) AS duration_ms, count(*) AS n_events"),
}
