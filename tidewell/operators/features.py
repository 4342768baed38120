"""Item and user features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.contracts import IMPRESSION_LOG
from tidewell.operators import sequences


def _n():
    """Number of rows."""
    return F.count(F.lit(1))


def item_features(items: DataFrame, inter: DataFrame, cold: int = 3) -> DataFrame:
    """items with interaction_count, unique_buyers, avg_rating (if inter has ratings), first and last time, is_cold; items without rows have zeros."""
    stats = [_n().alias("interaction_count"), F.countDistinct("user_id").alias("unique_buyers"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")]
    if "rating" in inter.columns:
        stats.append(F.avg("rating").alias("avg_rating"))
    out = items.join(inter.groupBy("item_id").agg(*stats), "item_id", "left").na.fill(0, ["interaction_count", "unique_buyers"])
    return out.withColumn("is_cold", F.col("interaction_count") < cold)


def _favourites(rows: DataFrame, column: str, n: int, name: str) -> DataFrame:
    """(user_id, name): the user's n most frequent values, most frequent first, ties by value, with commas between."""
    counts = rows.where(F.col(column).isNotNull()).groupBy("user_id", column).agg(_n().alias("n"))
    w = Window.partitionBy("user_id").orderBy(F.desc("n"), column)
    top = counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return top.groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", F.col(column).cast("string").alias("v")))), lambda x: x["v"]), ",").alias(name))


def user_features(users: DataFrame, inter: DataFrame, items: DataFrame | None = None, new: int = 3, top_n: int = 3) -> DataFrame:
    """users with counts, first and last time, active_days, is_new_user, and their favourite categories (top_n) and content types (2) where items have them."""
    stats = inter.groupBy("user_id").agg(_n().alias("interaction_count"), F.countDistinct("item_id").alias("unique_items"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
    out = users.join(stats, "user_id", "left").na.fill(0, ["interaction_count", "unique_items"])
    out = out.withColumn("active_days", F.coalesce(F.round((F.col("last_ts") - F.col("first_ts")) / 86400, 2), F.lit(0.0))).withColumn("is_new_user", F.col("interaction_count") < new)
    if items is not None:
        wanted = [(c, n, name) for c, n, name in (("category", top_n, "top_categories"), ("content_type", 2, "top_content_types")) if c in items.columns]
        if wanted:
            rows = inter.select("user_id", "item_id").join(items.select("item_id", *(c for c, _, _ in wanted)), "item_id")
            for c, n, name in wanted:
                out = out.join(_favourites(rows, c, n, name), "user_id", "left")
    return out


def impression_log(spark: SparkSession) -> DataFrame:
    """The empty impression log; its schema is its only content."""
    return spark.createDataFrame([], IMPRESSION_LOG)


def extract(users: DataFrame, items: DataFrame, inter: DataFrame, config: dict | None = None) -> dict[str, DataFrame]:
    """The five feature tables, each with its own switch in config."""
    on = lambda k: (config or {}).get(k, True)
    out = {}
    if on("item_features"):
        out["item_features"] = item_features(items, inter)
    if on("user_features"):
        out["user_features"] = user_features(users, inter, items)
    if on("user_interaction_history"):
        out["user_interaction_history"] = sequences.user_history(inter)
    if on("co_purchase"):
        out["co_purchase"] = sequences.co_purchase(inter)
    if on("impression_log"):
        out["impression_log"] = impression_log(inter.sparkSession)
    return out
