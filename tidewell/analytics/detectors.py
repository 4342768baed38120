"""Campaign detectors and their scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAGS = {"popularity": "flag_popularity", "burst": "flag_burst", "funnel": "flag_funnel", "geo": "flag_geo"}
HOUR, DAY = 3_600, 86_400

def _n():
    """Number of rows."""
    return F.count(F.lit(1))


def _with_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """df with the columns of a one-row frame, joined by broadcast on a constant."""
    return df.withColumn("_k", F.lit(1)).join(F.broadcast(one.withColumn("_k", F.lit(1))), "_k", "left").drop("_k")


def item_popularity_anomaly(df: DataFrame, share: float = 0.99, least: int = 500, per_user: float = 3.0) -> DataFrame:
    """Items with as many rows as the hottest (1 - share), at least `least`, or with many rows a user."""
    items = df.groupBy("item_id").agg(_n().alias("interaction_count"), F.countDistinct("user_id").alias("unique_users"))
    items = items.withColumn("per_user", F.try_divide(F.col("interaction_count").cast("double"), F.col("unique_users").cast("double")))
    cut = items.agg(F.greatest(F.percentile_approx("interaction_count", share, 10_000), F.lit(least)).alias("hot_cut"))
    flag = (F.col("interaction_count") >= F.col("hot_cut")) | (F.col("per_user") >= per_user)
    return _with_row(items, cut).select("item_id", "interaction_count", "unique_users", "per_user", F.coalesce(flag, F.lit(False)).alias("flag_popularity"))


def item_time_burst(df: DataFrame, bucket: str = "day", spike: float = 5.0, least: int = 100, top_share: float = 0.5) -> DataFrame:
    """Items whose busiest bucket stands out against their active buckets' mean, or holds most of their rows."""
    size = HOUR if bucket == "hour" else DAY
    buckets = df.groupBy("item_id", F.floor(F.col("timestamp") / size).alias("b")).agg(_n().alias("n"))
    items = buckets.groupBy("item_id").agg(F.sum("n").alias("total"), F.max("n").alias("busiest"), _n().alias("active_buckets"))
    ratio = F.col("busiest") * F.col("active_buckets") / F.col("total")
    part = F.col("busiest") / F.col("total")
    flag = (F.col("busiest") >= least) & ((ratio >= spike) | (part >= top_share))
    return items.select("item_id", "total", "busiest", "active_buckets", ratio.alias("spike_ratio"), part.alias("top_bucket_share"), flag.alias("flag_burst"))


def item_funnel_stats(df: DataFrame, actions: tuple[str, ...] = ("impression", "click"), least: int = 200, z: float = 3.0, cap: float = 1.0) -> DataFrame:
    """Items whose click rate stands out. The first action is the impression, all others count as clicks."""
    counts = [F.count_if(F.col("action") == a).alias(f"n_{i}") for i, a in enumerate(actions)]
    items = df.groupBy("item_id").agg(*counts).withColumns({"impressions": F.col("n_0"), "clicks": reduce(lambda a, b: a + b, (F.col(f"n_{i}") for i in range(1, len(actions))), F.lit(0)).cast("long")})
    items = items.withColumn("ctr", F.when(F.col("impressions") > 0, F.col("clicks") / F.col("impressions")))
    stats = items.where(F.col("impressions") >= least).agg(F.avg("ctr").alias("_m"), F.stddev("ctr").alias("_s"))
    score = F.when(F.coalesce(F.col("_s"), F.lit(0.0)) == 0, 0.0).otherwise((F.col("ctr") - F.col("_m")) / F.col("_s"))
    with_z = _with_row(items, stats).withColumn("ctr_z", score)
    flag = ((F.col("impressions") >= least) & ((F.col("ctr_z") >= z) | (F.col("ctr") >= cap))) | ((F.col("impressions") < least) & (F.col("clicks") >= least))
    return with_z.select("item_id", "impressions", "clicks", "ctr", "ctr_z", F.coalesce(flag, F.lit(False)).alias("flag_funnel"))


def user_velocity_anomaly(df: DataFrame, daily: int = 100, hourly: int = 50, least: int = 1) -> DataFrame:
    """Users with too many rows in a day or an hour. One aggregation by hour carries all the figures."""
    by_hour = df.groupBy("user_id", F.floor(F.col("timestamp") / DAY).alias("d"), F.floor(F.col("timestamp") / HOUR).alias("h")).agg(_n().alias("n"))
    by_day = by_hour.groupBy("user_id", "d").agg(F.sum("n").alias("n"), F.max("n").alias("h"))
    users = by_day.groupBy("user_id").agg(F.sum("n").alias("total"), _n().alias("active_days"), F.max("n").alias("max_daily"), F.max("h").alias("max_hourly"))
    items = df.groupBy("user_id").agg(F.countDistinct("item_id").alias("distinct_items"))
    flag = (F.col("total") >= least) & ((F.col("max_daily") >= daily) | (F.col("max_hourly") >= hourly))
    return users.join(items, F.equal_null(users["user_id"], items["user_id"])).select(users["user_id"], "total", "distinct_items", "active_days", "max_daily", "max_hourly", flag.alias("flag_velocity"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.sin(F.radians(lat2 - lat1) / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(F.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), a))))


def geo_mismatch(df: DataFrame, items: DataFrame, far_km: float = 50, far_share: float = 0.5, p90_km: float = 100, least: int = 50) -> DataFrame:
    """Items whose users are far away. df has user_lat, user_lon; items has item_lat, item_lon; without them nothing is flagged."""
    if not {"item_lat", "item_lon"} <= set(items.columns) or not {"user_lat", "user_lon"} <= set(df.columns):
        return df.select("item_id").distinct().select("item_id", F.lit(0).cast("long").alias("geo_count"), F.lit(None).cast("double").alias("p90_km"), F.lit(None).cast("double").alias("far_share"), F.lit(False).alias("flag_geo"))
    far = df.join(items.select("item_id", "item_lat", "item_lon"), "item_id").withColumn("km", haversine_km(F.col("user_lat"), F.col("user_lon"), F.col("item_lat"), F.col("item_lon"))).where("km is not null")
    out = far.groupBy("item_id").agg(_n().alias("geo_count"), F.percentile_approx("km", 0.9, 10_000).alias("p90_km"), F.avg((F.col("km") >= far_km).cast("double")).alias("far_share"))
    flag = (F.col("geo_count") >= least) & ((F.col("far_share") >= far_share) | (F.col("p90_km") >= p90_km))
    return out.withColumn("flag_geo", F.coalesce(flag, F.lit(False)))


DETECTORS = {"item_popularity_anomaly": item_popularity_anomaly, "item_time_burst": item_time_burst, "item_funnel_stats": item_funnel_stats, "user_velocity_anomaly": user_velocity_anomaly, "geo_mismatch": geo_mismatch}


def score_items(*detected: DataFrame, least: int = 1) -> DataFrame:
    """(item_id, flag_*, campaign_score, is_campaign_item, reason) of all items in any detector's result.

    The results are stacked and or-ed by item in one aggregation, which replaces a chain of full outer joins.
    """
    one = None
    for d in detected:
        flags = [(F.col(f) if f in d.columns else F.lit(False)).alias(f) for f in FLAGS.values()]
        d = d.select("item_id", *flags)
        one = d if one is None else one.unionByName(d)
    if one is None:
        raise ValueError("no detector result")
    items = one.groupBy("item_id").agg(*(F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in FLAGS.values()))
    score = reduce(lambda a, b: a + b, (F.col(f).cast("int") for f in FLAGS.values()))
    reason = F.concat_ws("|", *(F.when(F.col(f), F.lit(r)) for r, f in FLAGS.items()))
    return items.withColumns({"campaign_score": score, "is_campaign_item": score >= least, "reason": reason})


def score_users(velocity: DataFrame) -> DataFrame:
    flag = F.coalesce("flag_velocity", F.lit(False))
    return velocity.select("user_id", flag.alias("flag_velocity"), flag.alias("is_abnormal_user"), F.when(flag, "velocity").otherwise("").alias("reason"))


def campaign_summary(before: DataFrame, after: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """One row: rows before and after, flagged items and users, share of rows removed."""
    count = lambda d, n: d.agg(_n().alias(n))
    one = _with_row(count(before, "n_before"), count(after, "n_after"))
    one = _with_row(one, items.agg(F.count_if("is_campaign_item").alias("campaign_items"), *(F.count_if(f).alias(f"n_{f}") for f in FLAGS.values())))
    one = _with_row(one, users.agg(F.count_if("is_abnormal_user").alias("abnormal_users")))
    return one.withColumn("removed_pct", F.round(F.coalesce(F.try_divide((F.col("n_before") - F.col("n_after")) * 100.0, "n_before"), F.lit(0.0)), 4))
