"""Per-user sequences, co-occurrence and related items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.contracts import has
from tidewell.operators.dedup import TIME_COLUMNS

DAY = 86_400
HISTORY_FIELDS = ("item_id", "action", "timestamp", "store_id", "merchant_id", "amount")


def user_sequences(df: DataFrame, user: str = "user_id", most: int | None = None) -> DataFrame:
    """(user, interaction_history): all other columns as structs in time order. Ties follow the other columns' values.

    The struct begins with the time, so sort_array orders by it without a lambda.
    `most` keeps each user's earliest rows, ranked before they are collected, which bounds a user's array.
    """
    time = next((c for c in TIME_COLUMNS if c in df.columns), None)
    if not has(df, user, what="user_sequences"):
        return df
    rest = [c for c in df.columns if c not in (user, time)]
    fields = [time, *rest] if time else rest
    if most is not None and time:
        w = Window.partitionBy(user).orderBy(*fields)
        df = df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    return df.groupBy(user).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("interaction_history"))


def user_history(df: DataFrame, most: int = 200) -> DataFrame:
    """(user_id, history, seq_length): each user's earliest rows, the known fields only, in time order."""
    fields = [c for c in HISTORY_FIELDS if c in df.columns]
    if not has(df, "user_id", "timestamp", what="user_history"):
        return df
    w = Window.partitionBy("user_id").orderBy("timestamp", *(c for c in fields if c != "timestamp"))
    kept = df.select("user_id", *fields).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    ordered = F.sort_array(F.collect_list(F.struct("_n", F.struct(*fields).alias("e"))))
    return kept.groupBy("user_id").agg(F.transform(ordered, lambda x: x["e"]).alias("history"), F.count(F.lit(1)).alias("seq_length"))


def _recent(df: DataFrame, days: float | None) -> DataFrame:
    if days is None:
        return df
    last = df.agg(F.max("timestamp")).first()[0]
    return df if last is None else df.where(F.col("timestamp") >= last - int(days * DAY))


def pair_counts(df: DataFrame, window_days: float = 30, lookback_days: float | None = None, dedup: bool = True) -> DataFrame:
    """(item_id, related, n): how often two items meet in one user within the window.

    dedup: an item counts once a user (its first time), so n is the number of users;
    otherwise pairs of rows are counted. The band join has the time bucket in its
    equi-key, so a user with many rows is spread over buckets instead of pairing with itself whole. Each two rows meet once, the earlier
    one in its bucket, the later one in its own and the bucket before; both directions come out of the counts.
    """
    span = int(window_days * DAY)
    rows = _recent(df, lookback_days).where("user_id is not null and item_id is not null and timestamp is not null").select("user_id", "item_id", "timestamp")
    if dedup:
        rows = rows.groupBy("user_id", "item_id").agg(F.min("timestamp").alias("timestamp"))
    bucket = F.floor(F.col("timestamp") / max(span, 1)).cast("long")
    first = rows.select("user_id", F.col("item_id").alias("x"), F.col("timestamp").alias("t"), bucket.alias("b"))
    later = rows.select("user_id", F.col("item_id").alias("y"), F.col("timestamp").alias("u"), F.explode(F.array(bucket - 1, bucket)).alias("b"))
    after = (F.col("u") > F.col("t")) | ((F.col("u") == F.col("t")) & (F.col("y") > F.col("x")))
    near = first.join(later, ["user_id", "b"]).where((F.col("x") != F.col("y")) & after & (F.col("u") - F.col("t") <= span))
    counts = near.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    ways = F.explode(F.array(F.struct(F.col("x").alias("item_id"), F.col("y").alias("related")), F.struct(F.col("y").alias("item_id"), F.col("x").alias("related"))))
    return counts.select(ways.alias("w"), "n").select("w.item_id", "w.related", "n")


def co_occurrence(df: DataFrame, window_days: float = 30, lookback_days: float | None = None, least: int = 2, most: int = 50) -> DataFrame:
    """(item_id, related_items): up to `most` items met by at least `least` users, most frequent first, ties by id."""
    pairs = pair_counts(df, window_days, lookback_days).where(F.col("n") >= least)
    w = Window.partitionBy("item_id").orderBy(F.desc("n"), "related")
    top = pairs.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    ordered = F.sort_array(F.collect_list(F.struct("_n", "related")))
    return top.groupBy("item_id").agg(F.transform(ordered, lambda x: x["related"]).alias("related_items"))


def co_purchase(df: DataFrame, window_days: float = 30, most: int = 50) -> DataFrame:
    """(item_id, related_item_id, co_count, weight): pairs of rows within the window, weight = co_count / log10(popularity of the related item + 10), the most frequent ones."""
    pairs = pair_counts(df, window_days, dedup=False)
    popularity = df.groupBy(F.col("item_id").alias("related")).agg(F.count(F.lit(1)).alias("pop"))
    w = Window.partitionBy("item_id").orderBy(F.desc("n"), "related")
    top = pairs.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    return top.join(popularity, "related").select("item_id", F.col("related").alias("related_item_id"), F.col("n").alias("co_count"), (F.col("n") / F.log10(F.col("pop") + 10)).alias("weight"))


def clean_related(co: DataFrame, items: DataFrame, column: str = "related_items") -> DataFrame:
    """co without related items that aren't in `items`, in their order; null where none is left. Rows of unknown items go too."""
    if not has(co, "item_id", column, what="clean_related"):
        return co
    known = items.select("item_id").where("item_id is not null").distinct()
    own = co.join(known, "item_id", "left_semi")
    flat = own.select("item_id", F.posexplode(column).alias("_p", "_r"))
    kept = flat.join(known.withColumnRenamed("item_id", "_r"), "_r", "left_semi")
    lists = kept.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("_p", "_r"))).alias("_l")).select("item_id", F.transform("_l", lambda x: x["_r"]).alias(column))
    return own.drop(column).join(lists, "item_id", "left")


def clean_meta(meta: DataFrame, items: DataFrame, columns: tuple[str, ...] = ("also_buy", "also_view")) -> DataFrame:
    """Catalogue rows of known items, their related lists cleaned alike."""
    out = meta.join(items.select("item_id").distinct(), "item_id", "left_semi")
    for c in columns:
        if c in meta.columns:
            out = clean_related(out, items, c)
    return out


