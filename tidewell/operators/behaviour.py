"""Filters by behaviour: k-core, bursts, campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidewell.contracts import has
from tidewell.session import cut, drop_cut, rounds_of

#: Sets of dropped keys that k_core keeps beside the pairs, at most.
AWAY = 6


def k_core(df: DataFrame, k: int = 5, user: str = "user_id", item: str = "item_id", rounds: int | None = None) -> DataFrame:
    """Rows left when users and items of fewer than k rows are dropped again and again, until none is. Rows are counted, not pairs. Null keys go.
    With `rounds`, an error if it takes more.

    The rounds work on pair counts, not on rows: the pairs are far fewer than the
    rows of repeated interactions. A round counts the users' rows, then the items', and takes only those away that are too small, a set that shrinks
    quickly, by anti joins that are broadcast once it is small; it ends with the first side that loses nothing. The pairs are
    written anew when a quarter of the rows is gone or AWAY sets are. Tables are cut into the shared folder, so lost executors don't replay the
    rounds, and superseded ones go at once. The input is read again only by the two last semi joins, on the users and the items that are left.
    """
    if not has(df, user, item, what="k_core") or k <= 1:
        return df
    pairs = df.where(F.col(user).isNotNull() & F.col(item).isNotNull()).groupBy(F.col(user).alias("u"), F.col(item).alias("i")).agg(F.count(F.lit(1)).alias("n"))
    seen = Observation()
    pairs = cut(pairs.observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("rows")), "kcore")
    total = seen.get["rows"]
    away: list[tuple[str, DataFrame]] = []
    sizes: dict[str, DataFrame] = {}
    lost = 0

    def left() -> DataFrame:
        out = pairs
        for side, counts in away:
            out = out.join(counts.where(F.col("c") < k).select(side), side, "left_anti")
        return out

    for half in rounds_of(None if rounds is None else 2 * rounds, "k_core"):
        side = "ui"[half % 2]
        seen = Observation()
        sizes[side] = cut(left().groupBy(side).agg(F.sum("n").alias("c")).observe(seen, F.coalesce(F.sum(F.when(F.col("c") < k, F.col("c"))), F.lit(0)).alias("gone")), "kcore-sizes")
        gone = seen.get["gone"]
        if gone == 0 and half > 0:
            break
        if gone:
            away.append((side, sizes[side]))
            lost += gone
        if 4 * lost >= total or len(away) == AWAY:
            pairs = cut(left(), "kcore", instead_of=pairs)
            for _, t in away:
                if all(t is not x for x in sizes.values()):
                    drop_cut(t)
            away, total, lost = [], total - lost, 0
    drop_cut(pairs)
    # the last counts of each side hold all that is left of it, as nothing has gone since
    keep = lambda c, name: sizes[c].where(F.col("c") >= k).select(F.col(c).alias(name))
    return df.join(keep("u", user), user, "left_semi").join(keep("i", item), item, "left_semi").select(df.columns)


def burst_users(df: DataFrame, window_minutes: float = 10, most: int = 50, user: str = "user_id", time: str = "timestamp") -> DataFrame:
    """Users whose average rate exceeds most / window, or with more than `most` rows within one window in all."""
    stats = df.groupBy(user).agg(F.count(F.lit(1)).alias("n"), (F.max(time) - F.min(time)).alias("span"))
    rate = F.when((F.col("span") > 0) & (F.col("n") > 1), F.col("n") / (F.col("span") / 60)).otherwise(0.0)
    return stats.where((rate > most / window_minutes) | ((F.col("span") <= window_minutes * 60) & (F.col("n") > most))).select(user)


def drop_bursts(df: DataFrame, window_minutes: float = 10, most: int = 50, user: str = "user_id", time: str = "timestamp", exact: bool = False) -> DataFrame:
    """Without the rows of burst users; rows without user stay. exact: a user is out if any window of that length holds more than `most` rows."""
    if not has(df, user, time, what="drop_bursts"):
        return df
    if exact:
        w = Window.partitionBy(user).orderBy(time).rangeBetween(-int(window_minutes * 60), 0)
        bad = df.select(user, time).where(F.col(user).isNotNull()).withColumn("_n", F.count(F.lit(1)).over(w)).where(F.col("_n") > most).select(user).distinct()
    else:
        bad = burst_users(df, window_minutes, most, user, time)
    return df.join(bad, user, "left_anti")


def campaign_filter(df: DataFrame, item_flags: DataFrame | None = None, user_flags: DataFrame | None = None, drop_items: bool = True, drop_users: bool = True, downsample: bool = False, cap: int = 500, tie: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Without abnormal users; without campaign items, or with only their earliest `cap` rows. Dropping wins over capping."""
    if user_flags is not None and drop_users and has(df, "user_id", what="campaign_filter"):
        df = df.join(user_flags.where("is_abnormal_user").select("user_id").distinct(), "user_id", "left_anti")
    if item_flags is None or not has(df, "item_id", what="campaign_filter"):
        return df
    flagged = item_flags.where("is_campaign_item").select("item_id").distinct()
    if drop_items:
        return df.join(flagged, "item_id", "left_anti")
    if downsample and has(df, "timestamp", what="campaign cap"):
        # only the flagged items' rows are ranked; the rest takes no window
        hit = df.join(flagged, "item_id", "left_semi")
        w = Window.partitionBy("item_id").orderBy("timestamp", *tie)
        first = hit.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= cap).drop("_n")
        return df.join(flagged, "item_id", "left_anti").unionByName(first.select(df.columns))
    return df
