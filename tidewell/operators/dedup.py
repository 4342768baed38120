"""Deduplication of rows and of repeated neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.contracts import has
from tidewell.operators.ranking import with_previous

TIME_COLUMNS = ("timestamp", "review_time", "time")


def deduplicate(df: DataFrame, key: str | list[str] | None = None, order_by: list | None = None) -> DataFrame:
    """One row for each value of the key (a column or several; None: all columns). Null keys form one group.

    With order_by the first row in that order stays, kept by max/min aggregation over structs where possible, so a hot key is reduced before the shuffle.
    """
    if key is None:
        return df.dropDuplicates()
    keys = [key] if isinstance(key, str) else list(key)
    if not has(df, *keys, what="deduplicate"):
        return df
    if not order_by:
        return df.dropDuplicates(keys)
    if all(isinstance(c, str) for c in order_by):
        # the smallest row by (order, rest) a key: partial aggregation, no group in one task
        rest = [c for c in df.columns if c not in keys and c not in order_by]
        row = F.min_by(F.struct(*df.columns), F.struct(*order_by, *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in rest)))
        return df.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(row.alias("_row")).select("_row.*")
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def drop_repeats(df: DataFrame, user: str = "user_id", item: str = "item_id", keep: str = "first", tie: tuple[str, ...] = (), spread: bool | None = None) -> DataFrame:
    """Per user in time order (keep='last': backwards) the rows whose item equals the row's before go: run-length deduplication.

    A row with a null item, or after one, goes unless it is the user's first, as a null equals nothing and differs from nothing. Equal times are ordered by `tie` and item.
    A user with far more than a task's share of rows is spread over tasks (see with_previous).
    """
    time = next((c for c in TIME_COLUMNS if c in df.columns), None)
    if not has(df, user, item, what="drop_repeats") or time is None:
        return df
    order = [(F.asc if keep == "first" else F.desc)(time), *(F.asc(c) for c in tie), F.asc(item)]
    out = with_previous(df, [user], order, item, "_before", "_later", spread)
    return out.where(~F.col("_later") | (F.col("_before") != F.col(item))).drop("_before", "_later")


def drop_all_repeats(df: DataFrame, user: str = "user_id", item: str = "item_id", keep: str = "first", tie: tuple[str, ...] = ()) -> DataFrame:
    """One row for each user and item, the first or last in time (the legacy meaning)."""
    time = next((c for c in TIME_COLUMNS if c in df.columns), None)
    if not has(df, user, item, what="drop_all_repeats") or time is None:
        return df
    w = Window.partitionBy(user, item).orderBy((F.asc if keep == "first" else F.desc)(time), *tie)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
