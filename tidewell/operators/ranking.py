"""Row numbers and predecessors within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import cut


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "n") -> DataFrame:
    """df with the row's number within its group in that order, without a group in one task.

    Rows are range-partitioned by (group, order); each partition numbers its own
    and adds the rows of the group that lie in earlier partitions, known from counts of (group, partition). `order` should be unique.
    """
    placed = cut(df.repartitionByRange(*group, *order).withColumn("_p", F.spark_partition_id()), "ranked")
    counts = placed.groupBy(*group, "_p").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_o", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    own = placed.withColumn("_n", F.row_number().over(Window.partitionBy(*group, "_p").orderBy(*order)))
    keys = [F.equal_null(own[c], offsets[c]) for c in (*group, "_p")]
    on = keys[0]
    for k in keys[1:]:
        on = on & k
    return own.join(offsets, on).select(*(own[c] for c in df.columns), (F.col("_n") + F.col("_o")).cast("long").alias(name))


def has_heavy_group(df: DataFrame, group: list[str], share: float = 2.0) -> bool:
    """Whether a group holds more than `share` times a task's even load: partial counts, one row to the driver."""
    parts = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    one = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c").alias("m"), F.sum("_c").alias("s")).first()
    return one.m is not None and one.m > max(100_000, share * one.s / int(parts))


def with_previous(df: DataFrame, group: list[str], order: list, column: str, name: str, place: str, spread: bool | None = None) -> DataFrame:
    """df with `name`, the column's value in the row before within the group, and `place`, whether there is such a row.

    Without heavy groups a window does it. With one (spread; measured if None) the rows are range-partitioned by (group, order),
    the window is over (group, partition), and a partition's first row takes the last value of the partitions before, of which
    each gives one row.
    """
    keys = [F.expr(c) if isinstance(c, str) else c for c in order]
    if spread is None:
        spread = has_heavy_group(df, group)
    if not spread:
        w = Window.partitionBy(*group).orderBy(*keys)
        return df.withColumn(name, F.lag(column).over(w)).withColumn(place, F.row_number().over(w) > 1)
    placed = cut(df.repartitionByRange(*group, *keys).withColumn("_p", F.spark_partition_id()), "placed")
    w = Window.partitionBy(*group, "_p").orderBy(*keys)
    ranked = placed.withColumn("_n", F.row_number().over(w)).withColumn("_b", F.lag(column).over(w)).withColumn("_next", F.lead(F.lit(1)).over(w))
    lasts = ranked.where("_next is null").select(*group, "_p", F.struct(F.col(column).alias("v")).alias("_last"))
    before = lasts.select(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)), F.col("_p").alias("_q"), F.lag("_last").over(Window.partitionBy(*group).orderBy("_p")).alias("_carry"))
    on = ranked["_p"] == before["_q"]
    for i, c in enumerate(group):
        on = on & F.equal_null(ranked[c], before[f"_g{i}"])
    joined = ranked.join(before, on)
    first = F.col("_n") == 1
    return joined.select(*(ranked[c] for c in df.columns), F.when(first, F.col("_carry.v")).otherwise(F.col("_b")).alias(name), (~first | F.col("_carry").isNotNull()).alias(place))
