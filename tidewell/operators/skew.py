"""Per-key work when a few keys hold most rows: fragment-replicate by estimated load."""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import partitions_of

#: Light keys are packed by hash bucket, so many buckets for each bin.
BUCKETS_PER_BIN = 16
#: A key is heavy from this share of a bin's even load on; there are at most bins / HEAVY of them.
HEAVY = 0.25


@dataclass
class LoadPlan:
    """Where each key's rows go. heavy: key -> (rows, bins of its shards); buckets: bin of each bucket of light keys.

    Both are bounded by the number of bins, not by the data: at most bins / HEAVY
    heavy keys, bins + bins / HEAVY shards and bins * BUCKETS_PER_BIN buckets.
    """

    key: str
    bins: int
    total: int
    heavy: dict = field(default_factory=dict)
    buckets: list[int] = field(default_factory=list)
    loads: list[int] = field(default_factory=list)

    def __post_init__(self):
        self.key_type = T.StringType()

    def over(self, share: float) -> list[tuple[object, int]]:
        """Heavy keys with at least this share of all rows; exact for share >= HEAVY / bins."""
        return [(k, n) for k, (n, _) in self.heavy.items() if n >= share * self.total]


def plan_load(df: DataFrame, key: str, bins: int | None = None, share: float | None = None) -> LoadPlan:
    """Measure each key's load (partial counts, so no key meets in one task unreduced) and pack keys into bins.

    Keys at or over HEAVY of a bin's even load, or over `share` of all rows if that is
    less, are packed one by one, largest first, those over one bin's load
    cut into proportionate shards; the others by hash bucket. Null keys count in the
    total and belong to no bin. An empty table gives an empty plan.
    """
    bins = bins or partitions_of(df.sparkSession)
    n_buckets = bins * BUCKETS_PER_BIN
    total = df.count()
    plan = LoadPlan(key, bins, total)
    plan.key_type = df.schema[key].dataType
    even = max(1.0, total / bins)
    least = max(1.0, HEAVY * even if share is None else min(HEAVY * even, share * total))
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    big = F.col("n") >= least
    bucket = F.pmod(F.xxhash64("k"), F.lit(n_buckets)).cast("int")
    # one row for each heavy key and each bucket: bounded by the number of bins (or 1 / share)
    units = counts.groupBy(F.when(big, F.col("k")).alias("k"), F.when(~big, bucket).alias("b")).agg(F.sum("n").alias("n")).collect()
    queue = []
    for r in units:
        if r["b"] is not None:
            queue.append((r["n"], "b", r["b"]))
        else:
            shards = max(1, round(r["n"] / even + 0.499))
            queue += [(r["n"] / shards, "k", r["k"])] * shards
            plan.heavy[r["k"]] = (r["n"], [])
    load = [(0.0, i) for i in range(bins)]
    plan.buckets = [i % bins for i in range(n_buckets)]
    for n, kind, x in sorted(queue, key=lambda q: (-q[0], q[1], str(q[2]))):
        at, i = heapq.heappop(load)
        heapq.heappush(load, (at + n, i))
        if kind == "b":
            plan.buckets[x] = i
        else:
            plan.heavy[x][1].append(i)
    plan.loads = [round(n) for n, _ in sorted(load, key=lambda p: p[1])]
    return plan


def _with_homes(df: DataFrame, plan: LoadPlan) -> DataFrame:
    """df with _bins: the bins of each key's shards. The two maps have a proven bound (LoadPlan), so they are broadcast."""
    spark = df.sparkSession
    schema = T.StructType([T.StructField("_k", plan.key_type), T.StructField("_shards", T.ArrayType(T.IntegerType()))])
    heavy = spark.createDataFrame([(k, b) for k, (_, b) in plan.heavy.items()], schema)
    light = F.array(*map(F.lit, plan.buckets)) if len(plan.buckets) <= 64 else None
    out = df.join(F.broadcast(heavy), F.col(plan.key) == F.col("_k"), "left").drop("_k")
    number = F.pmod(F.xxhash64(plan.key), F.lit(max(1, len(plan.buckets)))).cast("int")
    if light is not None:
        return out.withColumn("_bins", F.coalesce("_shards", F.array(F.element_at(light, number + 1)))).drop("_shards")
    table = spark.createDataFrame(list(enumerate(plan.buckets)), "_b int, _bin int")
    return out.withColumn("_b", number).join(F.broadcast(table), "_b", "left").withColumn("_bins", F.coalesce("_shards", F.array("_bin"))).drop("_shards", "_b", "_bin")


def spread(df: DataFrame, plan: LoadPlan, row_id: str) -> DataFrame:
    """df with _bin, each row in the partition of that number: a heavy key's rows evenly over its shards by a hash of row_id."""
    out = _with_homes(df.where(F.col(plan.key).isNotNull()), plan)
    at = F.pmod(F.xxhash64(F.col(row_id)), F.size("_bins")).cast("int") + 1
    return out.withColumn("_bin", F.element_at("_bins", at)).drop("_bins").repartitionById(plan.bins, "_bin")


def replicate(df: DataFrame, plan: LoadPlan) -> DataFrame:
    """The matching side: one copy for each bin that holds a shard of the row's key."""
    out = _with_homes(df.where(F.col(plan.key).isNotNull()), plan)
    return out.withColumn("_bin", F.explode(F.array_distinct("_bins"))).drop("_bins").repartitionById(plan.bins, "_bin")


def balanced_join(fact: DataFrame, match: DataFrame, plan: LoadPlan, row_id: str, how: str = "left") -> DataFrame:
    """fact joined with match on the plan's key, both laid out by the plan. Columns of match that fact has too get the ending _match.

    how: inner or left. Rows of fact without key are left out. match may have any number of rows a key.
    """
    if how not in ("inner", "left"):
        raise ValueError("a replicated side allows inner and left joins only")
    match = match.withColumnsRenamed({c: f"{c}_match" for c in match.columns if c != plan.key and c in fact.columns})
    return spread(fact, plan, row_id).join(replicate(match, plan), ["_bin", plan.key], how).drop("_bin")
