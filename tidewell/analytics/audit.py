"""Data audit: each table's metrics in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.contracts import not_blank


def _n():
    """Number of rows."""
    return F.count(F.lit(1))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(_n().alias("rows")).select("rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(",".join(df.columns)).alias("columns"))


def field_completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, present, complete, completeness_pct) for each field; a field that df lacks has present = false."""
    there = [f for f in fields if f in df.columns]
    one = df.agg(_n().alias("_n"), *(F.count_if(not_blank(df, f)).alias(f) for f in there))
    rows = [F.struct(F.lit(f).alias("field"), F.lit(f in there).alias("present"), (F.col(f) if f in there else F.lit(0).cast("long")).alias("complete")) for f in fields]
    flat = one.select("_n", F.explode(F.array(*rows)).alias("x")).select("_n", "x.*")
    return flat.select("field", "present", "complete", F.round(F.coalesce(F.try_divide(F.col("complete") * 100.0, "_n"), F.lit(0.0)), 4).alias("completeness_pct"))


def key_uniqueness(df: DataFrame, keys: list[str] | list[list[str]]) -> DataFrame:
    """(key, total, distinct_keys, duplicates, duplicate_pct) of each key, single or composite. Null counts as a value."""
    out = None
    for k in keys:
        cols = [k] if isinstance(k, str) else list(k)
        one = df.groupBy(*cols).agg(_n().alias("_rows")).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("total"), _n().alias("distinct_keys"))
        one = one.select(F.lit("+".join(cols)).alias("key"), "total", "distinct_keys", (F.col("total") - F.col("distinct_keys")).alias("duplicates"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("duplicate_pct", F.round(F.coalesce(F.try_divide(F.col("duplicates") * 100.0, "total"), F.lit(0.0)), 4))


def time_range(df: DataFrame, column: str = "timestamp") -> DataFrame:
    span = F.col("max_time") - F.col("min_time")
    return df.agg(F.min(column).alias("min_time"), F.max(column).alias("max_time")).select("min_time", "max_time", span.alias("span_seconds"), F.round(span / 86400, 2).alias("span_days"), F.col("min_time").isNull().alias("is_empty"))


def outlier_check(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """(field, outliers, total, outlier_pct): values below the lower or above the upper bound."""
    exprs, rows = [_n().alias("_n")], []
    for c, (low, high) in bounds.items():
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(c) < low)
        if high is not None:
            bad = bad | (F.col(c) > high)
        exprs.append(F.count_if(bad).alias(c))
        rows.append(F.struct(F.lit(c).alias("field"), F.col(c).alias("outliers")))
    flat = df.agg(*exprs).select("_n", F.explode(F.array(*rows)).alias("x")).select("x.field", "x.outliers", F.col("_n").alias("total"))
    return flat.withColumn("outlier_pct", F.round(F.coalesce(F.try_divide(F.col("outliers") * 100.0, "total"), F.lit(0.0)), 4))


def audit(tables: dict[str, DataFrame], config: dict) -> dict[str, dict[str, list[dict]]]:
    """{table: {metric: rows}} by config {table: {fields, keys, time, bounds}}; small results only reach the driver."""
    report: dict[str, dict[str, list[dict]]] = {}
    for name, df in tables.items():
        c = config.get(name, {})
        if c.get("enabled", True) is False:
            continue
        plans = {"row_count": row_count(df)}
        if c.get("fields"):
            plans["field_completeness"] = field_completeness(df, c["fields"])
        if c.get("keys"):
            plans["key_uniqueness"] = key_uniqueness(df, c["keys"])
        if c.get("time") in df.columns:
            plans["time_range"] = time_range(df, c["time"])
        if c.get("bounds"):
            plans["outlier_check"] = outlier_check(df, c["bounds"])
        report[name] = {k: [r.asDict() for r in p.collect()] for k, p in plans.items()}
    return report
