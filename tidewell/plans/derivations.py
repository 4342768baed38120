"""Derived warehouse tables: profiles of customers and items, event sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AGE_BANDS = ((20, "A"), (30, "B"), (40, "C"), (50, "D"), (60, "E"))


def _latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The key's row with the largest order: partial aggregation over structs, no window."""
    return df.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def age_band(birth: Column, as_of: Column) -> Column:
    """A to F by full decades of age at as_of; unknown births are F."""
    years = F.floor(F.months_between(as_of, birth) / 12)
    out = None
    for limit, band in AGE_BANDS:
        out = F.when(years < limit, band) if out is None else out.when(years < limit, band)
    return out.otherwise("F")


def user_profile(customers: DataFrame, as_of: str) -> DataFrame:
    """(custref_no, age, self_income_round, sex) of the latest valid row of each customer. birth_dt is yyyyMMdd."""
    valid = _latest(customers.where("valid_cust_flg = 1"), "custref_no", "etl_dt")
    birth = F.try_to_timestamp(F.col("birth_dt").cast("string"), F.lit("yyyyMMdd")).cast("date")
    return valid.select("custref_no", age_band(birth, F.to_date(F.lit(as_of))).alias("age"), F.round(F.col("self_income").cast("double") / 5000).alias("self_income_round"), F.when(F.col("sex_id") == 2, "F").otherwise("M").alias("sex"))


def item_profile(shops: DataFrame, mapping: DataFrame, categories: DataFrame, normal: str = "NORMAL") -> DataFrame:
    """Latest row of each normal shop with its own category names: mapping rows (cat_nm, mt_cat_ids with commas, etl_dt, cat_id) are exploded, categories is (cat_id, cat_nm)."""
    base = _latest(shops.where(F.col("str_sta") == normal), "str_id", "etl_dt", "str_nm")
    pairs = _latest(mapping, "cat_id", "etl_dt").where("mt_cat_ids is not null and mt_cat_ids <> ''").select("cat_nm", F.explode(F.split("mt_cat_ids", ",")).alias("mt_cat_id"))
    named = pairs.join(categories.select(F.col("cat_id").alias("_id"), F.col("cat_nm").alias("cat_nm2")), F.col("mt_cat_id").try_cast("long") == F.col("_id"), "left")
    named = named.select(F.col("mt_cat_id").alias("_cat"), F.col("cat_nm").alias("cat_nm1"), "cat_nm2")
    return base.join(named, F.col("cat_id") == F.col("_cat"), "left").select("str_id", "str_nm", "city_nm", "cnty_nm", "lng", "lat", "cat_nm1", "cat_nm2")


def user_seq(events: DataFrame, area: str, page: str) -> DataFrame:
    """Events of one page with the shop from its address."""
    shop = F.regexp_extract("pg_url", r"shopId=(\d+)", 1)
    return events.where((F.col("spm_a") == area) & (F.col("pg_nm") == page)).select("event", F.col("time").alias("event_time"), F.col("distinct_id").alias("custref_no"), shop.alias("shopid"), F.col("latitude").alias("user_latitude"), F.col("longitude").alias("user_longitude"), "event_duration", "btn_nm", "cls_info")


def active_profiles(profiles: DataFrame, seq: DataFrame) -> DataFrame:
    """Profiles of customers with an event, one row each (the smallest of differing rows)."""
    kept = profiles.join(seq.select("custref_no").where("custref_no is not null").distinct(), "custref_no", "left_semi")
    return kept.groupBy("custref_no").agg(F.min(F.struct("age", "sex", "self_income_round")).alias("r")).select("custref_no", "r.*")
