"""Synonym groups: built, cleaned, merged, checked."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators import similarity

PRIORITY = {"rule": 0, "llm": 1, "embedding": 2}
LONGEST, MOST = 20, 10


def group_id(variants: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("|", F.sort_array(variants))), 1, 12)


def groups_from_pairs(df: DataFrame, canonical: str, variant: str, source: str, category: Column | None = None, confidence: float = 1.0) -> DataFrame:
    """(group_id, canonical, variants, source, confidence, category): the canonical name and all its variants; groups of one are left out."""
    grouped = df.where(F.col(canonical).isNotNull() & (F.col(canonical) != "")).groupBy(F.col(canonical).alias("canonical")).agg(F.collect_set(variant).alias("v"), F.first(category, True).alias("category") if category is not None else F.lit(None).cast("string").alias("category"))
    variants = F.sort_array(F.array_distinct(F.array_compact(F.filter(F.concat(F.array("canonical"), "v"), lambda x: x != ""))))
    out = grouped.withColumn("variants", variants).where(F.size("variants") >= 2)
    return out.select(group_id(F.col("variants")).alias("group_id"), "canonical", "variants", F.array(F.lit(source)).alias("source"), F.lit(confidence).alias("confidence"), "category")


def groups_from_names(names: DataFrame, key: str, name: str, groups: DataFrame) -> DataFrame:
    """(key, group_id, canonical, variants_found): groups of which a name holds variants."""
    flat = groups.select("group_id", "canonical", F.explode("variants").alias("variant"))
    hits = similarity.contains_join(names, key, name, flat, "variant")
    return hits.join(flat, "variant").groupBy(key, "group_id", "canonical").agg(F.sort_array(F.collect_set("variant")).alias("variants_found"))


def script(c: Column) -> Column:
    """cjk, latin or other: names of different scripts never merge."""
    return F.when(c.rlike(r"\p{IsHan}|\p{IsHiragana}|\p{IsKatakana}"), "cjk").when(c.rlike("[A-Za-z]"), "latin").otherwise("other")


def groups_from_ngram(names: DataFrame, name: str, least: float = 0.7, most: int | None = None, guard_script: bool = True) -> DataFrame:
    """Groups of names connected by bigram similarity, all of them or the first `most` by value (length_filter cuts groups to the search engine's size); groups of one are left out."""
    distinct = names.select(F.col(name).alias("name")).where("name is not null and name <> ''").distinct()
    pairs = similarity.similar_pairs(distinct.withColumn("g", similarity.ngrams(F.col("name"))), "name", "g", least)
    if guard_script:
        pairs = pairs.where(script(F.col("a")) == script(F.col("b")))
    parts = similarity.connected_components(pairs)
    if most is not None:
        w = Window.partitionBy("component").orderBy("node")
        parts = parts.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    out = parts.groupBy("component").agg(F.sort_array(F.collect_list("node")).alias("variants")).where(F.size("variants") >= 2)
    return out.select(group_id(F.col("variants")).alias("group_id"), F.col("component").alias("canonical"), "variants", F.array(F.lit("ngram")).alias("source"), F.lit(least).alias("confidence"), F.lit(None).cast("string").alias("category"))


def filter_antonyms(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """Groups that don't hold both words of a pair (a, b)."""
    flat = groups.select("group_id", F.explode("variants").alias("v"))
    bad = flat.join(pairs.select(F.col("a").alias("v"), "b"), "v").join(flat.select("group_id", F.col("v").alias("b")), ["group_id", "b"]).select("group_id").distinct()
    return groups.join(bad, "group_id", "left_anti")


def length_filter(groups: DataFrame, longest: int = LONGEST, most: int = MOST) -> DataFrame:
    """Variants of at most `longest` characters, in chunks of `most`; chunks of one are left out."""
    fit = F.filter("variants", lambda v: F.length(v) <= longest)
    sliced = groups.withColumn("_v", fit).where(F.size("_v") >= 2)
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size("_v") - 1) / most).cast("int")), lambda i: F.slice("_v", i * most + 1, most))
    out = sliced.withColumn("_c", F.explode(chunks)).where(F.size("_c") >= 2)
    return out.withColumn("variants", F.col("_c")).withColumn("group_id", group_id(F.col("_c"))).drop("_v", "_c")


def dedup_groups(groups: DataFrame) -> DataFrame:
    """Groups of the same variants as one: sources united, the highest confidence, the smallest canonical."""
    key = F.sort_array(F.array_distinct("variants"))
    out = groups.groupBy(key.alias("variants")).agg(F.min("canonical").alias("canonical"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("source")))).alias("source"), F.max("confidence").alias("confidence"), F.min("category").alias("category"))
    return out.select(group_id(F.col("variants")).alias("group_id"), "canonical", "variants", "source", "confidence", "category")


def merge_overlapping(groups: DataFrame) -> DataFrame:
    """Groups that share a variant as one, of the connected components of groups and variants; groups of one variant go."""
    flat = groups.select(F.concat(F.lit("g:"), "group_id").alias("a"), F.explode("variants").alias("v"), "canonical", "source", "confidence", "category")
    parts = similarity.connected_components(flat.select("a", F.concat(F.lit("v:"), "v").alias("b")))
    placed = flat.join(parts.withColumnRenamed("node", "a"), "a")
    out = placed.groupBy("component").agg(F.sort_array(F.collect_set("v")).alias("variants"), F.min("canonical").alias("canonical"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("source")))).alias("source"), F.max("confidence").alias("confidence"), F.min("category").alias("category")).where(F.size("variants") >= 2)
    return out.select(group_id(F.col("variants")).alias("group_id"), "canonical", "variants", "source", "confidence", "category")


def truncate(groups: DataFrame, most: int = 10_000) -> DataFrame:
    """At most so many groups: rule before llm before embedding, then by confidence. The search engine that reads them sets the limit."""
    rank = F.array_min(F.transform("source", lambda s: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p in PRIORITY.items() for x in p)), s), F.lit(1))))
    return groups.orderBy(rank, F.desc("confidence"), "group_id").limit(most)


def synonym_stats(groups: DataFrame) -> DataFrame:
    return groups.agg(F.count(F.lit(1)).alias("groups"), F.avg(F.size("variants")).alias("avg_size"), F.max(F.size("variants")).alias("max_size"), F.coalesce(F.sum(F.size("variants")), F.lit(0)).alias("tokens"), F.count_if(F.size("source") > 1).alias("multi_source"))


def source_overlap(groups: DataFrame) -> DataFrame:
    """(source_a, source_b, n): groups that come from both sources."""
    flat = groups.select("group_id", F.explode("source").alias("s"))
    return flat.select("group_id", F.col("s").alias("source_a")).join(flat.select("group_id", F.col("s").alias("source_b")), "group_id").where("source_a < source_b").groupBy("source_a", "source_b").agg(F.count(F.lit(1)).alias("n"))


def verify(groups: DataFrame, antonyms: DataFrame, most: int = 10_000) -> DataFrame:
    """(check, passed): the rules that the search engine's files must keep."""
    one = groups.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.exists("variants", lambda v: F.trim(v) == "")).alias("blank"), F.count_if(F.exists("variants", lambda v: F.length(v) > LONGEST)).alias("long"))
    left = filter_antonyms(groups, antonyms).agg(F.count(F.lit(1)).alias("left"))
    one = one.withColumn("_k", F.lit(1)).join(F.broadcast(left.withColumn("_k", F.lit(1))), "_k")
    rows = [("no_blank", F.col("blank") == 0), ("short_tokens", F.col("long") == 0), ("few_groups", F.col("n") <= most), ("no_antonyms", F.col("left") == F.col("n"))]
    return one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check"), c.alias("passed")) for k, c in rows))).alias("x")).select("x.*")


def solr_lines(groups: DataFrame) -> DataFrame:
    """(value): one line a group for a synonyms file."""
    return groups.select(F.concat_ws(", ", F.sort_array("variants")).alias("value"))


#: Vectors a bucket of embedding_pairs, about, as long as that takes no more than TABLES tables.
BUCKET, TABLES = 1_000, 512


def hash_shape(least: float, recall: float = 0.999, n: int = 0) -> tuple[int, int]:
    """(signs a table, tables) of random hyperplanes such that a pair of cosine `least` shares a bucket with that probability.

    Signs grow with the logarithm of the number n of vectors, so that a bucket stays at about BUCKET vectors; the tables that this takes grow too, the
    faster the smaller `least` is, and end the growth at TABLES.
    """
    p = 1 - math.acos(least) / math.pi
    tables = lambda k: math.ceil(math.log(1 - recall) / math.log(1 - p**k))
    planes = max(1, min(16, int(math.log(0.15) / math.log(p))))
    while n > BUCKET << planes and planes < 30 and tables(planes + 1) <= TABLES:
        planes += 1
    return planes, tables(planes)


def embedding_pairs(df: DataFrame, key: str, vector: str, least: float = 0.85, recall: float = 0.999, seed: int = 7) -> DataFrame:
    """(a, b, cosine, confidence): pairs of at least that cosine, a < b; high from 0.85 on, else to be confirmed (low).

    Equal vectors form a class: its smallest key stands for it in pairs with others, and each other member is paired with it alone, so copies don't multiply.
    Candidates share a bucket of random hyperplanes, found with probability `recall` each; similarity is computed exactly. Rows without vector or of length 0 are left out.
    """
    rows = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).where("k is not null and v is not null and size(v) > 0")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    unit = rows.withColumn("n", norm).where("n > 0").select("k", F.transform("v", lambda x: x / F.col("n")).alias("v"))
    classes = unit.groupBy("v").agg(F.min("k").alias("k"))
    planes, tables = hash_shape(least, recall, rows.count())
    copies = unit.join(classes.withColumnRenamed("k", "a"), "v").where("k > a").select("a", F.col("k").alias("b"), F.lit(1.0).alias("cosine"))

    @F.pandas_udf("array<long>")
    def buckets(vs: pd.Series) -> pd.Series:
        m = np.stack(vs.to_numpy())
        p = np.random.default_rng(seed).standard_normal((m.shape[1], planes * tables))
        bits = ((m @ p) > 0).reshape(len(m), tables, planes)
        codes = (bits * (1 << np.arange(planes))).sum(2) + (np.arange(tables) << planes)
        return pd.Series(list(codes.astype(np.int64)))

    placed = classes.withColumn("h", F.explode(buckets("v")))
    cand = placed.select(F.col("k").alias("a"), "h").join(placed.select(F.col("k").alias("b"), "h"), "h").where("a < b").select("a", "b").distinct()
    full = cand.join(classes.select(F.col("k").alias("a"), F.col("v").alias("va")), "a").join(classes.select(F.col("k").alias("b"), F.col("v").alias("vb")), "b")
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    near = full.withColumn("cosine", dot).where(F.col("cosine") >= least).select("a", "b", "cosine").unionByName(copies)
    return near.withColumn("confidence", F.when(F.col("cosine") >= 0.85, "high").otherwise("low"))


def build(parts: list[DataFrame], antonyms: DataFrame, most: int = 10_000) -> DataFrame:
    """Groups of all sources as one set: cleaned to size, equal ones united, overlapping ones merged, those with an antonym pair left out, the best `most`."""
    one = parts[0]
    for p in parts[1:]:
        one = one.unionByName(p)
    merged = merge_overlapping(dedup_groups(length_filter(one)))
    return truncate(filter_antonyms(length_filter(merged), antonyms), most)
