"""Tag vocabularies and tag inference for items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators import similarity
from tidewell.operators.ranking import numbered

# Legal endings of a brand.
LEGAL = "(有限公司|集团|股份|Co\\.?|Ltd\\.?|Inc\\.?|LLC|GmbH)$"
# Wording of promotion rules.
RULE_TEXT = [r"满\d+减\d+", r"\d+折", "限时", "抢购", "到店", "核销", "有效期", "使用说明", "不与其他", "代金券", "优惠券", "兑换券", r"^\s*\[券\]"]
# Category to consumable type, and hints in texts.
CONSUMABLE = {"drink": ["咖啡", "奶茶"], "food": ["快餐", "中餐", "西餐", "日料", "火锅", "烧烤", "烘焙", "甜品"], "mixed": ["便利店", "水果"]}
CONSUMABLE_HINTS = {"drink": ["咖啡", "拿铁", "美式", "奶茶", "茶饮", "果汁", "饮品", "椰汁", "柠檬"], "food": ["汉堡", "炸鸡", "面", "烤", "寿司", "火锅", "套餐", "米饭", "烤肉"], "mixed": ["便利店", "综合"]}
DIMENSIONS = ("category", "consumable_type", "brand", "avg_prc", "distance", "occasion", "taste")


def _without_parens(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(c), r"\([^)]*\)", ""), "（.*?）", "")


def clean_brand(c: Column) -> Column:
    """Trimmed, without bracketed parts and one legal ending; null becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(_without_parens(c), "(?i)" + LEGAL, "")), F.lit(""))


def clean_label(c: Column) -> Column:
    return F.coalesce(F.trim(_without_parens(c)), F.lit(""))


def clean_category(c: Column) -> Column:
    """The part after the last '-', if it has two characters or more; otherwise the whole."""
    last = F.substring_index(c, "-", -1)
    return F.coalesce(F.trim(F.when(c.contains("-") & (F.length(last) >= 2), last).otherwise(c)), F.lit(""))


def aggregate_raw(df: DataFrame, value: str, source: str) -> DataFrame:
    """(name, frequency, sources) of the non-blank values."""
    return df.where(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(F.col(value).alias("name")).agg(F.count(F.lit(1)).alias("frequency"), F.sort_array(F.collect_set(source)).alias("sources"))


def group_names(names: DataFrame, max_distance: int | None = 3, least: float = 0.6, clean=clean_brand) -> DataFrame:
    """(canonical, name, frequency): raw names by their cleaned form, cleaned forms grouped greedily by frequency.

    names: (name, frequency). Forms taken by falling frequency (shorter, then smaller first on ties) join the first
    canonical within max_distance edits (None: any) and with bigram similarity `least`. A cleaned form's frequency is the sum over its raw
    variants. Blank forms are left out.
    """
    forms = names.withColumn("form", clean(F.col("name"))).where("form <> ''")
    total = forms.groupBy("form").agg(F.sum("frequency").alias("f"))
    # the order is total, so it serves as the rank itself
    ranked = total.select(F.col("form").alias("name"), F.struct((-F.col("f")).alias("f"), F.length("form").alias("n"), F.col("form").alias("form")).alias("rank"))
    pairs = similarity.similar_pairs(total.withColumn("g", similarity.ngrams(F.col("form"))), "form", "g", least)
    if max_distance is not None:
        pairs = pairs.where(F.levenshtein("a", "b", max_distance) >= 0)
    groups = similarity.greedy_groups(ranked, pairs)
    return forms.join(groups.withColumnRenamed("name", "form"), "form").select("canonical", "name", "frequency")


def select_canonical(groups: DataFrame) -> DataFrame:
    """(group, canonical): the most frequent name of each group (group, name, frequency), the shorter on ties."""
    return groups.groupBy("group").agg(F.max_by("name", F.struct("frequency", (-F.length("name")).alias("n"), F.col("name").alias("s"))).alias("canonical"))


def vocabulary_diff(observed: DataFrame, dictionary: DataFrame, least: int = 10) -> DataFrame:
    """(value, frequency, status): observed values of that frequency at least against the dictionary: added, existing or removed."""
    seen = observed.where(F.col("frequency") >= least).select("value", "frequency")
    known = dictionary.select("value").distinct().withColumn("_known", F.lit(True))
    status = F.when(F.col("_known").isNull(), "added").when(F.col("frequency").isNull(), "removed").otherwise("existing")
    return seen.join(known, "value", "outer").select("value", "frequency", status.alias("status"))


def snapshot(observed: DataFrame, dictionary: DataFrame, dim: str, most: int | None = None) -> DataFrame:
    """(dim, value, place): the dictionary's values, observed ones by falling frequency first, then the rest by value."""
    both = dictionary.select("dim", "value").distinct().join(observed.select("dim", "value", "frequency"), ["dim", "value"], "left").where(F.col("dim") == dim)
    ranked = both.withColumn("_f", -F.coalesce(F.col("frequency"), F.lit(0)))
    out = numbered(ranked, ["dim"], ["_f", "value"], "place").withColumn("place", F.col("place").cast("int"))  # a dimension may hold any number of values
    return (out.where(F.col("place") <= most) if most else out).select("dim", "value", "place")


def is_rule_text(c: Column) -> Column:
    return F.coalesce(c.rlike("|".join(RULE_TEXT)), F.lit(False))


def product_name(*candidates: Column) -> Column:
    """The first non-empty name, without a leading coupon mark unless nothing else is left."""
    raw = F.coalesce(*(F.nullif(c, F.lit("")) for c in candidates), F.lit(""))
    bare = F.trim(F.regexp_replace(raw, r"^\s*[\[【]券[\]】]\s*", ""))
    return F.when(bare != "", bare).otherwise(F.trim(raw))


def infer_longest(names: DataFrame, key: str, name: str, values: DataFrame, value: str) -> DataFrame:
    """(key, value): the longest dictionary value in each name (the smaller on ties); rule texts and names without one are left out."""
    hits = similarity.contains_join(names.where(~is_rule_text(F.col(name))), key, name, values, value)
    return hits.groupBy(key).agg(F.min_by(value, F.struct((-F.length(value)).alias("n"), F.col(value).alias("v"))).alias(value))


def infer_all(names: DataFrame, key: str, name: str, values: DataFrame, value: str) -> DataFrame:
    """(key, values): all dictionary values in each name, sorted."""
    hits = similarity.contains_join(names.where(~is_rule_text(F.col(name))), key, name, values, value)
    return hits.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias("values"))


def consumable_type(category: Column, inferred: Column, text: Column, rule_text: Column, answer: Column | None = None, mapping: dict | None = None, hints: dict | None = None, default: str = "none") -> Column:
    """struct(value, origin): by category, by the category inferred from the name, by hints in the text, by the model's answer, else the default."""
    mapping, hints = mapping or CONSUMABLE, hints or CONSUMABLE_HINTS
    kinds = {c: k for k, cs in mapping.items() for c in cs}
    table = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))
    by_category = F.element_at(table, category)
    by_name = F.when((category.isNull() | (category == "")) & ~rule_text, F.element_at(table, inferred))
    lower = F.lower(text)
    scores = {k: reduce(lambda a, b: a + b, ((text.contains(h) | lower.contains(h)).cast("int") for h in words)) for k, words in hints.items()}
    top = F.greatest(*scores.values())
    by_hint = F.when(~rule_text & (top > 0), F.coalesce(*(F.when(s == top, F.lit(k)) for k, s in scores.items()))) if answer is None else F.lit(None).cast("string")
    by_model = F.when(answer.isin("food", "drink", "mixed", "none"), answer) if answer is not None else F.lit(None).cast("string")
    derived = F.coalesce(by_category, by_name, by_hint)
    return F.struct(F.coalesce(derived, by_model, F.lit(default)).alias("value"), F.when(derived.isNull() & by_model.isNotNull(), "ai").otherwise("derived").alias("origin"))


def distance_tag(lng: Column, lat: Column) -> Column:
    """struct(value, origin): no value at build time; the origin tells whether a position is there."""
    return F.struct(F.lit(None).cast("string").alias("value"), F.when(lng.isNotNull() & lat.isNotNull(), "geo").otherwise("missing").alias("origin"))


def price_bucket(*columns: Column) -> Column:
    """The bucket of the first column that has one; values that aren't numbers or aren't positive have none."""

    def one(c: Column) -> Column:
        v = c.try_cast("double")
        return F.when(v <= 0, None).when(v <= 30, "0-30").when(v <= 50, "30-50").when(v <= 100, "50-100").when(v <= 200, "100-200").when(v.isNotNull(), "200+")

    return F.coalesce(*map(one, columns))


def constrain_scalar(c: Column, allowed: Column) -> Column:
    """struct(value, rejected): the value if the dictionary has it."""
    ok = F.coalesce(F.array_contains(allowed, c), F.lit(False))
    return F.struct(F.when(ok, c).alias("value"), (c.isNotNull() & ~ok).alias("rejected"))


def constrain_array(c: Column, allowed: Column) -> Column:
    """struct(value, rejected): the values the dictionary has, null if none; the values it doesn't have."""
    kept = F.array_intersect(c, allowed)
    return F.struct(F.when(F.size(kept) > 0, kept).alias("value"), F.coalesce(F.array_except(c, allowed), F.array().cast("array<string>")).alias("rejected"))


def tag_origin(tag: Column, raw: list[Column]) -> Column:
    """missing without a tag, raw if it equals a raw column, else ai."""
    same = reduce(lambda a, b: a | b, (F.coalesce(tag == r, F.lit(False)) for r in raw), F.lit(False))
    return F.when(tag.isNull(), "missing").when(same, "raw").otherwise("ai")


def fill_with_hints(tag: Column, hint: Column, on: bool = True) -> Column:
    return F.coalesce(tag, hint) if on else tag


def _present(df: DataFrame, dim: str) -> Column:
    c = F.col(dim)
    return c.isNotNull() & ((F.size(c) > 0) if df.schema[dim].dataType.typeName() == "array" else F.lit(True))


def is_cold_start(df: DataFrame) -> Column:
    """Whether all dimensions but distance are missing."""
    return reduce(lambda a, b: a & b, (~_present(df, d) for d in DIMENSIONS if d != "distance" and d in df.columns))


def coverage(df: DataFrame, goal: float = 6.5) -> DataFrame:
    """One row: items, average number of dimensions with a value, whether the goal is met."""
    n = reduce(lambda a, b: a + b, (_present(df, d).cast("int") for d in DIMENSIONS if d in df.columns))
    return df.agg(F.count(F.lit(1)).alias("items"), F.avg(n).alias("avg_dims")).withColumn("passed", F.coalesce(F.col("avg_dims") >= goal, F.lit(False)))


def record_hash(df: DataFrame, columns: list[str]) -> Column:
    """md5 of the record as JSON with sorted names, nulls kept."""
    return F.md5(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}))


def changed(df: DataFrame, state: DataFrame, key: str, columns: list[str], versions: dict[str, str] | None = None) -> DataFrame:
    """Rows to compute again: new ones, and those whose content hash or one of the versions differs from the state (key, record_hash, versions...)."""
    now = df.withColumn("record_hash", record_hash(df, columns)).withColumns({k: F.lit(v) for k, v in (versions or {}).items()})
    marks = ["record_hash", *(versions or {})]
    old = state.select(key, *(F.col(m).alias(f"_{m}") for m in marks))
    differs = reduce(lambda a, b: a | b, (~F.equal_null(F.col(m), F.col(f"_{m}")) for m in marks))
    return now.join(old, key, "left").where(differs).drop(*(f"_{m}" for m in marks))


def upsert(state: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The state with fresh rows in place of those of the same key."""
    return state.join(fresh.select(key), key, "left_anti").unionByName(fresh.select(state.columns))


def tag_rows(df: DataFrame, key: str) -> DataFrame:
    """(key, dim, value) of scalar and array tags."""

    def one(d: str) -> Column:
        values = F.col(d) if df.schema[d].dataType.typeName() == "array" else F.array(F.col(d).cast("string"))
        return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.struct(F.lit(d).alias("dim"), v.alias("value")))

    parts = [one(d) for d in DIMENSIONS if d in df.columns]
    if not parts:
        return df.select(key, F.lit("").alias("dim"), F.lit("").alias("value")).limit(0)
    return df.select(key, F.explode(F.concat(*parts)).alias("x")).select(key, "x.dim", "x.value").where("value is not null")


def title_tags(title: Column, rules: dict[str, dict[str, str]]) -> Column:
    """struct of arrays: for each dimension the values whose pattern is found in the title (the offline default of the tagger)."""
    return F.struct(*(F.array_compact(F.array(*(F.when(title.rlike(p), F.lit(v)) for v, p in values.items()))).alias(d) for d, values in rules.items()))


def party_size(n: Column) -> Column:
    return F.when(n == 1, "1").when(n == 2, "2").when(n.between(3, 4), "3-4").when(n.between(5, 8), "5-8").when(n >= 9, "9+")


SCALARS, ARRAYS = ("category", "consumable_type", "brand", "avg_prc", "distance"), ("occasion", "taste")


def parse_answer(answer: Column) -> Column:
    """struct of the dimensions from a model's JSON: a list for a scalar gives its first value, a text for an array a list of one, blanks and 'null' give null."""
    blank = lambda c: F.when(~F.trim(c).isin("", "null", "None"), F.trim(c))
    raw = lambda d: F.get_json_object(answer, f"$.{d}")
    listed = lambda d: F.from_json(raw(d), "array<string>")
    is_list = lambda d: F.coalesce(F.startswith(F.ltrim(raw(d)), F.lit("[")), F.lit(False))
    scalar = lambda d: blank(F.when(is_list(d), F.get(listed(d), F.lit(0))).otherwise(raw(d)))
    many = lambda d: F.filter(F.transform(F.when(is_list(d), listed(d)).otherwise(F.array(raw(d))), blank), lambda v: v.isNotNull())
    return F.struct(*(scalar(d).alias(d) for d in SCALARS), *(F.when(F.size(many(d)) > 0, many(d)).alias(d) for d in ARRAYS))


def assemble(df: DataFrame, raw: dict[str, list[str]]) -> DataFrame:
    """df with tag_source: the origin of each dimension it has - missing without a tag (but distance: geo or missing, as given), raw if equal to one of the raw columns, else ai."""
    origins = []
    for d in DIMENSIONS:
        if d not in df.columns or d == "distance":
            continue
        same = [F.col(c) for c in raw.get(d, []) if c in df.columns] if d not in ARRAYS else []
        origins.append(F.when(~_present(df, d), "missing").otherwise(tag_origin(F.col(d) if d not in ARRAYS else F.lit("x"), same)).alias(d))
    return df.withColumn("tag_source", F.struct(*origins))


def extract(observed: dict[str, DataFrame], dictionary: DataFrame, least: int = 10) -> dict[str, dict[str, DataFrame]]:
    """The whole vocabulary run. observed: dimension -> (value, source); dictionary: (dim, value).

    Brands are grouped by edits and bigrams, categories by bigrams, other dimensions by their cleaned form; each gives its
    groups, the canonical values with frequency, and the difference to the dictionary.
    """
    out = {}
    for dim, df in observed.items():
        names = aggregate_raw(df, "value", "source").select("name", "frequency")
        if dim == "brand":
            groups = group_names(names)
        elif dim == "category":
            groups = group_names(names, None, clean=clean_category)
        else:
            groups = names.select(clean_label(F.col("name")).alias("canonical"), "name", "frequency").where("canonical <> ''")
        total = groups.groupBy(F.col("canonical").alias("value")).agg(F.sum("frequency").alias("frequency"))
        out[dim] = {"groups": groups, "values": total, "diff": vocabulary_diff(total, dictionary.where(F.col("dim") == dim).select("value"), least)}
    return out
