"""Dialogue corpora: cleaning, checks, statistics, splits, sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.operators.ranking import numbered
from tidewell.session import cut

OPS = ("contains", "not_contains", "in", "not_in", "gt", "gte", "lt", "lte", "between")
INTENTS = ("search_item", "search_product", "use_coupon", "pay", "view_order", "browse")
ROLES = ("user", "assistant", "system")
_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def content_hash(messages: str = "messages", params: str = "params") -> Column:
    return F.md5(F.to_json(F.struct(F.col(messages), F.array_sort(F.map_entries(params)).alias("params")), {"ignoreNullFields": "false"}))


def all_null(params: Column) -> Column:
    """Whether no dimension has a value; true without params."""
    return F.coalesce(F.forall(F.map_values(params), lambda v: v.isNull()), F.lit(True))


def drop_reasons(df: DataFrame, order: str = "seq", min_message: int = 10, turns: int = 4, template_share: float = 0.3, template_keep: float = 0.2) -> DataFrame:
    """df with drop_reason: the first rule that fails, null for rows that stay.

    df: seq (unique, the input order), messages array<struct<role, content>>, params
    map. Rules in order: turn_count, control_char, min_message_length, params_all_null, text_hash_dedup (the first stays),
    template_repeat: among the rest, templates (the first message's first 20 characters) of more than template_share keep int(template_keep * n) rows in order.
    """
    contents = F.transform("messages", lambda m: F.coalesce(m["content"], F.lit("")))
    n = F.coalesce(F.size("messages"), F.lit(0))
    first = (
        F.when((n < 1) | (n > turns), "turn_count").when(F.exists(contents, lambda c: c.rlike(_CONTROL)), "control_char")
        .when(F.exists(contents, lambda c: F.length(F.trim(c)) < min_message), "min_message_length").when(all_null(F.col("params")), "params_all_null")
    )
    rows = df.withColumn("_r", first).withColumn("_h", content_hash())
    # repeats are told by the smallest order of their hash: an aggregation and a join, no window over a hash that many rows share
    firsts = rows.where("_r is null").groupBy("_h").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c")
    rows = rows.join(firsts, "_h", "left").withColumn("_r", F.coalesce("_r", F.when(F.col(order) > F.col("_first"), "text_hash_dedup"))).withColumn("_t", F.substring(F.get(contents, F.lit(0)), 1, 20)).drop("_first")
    rows = cut(rows, "checked")
    kept = rows.where("_r is null")
    n_kept = kept.count()
    over = [r["_t"] for r in kept.groupBy("_t").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > template_share * n_kept).select("_t").collect()]  # at most 1 / template_share
    if not over:
        return rows.withColumn("drop_reason", F.col("_r")).select(*df.columns, "drop_reason")
    hot = F.col("_r").isNull() & F.coalesce(F.col("_t").isin(over), F.lit(False))
    counted = numbered(rows.where(hot), ["_t"], [order], "_n")
    late = counted.withColumn("drop_reason", F.when(F.col("_n") > int(template_keep * n_kept), "template_repeat"))
    return rows.where(~hot).withColumn("drop_reason", F.col("_r")).select(*df.columns, "drop_reason").unionByName(late.select(*df.columns, "drop_reason"))


def retention(df: DataFrame, alert: float = 0.5, least: float = 0.85) -> DataFrame:
    """One row: raw, kept, retention_rate and status alert / warning / ok of a frame with drop_reason."""
    one = df.agg(F.count(F.lit(1)).alias("raw_count"), F.count_if(F.col("drop_reason").isNull()).alias("cleaned_count"))
    rate = F.coalesce(F.try_divide(F.col("cleaned_count").cast("double"), F.col("raw_count").cast("double")), F.lit(0.0))
    return one.withColumn("retention_rate", rate).withColumn("status", F.when(F.col("retention_rate") < alert, "alert").when(F.col("retention_rate") < least, "warning").otherwise("ok"))


def shares(df: DataFrame, column: Column | str, name: str) -> DataFrame:
    """(name, n, share) over all rows."""
    c = F.col(column) if isinstance(column, str) else column
    counts = df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    return counts.withColumn("_k", F.lit(1)).join(F.broadcast(total.withColumn("_k", F.lit(1))), "_k").select(name, "n", F.round(F.col("n") / F.col("_n"), 4).alias("share"))


def distribution_stats(df: DataFrame, values: DataFrame | None = None, negative_target: float = 0.1) -> DataFrame:
    """(metric, key, value): intent, param, op, turn shares; negative share, average message length, diversity of combinations; coverage of dictionary values (dim, value)."""
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    flat = df.select(F.explode("params").alias("dim", "ps")).where("ps is not null")
    uses = flat.select("dim", F.explode("ps").alias("p")).select("dim", F.replace(F.col("p.op"), F.lit(" "), F.lit("_")).alias("op"), "p.values")

    def share(rows: DataFrame, column, metric: str, base: DataFrame) -> DataFrame:
        counts = rows.groupBy(F.col(column).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        b = base.select(F.col(base.columns[0]).alias("_n"))
        return counts.withColumn("_k", F.lit(1)).join(F.broadcast(b.withColumn("_k", F.lit(1))), "_k").select(F.lit(metric).alias("metric"), "key", F.round(F.col("n") / F.col("_n"), 4).alias("value"))

    out = share(df.withColumn("intent", F.coalesce("intent", F.lit("search_item"))), "intent", "intent", total)
    out = out.unionByName(share(flat, "dim", "param", total)).unionByName(share(uses, "op", "op", uses.agg(F.count(F.lit(1)))))
    out = out.unionByName(share(df.withColumn("turns", F.size("messages")), "turns", "turns", total))
    lengths = F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.coalesce(F.length(m["content"]), F.lit(0)))
    combo = F.to_json(F.array_sort(F.map_entries("params")))
    one = df.agg(F.avg(F.coalesce(F.col("negative"), F.lit(False)).cast("double")).alias("negative_ratio"), F.try_divide(F.sum(lengths).cast("double"), F.sum(F.size("messages")).cast("double")).alias("message_avg_length"), F.countDistinct(combo).cast("double").alias("combinations"))
    out = out.unionByName(one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.lit("").alias("key"), F.round(c, 4).alias("value")) for c in one.columns))).alias("x")).select("x.*"))
    if values is not None:
        seen = uses.select("dim", F.explode("values").alias("value")).groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n"))
        found = values.select("dim", "value").join(seen, ["dim", "value"])
        out = out.unionByName(found.select(F.lit("coverage").alias("metric"), F.concat_ws(".", "dim", "value").alias("key"), F.col("n").cast("double").alias("value")))
    return out


def distribution_warnings(stats: DataFrame, negative_target: float = 0.1) -> DataFrame:
    """(warning) for shares that are too small, figures out of their range, and intents of which one has over five times the share of another."""
    m, v, k = F.col("metric"), F.col("value"), F.col("key")
    text = (
        F.when((m == "intent") & (v < 0.03), F.concat(F.lit("intent."), k)).when((m == "param") & (v < 0.05), F.concat(F.lit("param."), k))
        .when((m == "op") & (k.isin("not_in", "not_contains")) & (v < 0.03), F.concat(F.lit("op."), k)).when((m == "negative_ratio") & (F.abs(v - negative_target) > 0.02), "negative_ratio")
        .when((m == "message_avg_length") & ~v.between(20, 80), "message_avg_length")
    )
    spread = stats.where("metric = 'intent'").agg(F.max("value").alias("most"), F.min("value").alias("least")).where(F.col("most") > 5 * F.col("least")).select(F.lit("intent_imbalance").alias("warning"))
    return stats.select(text.alias("warning")).where("warning is not null").unionByName(spread)


def md5_mod(c: Column, n: int = 100) -> Column:
    """The 128-bit number of the md5 of a text, modulo n (n up to 10^6), in decimals of the JVM."""
    h = F.md5(c)
    half = lambda i: F.conv(F.substring(h, i, 16), 16, 10).cast("decimal(20,0)")
    return (((half(1) % n).cast("long") * (2**64 % n) + (half(17) % n).cast("long")) % n).cast("int")


def split(df: DataFrame, key: str, train: int = 80, val: int = 90) -> DataFrame:
    """df with split: by the key's hash, so a key is in one split only. A null key counts as ''."""
    b = md5_mod(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return df.withColumn("split", F.when(b < train, "train").when(b < val, "val").otherwise("test"))


def leaks(df: DataFrame, key: str) -> DataFrame:
    """Keys in more than one split."""
    return df.groupBy(key).agg(F.countDistinct("split").alias("n_splits")).where("n_splits > 1")


def real_first(df: DataFrame, share: float = 0.5, order: str = "seq") -> DataFrame:
    """Val and test rows such that real ones make up at least `share` where there are enough: generated rows beyond that are moved to train, the last ones first."""
    held = df.where("split <> 'train'")
    counts = held.groupBy("split").agg(F.count_if("is_real").alias("_real"))
    gen = held.where(~F.col("is_real")).join(F.broadcast(counts), "split")
    kept = numbered(gen, ["split"], [order], "_n").withColumn("split", F.when((F.col("_real") > 0) & (F.col("_n") > F.col("_real") * ((1 - share) / share)), "train").otherwise(F.col("split"))).select(df.columns)
    return df.where("split = 'train' or is_real").select(df.columns).unionByName(kept)


def params_dedup(df: DataFrame, most: int = 3, order: str = "seq") -> DataFrame:
    """At most `most` rows of the same params, the first ones."""
    key = F.to_json(F.array_sort(F.map_entries("params")))
    w = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


RESPONSE = "conversation array<struct<role:string,content:string>>, messages array<struct<role:string,content:string>>, params map<string,array<struct<op:string,values:array<string>>>>, guide_text string, intent string"


def parse_response(c: Column, dims: tuple[str, ...]) -> Column:
    """struct(messages, params, guide_text, intent) of a model's JSON: either name of the messages, known dimensions only, operator names with underscores."""
    r = F.from_json(c, RESPONSE)
    empty = F.array().cast("array<struct<role:string,content:string>>")
    fix = lambda ps: F.transform(ps, lambda p: F.struct(F.replace(p["op"], F.lit(" "), F.lit("_")).alias("op"), p["values"].alias("values")))
    params = F.transform_values(F.map_filter(r["params"], lambda k, v: k.isin(*dims)), lambda k, v: fix(v))
    return F.struct(F.coalesce(r["conversation"], r["messages"], empty).alias("messages"), params.alias("params"), F.coalesce(r["guide_text"], F.lit("")).alias("guide_text"), F.coalesce(r["intent"], F.lit("search_item")).alias("intent"))


def sample_errors(max_turns: int = 5) -> Column:
    """The errors of a sample (messages, guide_text, params, intent) as an array; empty if it is valid."""
    ms = F.col("messages")
    n = F.coalesce(F.size(ms), F.lit(0))
    checks = [
        F.when(n == 0, "messages empty"),
        F.when((n > 0) & ~F.equal_null(F.get(ms, F.lit(0))["role"], F.lit("user")), "first role is not user"),
        F.when((n > 0) & (n > max_turns), "too many messages"),
        F.when(F.coalesce(F.exists(ms, lambda m: F.coalesce(F.trim(m["content"]), F.lit("")) == ""), F.lit(False)), "content empty"),
        F.when(F.coalesce(F.exists(ms, lambda m: ~F.coalesce(m["role"], F.lit("")).isin(*ROLES)), F.lit(False)), "role invalid"),
        F.when(F.coalesce(F.col("guide_text"), F.lit("")) == "", "guide_text missing"),
        F.when(F.coalesce(F.exists(F.flatten(F.filter(F.map_values("params"), lambda v: v.isNotNull())), lambda p: ~F.coalesce(p["op"], F.lit("")).isin(*OPS)), F.lit(False)), "op invalid"),
        F.when(F.coalesce(F.exists(F.flatten(F.filter(F.map_values("params"), lambda v: v.isNotNull())), lambda p: p["values"].isNull()), F.lit(False)), "values missing"),
        F.when(~F.coalesce(F.col("intent"), F.lit("")).isin(*INTENTS), "intent invalid"),
    ]
    return F.array_compact(F.array(*checks))


def param_errors(params: Column, dims: dict[str, list[str]], dictionary: dict[str, list[str]] | None = None) -> Column:
    """Errors of params against the contract: known dimension, operator allowed for it, values of the dictionary."""

    def one(e: Column) -> Column:
        known = F.create_map(*(x for d, ops in dims.items() for x in (F.lit(d), F.array(*map(F.lit, ops)))))
        words = F.create_map(*(x for d, vs in (dictionary or {"": [""]}).items() for x in (F.lit(d), F.array(*map(F.lit, vs)))))
        bad_dim = F.when(~F.map_contains_key(known, e["key"]), F.concat(F.lit("dimension "), e["key"]))
        bad_op = F.when(F.coalesce(F.exists(e["value"], lambda p: ~F.array_contains(F.element_at(known, e["key"]), p["op"])), F.lit(False)), F.concat(F.lit("op of "), e["key"]))
        outside = F.exists(e["value"], lambda p: F.size(F.array_except(p["values"], F.element_at(words, e["key"]))) > 0)
        bad_value = F.when(F.map_contains_key(words, e["key"]) & F.coalesce(outside, F.lit(False)), F.concat(F.lit("value of "), e["key"]))
        return F.array_compact(F.array(bad_dim, bad_op, bad_value))

    return F.flatten(F.transform(F.map_entries(params), one))


def matches(op: str, item: Column, values: Column) -> Column:
    """Whether an item's values (an array) meet a predicate: eq, in (any), contains (all), not_in / not_contains (none), gt .. between on the first as a number."""
    number = lambda c, i=1: F.try_element_at(c, F.lit(i)).try_cast("double")
    table = {
        "eq": F.array_sort(item) == F.array_sort(values), "in": F.arrays_overlap(item, values), "contains": F.size(F.array_except(values, item)) == 0,
        "not_in": ~F.arrays_overlap(item, values), "not_contains": ~F.arrays_overlap(item, values), "gt": number(item) > number(values), "gte": number(item) >= number(values),
        "lt": number(item) < number(values), "lte": number(item) <= number(values), "between": number(item).between(number(values), number(values, 2)),
    }
    return table[op]


def draw(*key: Column | str, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    return F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1_000_000)) / 1_000_000


def weighted_choice(weights: dict[str, float], u: Column) -> Column:
    """The value that u in [0, 1) falls to."""
    total, at, out = sum(weights.values()), 0.0, None
    for v, w in weights.items():
        at += w / total
        out = F.when(u < at, v) if out is None else out.when(u < at, v)
    return out.otherwise(list(weights)[-1])


def plan_samples(items: DataFrame, key: str, per_item: int, scenarios: dict[str, float], intents: dict[str, float], negative: float = 0.1, seed: int = 42) -> DataFrame:
    """(key, n, scenario, intent, negative): per_item planned samples of each item; the same for every run and layout."""
    rows = items.select(key, F.explode(F.sequence(F.lit(1), F.lit(per_item))).alias("n"))
    return rows.select(key, "n", weighted_choice(scenarios, draw(key, "n", F.lit("scenario"), seed=seed)).alias("scenario"), weighted_choice(intents, draw(key, "n", F.lit("intent"), seed=seed)).alias("intent"), (draw(key, "n", F.lit("negative"), seed=seed) < negative).alias("negative"))


#: Bands of distance in metres with their shares, types of negative samples, shares of the number of turns.
BANDS = {"near": (0, 1_000, 0.5), "town": (1_000, 5_000, 0.3), "far": (5_000, 20_000, 0.2)}
NEGATIVES = {"excluded_value": 0.5, "other_item": 0.3, "no_match": 0.2}
TURNS = {1: 0.4, 3: 0.3, 5: 0.2, 9: 0.1}


def plan_details(plan: DataFrame, key: str, most_turns: int = 9, bands: dict | None = None, negatives: dict | None = None, turns: dict | None = None, seed: int = 42) -> DataFrame:
    """plan with n_turns (at most most_turns), distance_band and distance_m, and negative_type of the negative samples: hash draws, the same for every run."""
    bands, u = bands or BANDS, lambda what: draw(key, "n", F.lit(what), seed=seed)
    band = weighted_choice({b: w for b, (_, _, w) in bands.items()}, u("band"))
    chosen = {str(t): w for t, w in (turns or TURNS).items() if t <= most_turns} or {"1": 1.0}
    out = plan.withColumns({"n_turns": weighted_choice(chosen, u("turns")).cast("int"), "distance_band": band})
    metres = None
    for b, (low, high, _) in bands.items():
        at = (F.lit(low) + u("metres") * (high - low)).cast("int")
        metres = F.when(F.col("distance_band") == b, at) if metres is None else metres.when(F.col("distance_band") == b, at)
    return out.withColumns({"distance_m": metres, "negative_type": F.when(F.col("negative"), weighted_choice(negatives or NEGATIVES, u("type")))})


def without_repeats(df: DataFrame, key: str, columns: list[str], order: str = "n") -> DataFrame:
    """One row for each combination of the columns within a key, the first in order; partial aggregation, so a key with many samples is reduced early."""
    return df.groupBy(F.col(key).alias("_k"), *(F.col(c).alias(f"_c{i}") for i, c in enumerate(columns))).agg(F.min_by(F.struct(*df.columns), F.col(order)).alias("_row")).select("_row.*")


def cover(df: DataFrame, tags: DataFrame, key: str = "item_id") -> DataFrame:
    """(key, n): a further sample for each item with a tag (key, dim, value) that none of its samples asks for, numbered after those it has."""
    gaps = uncovered_dims(df, tags, key).select(key).distinct()
    last = df.groupBy(key).agg(F.max("n").alias("_last"))
    return gaps.join(last, key, "left").select(key, (F.coalesce("_last", F.lit(0)) + 1).cast("int").alias("n"))


def oversample(df: DataFrame, column: str, least: float = 0.03, times: int = 2) -> DataFrame:
    """Rows of classes under `least` of all repeated `times` times."""
    small = shares(df, column, "_c").where(F.col("n").isNotNull()).select("_c", "share")
    n = F.when(F.col("share") < least, times).otherwise(1)
    return df.join(small, F.equal_null(df[column], F.col("_c")), "left").withColumn("_i", F.explode(F.sequence(F.lit(1), n))).select(df.columns)


def rerank(df: DataFrame, by: str, exclude: DataFrame | None = None, key: str = "item_id", k: int = 10, hot: DataFrame | None = None) -> DataFrame:
    """The top k by distance, popularity or price without excluded keys; if nothing is left the hot list. The set isn't changed by the order."""
    order = {"distance": F.asc("distance"), "popularity": F.desc("popularity"), "price": F.asc("price")}[by]
    left = df.join(exclude.select(key).distinct(), key, "left_anti") if exclude is not None else df
    top = left.orderBy(order, key).limit(k)
    return hot.limit(k) if hot is not None and not top.take(1) else top


def verification(**checks: DataFrame) -> DataFrame:
    """(check, passed): each frame has one boolean row."""
    parts = [d.select(F.lit(n).alias("check"), F.col(d.columns[0]).alias("passed")) for n, d in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def jsonl(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(value): one JSON object a row with all fields in order; NaN and infinities become null."""
    cols = []
    for c in columns or df.columns:
        t = df.schema[c].dataType.typeName()
        cols.append(F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)).alias(c) if t in ("double", "float") else F.col(c))
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def value_coverage(df: DataFrame, values: DataFrame, least: int = 5) -> DataFrame:
    """(dim, value, n, covered) for each dictionary value (dim, value): in how many samples' params it occurs."""
    flat = df.select("seq", F.explode("params").alias("dim", "ps")).where("ps is not null").select("seq", "dim", F.explode("ps").alias("p")).select("seq", "dim", F.explode("p.values").alias("value")).distinct()
    seen = flat.groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.select("dim", "value").distinct().join(seen, ["dim", "value"], "left").na.fill(0, ["n"]).withColumn("covered", F.col("n") >= least)


def uncovered_dims(df: DataFrame, tags: DataFrame, key: str = "item_id") -> DataFrame:
    """(key, dim): dimensions with a tag (key, dim, value) that none of the item's samples asks for."""
    asked = df.select(key, F.explode("params").alias("dim", "ps")).where("ps is not null").select(key, "dim").distinct()
    return tags.select(key, "dim").distinct().join(asked, [key, "dim"], "left_anti")


def diversity(df: DataFrame, least: int = 200, per: int = 1_000) -> DataFrame:
    """One row: samples, different params, whether there are `least` in `per` samples."""
    one = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.to_json(F.array_sort(F.map_entries("params")))).alias("combinations"))
    return one.withColumn("passed", F.col("combinations") * per >= F.least(F.col("n"), F.lit(per)) * least)


def synthesize_shops(spark, n: int, vocabulary: dict[str, list[str]], seed: int = 42) -> DataFrame:
    """n invented shops with a value of each dimension, the same for every run and layout."""
    rows = spark.range(n).select(F.format_string("shop-%06d", F.col("id")).alias("item_id"))
    return rows.select("item_id", *(weighted_choice(dict.fromkeys(vs, 1.0), draw("item_id", F.lit(d), seed=seed)).alias(d) for d, vs in vocabulary.items()))


def template_dialogues(plan: DataFrame, templates: dict[str, list[str]], dims: list[str], key: str = "item_id", seed: int = 42) -> DataFrame:
    """Dialogues for planned samples (plan_samples joined with the items' dimensions) from templates a scenario, with params; negative samples exclude the first dimension's value."""
    chosen = None
    for scenario, ts in templates.items():
        pick = weighted_choice(dict.fromkeys(ts, 1.0), draw(key, "n", F.lit("template"), seed=seed))
        chosen = F.when(F.col("scenario") == scenario, pick) if chosen is None else chosen.when(F.col("scenario") == scenario, pick)
    text = chosen
    for d in dims:
        text = F.replace(text, F.lit("{" + d + "}"), F.coalesce(F.col(d), F.lit("")))
    op = lambda d: F.when(F.col("negative") & F.lit(d == dims[0]), "not_in").otherwise("in")
    params = F.map_from_arrays(F.array(*map(F.lit, dims)), F.array(*(F.when(F.col(d).isNotNull(), F.array(F.struct(op(d).alias("op"), F.array(d).alias("values")))) for d in dims)))
    return plan.select(key, "n", "scenario", "intent", "negative", F.array(F.struct(F.lit("user").alias("role"), text.alias("content"))).alias("messages"), params.alias("params"))
