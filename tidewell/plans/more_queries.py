"""Queries for vocabularies, synonyms, corpora and derivations, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import corpus, similarity, synonyms, tags
from tidewell.operators.ranking import numbered
from tidewell.plans import derivations
from tidewell.plans.pipeline import Pipeline, cleaning_report
from tidewell.plans.reference_queries import E_SQL, events
from tidewell.session import table
from tidewell.sources import files, warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


# ---- vocabularies

_OWN = "o2o_new_gut_shop_base"
_THIRD = "o2o_new_gut_shop_base_third"
_BRAND_SQL = r"""trim(regexp_replace(regexp_replace(regexp_replace(trim(brnd_nm, ' '), '\([^)]*\)', '', 'g'), '（.*?）', '', 'g'), '(?i)(有限公司|集团|股份|Co\.?|Ltd\.?|Inc\.?|LLC|GmbH)$', ''), ' ')"""


@query(f"SELECT coalesce({_BRAND_SQL}, '') AS brand, count(*) AS n FROM {_OWN} GROUP BY 1")
def vocab_clean_brand(spark, d):
    return table(spark, d, _OWN).groupBy(tags.clean_brand(F.col("brnd_nm")).alias("brand")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT p_type, p_name, CASE WHEN contains(x, '-') AND length(split_part(x, '-', -1)) >= 2 THEN split_part(x, '-', -1) ELSE x END AS category FROM (SELECT p_type, p_name, replace(p_type, ' ', '-') AS x FROM part)")
def vocab_clean_category(spark, d):
    return table(spark, d, "part").select("p_type", "p_name", tags.clean_category(F.replace(F.col("p_type"), F.lit(" "), F.lit("-"))).alias("category")).distinct()


@query(f"SELECT brnd_nm AS name, count(*) AS frequency, coalesce(list_sort(list(DISTINCT shopStatus) FILTER (shopStatus IS NOT NULL)), []) AS sources FROM {_OWN} WHERE brnd_nm IS NOT NULL AND brnd_nm <> '' GROUP BY 1")
def vocab_aggregate(spark, d):
    return tags.aggregate_raw(table(spark, d, _OWN), "brnd_nm", "shopStatus")


@query(f"WITH o AS (SELECT brnd_nm AS value, count(*) AS frequency FROM {_OWN} WHERE brnd_nm IS NOT NULL GROUP BY 1 HAVING count(*) >= 3) SELECT value, frequency, CASE WHEN b.brand_nm IS NULL THEN 'added' WHEN frequency IS NULL THEN 'removed' ELSE 'existing' END AS status FROM (SELECT coalesce(o.value, b.brand_nm) AS value, o.frequency, b.brand_nm FROM o FULL JOIN (SELECT DISTINCT brand_nm FROM brand_list) b ON o.value = b.brand_nm) b")
def vocab_diff(spark, d):
    seen = table(spark, d, _OWN).where("brnd_nm is not null").groupBy(F.col("brnd_nm").alias("value")).agg(F.count(F.lit(1)).alias("frequency"))
    return tags.vocabulary_diff(seen, table(spark, d, "brand_list").select(F.col("brand_nm").alias("value")), 3)


@query(f"WITH o AS (SELECT brnd_nm AS value, count(*) AS f FROM {_OWN} GROUP BY 1) SELECT 'brand' AS dim, brand_nm AS value, CAST(row_number() OVER (ORDER BY coalesce(f, 0) DESC, brand_nm) AS INT) AS place FROM (SELECT DISTINCT brand_nm FROM brand_list) LEFT JOIN o ON value = brand_nm")
def vocab_snapshot(spark, d):
    dim = F.lit("brand").alias("dim")
    seen = table(spark, d, _OWN).groupBy(dim, F.col("brnd_nm").alias("value")).agg(F.count(F.lit(1)).alias("frequency"))
    return tags.snapshot(seen, table(spark, d, "brand_list").select(dim, F.col("brand_nm").alias("value")), "brand")


@query()
def vocab_groups(spark, d):
    """Brands as typed, grouped by spelling: the rule is sequential, so it is tested against its plain form instead of SQL."""
    names = table(spark, d, _OWN).where("brnd_nm is not null").groupBy(F.col("brnd_nm").alias("name")).agg(F.count(F.lit(1)).alias("frequency"))
    return tags.group_names(names)


@query("WITH h AS (SELECT \"Id\", brand_nm FROM o2o_new_gut_shop_base_third JOIN (SELECT DISTINCT brand_nm FROM brand_list) ON contains(Str_Nm, brand_nm) WHERE NOT regexp_matches(Str_Nm, '满\\d+减\\d+|\\d+折|限时|抢购|到店|核销|有效期|使用说明|不与其他|代金券|优惠券|兑换券|^\\s*\\[券\\]')), r AS (SELECT *, row_number() OVER (PARTITION BY \"Id\" ORDER BY length(brand_nm) DESC, brand_nm) AS n FROM h) SELECT \"Id\", brand_nm FROM r WHERE n = 1")
def tag_brand(spark, d):
    return tags.infer_longest(table(spark, d, _THIRD), "Id", "Str_Nm", table(spark, d, "brand_list"), "brand_nm")


@query("WITH v(value) AS (VALUES ('豆花'), ('虾饺'), ('拥挤'), ('鲜甜'), ('salty'), ('crisp')) SELECT doc_id, list_sort(list(DISTINCT value)) AS \"values\" FROM documents JOIN v ON contains(text, value) WHERE NOT regexp_matches(text, '满\\d+减\\d+|\\d+折|限时|抢购|到店|核销|有效期|使用说明|不与其他|代金券|优惠券|兑换券|^\\s*\\[券\\]') GROUP BY 1")
def tag_tastes(spark, d):
    values = spark.createDataFrame([(v,) for v in ("豆花", "虾饺", "拥挤", "鲜甜", "salty", "crisp")], "value string")
    return tags.infer_all(table(spark, d, "documents"), "doc_id", "text", values, "value")


@query("SELECT \"Id\", CASE WHEN Cat_Nm IN ('咖啡', '奶茶') THEN 'drink' WHEN Cat_Nm IN ('快餐', '中餐', '西餐', '日料', '火锅', '烧烤', '烘焙', '甜品') THEN 'food' WHEN Cat_Nm IN ('便利店', '水果') THEN 'mixed' ELSE 'none' END AS consumable FROM o2o_new_gut_shop_base_third")
def tag_consumable(spark, d):
    none = F.lit(None).cast("string")
    return table(spark, d, _THIRD).select("Id", tags.consumable_type(F.col("Cat_Nm"), none, F.lit(""), F.lit(False), answer=none)["value"].alias("consumable"))


@query("SELECT \"Id\", CASE WHEN p <= 0 THEN NULL WHEN p <= 30 THEN '0-30' WHEN p <= 50 THEN '30-50' WHEN p <= 100 THEN '50-100' WHEN p <= 200 THEN '100-200' WHEN p IS NOT NULL THEN '200+' END AS bucket FROM (SELECT \"Id\", TRY_CAST(Avg_Prc AS DOUBLE) AS p FROM o2o_new_gut_shop_base_third)")
def tag_price(spark, d):
    return table(spark, d, _THIRD).select("Id", tags.price_bucket(F.col("Avg_Prc")).alias("bucket"))


@query("SELECT doc_id, regexp_matches(text, '满\\d+减\\d+|\\d+折|限时|抢购|到店|核销|有效期|使用说明|不与其他|代金券|优惠券|兑换券|^\\s*\\[券\\]') AS is_rule FROM documents WHERE text IS NOT NULL")
def tag_rule_text(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", tags.is_rule_text(F.col("text")).alias("is_rule"))


@query("WITH a AS (SELECT list(DISTINCT brand_nm) AS l FROM brand_list) SELECT shopId, CASE WHEN list_contains(l, brnd_nm) THEN brnd_nm END AS value, brnd_nm IS NOT NULL AND NOT list_contains(l, brnd_nm) AS rejected FROM (SELECT DISTINCT shopId, brnd_nm FROM o2o_new_gut_shop_base), a")
def tag_constrained(spark, d):
    known = table(spark, d, "brand_list").select("brand_nm", F.lit(True).alias("ok")).distinct()
    rows = table(spark, d, _OWN).select("shopId", "brnd_nm").distinct().join(known, F.col("brnd_nm") == F.col("brand_nm"), "left")
    allowed = F.when(F.col("ok"), F.array("brnd_nm")).otherwise(F.array().cast("array<string>"))
    got = tags.constrain_scalar(F.col("brnd_nm"), allowed)
    return rows.select("shopId", got["value"].alias("value"), got["rejected"].alias("rejected"))


@query("SELECT count(*) AS items, round(avg((Cat_Nm IS NOT NULL)::INT + (Str_Type IS NOT NULL)::INT + (Avg_Prc IS NOT NULL)::INT), 6) AS avg_dims, avg((Cat_Nm IS NOT NULL)::INT + (Str_Type IS NOT NULL)::INT + (Avg_Prc IS NOT NULL)::INT) >= 2.5 AS passed FROM o2o_new_gut_shop_base_third")
def tag_coverage(spark, d):
    rows = table(spark, d, _THIRD).select(F.col("Cat_Nm").alias("category"), F.col("Str_Type").alias("brand"), F.col("Avg_Prc").alias("avg_prc"))
    return tags.coverage(rows, 2.5).withColumn("avg_dims", F.round("avg_dims", 6))


@query("SELECT \"Id\" FROM o2o_new_gut_shop_base_third WHERE \"Id\" % 3 = 0 OR Avg_Prc IS NOT NULL".replace(' OR Avg_Prc IS NOT NULL', ' OR "Id" % 5 = 0'))
def tag_changed(spark, d):
    """Incremental run: a state that lacks every third row and has other contents for every fifth."""
    rows = table(spark, d, _THIRD).select("Id", "Str_Nm", "Avg_Prc")
    state = rows.where("Id % 3 <> 0").withColumn("Str_Nm", F.when(F.col("Id") % 5 == 0, F.concat(F.coalesce("Str_Nm", F.lit("")), F.lit("~"))).otherwise(F.col("Str_Nm"))).select("Id", tags.record_hash(rows, ["Str_Nm", "Avg_Prc"]).alias("record_hash"))
    return tags.changed(rows, state, "Id", ["Str_Nm", "Avg_Prc"]).select("Id")


# ---- synonyms

_GRAMS = "CASE WHEN length(x) < 2 THEN [] ELSE list_distinct(list_transform(range(1, length(x)), lambda i: substr(x, i, 2))) END"


@query(f"WITH n AS (SELECT DISTINCT p_name AS x FROM part), g AS (SELECT x, {_GRAMS} AS g FROM n) SELECT a.x AS a, b.x AS b, round(len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))), 6) AS jaccard FROM g a JOIN g b ON a.x < b.x WHERE len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) >= 0.6")
def similar_names(spark, d):
    names = table(spark, d, "part").select("p_name").distinct().withColumn("g", similarity.ngrams(F.col("p_name")))
    return similarity.similar_pairs(names, "p_name", "g", 0.6).withColumn("jaccard", F.round("jaccard", 6))


@query()
def synonym_ngram(spark, d):
    return synonyms.groups_from_ngram(table(spark, d, "brand_list").select(F.explode(F.array("brand_nm", "alias_nm")).alias("n")), "n", 0.6)


_PAIRS_SQL = "SELECT brand_nm AS canonical, list_sort([brand_nm, alias_nm]) AS variants FROM brand_list WHERE alias_nm IS NOT NULL"


@query(f"SELECT substr(md5(array_to_string(variants, '|')), 1, 12) AS group_id, canonical, variants FROM ({_PAIRS_SQL})")
def synonym_brands(spark, d):
    return synonyms.groups_from_pairs(table(spark, d, "brand_list"), "brand_nm", "alias_nm", "rule").select("group_id", "canonical", "variants")


@query(f"SELECT count(*) AS groups, CAST(2 AS DOUBLE) AS avg_size, 2 AS max_size, CAST(2 * count(*) AS BIGINT) AS tokens, CAST(0 AS BIGINT) AS multi_source FROM ({_PAIRS_SQL})")
def synonym_stats(spark, d):
    return synonyms.synonym_stats(synonyms.groups_from_pairs(table(spark, d, "brand_list"), "brand_nm", "alias_nm", "rule"))


@query()
def synonym_merged(spark, d):
    """Brand pairs and groups by spelling, cleaned, split to size, united and merged."""
    a = synonyms.groups_from_pairs(table(spark, d, "brand_list"), "brand_nm", "alias_nm", "rule")
    one = synonyms.dedup_groups(synonyms.length_filter(a.unionByName(synonym_ngram(spark, d).select(a.columns))))
    return synonyms.truncate(synonyms.merge_overlapping(one))


@query("WITH u AS (SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings) SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.v, b.v) / (a.n * b.n), 4) AS cosine, 'low' AS confidence FROM u a JOIN u b ON a.vec_id < b.vec_id WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.4")
def embedding_pairs(spark, d):
    return synonyms.embedding_pairs(table(spark, d, "embeddings"), "vec_id", "embedding", 0.4).withColumn("cosine", F.round("cosine", 4))


# ---- corpora: documents as dialogues of their lines


def dialogues(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("source = 'dialogue' and text is not null")
    lines = F.filter(F.split("text", r"\r?\n"), lambda x: F.trim(x) != "")
    messages = F.transform(lines, lambda x, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), x.alias("content")))
    lang = F.lower(F.coalesce(F.substring("lang", 1, 2), F.lit("")))
    params = F.create_map(F.lit("brand"), F.when(lang != "", F.array(F.struct(F.when(F.col("doc_id") % 2 == 0, "in").otherwise("not contains").alias("op"), F.array(lang).alias("values")))))
    return docs.select(F.col("doc_id").alias("seq"), "item_id", messages.alias("messages"), params.alias("params"), F.when(F.col("doc_id") % 3 == 0, "browse").otherwise("search_item").alias("intent"), (F.col("doc_id") % 10 == 0).alias("negative"), F.coalesce("lang", F.lit("")).alias("guide_text"))


_DIALOGUE_SQL = r"""dl AS (SELECT doc_id AS seq, item_id, list_filter(regexp_split_to_array(text, '\r?\n'), lambda x: trim(x, ' ') <> '') AS lines, lower(coalesce(lang, '')[:2]) AS lg, coalesce(lang, '') AS guide_text,
 CASE WHEN doc_id % 3 = 0 THEN 'browse' ELSE 'search_item' END AS intent FROM documents WHERE source = 'dialogue' AND text IS NOT NULL)"""
_REASON_SQL = r"""rs AS (SELECT *, CASE WHEN len(lines) < 1 OR len(lines) > 4 THEN 'turn_count' WHEN len(list_filter(lines, lambda x: regexp_matches(x, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]'))) > 0 THEN 'control_char' WHEN len(list_filter(lines, lambda x: length(trim(x, ' ')) < 10)) > 0 THEN 'min_message_length' WHEN lg = '' THEN 'params_all_null' END AS r FROM dl),
 dd AS (SELECT *, row_number() OVER (PARTITION BY r IS NULL, lines, lg, CASE WHEN lg = '' THEN 0 ELSE seq % 2 END ORDER BY seq) AS n FROM rs), k AS (SELECT *, CASE WHEN r IS NULL AND n > 1 THEN 'text_hash_dedup' ELSE r END AS r2 FROM dd)"""


@query(f"WITH {_DIALOGUE_SQL}, {_REASON_SQL} SELECT seq, r2 AS drop_reason FROM k")
def corpus_reasons(spark, d):
    return corpus.drop_reasons(dialogues(spark, d)).select("seq", "drop_reason")


@query(f"WITH {_DIALOGUE_SQL}, {_REASON_SQL}, c AS (SELECT count(*) AS raw_count, count(*) FILTER (r2 IS NULL) AS cleaned_count FROM k) SELECT *, round(cleaned_count / raw_count, 6) AS retention_rate, CASE WHEN cleaned_count / raw_count < 0.5 THEN 'alert' WHEN cleaned_count / raw_count < 0.85 THEN 'warning' ELSE 'ok' END AS status FROM c")
def corpus_retention(spark, d):
    return corpus.retention(corpus.drop_reasons(dialogues(spark, d))).withColumn("retention_rate", F.round("retention_rate", 6))


@query("SELECT review_id, CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'val' ELSE 'test' END AS split FROM (SELECT review_id, ((concat('0x', substr(m, 1, 16))::UBIGINT % 100) * 16 + concat('0x', substr(m, 17, 16))::UBIGINT % 100) % 100 AS b FROM (SELECT review_id, md5(coalesce(parent_asin, '')) AS m FROM amazon_new_review))")
def corpus_split(spark, d):
    return corpus.split(table(spark, d, "amazon_new_review"), "parent_asin").select("review_id", "split")


@query("SELECT parent_asin, CAST(1 AS BIGINT) AS n_splits FROM amazon_new_review WHERE false")
def corpus_split_leaks(spark, d):
    return corpus.leaks(corpus.split(table(spark, d, "amazon_new_review"), "parent_asin"), "parent_asin")


@query(f"""WITH {_DIALOGUE_SQL}, t AS (SELECT count(*) AS t FROM dl) SELECT 'intent' AS metric, intent AS key, round(count(*) / any_value(t), 4) AS value FROM dl, t GROUP BY 2
UNION ALL SELECT 'turns', CAST(len(lines) AS VARCHAR), round(count(*) / any_value(t), 4) FROM dl, t GROUP BY 2 UNION ALL SELECT 'param', 'brand', round(count(*) FILTER (lg <> '') / any_value(t), 4) FROM dl, t
UNION ALL SELECT 'op', CASE WHEN seq % 2 = 0 THEN 'in' ELSE 'not_contains' END, round(count(*) / (SELECT count(*) FROM dl WHERE lg <> ''), 4) FROM dl WHERE lg <> '' GROUP BY 2
UNION ALL SELECT 'negative_ratio', '', round(avg((seq % 10 = 0)::INT), 4) FROM dl UNION ALL SELECT 'message_avg_length', '', round(sum(list_sum(list_transform(lines, lambda x: length(x)))) / sum(len(lines)), 4) FROM dl
UNION ALL SELECT 'combinations', '', CAST(count(DISTINCT CASE WHEN lg = '' THEN '' ELSE lg || (seq % 2) END) AS DOUBLE) FROM dl""")
def corpus_distribution(spark, d):
    return corpus.distribution_stats(dialogues(spark, d))


@query(f"""WITH {_DIALOGUE_SQL}, p AS (SELECT seq, row_number() OVER (PARTITION BY lg, CASE WHEN lg = '' THEN 0 ELSE seq % 2 END ORDER BY seq) AS n FROM dl) SELECT seq FROM p WHERE n <= 3""")
def corpus_params_dedup(spark, d):
    return corpus.params_dedup(dialogues(spark, d)).select("seq")


@query(f"""WITH {_DIALOGUE_SQL} SELECT seq, list_filter([CASE WHEN len(lines) > 5 THEN 'too many messages' END, CASE WHEN guide_text = '' THEN 'guide_text missing' END], lambda x: x IS NOT NULL) AS errors FROM dl WHERE len(lines) > 0""")
def corpus_errors(spark, d):
    fixed = dialogues(spark, d).where("size(messages) > 0").withColumn("params", F.transform_values("params", lambda k, v: F.transform(v, lambda p: F.struct(F.replace(p["op"], F.lit(" "), F.lit("_")).alias("op"), p["values"].alias("values")))))
    return fixed.select("seq", corpus.sample_errors().alias("errors"))


@query("SELECT c_custkey, c_mktsegment IN ('BUILDING', 'MACHINERY') AS is_in, c_mktsegment NOT IN ('BUILDING', 'MACHINERY') AS is_not, c_acctbal BETWEEN 0 AND 5000 AS is_between FROM customer")
def corpus_predicates(spark, d):
    item, values = F.array("c_mktsegment"), F.array(F.lit("BUILDING"), F.lit("MACHINERY"))
    bounds = F.array(F.lit("0"), F.lit("5000"))
    return table(spark, d, "customer").select("c_custkey", corpus.matches("in", item, values).alias("is_in"), corpus.matches("not_in", item, values).alias("is_not"), corpus.matches("between", F.array(F.col("c_acctbal").cast("string")), bounds).alias("is_between"))


@query("WITH s AS (SELECT source, count(*) / (SELECT count(*) FROM documents) AS share FROM documents GROUP BY 1) SELECT source, CAST(count(*) * any_value(CASE WHEN share < 0.09 THEN 2 ELSE 1 END) AS BIGINT) AS n FROM documents JOIN s USING (source) GROUP BY 1 UNION ALL SELECT NULL, CAST(count(*) * CASE WHEN count(*) / (SELECT count(*) FROM documents) < 0.09 THEN 2 ELSE 1 END AS BIGINT) FROM documents WHERE source IS NULL")
def corpus_oversample(spark, d):
    return corpus.oversample(table(spark, d, "documents").select("doc_id", "source"), "source", 0.09).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_partkey AS item_id, p_retailprice AS price FROM part WHERE p_brand <> 'Brand#11' ORDER BY p_retailprice, p_partkey LIMIT 10")
def corpus_rerank(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_retailprice").alias("price"), "p_brand")
    return corpus.rerank(rows, "price", rows.where("p_brand = 'Brand#11'")).select("item_id", "price")


@query()
def corpus_plan(spark, d):
    """Planned samples: hash draws, so SQL of another engine can't say the same."""
    items = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"))
    return corpus.plan_samples(items, "item_id", 3, {"gift": 0.5, "meal": 0.3, "party": 0.2}, {"search_item": 0.7, "browse": 0.3})


@query("SELECT CAST(to_json({'doc_id': doc_id, 'lang': lang, 'n_chars': n_chars}) AS VARCHAR) AS value FROM documents")
def corpus_lines(spark, d):
    return corpus.jsonl(table(spark, d, "documents"), ["doc_id", "lang", "n_chars"])


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS n FROM orders")
def rank_large_groups(spark, d):
    return numbered(table(spark, d, "orders"), ["o_orderstatus"], ["o_totalprice", "o_orderkey"]).select("o_orderkey", "n")


# ---- derivations


@query("SELECT CAST(c_custkey AS VARCHAR) AS custref_no, CASE WHEN a < 20 THEN 'A' WHEN a < 30 THEN 'B' WHEN a < 40 THEN 'C' WHEN a < 50 THEN 'D' WHEN a < 60 THEN 'E' ELSE 'F' END AS age, round(c_acctbal / 5000) + 0.0 AS self_income_round, CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex FROM (SELECT *, date_sub('year', make_date(CAST(1940 + c_custkey % 70 AS INT), 3, 5), DATE '2025-06-20') AS a FROM customer)")
def derive_user_profile(spark, d):
    year = (F.lit(1940) + F.col("c_custkey") % 70).cast("string")
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("custref_no"), F.concat(year, F.lit("0305")).alias("birth_dt"), F.col("c_acctbal").alias("self_income"), F.when(F.col("c_nationkey") % 2 == 0, 2).otherwise(1).alias("sex_id"), F.lit(1).alias("valid_cust_flg"))
    older = rows.withColumn("sex_id", F.lit(1)).withColumn("etl_dt", F.lit("20250101"))
    return derivations.user_profile(rows.withColumn("etl_dt", F.lit("20250620")).unionByName(older), "2025-06-20").withColumn("self_income_round", F.col("self_income_round") + 0.0)


@query("""WITH s AS (SELECT *, row_number() OVER (PARTITION BY Str_Id ORDER BY etl_dt DESC, "Id" DESC) AS n FROM o2o_new_gut_shop_base_third WHERE str_Sta = '正常')
SELECT Str_Id AS str_id, Str_Nm AS str_nm, City_Nm AS city_nm, Cnty_Nm AS cnty_nm, Lng AS lng, Lat AS lat, m.cat_nm1, m.cat_nm2 FROM s LEFT JOIN (VALUES ('100', '吃', 'hotpot'), ('111', '喝', 'milk tea'), ('155', '喝', NULL)) m(c, cat_nm1, cat_nm2) ON Cat_Id = c WHERE n = 1""")
def derive_item_profile(spark, d):
    shops = table(spark, d, _THIRD)
    shops = shops.toDF(*(c.lower() for c in shops.columns)).withColumn("etl_dt", F.concat("etl_dt", F.lpad(F.col("id").cast("string"), 12, "0")))
    mapping = spark.createDataFrame([(1, "吃", "100", "1"), (2, "喝", "111,155", "2"), (2, "old", "100", "1"), (3, "none", "", "1")], "cat_id int, cat_nm string, mt_cat_ids string, etl_dt string")
    names = spark.createDataFrame([(100, "hotpot"), (111, "milk tea")], "cat_id long, cat_nm string")
    return derivations.item_profile(shops, mapping, names, "正常")


@query("SELECT event, event_time, custref_no, regexp_extract(url, 'shopId=(\\d+)', 1) AS shopid FROM (SELECT *, 'https://x.example/p?shopId=' || shopid || '&a=1' AS url FROM user_seq) WHERE event = '$pageview'")
def derive_user_seq(spark, d):
    raw = table(spark, d, "user_seq").select("event", F.col("event_time").alias("time"), F.col("custref_no").alias("distinct_id"), F.concat(F.lit("https://x.example/p?shopId="), "shopid", F.lit("&a=1")).alias("pg_url"), F.col("user_latitude").alias("latitude"), F.col("user_longitude").alias("longitude"), "event_duration", "btn_nm", "cls_info", F.col("event").alias("spm_a"), F.lit("detail").alias("pg_nm"))
    return derivations.user_seq(raw, "$pageview", "detail").select("event", "event_time", "custref_no", "shopid")


@query("SELECT custref_no, min((age, sex, self_income_round))[1] AS age FROM user_profile WHERE custref_no IN (SELECT custref_no FROM user_seq) GROUP BY 1".replace("min((age, sex, self_income_round))[1] AS age", "count(*) > 0 AS active"))
def derive_active_profiles(spark, d):
    return derivations.active_profiles(table(spark, d, "user_profile"), table(spark, d, "user_seq")).select("custref_no", F.lit(True).alias("active"))


# ---- sources and the whole pipeline


@query("SELECT \"Id\", Str_Nm, etl_dt FROM o2o_new_gut_shop_base_third WHERE etl_dt IN (SELECT DISTINCT etl_dt FROM o2o_new_gut_shop_base_third ORDER BY 1 DESC LIMIT 2)")
def source_partitions(spark, d):
    meta = warehouse.TableMeta("", _THIRD, {"id": "BIGINT", "str_nm": "STRING", "addr": "STRING"}, {"etl_dt": "STRING"}, sensitive={"addr"})
    return warehouse.read_table(table(spark, d, _THIRD), meta, {"latest_n": 2}).select(F.col("id").alias("Id"), F.col("str_nm").alias("Str_Nm"), "etl_dt")


@query("SELECT \"Id\", round(x, 6) AS lng, round(y, 6) AS lat FROM (SELECT \"Id\", TRY_CAST(trim(Lng) AS DOUBLE) AS x, TRY_CAST(trim(Lat) AS DOUBLE) AS y FROM o2o_new_gut_shop_base_third) WHERE abs(x) <= 180 AND abs(y) <= 90 AND NOT (x = 0 AND y = 0)")
def source_geo(spark, d):
    rows = table(spark, d, _THIRD).select("Id", warehouse.geo(F.col("Lng"), F.col("Lat")).alias("g"))
    return rows.where("g is not null").select("Id", "g.lng", "g.lat")


_PIPE = {"filters": {"completeness": {}, "rules": {"rules": [{"field": "value", "operator": "gt", "value": 20}]}, "burst": {"time_window_minutes": 2880, "max_reviews": 5}, "dedup": {"enabled": False}, "kcore": {"k": 3}}, "sequences": {"enabled": False}}
_PIPE_SQL = f"""{E_SQL}, a AS (SELECT * FROM ev WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND item_id <> '' AND value > 20), s AS (SELECT user_id, count(*) AS n, max("timestamp") - min("timestamp") AS span FROM a GROUP BY 1),
b AS (SELECT * FROM a WHERE user_id NOT IN (SELECT user_id FROM s WHERE (CASE WHEN span > 0 AND n > 1 THEN n / (span / 60.0) ELSE 0 END) > 5.0 / 2880 OR (span <= 172800 AND n > 5))),
k0 AS (SELECT * FROM b WHERE user_id IN (SELECT user_id FROM b GROUP BY 1 HAVING count(*) >= 3) AND item_id IN (SELECT item_id FROM b GROUP BY 1 HAVING count(*) >= 3)),
k1 AS (SELECT * FROM k0 WHERE user_id IN (SELECT user_id FROM k0 GROUP BY 1 HAVING count(*) >= 3) AND item_id IN (SELECT item_id FROM k0 GROUP BY 1 HAVING count(*) >= 3)),
k2 AS (SELECT * FROM k1 WHERE user_id IN (SELECT user_id FROM k1 GROUP BY 1 HAVING count(*) >= 3) AND item_id IN (SELECT item_id FROM k1 GROUP BY 1 HAVING count(*) >= 3))"""


@query(f"WITH {_PIPE_SQL} SELECT event_id FROM k2")
def pipeline_interactions(spark, d):
    return Pipeline(_PIPE).process(None, None, events(spark, d))["interactions"].select("event_id")


@query(f"WITH {_PIPE_SQL} SELECT 'before' AS stage, count(*) AS rows, count(DISTINCT user_id) AS users, count(DISTINCT item_id) AS items, 100.0 AS kept_pct FROM ev UNION ALL SELECT 'after', count(*), count(DISTINCT user_id), count(DISTINCT item_id), round(count(*) * 100.0 / (SELECT count(*) FROM ev), 2) FROM k2")
def pipeline_report(spark, d):
    e = events(spark, d)
    return cleaning_report(e, Pipeline(_PIPE).process(None, None, e)["interactions"])


@query("SELECT review_id, overall AS rating, CAST(unixReviewTime AS BIGINT) * 1000 AS \"timestamp\", CASE WHEN lower(verified) = 'true' THEN 'true' ELSE 'false' END AS verified_purchase FROM amazon_old_review")
def source_old_as_new(spark, d):
    old = table(spark, d, "amazon_old_review").withColumn("asin", F.col("review_id").cast("string"))
    return files.old_as_new(old).select(F.col("asin").cast("long").alias("review_id"), "rating", "timestamp", "verified_purchase")


@query(f"WITH {_DIALOGUE_SQL}, v(dim, value) AS (VALUES ('brand', 'en'), ('brand', 'zh'), ('brand', 'xx'), ('taste', 'en')) SELECT dim, value, CAST(CASE WHEN dim = 'brand' THEN (SELECT count(*) FROM dl WHERE lg = value) ELSE 0 END AS BIGINT) AS n, CASE WHEN dim = 'brand' THEN (SELECT count(*) FROM dl WHERE lg = value) ELSE 0 END >= 5 AS covered FROM v")
def corpus_value_coverage(spark, d):
    values = spark.createDataFrame([("brand", "en"), ("brand", "zh"), ("brand", "xx"), ("taste", "en")], "dim string, value string")
    return corpus.value_coverage(dialogues(spark, d), values)


@query(f"WITH {_DIALOGUE_SQL} SELECT CAST(seq AS VARCHAR) AS item_id, 'brand' AS dim FROM dl WHERE lg = ''")
def corpus_uncovered(spark, d):
    rows = dialogues(spark, d).withColumn("item_id", F.col("seq").cast("string"))
    return corpus.uncovered_dims(rows, rows.select("item_id", F.lit("brand").alias("dim"), F.lit("x").alias("value")))


@query()
def synonym_build(spark, d):
    """All sources of groups as one set without antonyms."""
    a = synonyms.groups_from_pairs(table(spark, d, "brand_list"), "brand_nm", "alias_nm", "rule")
    return synonyms.build([a, synonym_ngram(spark, d).select(a.columns)], spark.createDataFrame([("热", "冷")], "a string, b string"))
