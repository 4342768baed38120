"""Queries of tag inference, model answers, synonym rules, corpus checks and the smaller operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import models
from tidewell.analytics import audit, detectors, reviews
from tidewell.functions import text
from tidewell.operators import corpus, synonyms, tags
from tidewell.plans import derivations
from tidewell.plans.more_queries import _DIALOGUE_SQL, dialogues
from tidewell.plans.reference_queries import E_SQL, events
from tidewell.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_THIRD = "o2o_new_gut_shop_base_third"


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


# ---- tags


@query(r"""SELECT DISTINCT Str_Nm, coalesce(trim(regexp_replace(regexp_replace(trim(Str_Nm, ' '), '\([^)]*\)', '', 'g'), '（.*?）', '', 'g'), ' '), '') AS label FROM o2o_new_gut_shop_base_third""")
def tag_clean_label(spark, d):
    return table(spark, d, _THIRD).select("Str_Nm", tags.clean_label(F.col("Str_Nm")).alias("label")).distinct()


@query("SELECT k, v FROM (VALUES (1, '拿铁'), (2, '[券]'), (3, 'B'), (4, ''), (5, 'x')) t(k, v)")
def tag_product_name(spark, d):
    rows = spark.createDataFrame([(1, " [券] 拿铁", "B"), (2, "[券]", None), (3, None, "B"), (4, None, ""), (5, "", "【券】x")], "k int, a string, b string")
    return rows.select("k", tags.product_name(F.col("a"), F.col("b")).alias("v"))


@query("SELECT \"Id\", CASE WHEN Lng IS NOT NULL AND Lat IS NOT NULL THEN 'geo' ELSE 'missing' END AS origin FROM o2o_new_gut_shop_base_third")
def tag_distance(spark, d):
    return table(spark, d, _THIRD).select("Id", tags.distance_tag(F.col("Lng"), F.col("Lat"))["origin"].alias("origin"))


@query("""SELECT "Id", CASE WHEN Cat_Nm IS NULL THEN 'missing' ELSE 'raw' END AS category, CASE WHEN City_Nm IS NULL THEN 'missing' WHEN City_Nm = Cnty_Nm THEN 'raw' ELSE 'ai' END AS brand, CASE WHEN "Id" % 3 = 0 THEN 'missing' ELSE 'ai' END AS taste FROM o2o_new_gut_shop_base_third""")
def tag_assembled(spark, d):
    rows = table(spark, d, _THIRD).select("Id", F.col("Cat_Nm").alias("category"), F.col("Cat_Nm").alias("raw_cat"), F.col("City_Nm").alias("brand"), F.col("Cnty_Nm").alias("raw_brand"), F.when(F.col("Id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("hot"))).alias("taste"))
    return tags.assemble(rows, {"category": ["raw_cat"], "brand": ["raw_brand"]}).select("Id", *(F.col(f"tag_source.{c}").alias(c) for c in ("category", "brand", "taste")))


@query("""SELECT "Id", Cat_Nm IS NULL AND Avg_Prc IS NULL AS cold FROM o2o_new_gut_shop_base_third""")
def tag_cold_start(spark, d):
    rows = table(spark, d, _THIRD).select("Id", F.col("Cat_Nm").alias("category"), F.col("Avg_Prc").alias("avg_prc"), F.lit("near").alias("distance"))
    return rows.select("Id", tags.is_cold_start(rows).alias("cold"))


@query("""SELECT CAST(o_orderkey AS BIGINT) AS k, CASE WHEN n = 1 THEN '1' WHEN n = 2 THEN '2' WHEN n BETWEEN 3 AND 4 THEN '3-4' WHEN n BETWEEN 5 AND 8 THEN '5-8' WHEN n >= 9 THEN '9+' END AS party FROM (SELECT o_orderkey, o_custkey % 12 AS n FROM orders)""")
def tag_party(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), tags.party_size(F.col("o_custkey") % 12).alias("party"))


@query("""SELECT doc_id, list_filter([CASE WHEN regexp_matches(text, '甜|sweet') THEN 'sweet' END, CASE WHEN regexp_matches(text, '辣|spicy') THEN 'hot' END], lambda x: x IS NOT NULL) AS taste FROM documents WHERE text IS NOT NULL""")
def tag_titles(spark, d):
    rules = {"taste": {"sweet": "甜|sweet", "hot": "辣|spicy"}}
    return table(spark, d, "documents").where("text is not null").select("doc_id", tags.title_tags(F.col("text"), rules)["taste"].alias("taste"))


@query("""SELECT "Id", coalesce(Cat_Nm, Str_Type) AS tag, CASE WHEN Cat_Nm IS NULL THEN 'missing' WHEN Cat_Nm = Str_Type THEN 'raw' ELSE 'ai' END AS origin FROM o2o_new_gut_shop_base_third""")
def tag_hints(spark, d):
    c = F.col("Cat_Nm")
    return table(spark, d, _THIRD).select("Id", tags.fill_with_hints(c, F.col("Str_Type")).alias("tag"), tags.tag_origin(c, [F.col("Str_Type")]).alias("origin"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN p_brand WHEN 2 THEN NULL END AS brand, CASE p_partkey % 4 WHEN 0 THEN ['hot', p_type] WHEN 1 THEN [p_type] WHEN 2 THEN NULL END AS taste FROM part""")
def tag_answers(spark, d):
    """A model's answers in the forms they come in: as asked, a list for one value, a text for a list, blanks and 'null', no JSON."""
    lists = F.struct(F.array("p_brand").alias("brand"), F.array(F.lit(" hot"), F.col("p_type"), F.lit("null")).alias("taste"))
    texts = F.struct(F.concat(F.lit(" "), "p_brand").alias("brand"), F.col("p_type").alias("taste"))
    none = F.struct(F.lit("null").alias("brand"), F.array(F.lit("")).alias("taste"))
    k = F.col("p_partkey") % 4
    answer = F.when(k == 0, F.to_json(lists)).when(k == 1, F.to_json(texts)).when(k == 2, F.to_json(none)).otherwise("sorry")
    return table(spark, d, "part").select("p_partkey", tags.parse_answer(answer).alias("a")).select("p_partkey", "a.brand", "a.taste")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '{"brand": "' || p_brand || '"}' WHEN 1 THEN '{}' END AS answer, p_partkey % 3 = 2 AS failed FROM part""")
def tag_model(spark, d):
    """The model plug with a client that answers in a fenced block, without JSON, or fails."""

    def make():
        def ask(prompt: str) -> str:
            k, brand = prompt.split("|")
            if int(k) % 3 == 2:
                raise OSError("down")
            return f'Here:\n```json\n{{"brand": "{brand}"}}\n```' if int(k) % 3 == 0 else "well {} then"

        return ask

    rows = table(spark, d, "part").select("p_partkey", models.fill("{k}|{b}", k=F.col("p_partkey"), b=F.col("p_brand")).alias("prompt"))
    return models.complete(rows, "prompt", make, retries=1).select("p_partkey", "answer", F.col("answer_error").isNotNull().alias("failed"))


@query("""WITH f AS (SELECT brnd_nm AS name, count(*) AS f, lower(brnd_nm) AS g FROM o2o_new_gut_shop_base WHERE brnd_nm <> '' GROUP BY 1) SELECT g AS "group", name AS canonical FROM f QUALIFY row_number() OVER (PARTITION BY g ORDER BY f DESC, length(name), name DESC) = 1""")
def vocab_canonical(spark, d):
    names = table(spark, d, "o2o_new_gut_shop_base").where("brnd_nm <> ''").groupBy(F.col("brnd_nm").alias("name")).agg(F.count(F.lit(1)).alias("frequency"))
    return tags.select_canonical(names.withColumn("group", F.lower("name")))


@query("""WITH o AS (SELECT coalesce(trim(regexp_replace(regexp_replace(trim(Cat_Nm, ' '), '\\([^)]*\\)', '', 'g'), '（.*?）', '', 'g'), ' '), '') AS value, count(*) AS f FROM o2o_new_gut_shop_base_third WHERE Cat_Nm <> '' GROUP BY 1), o2 AS (SELECT * FROM o WHERE f >= 10 AND value <> '')
SELECT coalesce(o2.value, k.value) AS value, f AS frequency, CASE WHEN k.value IS NULL THEN 'added' WHEN f IS NULL THEN 'removed' ELSE 'existing' END AS status FROM o2 FULL JOIN (SELECT unnest(['咖啡', '没有的']) AS value) k ON k.value = o2.value""")
def vocab_extract(spark, d):
    """The whole vocabulary run for one dimension of labels."""
    seen = table(spark, d, _THIRD).select(F.col("Cat_Nm").alias("value"), F.lit("shops").alias("source"))
    known = spark.createDataFrame([("taste", "咖啡"), ("taste", "没有的"), ("brand", "x")], "dim string, value string")
    return tags.extract({"taste": seen}, known)["taste"]["diff"]


@query("SELECT Cat_Nm AS category, CASE WHEN Cat_Nm IN ('咖啡', '奶茶') THEN 'drink' WHEN Cat_Nm IN ('快餐', '中餐', '西餐', '日料', '火锅', '烧烤', '烘焙', '甜品') THEN 'food' WHEN Cat_Nm IN ('便利店', '水果') THEN 'mixed' WHEN \"Id\" % 3 = 0 THEN 'drink' WHEN \"Id\" % 3 = 1 THEN 'food' ELSE 'none' END AS value, \"Id\" FROM o2o_new_gut_shop_base_third")
def tag_consumable_hints(spark, d):
    """Without a category that says it: by the category inferred from the name, by hints in the text, else none."""
    k = F.col("Id") % 3
    known = F.col("Cat_Nm").isin("咖啡", "奶茶", "快餐", "中餐", "西餐", "日料", "火锅", "烧烤", "烘焙", "甜品", "便利店", "水果")
    raw = F.when(known, F.col("Cat_Nm"))
    got = tags.consumable_type(raw, F.when(k == 0, "咖啡"), F.when(k == 1, "招牌寿司").otherwise("书"), F.lit(False))
    return table(spark, d, _THIRD).select(F.col("Cat_Nm").alias("category"), got["value"].alias("value"), "Id")


# ---- synonyms


def _brand_groups(spark, d):
    return synonyms.groups_from_pairs(table(spark, d, "brand_list"), "brand_nm", "alias_nm", "rule")


_GROUP_SQL = "g AS (SELECT brand_nm AS canonical, list_sort([brand_nm, alias_nm]) AS variants, substr(md5(array_to_string(list_sort([brand_nm, alias_nm]), '|')), 1, 12) AS group_id FROM brand_list WHERE alias_nm IS NOT NULL)"


@query(f"WITH {_GROUP_SQL} SELECT group_id FROM g WHERE canonical NOT IN (SELECT brand_nm FROM brand_list WHERE brand_id % 4 = 0)")
def synonym_antonyms(spark, d):
    pairs = table(spark, d, "brand_list").where("brand_id % 4 = 0 and alias_nm is not null").select(F.col("brand_nm").alias("a"), F.col("alias_nm").alias("b"))
    return synonyms.filter_antonyms(_brand_groups(spark, d), pairs).select("group_id")


@query(f"WITH {_GROUP_SQL} SELECT canonical, variants FROM g WHERE length(variants[1]) <= 8 AND length(variants[2]) <= 8")
def synonym_lengths(spark, d):
    return synonyms.length_filter(_brand_groups(spark, d), longest=8).select("canonical", "variants")


@query(f"WITH {_GROUP_SQL} SELECT variants, canonical, ['llm', 'rule'] AS source, CAST(1 AS DOUBLE) AS confidence FROM g")
def synonym_dedup(spark, d):
    a = _brand_groups(spark, d)
    b = a.withColumn("source", F.array(F.lit("llm"))).withColumn("confidence", F.lit(0.5))
    return synonyms.dedup_groups(a.unionByName(b)).select("variants", "canonical", "source", "confidence")


@query(f"WITH {_GROUP_SQL} SELECT 'no_blank' AS \"check\", true AS passed UNION ALL SELECT 'short_tokens', (SELECT count(*) FROM g WHERE length(variants[1]) > 20 OR length(variants[2]) > 20) = 0 UNION ALL SELECT 'few_groups', (SELECT count(*) FROM g) <= 100 UNION ALL SELECT 'no_antonyms', true")
def synonym_verify(spark, d):
    return synonyms.verify(_brand_groups(spark, d), spark.createDataFrame([("热", "冷")], "a string, b string"), 100)


@query(f"WITH {_GROUP_SQL}, v AS (SELECT group_id, canonical, unnest(variants) AS v FROM g), h AS (SELECT DISTINCT \"Id\", v.* FROM o2o_new_gut_shop_base_third JOIN v ON contains(Str_Nm, v)) SELECT \"Id\", group_id, canonical, list_sort(list(v)) AS variants_found FROM h GROUP BY 1, 2, 3")
def synonym_names(spark, d):
    return synonyms.groups_from_names(table(spark, d, _THIRD), "Id", "Str_Nm", _brand_groups(spark, d))


@query(f"WITH {_GROUP_SQL} SELECT 'llm' AS source_a, 'rule' AS source_b, count(*) AS n FROM g")
def synonym_overlap(spark, d):
    return synonyms.source_overlap(_brand_groups(spark, d).withColumn("source", F.array(F.lit("llm"), F.lit("rule"))))


@query("""WITH RECURSIVE e AS (SELECT p_partkey // 6 * 6 AS a, p_partkey AS b FROM part WHERE p_partkey % 6 > 0 UNION SELECT p_partkey AS a, p_partkey + 6 AS b FROM part WHERE p_partkey % 12 = 0),
x AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), r AS (SELECT a AS n, a AS m FROM x UNION SELECT x.b, r.m FROM r JOIN x ON x.a = r.n) SELECT CAST(n AS VARCHAR) AS node, CAST(min(m) AS VARCHAR) AS component FROM r GROUP BY 1""")
def components(spark, d):
    """Connected components of a graph of chains, by recursion in SQL."""
    from tidewell.operators import similarity

    k = F.col("p_partkey")
    part = table(spark, d, "part")
    edges = part.where(k % 6 > 0).select((F.floor(k / 6) * 6).alias("a"), k.alias("b")).unionByName(part.where(k % 12 == 0).select(k.alias("a"), (k + 6).alias("b")))
    return similarity.connected_components(edges).select(F.col("node").cast("string").alias("node"), F.col("component").cast("string").alias("component"))


_NAMES_SQL = "n AS (SELECT DISTINCT x FROM (SELECT brand_nm AS x FROM brand_list UNION SELECT alias_nm FROM brand_list) WHERE x <> '')"
_GRAM_SQL = "CASE WHEN length(x) < 2 THEN [] ELSE list_distinct(list_transform(range(1, length(x)), lambda i: substr(x, i, 2))) END"
_SCRIPT_SQL = r"CASE WHEN regexp_matches({x}, '[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}]') THEN 1 WHEN regexp_matches({x}, '[A-Za-z]') THEN 2 ELSE 3 END"


@query(f"""WITH RECURSIVE {_NAMES_SQL}, g AS (SELECT x, {_GRAM_SQL} AS g FROM n),
e AS (SELECT a.x AS a, b.x AS b FROM g a JOIN g b ON a.x <> b.x AND len(list_intersect(a.g, b.g)) > 0 AND len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) >= 0.6 WHERE {_SCRIPT_SQL.format(x="a.x")} = {_SCRIPT_SQL.format(x="b.x")}),
r AS (SELECT a AS n, a AS m FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.n), c AS (SELECT n, min(m) AS m FROM r GROUP BY 1)
SELECT m AS canonical, list_sort(list(n)) AS variants FROM c GROUP BY 1 HAVING count(*) >= 2""")
def synonym_spelling(spark, d):
    """synonym_ngram's groups, with recursion in SQL."""
    names = table(spark, d, "brand_list").select(F.explode(F.array("brand_nm", "alias_nm")).alias("n"))
    return synonyms.groups_from_ngram(names, "n", 0.6).select("canonical", "variants")


ORACLES["synonym_ngram"] = f"SELECT substr(md5(array_to_string(variants, '|')), 1, 12) AS group_id, canonical, variants, ['ngram'] AS source, CAST(0.6 AS DOUBLE) AS confidence, CAST(NULL AS VARCHAR) AS category FROM ({ORACLES['synonym_spelling']})"


# ---- corpora


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN 'search_item' ELSE 'browse' END AS intent, CASE WHEN doc_id % 3 = 2 THEN 0 ELSE 1 END AS n_messages, CASE WHEN doc_id % 3 < 2 THEN 'not_in' END AS op FROM documents""")
def corpus_responses(spark, d):
    """Dialogues in a model's JSON under either name of the messages, with unknown dimensions and blanks in operators; no JSON gives an empty one."""
    k = F.col("doc_id") % 3
    message = F.array(F.struct(F.lit("user").alias("role"), F.lit("hi").alias("content")))
    params = F.create_map(F.lit("brand"), F.array(F.struct(F.lit("not in").alias("op"), F.array(F.lit("a")).alias("values"))), F.lit("other"), F.array(F.struct(F.lit("in").alias("op"), F.array(F.lit("b")).alias("values"))))
    body = lambda name: F.to_json(F.struct(message.alias(name), params.alias("params"), F.lit("browse").alias("intent")))
    answer = F.when(k == 0, body("conversation")).when(k == 1, body("messages")).otherwise("none")
    return table(spark, d, "documents").select("doc_id", corpus.parse_response(answer, ("brand",)).alias("r")).select("doc_id", "r.intent", F.size("r.messages").alias("n_messages"), F.get(F.try_element_at("r.params", F.lit("brand")), F.lit(0))["op"].alias("op"))


@query(f"""WITH {_DIALOGUE_SQL} SELECT seq, list_filter([CASE WHEN seq % 2 = 1 THEN 'op of brand' END, CASE WHEN lg NOT IN ('en', 'zh') THEN 'value of brand' END], lambda x: x IS NOT NULL) AS errors FROM dl WHERE lg <> ''""")
def corpus_param_errors(spark, d):
    rows = dialogues(spark, d).where("params['brand'] is not null")
    return rows.select("seq", corpus.param_errors(F.col("params"), {"brand": ["in", "not_in"]}, {"brand": ["en", "zh"]}).alias("errors"))


@query(f"""WITH {_DIALOGUE_SQL}, t AS (SELECT count(*) AS t, count(*) FILTER (lg <> '') AS p FROM dl), l AS (SELECT sum(list_sum(list_transform(lines, lambda x: length(x)))) / sum(len(lines)) AS avg_len, avg((seq % 10 = 0)::INT) AS neg FROM dl)
SELECT 'intent.' || intent AS warning FROM dl, t GROUP BY intent HAVING round(count(*) / any_value(t), 4) < 0.03 UNION ALL SELECT 'param.brand' FROM t WHERE round(p / t, 4) < 0.05
UNION ALL SELECT 'op.not_contains' FROM dl, t WHERE lg <> '' AND seq % 2 = 1 GROUP BY 1 HAVING round(count(*) / any_value(p), 4) < 0.03 UNION ALL SELECT 'negative_ratio' FROM l WHERE abs(neg - 0.5) > 0.02 UNION ALL SELECT 'message_avg_length' FROM l WHERE NOT round(avg_len, 4) BETWEEN 20 AND 80""")
def corpus_warnings(spark, d):
    return corpus.distribution_warnings(corpus.distribution_stats(dialogues(spark, d)), 0.5)


@query(f"""WITH {_DIALOGUE_SQL} SELECT count(*) AS n, count(DISTINCT CASE WHEN lg = '' THEN '' ELSE lg || (seq % 2) END) AS combinations, count(DISTINCT CASE WHEN lg = '' THEN '' ELSE lg || (seq % 2) END) * 1000 >= least(count(*), 1000) * 2 AS passed FROM dl""")
def corpus_diversity(spark, d):
    return corpus.diversity(dialogues(spark, d), least=2)


@query("""WITH s AS (SELECT review_id AS seq, CASE review_id % 10 WHEN 8 THEN 'val' WHEN 9 THEN 'test' ELSE 'train' END AS split, review_id % 3 = 0 AS is_real FROM amazon_new_review), c AS (SELECT split, count(*) FILTER (is_real) AS r FROM s GROUP BY 1),
g AS (SELECT s.*, r, row_number() OVER (PARTITION BY s.split ORDER BY seq) AS n FROM s JOIN c USING (split) WHERE s.split <> 'train' AND NOT is_real)
SELECT seq, CASE WHEN r > 0 AND n > r THEN 'train' ELSE split END AS split FROM g UNION ALL SELECT seq, split FROM s WHERE split = 'train' OR is_real""")
def corpus_real_first(spark, d):
    k = F.col("review_id") % 10
    rows = table(spark, d, "amazon_new_review").select(F.col("review_id").alias("seq"), F.when(k == 8, "val").when(k == 9, "test").otherwise("train").alias("split"), (F.col("review_id") % 3 == 0).alias("is_real"))
    return corpus.real_first(rows).select("seq", "split")


@query("SELECT 'no_leak' AS \"check\", true AS passed UNION ALL SELECT 'many', (SELECT count(*) FROM amazon_new_review) > 100")
def corpus_verified(spark, d):
    rows = corpus.split(table(spark, d, "amazon_new_review"), "parent_asin")
    return corpus.verification(no_leak=corpus.leaks(rows, "parent_asin").agg((F.count(F.lit(1)) == 0).alias("ok")), many=rows.agg((F.count(F.lit(1)) > 100).alias("ok")))


@query("SELECT 'shop-' || lpad(CAST(i AS VARCHAR), 6, '0') AS item_id, true AS known FROM range(500) t(i)")
def corpus_shops(spark, d):
    """Invented shops: ids and that each value is of its dimension; the draws are hashes."""
    rows = corpus.synthesize_shops(spark, 500, {"taste": ["hot", "sweet"], "brand": ["a", "b", "c"]})
    return rows.select("item_id", (F.col("taste").isin("hot", "sweet") & F.col("brand").isin("a", "b", "c")).alias("known"))


@query("SELECT 'shop-' || lpad(CAST(i AS VARCHAR), 6, '0') AS item_id, CAST(n AS INT) AS n, true AS named, true AS excluded FROM range(200) t(i), range(1, 3) u(n)")
def corpus_dialogues(spark, d):
    """Dialogues from templates: the text names the item's brand, and a negative sample excludes it."""
    shops = corpus.synthesize_shops(spark, 200, {"brand": ["aa", "bb"]})
    plan = corpus.plan_samples(shops, "item_id", 2, {"gift": 0.5, "meal": 0.5}, {"browse": 1.0}, 0.3).join(shops, "item_id")
    out = corpus.template_dialogues(plan, {"gift": ["a gift of {brand}", "{brand} for a friend"], "meal": ["{brand} tonight"]}, ["brand"]).join(shops, "item_id")
    op = F.get(F.element_at("params", "brand"), F.lit(0))
    return out.select("item_id", "n", F.contains(F.get("messages", F.lit(0))["content"], F.col("brand")).alias("named"), ((op["op"] == F.when(F.col("negative"), "not_in").otherwise("in")) & (F.get(op["values"], F.lit(0)) == F.col("brand"))).alias("excluded"))


# ---- smaller operators


@query(r"""SELECT review_id, trim(regexp_replace(lower(title), '\s+', ' ', 'g'), ' ') AS title, coalesce(nullif(regexp_extract(asin, '([0-9]+)', 1), ''), 'none') AS asin, replace(replace(user_id, 'A', 'x'), 'B', '') AS user_id FROM amazon_new_review""")
def text_configured(spark, d):
    """Normalizers by configuration, with rules of one column; unknown ones and broken patterns are skipped."""
    steps = [
        {"normalizer": "lowercase_normalizer", "columns": ["title", "missing", "rating"]}, {"normalizer": "whitespace_normalizer", "columns": ["title"]}, {"normalizer": "none", "columns": ["title"]},
        {"normalizer": "regex_extract_normalizer", "columns": [{"name": "asin", "pattern": "([0-9]+)", "default": "none"}, {"name": "title", "pattern": "("}]},
        {"normalizer": "regex_replace_normalizer", "columns": [{"name": "user_id", "rules": [{"pattern": "A", "replacement": "x"}, {"pattern": "B"}, {"pattern": "["}]}]},
    ]
    return text.normalize(table(spark, d, "amazon_new_review"), steps).select("review_id", "title", "asin", "user_id")


@query(f"WITH {E_SQL} SELECT 'events' AS t, 'row_count' AS metric, CAST(1 AS INT) AS n UNION ALL SELECT 'events', 'field_completeness', 2 UNION ALL SELECT 'events', 'time_range', 1 UNION ALL SELECT 'users', 'row_count', 1")
def audit_report(spark, d):
    e = events(spark, d)
    found = audit.audit({"events": e, "users": e.select("user_id").distinct(), "off": e}, {"events": {"fields": ["user_id", "item_id"], "time": "timestamp"}, "off": {"enabled": False}})
    return spark.createDataFrame([(t, m, len(rows)) for t, ms in found.items() for m, rows in ms.items()], "t string, metric string, n int")


@query("""SELECT DISTINCT p.custref_no, p.age, p.sex FROM user_profile p WHERE p.custref_no IN (SELECT custref_no FROM user_seq)""")
def derive_active_fields(spark, d):
    return derivations.active_profiles(table(spark, d, "user_profile"), table(spark, d, "user_seq")).select("custref_no", "age", "sex").distinct()


@query("""WITH s AS (SELECT "Id" AS item_id, 112.0 + ("Id" % 7) AS item_lon, 30.0::DOUBLE AS item_lat FROM o2o_new_gut_shop_base_third), k AS (SELECT s.*, 2 * 6371.0 * asin(sqrt(power(cos(radians(30.0)) * 1.0, 2) * power(sin(radians(item_lon - 112.0) / 2), 2))) AS km FROM s, range(3))
SELECT CAST(item_id AS VARCHAR) AS item_id, max(km) >= 50 AS flag_geo, CAST(CASE WHEN max(km) >= 50 THEN 1 ELSE 0 END AS INT) AS campaign_score, CASE WHEN max(km) >= 50 THEN 'geo' ELSE '' END AS reason FROM k GROUP BY 1""")
def score_geo_items(spark, d):
    """Scores with the geo detector's flags."""
    items = table(spark, d, _THIRD).select(F.col("Id").cast("string").alias("item_id"), (112.0 + F.col("Id") % 7).alias("item_lon"), F.lit(30.0).alias("item_lat"))
    seen = items.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(2))))
    found = detectors.geo_mismatch(seen.select("item_id", F.lit(30.0).alias("user_lat"), F.lit(112.0).alias("user_lon")), items, least=3)
    return detectors.score_items(found).select("item_id", "flag_geo", "campaign_score", "reason")


@query("SELECT min(review_year_month) AS first FROM (SELECT strftime(make_timestamp(CASE WHEN \"timestamp\" < 1000000000000 THEN \"timestamp\" * 1000 ELSE \"timestamp\" END * 1000), '%Y-%m') AS review_year_month FROM amazon_new_review)")
def reviews_sorted(spark, d):
    """An analyzer's result in the order it is written in; its first row."""
    plans, _ = reviews.run_all(reviews.derive(table(spark, d, "amazon_new_review")), ["rating_by_time"])
    return reviews.shown("rating_by_time", plans["rating_by_time"]).select(F.col("review_year_month").cast("string").alias("first")).where("first is not null").limit(1)


@query("""SELECT "Id", 'category' AS dim, Cat_Nm AS value FROM o2o_new_gut_shop_base_third WHERE Cat_Nm IS NOT NULL UNION ALL SELECT "Id", 'avg_prc', Avg_Prc FROM o2o_new_gut_shop_base_third WHERE Avg_Prc IS NOT NULL UNION ALL SELECT "Id", 'taste', unnest(['a', 'b']) FROM o2o_new_gut_shop_base_third WHERE "Id" % 2 = 0""")
def tag_flat(spark, d):
    rows = table(spark, d, _THIRD).select("Id", F.col("Cat_Nm").alias("category"), F.col("Avg_Prc").alias("avg_prc"), F.when(F.col("Id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).alias("taste"))
    return tags.tag_rows(rows, "Id")


@query("SELECT min(review_id) AS review_id FROM amazon_new_review GROUP BY user_id, parent_asin")
def corpus_unrepeated(spark, d):
    return corpus.without_repeats(table(spark, d, "amazon_new_review"), "user_id", ["parent_asin"], "review_id").select("review_id")


@query(f"WITH {_DIALOGUE_SQL} SELECT CAST(seq AS VARCHAR) AS item_id, CAST(2 AS INT) AS n FROM dl WHERE lg = ''")
def corpus_cover(spark, d):
    """A further sample for each item with a tag that none of its samples asks for."""
    rows = dialogues(spark, d).withColumn("item_id", F.col("seq").cast("string")).withColumn("n", F.lit(1))
    return corpus.cover(rows, rows.select("item_id", F.lit("brand").alias("dim"), F.lit("x").alias("value")))
