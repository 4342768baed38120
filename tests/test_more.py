"""Vocabularies, synonyms, corpora, sources, sinks, pipeline, models, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from tidewell import models, sinks, sources
from tidewell.operators import corpus, similarity, synonyms, tags
from tidewell.plans.pipeline import Pipeline
from tidewell.sources import warehouse
from tidewell.streaming import events as stream


def test_greedy_groups_equal_the_sequential_rule(spark):
    import random

    random.seed(8)
    stems = ["starcafe", "moonbakery", "redpanda", "greentea"]
    names = {}
    for _ in range(60):
        s = list(random.choice(stems))
        for _ in range(random.randrange(3)):
            s[random.randrange(len(s))] = random.choice("abcde")
        names["".join(s)] = random.randrange(1, 30)
    df = spark.createDataFrame(list(names.items()), "name string, frequency long")
    got = {r.name: r.canonical for r in tags.group_names(df).collect()}

    def grams(x):
        return {x[i : i + 2] for i in range(len(x) - 1)}

    def distance(a, b):
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            q = [i]
            for j, y in enumerate(b, 1):
                q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
            p = q
        return p[-1]

    canon, want = [], {}
    for n in sorted(names, key=lambda x: (-names[x], len(x), x)):
        hit = next((c for c in canon if distance(n, c) <= 3 and len(grams(n) & grams(c)) / len(grams(n) | grams(c)) >= 0.6), None)
        if hit is None:
            canon.append(n)
        want[n] = hit or n
    assert got == want and len(canon) < len(names)


def test_components(spark):
    edges = [(f"n{k:03}", f"n{k + 1:03}") for k in range(60) if k != 30] + [("x", "x"), (None, "y")]
    got = {r.node: r.component for r in similarity.connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got["n030"] == "n000" and got["n060"] == "n031" and got["x"] == "x" and len(got) == 62
    assert similarity.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_tags(spark):
    df = spark.createDataFrame([("  Star (Mall) Co.", "小吃-米粉面馆", "[券]奶茶"), (None, "甲-乙", "满50减10"), ("光明集团", None, "[券]")], "b string, c string, n string")
    got = df.select(tags.clean_brand(F.col("b")), tags.clean_category(F.col("c")), tags.product_name(F.col("n")), tags.is_rule_text(F.col("n"))).collect()
    assert [r[0] for r in got] == ["Star", "", "光明"] and [r[1] for r in got] == ["米粉面馆", "甲-乙", ""]
    assert [r[2] for r in got] == ["奶茶", "满50减10", "[券]"] and [r[3] for r in got] == [True, True, True]
    names = spark.createDataFrame([(1, "大杯珍珠奶茶"), (2, "奶茶"), (3, "满50减10奶茶"), (4, None), (5, "水")], "k int, n string")
    values = spark.createDataFrame([("奶茶",), ("珍珠奶茶",), ("水",), (None,)], "v string")
    assert {tuple(r) for r in tags.infer_longest(names, "k", "n", values, "v").collect()} == {(1, "珍珠奶茶"), (2, "奶茶"), (5, "水")}
    c = spark.createDataFrame([("咖啡", "", ""), ("", "火锅", "x"), (None, None, "一杯拿铁"), (None, None, "?")], "cat string, inf string, txt string")
    kinds = c.select(tags.consumable_type(F.col("cat"), F.col("inf"), F.col("txt"), F.lit(False)).alias("x")).select("x.*").collect()
    assert [tuple(r) for r in kinds] == [("drink", "derived"), ("food", "derived"), ("drink", "derived"), ("none", "derived")]
    asked = c.limit(1).select(tags.consumable_type(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(""), F.lit(False), answer=F.lit("mixed")).alias("x")).first().x
    assert tuple(asked) == ("mixed", "ai")
    p = spark.createDataFrame([("0", None), ("30", None), ("x", "150"), ("999", "1")], "a string, b string").select(tags.price_bucket(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in p] == [None, "0-30", "100-200", "200+"]
    arr = spark.range(1).select(tags.constrain_array(F.array(F.lit("a"), F.lit("z")), F.array(F.lit("a"))).alias("x")).first().x
    assert arr.value == ["a"] and arr.rejected == ["z"]
    assert [r[0] for r in spark.createDataFrame([(n,) for n in (1, 2, 4, 8, 9)], "n int").select(tags.party_size(F.col("n"))).collect()] == ["1", "2", "3-4", "5-8", "9+"]


def test_incremental_state(spark):
    rows = spark.createDataFrame([("a", "x", None), ("b", "y", 1), ("c", "z", 2)], "k string, n string, p int")
    state = rows.withColumn("record_hash", tags.record_hash(rows, ["n", "p"])).withColumn("v", F.lit("1")).select("k", "record_hash", "v").where("k <> 'c'")
    assert [r.k for r in tags.changed(rows, state, "k", ["n", "p"], {"v": "1"}).collect()] == ["c"]
    assert tags.changed(rows, state, "k", ["n", "p"], {"v": "2"}).count() == 3
    assert tags.upsert(state, state.limit(1).withColumn("v", F.lit("9")), "k").where("v = '9'").count() == 1


def test_synonyms(spark, tmp_path):
    pairs = spark.createDataFrame([("可乐", "可口可乐"), ("可乐", "cola"), ("x", "x"), ("茶", None)], "c string, v string")
    g = synonyms.groups_from_pairs(pairs, "c", "v", "rule")
    assert [r.variants for r in g.collect()] == [["cola", "可乐", "可口可乐"]]
    more = spark.createDataFrame([("g1", "a", ["a", "b"], ["llm"], 0.5, None), ("g2", "a", ["b", "a"], ["rule"], 0.9, None), ("g3", "c", ["b", "c"], ["llm"], 0.7, None), ("g4", "d", ["热", "冷"], ["llm"], 0.7, None)], "group_id string, canonical string, variants array<string>, source array<string>, confidence double, category string")
    one = synonyms.dedup_groups(more)
    assert one.count() == 3 and one.where("size(source) = 2").first().confidence == 0.9
    merged = synonyms.merge_overlapping(one)
    assert sorted(r.variants for r in merged.collect()) == [["a", "b", "c"], ["冷", "热"]]
    antonyms = spark.createDataFrame([("冷", "热")], "a string, b string")
    assert synonyms.filter_antonyms(merged, antonyms).count() == 1
    assert {r.check: r.passed for r in synonyms.verify(merged, antonyms).collect()} == {"no_blank": True, "short_tokens": True, "few_groups": True, "no_antonyms": False}
    long = spark.createDataFrame([("g", "a", [f"w{k:02}" for k in range(23)] + ["x" * 21], ["llm"], 0.5, None)], more.schema)
    assert sorted(len(r.variants) for r in synonyms.length_filter(long).collect()) == [3, 10, 10]
    assert synonyms.truncate(one, 1).first().source == ["llm", "rule"]
    assert synonyms.source_overlap(one).first().n == 1
    sinks.write_solr(merged, str(tmp_path), "made by test")
    assert [r.value for r in spark.read.text(f"{tmp_path}/ext_synonyms.txt").collect()] == ["# made by test", "a, b, c", "冷, 热"]
    grams = synonyms.groups_from_ngram(spark.createDataFrame([("starbucks",), ("starbuckss",), ("星巴克",), (None,), ("",)], "n string"), "n")
    assert [r.variants for r in grams.collect()] == [["starbucks", "starbuckss"]]
    assert synonyms.groups_from_names(spark.createDataFrame([(1, "喝cola吧")], "k int, n string"), "k", "n", g).first().variants_found == ["cola"]


def test_embedding_pairs(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    base = rng.standard_normal((30, 16))
    vecs = [*(b.tolist() for b in base), *((b + 0.15 * rng.standard_normal(16)).tolist() for b in base), base[0].tolist(), [0.0] * 16]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vecs)] + [(99, None)], "k int, v array<double>")
    m = np.array(vecs[:60])
    m /= np.linalg.norm(m, axis=1)[:, None]
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if m[i] @ m[j] >= 0.85} | {(0, 60)}
    got = {(r.a, r.b) for r in synonyms.embedding_pairs(df, "k", "v").collect()}
    assert got == want


def samples(spark):
    def s(seq, texts, dims, item="i"):
        return (seq, item, [("user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)], dims)

    ok = {"taste": [("in", ["hot"])]}
    rows = [s(1, ["a long enough message"], ok), s(2, ["a long enough message"], ok), s(3, ["short"], ok), s(4, ["a long enough message!"], {"taste": None}), s(5, ["bad \x07 control char"], ok), s(6, [], ok), s(7, ["m long enough one"] * 5, ok), s(8, ["another fine message"], {}), s(9, ["x"] * 0, None)]
    return spark.createDataFrame(rows, "seq long, item_id string, messages array<struct<role string, content string>>, params map<string, array<struct<op string, values array<string>>>>")


def test_cleaner(spark):
    got = {r.seq: r.drop_reason for r in corpus.drop_reasons(samples(spark), template_share=1.0).collect()}
    assert got == {1: None, 2: "text_hash_dedup", 3: "min_message_length", 4: "params_all_null", 5: "control_char", 6: "turn_count", 7: "turn_count", 8: "params_all_null", 9: "turn_count"}
    assert corpus.retention(corpus.drop_reasons(samples(spark))).first().status == "alert"
    assert corpus.retention(corpus.drop_reasons(samples(spark).limit(0))).first().retention_rate == 0


def test_cleaner_templates(spark):
    rows = [(k, "i", [("user", f"the same first twenty chars {k}")], {"t": [("in", [str(k)])]}) for k in range(80)] + [(100 + k, "i", [("user", f"{k} all different ones")], {"t": [("in", ["v"])]}) for k in range(20)]
    df = spark.createDataFrame(rows, samples(spark).schema)
    got = corpus.drop_reasons(df)
    assert sorted(r.seq for r in got.where("drop_reason is null and seq < 100").collect()) == list(range(20)) and got.where("drop_reason = 'template_repeat'").count() == 60


def test_validation_and_predicates(spark):
    ok = spark.createDataFrame([([("user", "hi")], "g", {"t": [("in", ["a"])]}, "browse"), ([("assistant", " ")], "", {"t": [("is", None)]}, "x"), ([], "g", None, "browse")], "messages array<struct<role string, content string>>, guide_text string, params map<string, array<struct<op string, values array<string>>>>, intent string")
    errors = [r[0] for r in ok.select(corpus.sample_errors()).collect()]
    assert errors[0] == [] and set(errors[1]) == {"first role is not user", "content empty", "guide_text missing", "op invalid", "values missing", "intent invalid"} and errors[2] == ["messages empty"]
    assert ok.limit(1).select(corpus.param_errors(F.col("params"), {"t": ["in"]}, {"t": ["b"]})).first()[0] == ["value of t"]
    assert ok.limit(1).select(corpus.param_errors(F.col("params"), {"u": ["in"]})).first()[0][0] == "dimension t"
    arr = lambda *x: F.array(*map(F.lit, x))
    cases = [("eq", arr("a", "b"), arr("b", "a"), True), ("in", arr("a"), arr("a", "c"), True), ("contains", arr("a", "b"), arr("a"), True), ("contains", arr("a"), arr("a", "b"), False), ("not_in", arr("a"), arr("b"), True), ("gt", arr("5"), arr("4"), True), ("between", arr("5"), arr("1", "5"), True), ("lt", arr("x"), arr("5"), None)]
    got = spark.range(1).select(*(corpus.matches(op, a, b).alias(f"c{k}") for k, (op, a, b, _) in enumerate(cases))).first()
    assert list(got) == [w for *_, w in cases]
    answer = spark.createDataFrame([('{"conversation":[{"role":"user","content":"q"}],"params":{"t":[{"op":"not contains","values":["a"]}],"zz":null}}',), ('{"messages":[]}',), ("broken",)], "a string").select(corpus.parse_response(F.col("a"), ("t",)).alias("r")).select("r.*").collect()
    assert answer[0].messages[0].content == "q" and answer[0].params["t"][0].op == "not_contains" and set(answer[0].params) == {"t"} and answer[1].messages == [] and answer[2].intent == "search_item"


def test_split_and_sampling(spark):
    import hashlib

    keys = [f"k{i}" for i in range(300)] + ["", "键"]
    df = spark.createDataFrame([(k, n) for k in keys for n in range(2)], "item string, n int")
    got = {r.item: r.b for r in df.select("item", corpus.md5_mod(F.col("item")).alias("b")).collect()}
    assert got == {k: int(hashlib.md5(k.encode()).hexdigest(), 16) % 100 for k in keys}
    assert corpus.leaks(corpus.split(df, "item"), "item").count() == 0
    a = corpus.plan_samples(df.select("item").distinct(), "item", 2, {"x": 1, "y": 3}, {"p": 1})
    b = corpus.plan_samples(df.select("item").distinct().repartition(7), "item", 2, {"x": 1, "y": 3}, {"p": 1})
    assert sorted(a.collect()) == sorted(b.collect()) and 0.6 < a.where("scenario = 'y'").count() / a.count() < 0.9
    many = spark.createDataFrame([("rare", k) for k in range(2)] + [("common", k) for k in range(98)], "c string, n int")
    assert corpus.oversample(many, "c").where("c = 'rare'").count() == 4
    held = spark.createDataFrame([(k, k < 4, "val") for k in range(20)] + [(50, False, "train")], "seq long, is_real boolean, split string")
    assert corpus.real_first(held).where("split = 'val'").count() == 8 and corpus.real_first(held).count() == 21
    assert corpus.params_dedup(samples(spark).where("seq in (1, 2, 5, 3, 7)")).count() == 3
    line = json.loads(corpus.jsonl(spark.sql("select double('NaN') a, cast(null as string) b, 1 c")).first().value)
    assert line == {"a": None, "b": None, "c": 1}
    hot = spark.createDataFrame([("h", 1.0)], "item_id string, price double")
    rows = spark.createDataFrame([("a", 2.0), ("b", 1.0)], "item_id string, price double")
    assert [r.item_id for r in corpus.rerank(rows, "price").collect()] == ["b", "a"] and corpus.rerank(rows, "price", rows, hot=hot).first().item_id == "h"
    warned = corpus.distribution_warnings(corpus.distribution_stats(samples(spark).withColumn("intent", F.lit(None).cast("string")).withColumn("negative", F.lit(False))))
    assert {r.warning for r in warned.collect()} >= {"negative_ratio"}


def test_model_plug(spark):
    assert models.extract_json('say ```json\n{"a": 1}\n``` ok') == '{"a": 1}' and models.extract_json("no [1, 2] x") == "[1, 2]" and models.extract_json("{bad") is None and models.extract_json(None) is None
    df = spark.createDataFrame([(1, "x"), (2, "fail"), (3, None), (4, "x")], "k int, prompt string")

    def make():
        def ask(p):
            if p == "fail":
                raise OSError("down")
            return f'answer: {{"p": "{p}"}}'

        return ask

    got = {r.k: (r.answer, r.answer_error) for r in models.complete(df, "prompt", make, wait=0.0).collect()}
    assert got == {1: ('{"p": "x"}', None), 2: (None, "down"), 3: (None, None), 4: ('{"p": "x"}', None)}
    assert models.complete(df, "prompt").first().answer == "{}"
    assert df.select(models.fill("q {a} {b}", a=F.col("k"), b=F.lit(None))).first()[0] == "q 1 null"
    with pytest.raises(ValueError):
        models.client("nobody")


def test_sources_and_sinks(spark, tmp_path):
    p = str(tmp_path)
    (tmp_path / "ratings.txt").write_text("1:\n10,5,2005-01-01\n11,2,2005-01-02\n2:\n10,3,2005-01-03\nbroken\n")
    (tmp_path / "titles.csv").write_text("1,2003,Sea\n2,2004,Land\n")
    movies = sources.create("Movie_Ratings", spark, {"ratings_paths": f"{p}/ratings.txt", "titles_path": f"{p}/titles.csv"})
    assert sorted(tuple(r) for r in movies.get_interactions().collect()) == [("10", "1", 5.0, 1104537600, "like"), ("10", "2", 3.0, 1104710400, "neutral"), ("11", "1", 2.0, 1104624000, "dislike")]
    assert movies.schema_info()["co_occurrence"] is None and movies.get_items().count() == 2
    with pytest.raises(ValueError):
        sources.create("movie_ratings", spark, {"ratings_paths": 3}).validate_config()
    with pytest.raises(ValueError):
        sources.create("nothing", spark)

    (tmp_path / "old.json").write_text('{"overall": 5, "reviewText": "t", "reviewerID": "u", "asin": "a", "unixReviewTime": 10, "reviewerName": "N"}\n{"overall": 3.5, "reviewerID": "u", "asin": "b", "unixReviewTime": 20, "reviewerName": "M"}\n')
    (tmp_path / "meta.json").write_text('{"asin": "a", "title": "A", "also_buy": ["b"], "also_view": []}\n')
    old = sources.create("reviews_old", spark, {"reviews_path": f"{p}/old.json", "meta_path": f"{p}/meta.json"})
    assert {r.item_id: r.action for r in old.get_interactions().collect()} == {"a": "like", "b": "neutral"} and old.get_users().first().user_name == "M"
    assert old.get_co_occurrence().first().related_items == ["b"] and old.get_items().columns == ["item_id", "item_title"]

    (tmp_path / "new.json").write_text('{"rating": 2, "text": "t", "title": "h", "parent_asin": "a", "asin": "x", "user_id": "u", "timestamp": 1700000000123, "verified_purchase": "false"}\n')
    (tmp_path / "meta2.json").write_text('{"parent_asin": "a", "title": "A", "bought_together": "[\\"b\\"]"}\n{"parent_asin": "c", "title": "C"}\n')
    new = sources.create("reviews_new", spark, {"reviews_path": f"{p}/new.json", "meta_path": f"{p}/meta2.json"})
    r = new.get_interactions().first()
    assert r.timestamp == 1700000000 and r.action == "dislike" and r.verified is False and r.item_id == "a"
    assert {x.item_id: x.related_items for x in new.get_co_occurrence().collect()} == {"a": ["b"], "c": []}

    (tmp_path / "items.csv").write_text("item_id,item_nm,lon,lat\n i1 ,Shop,120.5,30\n")
    (tmp_path / "inter.csv").write_text("custref_no,item_id,event_time,event,btn_nm,lat,lon\nu1,i1,1700000000,showPage,,30,120\nu1,i1,1700000001,Click,buy,,\nu1,i1,1700000002,Click,other,,\n,i1,1,Click,x,,\nu2,i1,x,Share,x,,\nu2,i1,5,Share,x,,\n")
    csv = sources.create("coupon_csv", spark, {"items_path": f"{p}/items.csv", "interactions_path": f"{p}/inter.csv", "btn_action_mapping": {"buy": "receive"}})
    assert [x.action for x in csv.get_interactions().orderBy("timestamp").collect()] == ["share", "impression", "receive", "click"] and csv.get_items().first().item_lon == 120.5

    for name, rows in {"users": [("u1", "A")], "items": [("s1", "Shop")], "events": [("$pageview", 1_700_000_000_000, "u1", "s1"), ("Weird", 1_700_000_001, "u1", "s1"), ("coupon_use", 5, "", "s1")]}.items():
        cols = {"users": "custref_no string, age string", "items": "str_id string, str_nm string", "events": "event string, time long, custref_no string, shopid string"}[name]
        spark.createDataFrame(rows, cols).createOrReplaceTempView(f"w_{name}")
    hive = sources.create("coupon_warehouse", spark, {"users_table": "w_users", "items_table": "w_items", "interactions_table": "w_events"})
    hive.validate_config()
    assert sorted((x.action, x.timestamp) for x in hive.get_interactions().collect()) == [("view", 1_700_000_000), ("weird", 1_700_000_001)]
    assert hive.get_users().first().sex is None and hive.get_items().first().city_nm == ""

    spark.createDataFrame([("u", "c1", 7, "buy", 1), ("u", "c1", 7, "look", 2)], "user_id string, coupon_id string, template_id int, action string, timestamp long").write.parquet(f"{p}/trades")
    trade = sources.create("trade_coupons", spark, {"trades_path": f"{p}/trades"})
    assert trade.get_interactions().count() == 1 and trade.get_items().columns == ["item_id", "template_id"]
    assert sources.create("external_coupons", spark).get_interactions().columns == ["user_id", "item_id", "timestamp", "action"]
    spark.createDataFrame([("u", 9, 1)], "user_id string, store_id int, timestamp long").write.parquet(f"{p}/pay")
    assert sources.create("local_payments", spark, {"trades_path": f"{p}/pay"}).get_interactions().first().item_id == "store-9"

    (tmp_path / "v_users.csv").write_text("user_id,user_active_degree,follow_user_num,follow_user_num_range\n1,full,3.0,(0,10]\n".replace("(0,10]", "low"))
    (tmp_path / "v_log.csv").write_text("user_id,video_id,time_ms,is_like,long_view\n1,v,1700000000123,0.0,1.0\n1,w,1700000000123,0,0\n")
    (tmp_path / "v_basic.csv").write_text("video_id,upload_dt,tag\nv,2022-01-01,x\nw,bad,y\n")
    (tmp_path / "v_stat.csv").write_text("video_id,plays,tag\nv,5,z\n")
    video = sources.create("video_logs", spark, {"users_path": f"{p}/v_users.csv", "log_path": f"{p}/v_log.csv", "basic_path": f"{p}/v_basic.csv", "statistic_path": f"{p}/v_stat.csv"})
    assert video.get_users().first().follow_user_num == 3 and {x.item_id: x.action for x in video.get_interactions().collect()} == {"v": "like", "w": "dislike"}
    assert {x.item_id: (x.plays, x.upload_timestamp) for x in video.get_items().collect()} == {"v": ("5", 1640995200), "w": (None, None)}

    for form in ("parquet", "json", "csv"):
        out = sinks.write_all({"users": hive.get_users(), "interactions": hive.get_interactions(), "co_occurrence": None, "seq": new.get_co_occurrence()}, f"{p}/out_{form}", form)
        assert set(out) == {"users", "interactions", "seq"}
        back = warehouse.intermediate(spark, f"{p}/out_{form}", form)
        assert back["interactions"].count() == 2 and back["items"].first().item_title is None
    with pytest.raises(ValueError):
        sinks.write(hive.get_users(), p, "x", "orc")
    sinks.write_lines(hive.get_users(), f"{p}/lines")
    assert json.loads(spark.read.text(f"{p}/lines").first().value)["sex"] is None
    sinks.report({"n": 1}, f"{p}/report", hive.get_users())
    assert "generated_at" in json.loads(spark.read.text(f"{p}/report").first().value)


def test_ddl_and_tables(spark, tmp_path):
    sql = """-- note (with, brackets
    CREATE TABLE IF NOT EXISTS ws.o2o_shop_base (`Str_Id` varchar(20) COMMENT 'a, (b)', prc decimal(10,2), tags array<string>) PARTITIONED BY (etl_dt string) STORED AS parquet;
    /* x */ create external table ws.coupon_x (id bigint, nm string);"""
    a, b = warehouse.parse_ddl(sql)
    assert a.columns == {"str_id": "VARCHAR(20)", "prc": "DECIMAL(10,2)", "tags": "ARRAY<STRING>"} and a.partition_keys == {"etl_dt": "STRING"} and a.role == "shop" and a.db == "ws"
    assert b.columns == {"id": "BIGINT", "nm": "STRING"} and b.role == "coupon"
    assert warehouse.statements("select 1;\nselect ';' as x;\n\n") == ["select 1", "select ';' as x"] and warehouse.run_script(spark, "select 1;\nselect 2") == 2
    m = warehouse.load_tables([{"table": "Shop", "columns": [{"name": "ID", "type": "bigint"}, {"name": "phone", "sensitive": True}], "item_id": "id", "partition_keys": ["etl_dt"]}])[0]
    df = spark.createDataFrame([(1, "p", "x", d) for d in ("20250101", "20250102", "20250103")], "Id long, phone string, extra string, etl_dt string")
    assert warehouse.read_table(df, m, {"latest_n": 2}).columns == ["id", "etl_dt"] and warehouse.read_table(df, m, {"latest_n": 2}).count() == 2
    assert warehouse.read_table(df, m, {"single": "20250101"}).count() == 1 and warehouse.read_table(df, m, {"range": ["20250102", "20250109"]}).count() == 2
    for bad in ([{"columns": []}], [{"table": "a", "columns": [{"name": "x"}]}] * 2, [{"table": "a", "columns": [{"name": "x"}], "item_id": "y"}]):
        with pytest.raises(ValueError):
            warehouse.load_tables(bad)
    (tmp_path / "c.csv").write_text("ID,Phone,Nm\n1234567,1,a\r\n12,1,b\n")
    got = warehouse.read_csv(spark, str(tmp_path / "c.csv"), m, "id").collect()
    assert [r.asDict() for r in got] == [{"id": "1234567", "nm": "a", "etl_dt": "20260620"}]
    assert df.limit(1).select(warehouse.item_key(m, "mt-")).first()[0] == "mt-1"
    shops = spark.createDataFrame([("s1", "0", "0"), ("s2", "120.12345678", "30"), ("s3", "x", "30")], "shop_id string, lng string, lat string")
    links = spark.createDataFrame([("c1", "s1"), ("c1", "s2"), ("c2", "s3")], "coupon_id string, shop_id string")
    coupons = spark.createDataFrame([("c1",), ("c2",)], "coupon_id string")
    assert {r.coupon_id: r.shop_lng for r in warehouse.geo_of_coupons(coupons, links, shops).collect()} == {"c1": 120.123457, "c2": None}


def test_pipeline(spark):
    inter = spark.createDataFrame([("u1", "i1", 1, "view"), ("u1", "i2", 2, "view"), ("u2", "i1", 3, "view"), ("u2", "i2", 4, "x"), ("u3", "i9", 5, "view"), (None, "i1", 6, "view")], "user_id string, item_id string, timestamp long, action string")
    users = spark.createDataFrame([("u1",), ("u3",)], "user_id string")
    items = spark.createDataFrame([("i1", "<b>A</b>"), ("i2", "B")], "item_id string, item_title string")
    pipe = Pipeline({"filters": {"kcore": {"k": 2}, "product_exists": {}, "completeness": {}, "burst": {"enabled": False}}, "item_rules": {"rules": [{"field": "item_id", "operator": "eq", "value": "i1"}]}, "normalizers": {"items": [{"normalizer": "html_normalizer", "columns": ["item_title"]}]}})
    assert pipe.steps() == ["completeness", "product_exists", "kcore"]
    co = spark.createDataFrame([("i1", ["i2", "i1"])], "item_id string, related_items array<string>")
    out = pipe.process(users, items, inter, co)
    assert out["interactions"].count() == 4 and [r.user_id for r in out["users"].collect()] == ["u1"] and [r.item_title for r in out["items"].collect()] == ["A"]
    assert out["co_occurrence"].first().related_items == ["i1"] and out["user_interaction_seq"].count() == 2
    assert pipe.step_counts() == {"input": 6, "completeness": 5, "product_exists": 4, "kcore": 4}
    with pytest.raises(ValueError):
        Pipeline({"filter": {}})
    with pytest.raises(ValueError):
        Pipeline({}).process(None, None, inter.drop("action"))
    assert Pipeline({"preset": "legacy_review", "filters": {"spam": {}, "quality": {}, "user_product": {}, "kcore": {}}}).steps() == ["quality", "spam", "user_product", "kcore"]


def test_streaming(spark, tmp_path):
    src, out, chk = (str(tmp_path / n) for n in ("in", "out", "chk"))
    (tmp_path / "in").mkdir()

    def put(name, rows):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"event_id": e, "user_id": u, "item_id": "i", "action": "view", "timestamp": t}) for e, u, t in rows))

    def run():
        stream.start(stream.files(spark, src), out, chk, None).awaitTermination()

    put("1.json", [("e1", "u1", 1000), ("e2", "u1", 1010), ("e1", "u1", 1000)])
    run()
    put("2.json", [("e2", "u1", 1010), ("e3", "u2", 1020), ("e4", "u1", 1030)])
    run()
    run()  # nothing new
    sink = stream.FeatureSink(out)
    got = {r.user_id: (r.interaction_count, r.first_seen, r.last_seen) for r in sink.features(spark).collect()}
    assert got == {"u1": (3, 1000, 1030), "u2": (1, 1020, 1020)} and sink.history(spark).count() == 4
    again = spark.createDataFrame([("u2", 1020)], "user_id string, timestamp long")
    last = sink.versions(spark)[-1]
    sink(again.limit(0), last + 1)
    assert sink.versions(spark)[-1] == last  # an empty batch writes nothing
    with pytest.raises(ValueError):
        stream.start(stream.files(spark, src), out, chk, 30)
    messages = spark.createDataFrame([('{"event_id":"a","user_id":"u","item_id":"i","timestamp":5}',), ("bad",), ('{"user_id":"u"}',)], "value string")
    assert stream.parse(messages).count() == 1
    batch = spark.createDataFrame([("u1", "i", 0), ("u1", "i", 60), ("u2", "i", 400), ("u1", "i", 9_000)], "user_id string, item_id string, timestamp long")
    assert sorted((r.n, r.users) for r in stream.windowed_counts(batch).collect()) == [(1, 1), (1, 1), (2, 1)]
    assert sorted((r.user_id, r.n) for r in stream.stream_sessions(batch).collect()) == [("u1", 1), ("u1", 2), ("u2", 1)]


def test_answers_and_assembly(spark):
    df = spark.createDataFrame([('{"brand": ["A", "B"], "taste": "hot", "category": "null", "occasion": ["x", ""]}', "A"), ("broken", None), (None, "A")], "answer string, brnd_nm string")
    got = df.select("brnd_nm", tags.parse_answer(F.col("answer")).alias("t")).select("brnd_nm", "t.*")
    rows = got.collect()
    assert rows[0].brand == "A" and rows[0].taste == ["hot"] and rows[0].category is None and rows[0].occasion == ["x"] and rows[1].brand is None and rows[2].taste is None
    s = [r.tag_source for r in tags.assemble(got, {"brand": ["brnd_nm"]}).collect()]
    assert s[0].brand == "raw" and s[0].taste == "ai" and s[0].category == "missing" and s[1].brand == "missing"
    assert [r[0] for r in got.select(tags.is_cold_start(got)).collect()] == [False, True, True]
    seen = spark.createDataFrame([("A Co.", "s")] * 12 + [("A", "t")] + [("B", "t")], "value string, source string")
    run = tags.extract({"brand": seen, "taste": seen}, spark.createDataFrame([("brand", "Z"), ("taste", "B")], "dim string, value string"))
    assert {(r.value, r.status) for r in run["brand"]["diff"].collect()} == {("A", "added"), ("Z", "removed")}


def test_invented_dialogues(spark):
    shops = corpus.synthesize_shops(spark, 20, {"category": ["tea", "noodles"], "taste": ["hot"]})
    assert sorted(shops.collect()) == sorted(corpus.synthesize_shops(spark, 20, {"category": ["tea", "noodles"], "taste": ["hot"]}).repartition(3).collect())
    plan = corpus.plan_samples(shops, "item_id", 2, {"gift": 1, "meal": 1}, {"browse": 1}, negative=0.5).join(shops, "item_id")
    made = corpus.template_dialogues(plan, {"gift": ["a {category} gift please"], "meal": ["{taste} {category}, now", "some {category}"]}, ["category", "taste"])
    assert made.count() == 40 and made.where(F.col("messages")[0]["content"].contains("{")).count() == 0
    assert {r.op for r in made.select(F.col("params")["category"][0]["op"].alias("op"), "negative").collect() if r.negative} == {"not_in"}
    tagged = spark.createDataFrame([("shop-000001", "taste", "hot"), ("shop-000001", "brand", "x")], "item_id string, dim string, value string")
    assert [tuple(r) for r in corpus.uncovered_dims(made, tagged).collect()] == [("shop-000001", "brand")]
    assert corpus.diversity(made).first().n == 40


def test_memory_source_and_cli(spark, tmp_path, capsys):
    from tidewell import cli

    inter = spark.createDataFrame([("u", "i", 1, "view"), ("u", "j", 2, "view"), ("v", "i", 3, "click")], "user_id string, item_id string, timestamp long, action string")
    m = sources.create("memory", spark, {"interactions": inter})
    assert m.get_users().count() == 2 and m.get_items().count() == 2 and m.get_co_occurrence() is None
    with pytest.raises(ValueError):
        sources.create("memory", spark).get_interactions()
    sinks.write(inter, f"{tmp_path}/in", "interactions")
    (tmp_path / "c.json").write_text(json.dumps({"input": f"{tmp_path}/in", "output": f"{tmp_path}/out", "pipeline": {"filters": {"kcore": {"k": 9}}}, "detectors": {"item_popularity_anomaly": {"least": 2}, "user_velocity_anomaly": {}}, "audit": {"interactions": {"keys": ["user_id"]}}}))
    assert cli.main(["run", "--config", f"{tmp_path}/c.json", "--set", "pipeline.filters.kcore.k=1"], spark) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"input": 3, "kcore": 3}
    for command in ("ingest", "campaign", "check"):
        assert cli.main([command, "--config", f"{tmp_path}/c.json"], spark) == 0
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/user_flags.csv").count() == 2
    spark.createDataFrame([(5.0, "t", "x", "p", "u", 1, 0, "true")], "rating double, title string, text string, parent_asin string, user_id string, timestamp long, helpful_vote int, verified_purchase string").write.json(f"{tmp_path}/r")
    (tmp_path / "a.json").write_text(json.dumps({"input": f"{tmp_path}/r", "output": f"{tmp_path}/an"}))
    assert cli.main(["analyze", "--config", f"{tmp_path}/a.json"], spark) == 0 and json.loads(capsys.readouterr().out.splitlines()[-1])["errors"] == {}


def test_review_forms(spark):
    from tidewell.sources import files

    old = spark.createDataFrame([(4.0, "s", "t", "u", "a", 10, "True", "N", "01 1, 1970")], "overall float, summary string, reviewText string, reviewerID string, asin string, unixReviewTime int, verified string, reviewerName string, reviewTime string")
    r = files.old_as_new(old).first()
    assert r.timestamp == 10_000 and r.verified_purchase == "true" and r.parent_asin == "a" and r.helpful_vote == 0
    assert files.legacy_names(old).first().product_id == "a" and "review_text" in files.legacy_names(old).columns


def test_feature_sink_writes_touched_parts_only(spark, tmp_path):
    sink = stream.FeatureSink(f"{tmp_path}/f", keep=2, parts=8)
    rows = lambda *us: spark.createDataFrame([(u, 10) for u in us], "user_id string, timestamp long")
    users = [f"u{k}" for k in range(40)]
    sink(rows(*users), 0)
    sink(rows("u1", "u1"), 1)
    assert len(sink.contents(spark)[0]) == 8 and len(sink.contents(spark)[1]) == 1
    sink(rows("u1"), 2)
    sink(rows("u1"), 2)  # again after a failure
    got = {r.user_id: r.interaction_count for r in sink.features(spark).collect()}
    assert got == {u: 4 if u == "u1" else 1 for u in users}
    assert [len(ps) for ps in sink.contents(spark).values()] == [7, 1, 1]  # two versions of the part are left
    with pytest.raises(ValueError):
        stream.FeatureSink("x", keep=1)


def test_pairs_meet_once(spark):
    import random

    rng = random.Random(3)
    rows = [(f"u{rng.randrange(3)}", f"i{rng.randrange(4)}", rng.randrange(0, 6 * 86_400)) for _ in range(90)]
    from tidewell.operators import sequences

    got = {(r.item_id, r.related): r.n for r in sequences.pair_counts(spark.createDataFrame(rows, "user_id string, item_id string, timestamp long"), 1, dedup=False).collect()}
    want = {}
    for u, a, t in rows:
        for v, b, s in rows:
            if u == v and a != b and abs(t - s) <= 86_400:
                want[a, b] = want.get((a, b), 0) + 1
    assert got == want


def test_signs_grow_with_vectors():
    small, large = synonyms.hash_shape(0.85, 0.999, 1_000), synonyms.hash_shape(0.85, 0.999, 10**8)
    assert large[0] > small[0] and large[1] <= synonyms.TABLES and synonyms.hash_shape(0.4) == synonyms.hash_shape(0.4, 0.999, 2_000)
