"""The training-data runs end to end, with clients that need no network."""

import json

from pyspark.sql import functions as F

from tidewell import cli, models
from tidewell.operators import corpus
from tidewell.plans import corpora

DICTIONARY = [("category", "咖啡"), ("category", "火锅"), ("brand", "晨光"), ("brand", "星河"), ("taste", "甜"), ("taste", "辣")]


def _made():
    """A factory of clients that is no function of this module, which the workers can't import."""

    def client():
        def ask(prompt):
            if "坏" in prompt:
                raise OSError("down")
            return json.dumps({"category": "火锅" if "锅" in prompt.split("It may")[0] else None, "brand": "不在", "taste": ["辣", "酸"], "avg_prc": "30-50"}, ensure_ascii=False)

        return ask

    return client


def _items(spark):
    return spark.createDataFrame([("1", "晨光咖啡"), ("2", "星河火锅"), ("3", "坏"), ("4", None), (None, "x")], "item_id string, title string").withColumn("text", F.lit("clash"))


def test_enrich(spark):
    known = spark.createDataFrame(DICTIONARY, "dim string, value string")
    out = corpora.enrich(_items(spark), "item_id", "title", known, _made(), versions={"prompt": "1"}, retries=1)
    got = {r.item_id: r for r in out["tags"].collect()}
    assert set(got) == {"1", "2", "3", "4"}
    assert (got["1"].category, got["1"].brand, got["1"].taste, got["1"].avg_prc) == ("咖啡", "晨光", ["辣"], "30-50")  # hints where the answer had none or was rejected
    assert (got["2"].category, got["2"].brand) == ("火锅", "星河") and got["3"].answer_error == "down" and got["3"].taste is None
    assert got["4"].brand is None and got["1"].tag_source.taste == "ai" and got["4"].tag_source.brand == "missing"
    assert {(r.dim, r.value) for r in out["rejected"].collect()} == {("brand", "不在"), ("taste", "酸")}
    again = corpora.enrich(_items(spark).withColumn("title", F.when(F.col("item_id") == "1", "晨光").otherwise(F.col("title"))), "item_id", "title", known, _made(), out["state"], versions={"prompt": "1"}, retries=1)
    assert [r.item_id for r in again["tags"].collect()] == ["1"] and again["state"].count() == 4
    assert corpora.enrich(_items(spark).limit(0), "item_id", "title", known)["tags"].count() == 0


def test_dialogues(spark):
    items = spark.createDataFrame([(f"i{k}", f"b{k % 3}", "c" if k % 2 else None) for k in range(40)], "item_id string, brand string, category string")
    out = corpora.dialogues(items, "item_id", 6, 5)
    rows = out["corpus"].collect()
    assert len({r.seq for r in rows}) == len(rows) and out["errors"].count() == 0 and {r.item_id for r in rows} == {f"i{k}" for k in range(40)}
    said = [(r.item_id, r.messages[0].content, r.intent, r.negative) for r in rows if r.n <= 6]
    assert len(said) == len(set(said))
    assert {r["check"]: r.passed for r in corpora.verify(out["corpus"], "item_id").collect()}["no_leak"]


def test_samplers(spark):
    items = spark.range(2_000).select(F.col("id").cast("string").alias("item_id"))
    plan = corpus.plan_details(corpus.plan_samples(items, "item_id", 2, {"a": 1.0}, {"browse": 1.0}, 0.25), "item_id", 5)
    got = plan.agg(F.max("n_turns"), F.avg((F.col("distance_band") == "near").cast("int")), F.count_if(F.col("negative") != F.col("negative_type").isNotNull()), F.count_if((F.col("distance_band") == "far") != (F.col("distance_m") >= 5_000)), F.max("distance_m")).first()
    assert got[0] == 5 and abs(got[1] - 0.5) < 0.05 and got[2] == 0 and got[3] == 0 and got[4] < 20_000
    df = spark.createDataFrame([("a", 1, {"x": [1]}), ("a", 2, {"x": [1]}), ("b", 3, {"y": [1]})], "item_id string, n int, params map<string,array<int>>")
    tags = spark.createDataFrame([("a", "x", "v"), ("a", "y", "v"), ("b", "y", "v"), ("c", "x", "v")], "item_id string, dim string, value string")
    assert {tuple(r) for r in corpus.cover(df, tags).collect()} == {("a", 3), ("c", 1)}
    stats = spark.createDataFrame([("intent", "a", 0.9), ("intent", "b", 0.1)], "metric string, key string, value double")
    assert [r[0] for r in corpus.distribution_warnings(stats).collect()] == ["intent_imbalance"]


def test_commands(spark, tmp_path):
    models.register_client("test")(_made())
    known = spark.createDataFrame(DICTIONARY, "dim string, value string")
    known.write.json(f"{tmp_path}/dict")
    _items(spark).write.parquet(f"{tmp_path}/items")
    spark.createDataFrame([("晨光", "Morning"), ("热", "冷")], "a string, b string").write.parquet(f"{tmp_path}/pairs")
    (tmp_path / "ddl.sql").write_text("CREATE TABLE m.shop_x (id BIGINT) PARTITIONED BY (etl_dt STRING);")
    config = {
        "tables_meta": {"script": f"{tmp_path}/ddl.sql", "output": f"{tmp_path}/o"},
        "extract_tags": {"observed": {"brand": {"path": f"{tmp_path}/items", "column": "title"}}, "dictionary": f"{tmp_path}/dict", "output": f"{tmp_path}/o", "frequency_min": 1},
        "enrich": {"items": {"path": f"{tmp_path}/items", "key": "item_id", "name": "title"}, "dictionary": f"{tmp_path}/dict", "client": "test", "output": f"{tmp_path}/o"},
        "sft": {"input": f"{tmp_path}/o/item_tags.jsonl", "output": f"{tmp_path}/o", "count_per_item": 3},
        "split": {"input": f"{tmp_path}/o/sft_corpus.jsonl", "output": f"{tmp_path}/o"},
        "generate_synonyms": {"pairs": {"path": f"{tmp_path}/pairs", "canonical": "a", "variant": "b"}, "output": f"{tmp_path}/o"},
        "verify": {"input": f"{tmp_path}/o/sft_corpus.jsonl", "tags": f"{tmp_path}/o/item_tags.jsonl"},
    }
    (tmp_path / "c.json").write_text(json.dumps(config))
    assert cli.main(["everything", "--config", f"{tmp_path}/c.json"], spark) == 0
    parts = {p: spark.read.json(f"{tmp_path}/o/{p}.jsonl") for p in ("sft_corpus", "item_tags", "item_rejected")}
    assert parts["item_tags"].count() == 4 and parts["item_rejected"].count() > 0 and parts["sft_corpus"].count() > 4
    assert spark.read.text(f"{tmp_path}/o/ext_synonyms.txt").count() == 2 and spark.read.json(f"{tmp_path}/o/brand_snapshot.jsonl").count() >= 5
