"""Queries of sources, sinks, pipeline orders and streams: the driver's tables are written in a source's form and read back by it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import sinks, sources
from tidewell.operators import features, sequences
from tidewell.plans.pipeline import Pipeline
from tidewell.plans.reference_queries import E_SQL, O_SQL, events, orders
from tidewell.session import scratch, table
from tidewell.sources import files, warehouse
from tidewell.streaming import events as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return put


def _as(df: DataFrame, form: str, label: str, **options) -> str:
    """The path of df written in that form."""
    path = scratch(df.sparkSession, label)
    df.write.options(**options).format(form).save(path)
    return path


def _csv(df: DataFrame, label: str) -> str:
    return _as(df, "csv", label, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


# ---- reviews

_OLD_ACTION = "CASE WHEN overall >= 4 THEN 'like' WHEN overall <= 3 THEN 'dislike' ELSE 'neutral' END"


def _old(spark: SparkSession, d: str) -> sources.base.Source:
    parts = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("asin"), F.col("p_name").alias("title"), F.array("p_type").alias("description"), F.array("p_brand", "p_type").alias("also_buy"), F.array("p_brand").alias("also_view"))
    return sources.create("reviews_old", spark, {"reviews_path": _as(table(spark, d, "amazon_old_review").drop("review_id"), "json", "old"), "meta_path": _as(parts.unionByName(parts), "json", "meta")})


@query(f'SELECT reviewerID AS user_id, asin AS item_id, overall AS rating, summary AS review_title, reviewText AS review_text, CAST(unixReviewTime AS BIGINT) AS "timestamp", {_OLD_ACTION} AS action FROM amazon_old_review')
def source_old_interactions(spark, d):
    return _old(spark, d).get_interactions().select("user_id", "item_id", "rating", "review_title", "review_text", "timestamp", "action")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY reviewerID ORDER BY unixReviewTime DESC NULLS LAST, reviewerName DESC NULLS LAST) AS n FROM amazon_old_review WHERE reviewerID IS NOT NULL),
t AS (SELECT reviewerID AS user_id, count(*) AS interaction_count, CAST(min(unixReviewTime) AS BIGINT) AS first_timestamp, CAST(max(unixReviewTime) AS BIGINT) AS last_timestamp FROM r GROUP BY 1)
SELECT t.*, r.reviewerName AS user_name FROM t JOIN r ON user_id = reviewerID AND n = 1""")
def source_old_users(spark, d):
    return _old(spark, d).get_users()


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS item_title, [p_type] AS item_description FROM part")
def source_old_items(spark, d):
    return _old(spark, d).get_items()


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_id, [p_brand, p_type] AS related_items FROM part")
def source_old_related(spark, d):
    return _old(spark, d).get_co_occurrence()


def _new(spark: SparkSession, d: str) -> sources.base.Source:
    parts = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("parent_asin"), F.col("p_name").alias("title"), F.array("p_type").alias("description"), F.col("p_retailprice").cast("float").alias("price"), F.when(F.col("p_partkey") % 3 > 0, F.to_json(F.array("p_brand", "p_type"))).alias("bought_together"))
    return sources.create("Reviews_New", spark, {"reviews_path": _as(table(spark, d, "amazon_new_review").drop("review_id"), "json", "new"), "meta_path": _as(parts, "json", "meta")})


@query("""SELECT user_id, parent_asin AS item_id, rating, title AS review_title, text AS review_text, CASE WHEN "timestamp" > 1000000000000 THEN "timestamp" // 1000 ELSE "timestamp" END AS "timestamp", coalesce(lower(verified_purchase) = 'true', false) AS verified,
CASE WHEN rating >= 4 THEN 'like' WHEN rating <= 2 THEN 'dislike' ELSE 'neutral' END AS action, helpful_vote FROM amazon_new_review""")
def source_new_interactions(spark, d):
    return _new(spark, d).get_interactions().select("user_id", "item_id", "rating", "review_title", "review_text", "timestamp", "verified", "action", "helpful_vote")


@query("SELECT DISTINCT user_id FROM amazon_new_review WHERE user_id IS NOT NULL")
def source_new_users(spark, d):
    return _new(spark, d).get_users()


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS item_title, [p_type] AS item_description, CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS price FROM part")
def source_new_items(spark, d):
    return _new(spark, d).get_items().select("item_id", "item_title", "item_description", F.col("price").cast("double").alias("price"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_id, CASE WHEN p_partkey % 3 > 0 THEN [p_brand, p_type] ELSE [] END AS related_items FROM part")
def source_new_related(spark, d):
    return _new(spark, d).get_co_occurrence()


@query("""SELECT user_id, coalesce(parent_asin, asin) AS product_id, rating, text AS review_text, title AS review_title, CASE WHEN "timestamp" > 1000000000000 THEN "timestamp" // 1000 ELSE "timestamp" END AS "timestamp" FROM amazon_new_review
UNION ALL SELECT reviewerID, asin, overall, reviewText, summary, CASE WHEN CAST(unixReviewTime AS BIGINT) * 1000 > 1000000000000 THEN CAST(unixReviewTime AS BIGINT) ELSE CAST(unixReviewTime AS BIGINT) * 1000 END FROM amazon_old_review""")
def source_legacy_names(spark, d):
    columns = ["user_id", "product_id", "rating", "review_text", "review_title", "timestamp"]
    return files.legacy_names(table(spark, d, "amazon_new_review")).select(columns).unionByName(files.legacy_names(table(spark, d, "amazon_old_review")).select(columns))


# ---- other files


@query("""SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey % 40 AS VARCHAR) AS item_id, CAST(1 + o_orderkey % 5 AS DOUBLE) AS rating, epoch_us(date_trunc('day', o_orderdate)) // 1000000 AS "timestamp", CASE WHEN 1 + o_orderkey % 5 >= 4 THEN 'like' WHEN 1 + o_orderkey % 5 <= 2 THEN 'dislike' ELSE 'neutral' END AS action FROM orders""")
def source_movie_ratings(spark, d):
    """Lines of a movie's ratings after its own line; unreadable ones are skipped."""
    rows = table(spark, d, "orders").select((F.col("o_orderkey") % 40).alias("m"), F.concat_ws(",", F.col("o_custkey"), 1 + F.col("o_orderkey") % 5, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("value"), F.lit(1).alias("k"))
    heads = rows.select("m").distinct().select("m", F.concat(F.col("m").cast("string"), F.lit(":")).alias("value"), F.lit(0).alias("k"))
    bad = heads.select("m", F.lit("no rating").alias("value"), F.lit(2).alias("k"))
    lines = rows.unionByName(heads).unionByName(bad).repartitionByRange(3, "m").sortWithinPartitions("m", "k", "value").select("value")
    return sources.create("movie_ratings", spark, {"ratings_paths": _as(lines, "text", "ratings")}).get_interactions()


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS item_title, '' AS item_description, CAST(1950 + p_size AS INT) AS year FROM part")
def source_movie_titles(spark, d):
    path = _as(table(spark, d, "part").select("p_partkey", (1950 + F.col("p_size")).alias("y"), "p_name"), "csv", "titles")
    return sources.create("movie_ratings", spark, {"titles_path": path}).get_items()


def _video(spark: SparkSession, d: str) -> sources.base.Source:
    part, cust = table(spark, d, "part"), table(spark, d, "customer")
    of = part.select(F.col("p_partkey").alias("video_id"), "p_name", "p_size", "p_brand", "p_type", "p_retailprice")
    log = table(spark, d, "events").select("user_id", F.get_json_object("props", "$.k").alias("video_id"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long").alias("time_ms"), F.when(F.col("event_type") == "click", "1.0").otherwise("0.0").alias("is_like"), F.when(F.col("value") > 50, "1").alias("long_view"))
    return sources.create("video_logs", spark, {
        "users_path": _csv(cust.select(F.col("c_custkey").alias("user_id"), F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias("follow_user_num"), F.col("c_mktsegment").alias("fans_range"), F.col("c_name").alias("user_active_degree")), "users"),
        "basic_path": _csv(of.select("video_id", F.lit("2020-01-02").alias("upload_dt"), F.col("p_name").alias("caption")), "basic"), "statistic_path": _csv(of.where("video_id % 2 = 0").select("video_id", "p_size"), "statistic"),
        "categories_path": _csv(of.select("video_id", F.col("p_type").alias("category")), "categories"), "captions_path": _csv(of.where("video_id % 3 = 0").select("video_id", "p_brand", F.lit("x").alias("caption")), "captions"), "log_path": _csv(log, "log"), "seconds": True,
    })


@query("SELECT CAST(c_custkey AS VARCHAR) AS user_id, CAST(c_nationkey AS INT) AS follow_user_num, c_mktsegment AS fans_range, c_name AS user_active_degree FROM customer")
def source_video_users(spark, d):
    return _video(spark, d).get_users()


@query("""SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS caption, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS p_size, p_type AS category, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS p_brand, CAST(1577923200 AS BIGINT) AS upload_timestamp FROM part""")
def source_video_items(spark, d):
    return _video(spark, d).get_items().select("item_id", "caption", "p_size", "category", "p_brand", "upload_timestamp")


@query("""SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id, epoch_us(ts) // 1000000 AS "timestamp", CASE WHEN event_type = 'click' OR value > 50 THEN 'like' ELSE 'dislike' END AS action FROM events""")
def source_video_log(spark, d):
    return _video(spark, d).get_interactions().select("user_id", "item_id", "timestamp", "action")


def _campaign(spark: SparkSession, d: str) -> sources.base.Source:
    third = table(spark, d, "o2o_new_gut_shop_base_third").select(F.col("Id").cast("string").alias("item_id"), F.col("Str_Type").alias("item_nm"), F.lit("112.5").alias("lon"), F.when(F.col("Id") % 2 == 0, "30.25").otherwise("-").alias("lat"), F.col("Cat_Id").alias("cat"))
    seq = table(spark, d, "user_seq").where("event_time is not null").select("custref_no", F.when(F.col("event_id").like("%1"), "showPage").when(F.col("event_id").like("%2"), "Other").otherwise("Click").alias("event"), "event_time", F.col("shopid").alias("item_id"), F.when(F.col("event_id").like("%3"), "立即领取").otherwise("x").alias("btn_nm"))
    return sources.create("coupon_csv", spark, {"items_path": _csv(third, "items"), "interactions_path": _csv(seq, "events"), "time_format": "ms", "btn_action_mapping": {"立即领取": "receive"}})


@query("""SELECT CAST("Id" AS VARCHAR) AS item_id, Str_Type AS item_title, 112.5::DOUBLE AS item_lon, CASE WHEN "Id" % 2 = 0 THEN 30.25::DOUBLE END AS item_lat, Cat_Id AS cat FROM o2o_new_gut_shop_base_third""")
def source_campaign_items(spark, d):
    return _campaign(spark, d).get_items()


@query("""SELECT trim(custref_no, ' ') AS user_id, trim(shopid, ' ') AS item_id, CASE WHEN event_time > 1000000000000 THEN event_time // 1000 ELSE event_time END AS "timestamp",
CASE WHEN event_id LIKE '%1' THEN 'impression' WHEN event_id LIKE '%2' THEN 'other' WHEN event_id LIKE '%3' THEN 'receive' ELSE 'click' END AS action FROM user_seq WHERE event_time IS NOT NULL AND trim(custref_no, ' ') <> '' AND trim(shopid, ' ') <> ''""")
def source_campaign_events(spark, d):
    s = _campaign(spark, d)
    return s.get_interactions().select("user_id", "item_id", "timestamp", "action")


def _trades(spark: SparkSession, d: str) -> str:
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("user_id"), F.col("l_partkey").alias("coupon_id"), (F.col("l_partkey") % 7).alias("template_id"), (F.col("l_suppkey") % 5).alias("merchant_id"), F.when(F.col("l_linenumber") < 4, F.col("l_suppkey")).alias("store_id"), F.when(F.col("l_returnflag") == "R", "buy").when(F.col("l_returnflag") == "A", "use").otherwise("view").alias("action"), F.col("l_linenumber").alias("n"))
    return _as(li, "parquet", "trades")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id, CASE WHEN l_returnflag = 'R' THEN 'buy' ELSE 'use' END AS action, l_linenumber AS n FROM lineitem WHERE l_returnflag IN ('R', 'A')")
def source_trade_interactions(spark, d):
    return sources.create("trade_coupons", spark, {"trades_path": _trades(spark, d)}).get_interactions().select("user_id", "item_id", "action", "n")


@query("SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS item_id, l_partkey % 7 AS template_id, CASE WHEN l_partkey % 7 < 5 THEN 't' || (l_partkey % 7) END AS template_name FROM lineitem")
def source_trade_items(spark, d):
    names = _as(spark.range(5).select(F.col("id").alias("template_id"), F.concat(F.lit("t"), "id").alias("template_name")), "parquet", "templates")
    return sources.create("trade_coupons", spark, {"trades_path": _trades(spark, d), "template_path": names}).get_items()


@query("SELECT CAST(l_orderkey AS VARCHAR) AS user_id, 'store-' || l_suppkey AS item_id, 'pay' AS action FROM lineitem WHERE l_linenumber < 4")
def source_payments(spark, d):
    return sources.create("local_payments", spark, {"trades_path": _trades(spark, d)}).get_interactions().select("user_id", "item_id", "action")


@query("SELECT DISTINCT 'store-' || l_suppkey AS item_id, l_suppkey AS store_id FROM lineitem WHERE l_linenumber < 4")
def source_payment_items(spark, d):
    return sources.create("local_payments", spark, {"trades_path": _trades(spark, d)}).get_items()


@query("SELECT 'interactions' AS t, 'user_id,item_id,timestamp,action' AS names, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'items', 'item_id,item_title', 0")
def source_external(spark, d):
    s = sources.create("external_coupons", spark, {})
    one = lambda t: s.get(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("t"), F.lit(",".join(s.get(t).columns)).alias("names"), "n")
    return one("interactions").unionByName(one("items"))


# ---- catalogue tables


def _views(spark: SparkSession, d: str) -> sources.base.Source:
    table(spark, d, "user_profile").createOrReplaceTempView("tw_profile")
    table(spark, d, "o2o_new_gut_shop_base_third").selectExpr("Str_Id as str_id", "Str_Nm as str_nm", "City_Nm as city_nm", "Cat_Nm as cat_nm1").where("str_id is not null").groupBy("str_id").agg(*(F.min(c).alias(c) for c in ("str_nm", "city_nm", "cat_nm1"))).createOrReplaceTempView("tw_shops")
    table(spark, d, "user_seq").createOrReplaceTempView("tw_seq")
    return sources.create("coupon_warehouse", spark, {"users_table": "tw_profile", "items_table": "tw_shops", "interactions_table": "tw_seq", "time_format": "ms", "action_mapping": {"pageview": "view"}})


@query("SELECT DISTINCT custref_no AS user_id FROM user_profile")
def source_warehouse_users(spark, d):
    return _views(spark, d).get_users().select("user_id")


@query("""SELECT Str_Id AS item_id, min(Str_Nm) AS item_title, coalesce(min(City_Nm), '') AS city_nm, '' AS cnty_nm, coalesce(min(Cat_Nm), '') AS cat_nm1 FROM o2o_new_gut_shop_base_third WHERE Str_Id IS NOT NULL GROUP BY 1""")
def source_warehouse_items(spark, d):
    return _views(spark, d).get_items().select("item_id", "item_title", "city_nm", "cnty_nm", "cat_nm1")


@query("""SELECT custref_no AS user_id, shopid AS item_id, CASE WHEN event_time > 1000000000000 THEN event_time // 1000 ELSE event_time END AS "timestamp", coalesce(CASE event WHEN '$pageview' THEN 'view' WHEN 'page_view' THEN 'view' WHEN 'view' THEN 'view' WHEN '$element_click' THEN 'click' WHEN 'click' THEN 'click' WHEN 'btn_click' THEN 'click'
 WHEN '$exposure' THEN 'impression' WHEN 'exposure' THEN 'impression' WHEN 'coupon_receive' THEN 'receive' WHEN 'receive' THEN 'receive' WHEN 'coupon_use' THEN 'use' WHEN 'use' THEN 'use' WHEN 'pay' THEN 'use' WHEN 'pageview' THEN 'view' END, lower(event)) AS action
 FROM user_seq WHERE custref_no <> '' AND shopid <> ''""")
def source_warehouse_interactions(spark, d):
    return _views(spark, d).get_interactions()


_SCRIPT = """CREATE EXTERNAL TABLE IF NOT EXISTS `mart`.`o2o_Shop_base` (Id BIGINT COMMENT 'the (key)', `Str_Nm` STRING, avg_prc DECIMAL(18, 2)) -- shops
PARTITIONED BY (etl_dt STRING) STORED AS PARQUET;
/* none; */ create table cust_info (custref_no string, tags ARRAY<STRING>);
"""


@query("""SELECT * FROM (VALUES ('mart', 'o2o_shop_base', 'shop', 'id', 'BIGINT', false), ('mart', 'o2o_shop_base', 'shop', 'str_nm', 'STRING', false), ('mart', 'o2o_shop_base', 'shop', 'avg_prc', 'DECIMAL(18,2)', false), ('mart', 'o2o_shop_base', 'shop', 'etl_dt', 'STRING', true),
('', 'cust_info', 'customer', 'custref_no', 'STRING', false), ('', 'cust_info', 'customer', 'tags', 'ARRAY<STRING>', false)) t(db, name, role, col, kind, is_key)""")
def source_ddl(spark, d):
    rows = [(m.db, m.name, m.role, c, t, k) for m in warehouse.parse_ddl(_SCRIPT) for part, k in ((m.columns, False), (m.partition_keys, True)) for c, t in part.items()]
    return spark.createDataFrame(rows, "db string, name string, role string, col string, kind string, is_key boolean")


@query("SELECT * FROM (VALUES ('shops', 'shop', 'id', true), ('coupon_shop_x', 'coupon_shop', NULL, false)) t(name, role, item_id, hides)")
def source_table_config(spark, d):
    metas = warehouse.load_tables([{"table": "Shops", "columns": [{"name": "ID"}, {"name": "phone", "sensitive": True}], "item_id": "id"}, {"table": "coupon_shop_x", "columns": [{"name": "a", "type": "int"}]}])
    return spark.createDataFrame([(m.name, m.role, m.item_id, bool(m.sensitive)) for m in metas], "name string, role string, item_id string, hides boolean")


@query("SELECT CAST(\"Id\" AS VARCHAR) AS id, Str_Type AS str_type, coalesce(etl_dt, '20260620') AS etl_dt FROM o2o_new_gut_shop_base_third WHERE length(CAST(\"Id\" AS VARCHAR)) >= 3")
def source_csv(spark, d):
    raw = table(spark, d, "o2o_new_gut_shop_base_third").select("Id", "Str_Type", F.col("Addr").alias("PHONE"), "etl_dt")
    meta = warehouse.TableMeta("", "shops", {"id": "BIGINT"}, sensitive={"phone"})
    return warehouse.read_csv(spark, _csv(raw.withColumn("PHONE", F.lit("1")), "shops"), meta, "id", least=3)


@query("SELECT role, count(*) AS n FROM (SELECT 'shop' AS role FROM o2o_new_gut_shop_base_third UNION ALL SELECT 'customer' FROM user_profile) GROUP BY 1")
def source_roles(spark, d):
    table(spark, d, "o2o_new_gut_shop_base_third").createOrReplaceTempView("tw_shop_all")
    table(spark, d, "user_profile").createOrReplaceTempView("tw_cust_all")
    metas = [warehouse.TableMeta("", n, {c: "STRING"}, role=warehouse.role_of(n)) for n, c in (("tw_shop_all", "id"), ("tw_cust_all", "age"))]
    found = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(r).alias("role"), "n") for r, df in warehouse.read_roles(spark, metas).items()]
    return found[0].unionByName(found[1])


@query("SELECT 'mt-' || \"Id\" AS item_key, count(*) OVER () AS n FROM o2o_new_gut_shop_base_third")
def source_item_keys(spark, d):
    rows = table(spark, d, "o2o_new_gut_shop_base_third")
    return rows.select(warehouse.item_key(warehouse.TableMeta("", "s", {}, item_id="Id"), warehouse.PREFIX["shop_third"]).alias("item_key")).withColumn("n", F.lit(rows.count()))


@query("SELECT Str_Id, \"Id\" FROM (SELECT *, row_number() OVER (PARTITION BY Str_Id ORDER BY etl_dt, \"Id\") AS n FROM o2o_new_gut_shop_base_third) WHERE n = 1")
def source_first_rows(spark, d):
    return warehouse.first_rows(table(spark, d, "o2o_new_gut_shop_base_third"), "Str_Id", "etl_dt", "Id").select("Str_Id", "Id")


@query("""WITH g AS (SELECT "Id" AS shop_id, "Id" % 50 AS coupon_id, TRY_CAST(trim(Lng) AS DOUBLE) AS x, TRY_CAST(trim(Lat) AS DOUBLE) AS y FROM o2o_new_gut_shop_base_third), p AS (SELECT *, row_number() OVER (PARTITION BY coupon_id ORDER BY shop_id) AS n FROM g WHERE abs(x) <= 180 AND abs(y) <= 90 AND NOT (x = 0 AND y = 0))
SELECT c.id AS coupon_id, round(x, 6) AS shop_lng, round(y, 6) AS shop_lat FROM range(60) c(id) LEFT JOIN p ON c.id = coupon_id AND n = 1""")
def source_coupon_geo(spark, d):
    shops = table(spark, d, "o2o_new_gut_shop_base_third").select(F.col("Id").alias("shop_id"), F.col("Lng").alias("lng"), F.col("Lat").alias("lat"))
    links = shops.select((F.col("shop_id") % 50).alias("coupon_id"), "shop_id")
    return warehouse.geo_of_coupons(spark.range(60).select(F.col("id").alias("coupon_id")), links, shops)


@query("SELECT name, list_contains(['coupon_csv', 'coupon_warehouse', 'external_coupons', 'local_payments', 'memory', 'movie_ratings', 'own_coupons', 'reviews_new', 'reviews_old', 'trade_coupons', 'video_logs'], name) AS known FROM (VALUES ('reviews_old'), ('none'), ('memory')) t(name)")
def source_registry(spark, d):
    return spark.createDataFrame([(n, n in sources.names()) for n in ("reviews_old", "none", "memory")], "name string, known boolean")


@query("""SELECT * FROM (VALUES ('users', 'user_id'), ('items', 'item_id'), ('interactions', 'user_id,item_id,timestamp,action,event_id,value'), ('co_occurrence', NULL)) x(t, names)""")
def source_schema(spark, d):
    info = sources.create("memory", spark, {"interactions": events(spark, d)}).schema_info()
    return spark.createDataFrame([(t, ",".join(c) if c else None) for t, c in info.items()], "t string, names string")


# ---- sinks, read back


@query(f"WITH {E_SQL} SELECT DISTINCT user_id, CAST(0 AS INT) AS interaction_count FROM ev")
def sink_tables_users(spark, d):
    folder = scratch(spark, "tables")
    sinks.write_all({"interactions": events(spark, d), "users": None}, folder)
    return warehouse.intermediate(spark, folder)["users"]


@query("SELECT user_id, CAST(n AS VARCHAR) AS n, l AS items FROM (SELECT CAST(user_id AS VARCHAR) AS user_id, count(*) AS n, CAST(to_json(list_sort(list(DISTINCT event_type))) AS VARCHAR) AS l FROM events GROUP BY 1)")
def sink_csv(spark, d):
    rows = table(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("user_id")).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("event_type")).alias("items"))
    path = sinks.write_all({"t": rows}, scratch(spark, "csv"), "csv")["t"]
    return spark.read.option("header", True).option("escape", "\\").csv(path)


@query("SELECT CAST(to_json({'doc_id': doc_id, 'item_id': item_id, 'lang': lang}) AS VARCHAR) AS value FROM documents")
def sink_lines(spark, d):
    path = scratch(spark, "lines")
    sinks.write_lines(table(spark, d, "documents").select("lang", "doc_id", "item_id"), path, ["doc_id", "item_id", "lang"])
    return spark.read.text(path)


@query("SELECT 'syn' AS f, least(brand_nm, alias_nm) || ', ' || greatest(brand_nm, alias_nm) AS value FROM brand_list WHERE alias_nm IS NOT NULL UNION ALL SELECT 'syn', '# made here' UNION ALL SELECT DISTINCT 'dict', unnest([brand_nm, alias_nm]) FROM brand_list WHERE alias_nm IS NOT NULL")
def sink_solr(spark, d):
    from tidewell.operators import synonyms

    path = scratch(spark, "solr")
    sinks.write_solr(synonyms.groups_from_pairs(table(spark, d, "brand_list"), "brand_nm", "alias_nm", "rule"), path, "made here")
    read = lambda n, f: spark.read.text(f"{path}/{n}.txt").select(F.lit(f).alias("f"), "value")
    return read("ext_synonyms", "syn").unionByName(read("ext_dict", "dict"))


@query("SELECT count(*) AS rows, true AS dated FROM events")
def sink_report(spark, d):
    path = scratch(spark, "report")
    rows = table(spark, d, "events")
    sinks.report({"rows": rows.count()}, path, rows)
    return spark.read.json(path).select("rows", F.col("generated_at").isNotNull().alias("dated"))


@query("SELECT custref_no, CASE WHEN age = 'A' THEN 'young' END AS age FROM user_profile")
def sink_profile_rows(spark, d):
    rows = table(spark, d, "user_profile").withColumn("age", F.when(F.col("age") == "A", "young"))
    return sinks.profile_rows(rows, ["custref_no", "age"], ["age"])


# ---- pipeline, features, related items


@query(f"""WITH {O_SQL}, a AS (SELECT * FROM od WHERE rating BETWEEN 2 AND 5 AND "timestamp" >= 631152000), w AS (SELECT *, lag(item_id) OVER u AS b, row_number() OVER u AS n FROM a WINDOW u AS (PARTITION BY user_id ORDER BY "timestamp", item_id))
SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(item_id AS BIGINT)) AS BIGINT) AS s FROM w WHERE n = 1 OR b <> item_id""")
def pipeline_four_step(spark, d):
    config = {"preset": "four_step", "as_of": 4_000_000_000, "filters": {"outlier": {"min_rating": 2}, "user_item": {}, "kcore": {"k": 1}}, "sequences": {"enabled": False}}
    return Pipeline(config).process(None, None, orders(spark, d))["interactions"].agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("item_id").cast("long")).alias("s"))


@query("""SELECT review_id FROM amazon_new_review WHERE user_id <> '' AND parent_asin <> '' AND rating BETWEEN 1 AND 5 AND "timestamp" >= 631152000 AND "timestamp" <= 9000000000000 AND length(trim(text, ' ')) >= 10 AND length(text) <= 700""")
def pipeline_legacy_review(spark, d):
    rows = table(spark, d, "amazon_new_review").select("user_id", F.col("parent_asin").alias("item_id"), "rating", "timestamp", F.col("text").alias("review_text"), "review_id", F.lit("review").alias("action"))
    config = {"preset": "legacy_review", "as_of": 9_000_000_000_000, "filters": {"completeness": {}, "outlier": {}, "quality": {}, "length": {}, "burst": {"enabled": False}}, "sequences": {"enabled": False}}
    return Pipeline(config).process(None, None, rows)["interactions"].select("review_id")


@query(f"WITH {E_SQL} SELECT 'input' AS step, count(*) AS rows FROM ev UNION ALL SELECT 'completeness', count(*) FROM ev WHERE user_id <> '' AND item_id <> '' AND \"timestamp\" IS NOT NULL UNION ALL SELECT 'rules', count(*) FROM ev WHERE user_id <> '' AND item_id <> '' AND value > 20")
def pipeline_steps(spark, d):
    pipe = Pipeline({"filters": {"completeness": {}, "rules": {"rules": [{"field": "value", "operator": "gt", "value": 20}]}}, "sequences": {"enabled": False}})
    pipe.process(None, None, events(spark, d))["interactions"].write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(pipe.step_counts().items()), "step string, rows long")


@query("""WITH u AS (SELECT * FROM customer WHERE c_acctbal > 0), i AS (SELECT * FROM part WHERE p_size >= 10) SELECT 'users' AS t, CAST(c_custkey AS VARCHAR) AS k FROM u WHERE c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
UNION ALL SELECT 'items', CAST(p_partkey AS VARCHAR) FROM i WHERE p_partkey IN (SELECT l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)""")
def pipeline_table_rules(spark, d):
    users = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("user_id"), "c_acctbal")
    items = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"), "p_size")
    rule = lambda f, o, v: {"rules": [{"field": f, "operator": o, "value": v}]}
    out = Pipeline({"user_rules": rule("c_acctbal", "gt", 0), "item_rules": rule("p_size", "gte", 10), "sequences": {"enabled": False}}).process(users, items, orders(spark, d))
    return out["users"].select(F.lit("users").alias("t"), F.col("user_id").alias("k")).unionByName(out["items"].select(F.lit("items").alias("t"), F.col("item_id").alias("k")))


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_id, CASE WHEN p_partkey % 2 = 0 THEN [CAST(p_partkey + 1 AS VARCHAR)] END AS also_buy FROM part WHERE p_partkey <= 100")
def related_meta(spark, d):
    items = table(spark, d, "part").where("p_partkey <= 100").select(F.col("p_partkey").cast("string").alias("item_id"))
    more = items.unionByName(spark.createDataFrame([("101",)], "item_id string"))
    meta = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"), F.when(F.col("p_partkey") % 2 == 0, F.array((F.col("p_partkey") + 1).cast("string"), F.lit("none"))).otherwise(F.array(F.lit("gone"))).alias("also_buy"))
    return sequences.clean_meta(meta, more, ("also_buy",)).where("item_id <> '101'")


@query("SELECT * FROM (VALUES ('impression_log'), ('user_interaction_history')) v(t)")
def feature_switches(spark, d):
    e = events(spark, d)
    out = features.extract(e.select("user_id").distinct(), e.select("item_id").distinct(), e, {"item_features": False, "user_features": False, "co_purchase": False})
    return spark.createDataFrame([(k,) for k in out], "t string")


# ---- streams over what is there


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """Every event twice, as JSON files, read as a stream."""
    e = events(spark, d).select(F.col("event_id").cast("string").alias("event_id"), "user_id", "item_id", "action", "timestamp")
    return streams.files(spark, _as(e.unionByName(e).repartition(4), "json", "stream"))


def _taken(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """What a stream gives for all that is there."""
    spark = stream.sparkSession
    out = scratch(spark, label)
    schema = stream.schema
    each = lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}")
    q = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", scratch(spark, f"{label}-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(schema).parquet(out).select(schema.names)


@query(f"WITH {E_SQL} SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, item_id, \"timestamp\" FROM ev")
def stream_dedup(spark, d):
    return _taken(streams.dedup(_stream(spark, d), late="3650 days"), "dedup").select("event_id", "user_id", "item_id", "timestamp")


@query(f"WITH {E_SQL} SELECT \"timestamp\" // 300 * 300 AS start_s, item_id, 2 * count(*) AS n FROM ev GROUP BY 1, 2")
def stream_windows(spark, d):
    """Counts of event-time windows; in complete mode the last batch holds them all."""
    rows = streams.windowed_counts(_stream(spark, d), late="3650 days")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    q = rows.writeStream.outputMode("complete").format("memory").queryName("tw_windows").option("checkpointLocation", scratch(spark, "windows-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table("tw_windows").select(F.unix_timestamp("window_start").alias("start_s"), "item_id", "n")


@query(f"""WITH {E_SQL}, g AS (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp") < 86400 THEN 0 ELSE 1 END AS f FROM ev), s AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min("timestamp") AS start_s, max("timestamp") + 86400 AS end_s, 2 * count(*) AS n FROM s GROUP BY user_id, k""")
def stream_session_windows(spark, d):
    rows = streams.stream_sessions(_stream(spark, d), gap="86400 seconds", late="3650 days")
    q = rows.writeStream.outputMode("complete").format("memory").queryName("tw_sessions").option("checkpointLocation", scratch(spark, "sessions-state")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table("tw_sessions").select("user_id", F.unix_timestamp("session_start").alias("start_s"), F.unix_timestamp("session_end").alias("end_s"), "n")


@query(f"WITH {E_SQL} SELECT user_id, CAST(count(*) AS BIGINT) AS interaction_count, min(\"timestamp\") AS first_seen, max(\"timestamp\") AS last_seen FROM ev GROUP BY 1")
def stream_features(spark, d):
    folder = scratch(spark, "features")
    streams.start(_stream(spark, d), folder, scratch(spark, "features-state"), None, late="3650 days").awaitTermination()
    return streams.FeatureSink(folder).features(spark).select("user_id", "interaction_count", "first_seen", "last_seen")


@query(f"WITH {E_SQL} SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, action FROM ev WHERE event_id % 2 = 0")
def stream_messages(spark, d):
    """Messages as a topic gives them; those that can't be read or lack a user are dropped."""
    e = events(spark, d).select(F.col("event_id").cast("string").alias("event_id"), F.when(F.col("event_id") % 2 == 0, F.col("user_id")).alias("user_id"), "item_id", "action", "timestamp")
    broken = spark.createDataFrame([("{",), ("",), (None,)], "value string")
    return streams.parse(e.select(F.to_json(F.struct("*")).alias("value")).unionByName(broken)).select("event_id", "user_id", "action")
