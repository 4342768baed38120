"""Sources that read catalogue tables: coupon warehouse, partition scans, DDL and table configurations."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.contracts import log
from tidewell.functions.events import strip
from tidewell.operators import sequences
from tidewell.sources.base import Source, mapped, register, to_seconds

# Event names and their actions.
ACTIONS = {"$pageview": "view", "page_view": "view", "view": "view", "$element_click": "click", "click": "click", "btn_click": "click", "$exposure": "impression", "exposure": "impression", "coupon_receive": "receive", "receive": "receive", "coupon_use": "use", "use": "use", "pay": "use"}
TYPES = {"TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "DECIMAL", "STRING", "VARCHAR", "CHAR", "BOOLEAN", "DATE", "TIMESTAMP"}


@register("coupon_warehouse")
class CouponWarehouse(Source):
    """Catalogue tables. config: database, users_table, items_table, interactions_table, time_format (ms, s, datetime), time_column, action_mapping, co_occurrence {window_days, lookback_days, min_cooccur, top_k}."""

    def validate_config(self) -> None:
        self.need("users_table", "items_table", "interactions_table")
        if self.config.get("time_format", "ms") not in ("ms", "s", "datetime"):
            raise ValueError("time_format is ms, s or datetime")

    def _table(self, key: str) -> DataFrame:
        name = self.config[key]
        db = self.config.get("database")
        name = name if "." in name or not db else f"{db}.{name}"
        try:
            return self.spark.table(name)
        except Exception as e:
            raise ValueError(f"table {name} can't be read: {e}") from e

    def load_users(self) -> DataFrame:
        df = self._table("users_table")
        text = lambda c: (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
        return df.select(F.col("custref_no").cast("string").alias("user_id"), text("age"), text("sex"), text("self_income_round")).dropDuplicates(["user_id"])

    def load_items(self) -> DataFrame:
        df = self._table("items_table")
        text = lambda c: F.coalesce(F.col(c).cast("string") if c in df.columns else F.lit(""), F.lit("")).alias(c)
        return df.select(F.col("str_id").cast("string").alias("item_id"), F.col("str_nm").alias("item_title"), *(text(c) for c in ("city_nm", "cnty_nm", "lng", "lat", "cat_nm1", "cat_nm2"))).dropDuplicates(["item_id"])

    def load_interactions(self) -> DataFrame:
        df = self._table("interactions_table")
        time = next((c for c in (self.config.get("time_column"), "event_time", "time") if c and c in df.columns), None)
        if time is None:
            raise ValueError(f"no time column among {df.columns}")
        event = F.col("event") if "event" in df.columns else F.lit("view")
        action = mapped(event, ACTIONS | (self.config.get("action_mapping") or {}), F.lower(event))
        rows = df.select(F.col("custref_no").cast("string").alias("user_id"), F.col("shopid").cast("string").alias("item_id"), to_seconds(F.col(time), self.config.get("time_format", "ms")).alias("timestamp"), action.alias("action"))
        return rows.where("user_id is not null and user_id <> '' and item_id is not null and item_id <> ''")

    def load_co_occurrence(self) -> DataFrame:
        c = self.config.get("co_occurrence") or {}
        return sequences.co_occurrence(self.get_interactions(), c.get("window_days", 30), c.get("lookback_days"), c.get("min_cooccur", 2), c.get("top_k", 50))


@dataclass
class TableMeta:
    db: str
    name: str
    columns: dict[str, str]
    partition_keys: dict[str, str] = field(default_factory=dict)
    role: str | None = None
    item_id: str | None = None
    sensitive: set[str] = field(default_factory=set)


def role_of(name: str) -> str | None:
    """What a table is for, by the first word found in its name."""
    for word, role in (("coupon_shop", "coupon_shop"), ("coupon", "coupon"), ("category", "category"), ("addr", "address"), ("shop", "shop"), ("store", "shop"), ("cust", "customer"), ("event", "event"), ("log", "event")):
        if word in name.lower():
            return role
    return None


def _body(text: str, at: int) -> tuple[str, int]:
    """The balanced bracket from `at` on, without its ends; quotes may hold brackets."""
    depth, quote, start = 0, "", at + 1
    for i in range(at, len(text)):
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"`":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if depth == 0:
                return text[start:i], i + 1
    raise ValueError("brackets don't balance")


def _columns(body: str) -> dict[str, str]:
    out, depth, quote, part = {}, 0, "", ""
    for c in body + ",":
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c in "(<":
            depth += 1
        elif c in ")>":
            depth -= 1
        if c == "," and depth == 0 and not quote:
            m = re.match(r"\s*`?([\w$]+)`?\s+([\w]+(?:\s*[(<].*?[)>])?)", part, re.S)
            if m:
                out[m[1].lower()] = re.sub(r"\s+", "", m[2]).upper()
            part = ""
        else:
            part += c
    return out


def parse_ddl(sql: str) -> list[TableMeta]:
    """The CREATE TABLE statements of a script, with columns and partition keys in lower case; comments are ignored. Types that aren't known are kept."""
    sql = re.sub(r"/\*.*?\*/", " ", re.sub(r"--[^\n]*", " ", sql), flags=re.S)
    out = []
    for m in re.finditer(r"create\s+(?:external\s+)?table\s+(?:if\s+not\s+exists\s+)?([`\w.]+)\s*\(", sql, re.I):
        name = m[1].replace("`", "")
        body, end = _body(sql, m.end() - 1)
        rest = sql[end:].split(";", 1)[0]
        parts = re.search(r"partitioned\s+by\s*\(", rest, re.I)
        keys = _columns(_body(rest, parts.end() - 1)[0]) if parts else {}
        db, _, table = name.rpartition(".")
        cols = _columns(body)
        for c, t in cols.items():
            if re.match(r"\w+", t)[0] not in TYPES:
                log.warning("%s.%s has type %s", table, c, t)
        out.append(TableMeta(db.lower(), table.lower(), cols, keys, role_of(table)))
    return out


def statements(script: str) -> list[str]:
    """A script's statements: cut at semicolons that end a line."""
    return [s.strip() for s in re.split(r";\s*(?:\n|$)", script) if s.strip()]


def run_script(spark: SparkSession, script: str) -> int:
    """Run a script's statements in order; their number."""
    todo = statements(script)
    for s in todo:
        spark.sql(s)
    return len(todo)


def load_tables(config: list[dict]) -> list[TableMeta]:
    """Table descriptions {db, table, columns, partition_keys, role, item_id, sensitive} from a configuration; ValueError names what is missing or doubled."""
    out, seen = [], set()
    for t in config:
        for k in ("table", "columns"):
            if not t.get(k):
                raise ValueError(f"a table lacks {k}: {t}")
        name = t["table"].lower()
        if name in seen:
            raise ValueError(f"table {name} is there twice")
        seen.add(name)
        cols = {c["name"].lower(): c.get("type", "STRING").upper() for c in t["columns"]}
        hidden = {c["name"].lower() for c in t["columns"] if c.get("sensitive")} | {c.lower() for c in t.get("sensitive", [])}
        if t.get("item_id") and t["item_id"].lower() not in cols:
            raise ValueError(f"{name}: no key column {t['item_id']}")
        out.append(TableMeta(t.get("db", ""), name, cols, {k.lower(): "STRING" for k in t.get("partition_keys", [])}, t.get("role") or role_of(name), t.get("item_id"), hidden))
    return out


def select_partitions(df: DataFrame, key: str, spec: dict) -> DataFrame:
    """Rows of the partitions asked for: {single}, {range: [low, high]} or {latest_n}. The filter is on the partition column, so others aren't read."""
    if spec.get("single"):
        return df.where(F.col(key) == spec["single"])
    if spec.get("range"):
        return df.where(F.col(key).between(*spec["range"]))
    if spec.get("latest_n"):
        latest = [r[0] for r in df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(F.desc(key)).limit(int(spec["latest_n"])).collect()]
        return df.where(F.col(key).isin(latest)) if latest else df.where(F.lit(False))
    return df


def read_table(df: DataFrame, meta: TableMeta, spec: dict | None = None, limit: int | None = None) -> DataFrame:
    """A table's declared columns without the sensitive ones, of the partitions asked for. Undeclared columns are ignored, missing ones are null; `limit` takes a sample."""
    for key in meta.partition_keys:
        if key in {c.lower() for c in df.columns} and spec:
            df = select_partitions(df, key, spec)
            break
    have = {c.lower(): c for c in df.columns}
    wanted = [c for c in [*meta.columns, *meta.partition_keys] if c not in meta.sensitive]
    out = df.select([(F.col(have[c]) if c in have else F.lit(None).cast("string")).alias(c) for c in wanted])
    return out.limit(limit) if limit else out


def read_csv(spark: SparkSession, path: str, meta: TableMeta, key: str | None = None, default_dt: str = "20260620", least: int = 6) -> DataFrame:
    """CSV with header: names in lower case, NUL and CR removed, sensitive columns dropped, keys shorter than `least` characters skipped, a missing partition date filled in."""
    raw = spark.read.option("header", True).option("multiLine", False).csv(path)
    df = raw.toDF(*(c.strip().lower() for c in raw.columns))
    df = df.select([F.translate(c, "\x00\r", "").alias(c) for c in df.columns if c not in meta.sensitive])
    if key and key in df.columns:
        df = df.where(F.length(key) >= least)
    return df.withColumn("etl_dt", F.coalesce(F.col("etl_dt"), F.lit(default_dt)) if "etl_dt" in df.columns else F.lit(default_dt))


def item_key(meta: TableMeta, prefix: str = "") -> Column:
    """The item's id: the declared key as text, '' without one; with a prefix for the table if asked."""
    key = F.coalesce(F.col(meta.item_id).cast("string"), F.lit("")) if meta.item_id else F.lit("")
    return F.concat(F.lit(prefix), key) if prefix else key


PREFIX = {"shop_third": "mt-", "shop_own": "self-", "coupon": "cpn-"}


def geo(lng: Column, lat: Column) -> Column:
    """struct(lng, lat), 6 decimals; null if not numeric, out of range or (0, 0)."""
    x, y = F.round(strip(lng).try_cast("double"), 6), F.round(strip(lat).try_cast("double"), 6)
    return F.when((F.abs(x) <= 180) & (F.abs(y) <= 90) & ~((x == 0) & (y == 0)), F.struct(x.alias("lng"), y.alias("lat")))


def first_rows(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row a key, the first in that order; partial aggregation."""
    return df.groupBy(F.col(key).alias("_k")).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def geo_of_coupons(coupons: DataFrame, links: DataFrame, shops: DataFrame) -> DataFrame:
    """Coupons with the position of the first of their shops (coupon_id, shop_id; shop_id, lng, lat) that has one."""
    placed = links.join(shops.select("shop_id", geo(F.col("lng"), F.col("lat")).alias("g")), "shop_id").where("g is not null").groupBy("coupon_id").agg(F.min_by("g", "shop_id").alias("g"))
    return coupons.join(placed, "coupon_id", "left").select(*coupons.columns, F.col("g.lng").alias("shop_lng"), F.col("g.lat").alias("shop_lat"))


def read_roles(spark: SparkSession, metas: list[TableMeta], roles: tuple[str, ...] = ("shop", "coupon", "customer"), spec: dict | None = None) -> dict[str, DataFrame]:
    """The first table of each role."""
    out = {}
    for m in metas:
        if m.role in roles and m.role not in out:
            out[m.role] = read_table(spark.table(f"{m.db}.{m.name}" if m.db else m.name), m, spec)
    return out


def intermediate(spark: SparkSession, folder: str, form: str = "parquet") -> dict[str, DataFrame | None]:
    """users, items, interactions and co_occurrence from a folder; missing users and items are derived from the interactions."""
    jvm = spark.sparkContext._jvm

    def there(name: str) -> DataFrame | None:
        path = f"{folder.rstrip('/')}/{name}.{form}"
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return None
        reader = spark.read.format(form)
        return (reader.option("header", True) if form == "csv" else reader).load(path)

    t = {n: there(n) for n in ("users", "items", "interactions", "co_occurrence")}
    if t["interactions"] is None:
        raise ValueError(f"no interactions in {folder}")
    if t["users"] is None:
        t["users"] = t["interactions"].select("user_id").distinct().withColumn("interaction_count", F.lit(0))
    if t["items"] is None:
        t["items"] = t["interactions"].select("item_id").distinct().withColumn("item_title", F.lit(None).cast("string"))
    return t
