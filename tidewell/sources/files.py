"""Sources that read files: reviews, ratings, logs, campaign and trade tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.contracts import REVIEW_NEW, REVIEW_OLD
from tidewell.sources.base import Source, liked, mapped, register, to_seconds


def _json(source: Source, key: str, schema: str | None = None) -> DataFrame:
    source.need(key)
    reader = source.spark.read.schema(schema) if schema else source.spark.read
    return reader.json(source.config[key])


@register("reviews_old")
class OldReviews(Source):
    """JSON lines of the old review form. config: reviews_path, meta_path."""

    def load_interactions(self) -> DataFrame:
        names = {"overall": "rating", "reviewText": "review_text", "summary": "review_title", "reviewerID": "user_id", "asin": "item_id", "unixReviewTime": "timestamp"}
        df = _json(self, "reviews_path", REVIEW_OLD).withColumnsRenamed(names)
        return df.withColumn("timestamp", F.col("timestamp").cast("long")).withColumn("action", liked(F.col("rating"), 4, 3)).drop("reviewTime")

    def load_users(self) -> DataFrame:
        """One row a user, the name of the user's latest review."""
        return self.get_interactions().where("user_id is not null").groupBy("user_id").agg(F.max_by("reviewerName", F.struct("timestamp", "reviewerName")).alias("user_name"), F.count(F.lit(1)).alias("interaction_count"), F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"))

    def load_items(self) -> DataFrame:
        df = _json(self, "meta_path").drop("also_view", "also_buy")
        return df.withColumnsRenamed({"asin": "item_id", "title": "item_title", "description": "item_description"}).dropDuplicates(["item_id"])

    def load_co_occurrence(self) -> DataFrame | None:
        df = _json(self, "meta_path")
        if "also_buy" not in df.columns:
            return None
        return df.select(F.col("asin").alias("item_id"), F.col("also_buy").alias("related_items")).dropDuplicates(["item_id"])


META_NEW = "main_category string, title string, average_rating float, rating_number int, features array<string>, description array<string>, price float, images array<string>, videos array<string>, store string, categories array<string>, parent_asin string, bought_together string"


@register("reviews_new")
class NewReviews(Source):
    """JSON lines of the new review form. config: reviews_path, meta_path.

    verified is whether the text is 'true'; the published reading (any text counts) is config verified='present'.
    """

    def load_interactions(self) -> DataFrame:
        df = _json(self, "reviews_path", REVIEW_NEW)
        text = F.lower("verified_purchase")
        verified = F.col("verified_purchase").isNotNull() if self.config.get("verified") == "present" else F.coalesce(text == "true", F.lit(False))
        out = df.withColumnsRenamed({"text": "review_text", "title": "review_title", "parent_asin": "item_id"})
        return out.withColumns({"timestamp": to_seconds(F.col("timestamp")), "verified": verified, "action": liked(F.col("rating"), 4, 2)}).drop("verified_purchase", "asin")

    def load_users(self) -> DataFrame:
        return self.get_interactions().select("user_id").where("user_id is not null").distinct()

    def load_items(self) -> DataFrame:
        return _json(self, "meta_path", META_NEW).drop("bought_together").withColumnsRenamed({"parent_asin": "item_id", "title": "item_title", "description": "item_description"})

    def load_co_occurrence(self) -> DataFrame:
        listed = F.coalesce(F.from_json("bought_together", "array<string>"), F.array().cast("array<string>"))
        return _json(self, "meta_path", META_NEW).select(F.col("parent_asin").alias("item_id"), listed.alias("related_items"))


@register("movie_ratings")
class MovieRatings(Source):
    """Text files with lines 'N:' that begin a movie and lines user,rating,yyyy-MM-dd. config: ratings_paths (one or a list), titles_path.

    A line belongs to the last movie line before it in its file. Files are cut into blocks at those
    lines where they are read (the line separator of the reader is the colon line's end), so no file is one task: see load_interactions.
    """

    def validate_config(self) -> None:
        paths = self.config.get("ratings_paths")
        if not paths or not isinstance(paths, (str, list)):
            raise ValueError("ratings_paths must be a path or a list of paths")

    def load_interactions(self) -> DataFrame:
        """Lines get their place in the file; the movie is the last one before it (forward fill).

        Splits of one file are filled apart first, and only a split's lines before its first movie line take the movie from
        the splits before, so the window is over a split, not over a file.
        """
        self.validate_config()
        paths = self.config["ratings_paths"]
        lines = self.spark.read.text(paths if isinstance(paths, list) else [paths]).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n"))
        movie = F.regexp_extract("value", r"^(\d+):\s*$", 1)
        lines = lines.withColumn("m", F.when(movie != "", movie))
        w = Window.partitionBy("f", "b").orderBy("n")
        filled = lines.withColumn("m", F.last("m", ignorenulls=True).over(w)).where(~F.col("value").rlike(r"^\d+:\s*$"))
        lasts = lines.where("m is not null").groupBy("f", "b").agg(F.max_by("m", "n").alias("last_m"))
        blocks = lines.select("f", "b").distinct().join(lasts, ["f", "b"], "left")
        carry = blocks.withColumn("carried", F.last("last_m", ignorenulls=True).over(Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))).select("f", "b", "carried")
        rows = filled.join(carry, ["f", "b"], "left").withColumn("m", F.coalesce("m", "carried"))
        part = lambda i: F.regexp_extract("value", r"^(\d+),(\d+(?:\.\d+)?),(\d{4}-\d{2}-\d{2})", i)
        rating = part(2).try_cast("double")
        return rows.where(part(1) != "").select(part(1).alias("user_id"), F.col("m").alias("item_id"), rating.alias("rating"), F.unix_timestamp(F.to_timestamp(part(3), "yyyy-MM-dd")).alias("timestamp"), liked(rating, 4, 2).alias("action"))

    def load_users(self) -> DataFrame:
        return self.get_interactions().select("user_id").distinct()

    def load_items(self) -> DataFrame:
        self.need("titles_path")
        df = self.spark.read.csv(self.config["titles_path"], schema="movie_id string, year int, title string")
        return df.select(F.col("movie_id").alias("item_id"), F.col("title").alias("item_title"), F.lit("").alias("item_description"), "year")


@register("video_logs")
class VideoLogs(Source):
    """CSV tables of a video service. config: users_path, basic_path, statistic_path, categories_path, captions_path, log_path; whole numbers come as decimals.

    Times are kept in ms as published; config seconds=True turns them into seconds.
    """

    def _csv(self, key: str) -> DataFrame:
        self.need(key)
        return self.spark.read.option("header", True).csv(self.config[key])

    @staticmethod
    def _numbers(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
        """Columns that hold whole numbers written as decimals become int where they parse; the others stay."""
        return df.withColumns({c: F.col(c).try_cast("double").try_cast("int") for c in df.columns if c not in keep})

    def load_users(self) -> DataFrame:
        df = self._csv("users_path")
        text = tuple(c for c in df.columns if c.endswith("_range") or c in ("user_id", "user_active_degree"))
        return self._numbers(df, text)

    def load_items(self) -> DataFrame:
        parts = [self._csv(k) for k in ("basic_path", "statistic_path", "categories_path", "captions_path") if self.config.get(k)]
        df = reduce(lambda a, b: a.join(b.select("video_id", *(c for c in b.columns if c not in a.columns)), "video_id", "left"), parts)
        if "upload_dt" in df.columns:
            df = df.withColumn("upload_timestamp", F.unix_timestamp(F.try_to_timestamp("upload_dt")))
        return df.withColumn("item_id", F.col("video_id").cast("string"))

    def load_interactions(self) -> DataFrame:
        df = self._numbers(self._csv("log_path"), ("user_id", "video_id", "time_ms"))
        at = F.col("time_ms").try_cast("double").try_cast("long")
        like = (F.coalesce(F.col("is_like"), F.lit(0)) == 1) | (F.coalesce(F.col("long_view"), F.lit(0)) == 1)
        return df.withColumnRenamed("video_id", "item_id").withColumns({"timestamp": to_seconds(at) if self.config.get("seconds") else at, "action": F.when(like, "like").otherwise("dislike")}).drop("time_ms")


@register("coupon_csv")
class CouponCsv(Source):
    """CSV tables of a coupon campaign with a header. config: items_path, interactions_path, time_format, column names, events and the map of buttons."""

    def _csv(self, key: str) -> DataFrame:
        self.need(key)
        return self.spark.read.option("header", True).csv(self.config[key])

    def load_items(self) -> DataFrame:
        df = self._csv("items_path")
        ident, name = self.config.get("item_id_column", "item_id"), self.config.get("item_name_column", "item_nm")
        coordinate = lambda c: (F.col(c).try_cast("double") if c in df.columns else F.lit(None).cast("double"))
        rest = [c for c in df.columns if c not in (ident, name, "lon", "lat")]
        return df.select(F.trim(ident).alias("item_id"), (F.col(name) if name in df.columns else F.lit("")).alias("item_title"), coordinate("lon").alias("item_lon"), coordinate("lat").alias("item_lat"), *rest).where("item_id is not null and item_id <> ''").dropDuplicates(["item_id"])

    def load_interactions(self) -> DataFrame:
        c, df = self.config, self._csv("interactions_path")
        user, item, time = c.get("interaction_user_column", "custref_no"), c.get("interaction_item_column", "item_id"), c.get("interaction_time_column", "event_time")
        missing = [x for x in (user, item, time) if x not in df.columns]
        if missing:
            raise ValueError(f"interactions lack {missing}; they have {df.columns}")
        text = lambda n, d=None: F.col(n) if n in df.columns else F.lit(d).cast("string")
        number = lambda n: F.col(n).try_cast("double") if n in df.columns else F.lit(None).cast("double")
        rows = df.select(F.trim(user).alias("user_id"), F.trim(item).alias("item_id"), to_seconds(F.col(time), c.get("time_format", "s")).alias("timestamp"), text("event", c.get("impression_event", "showPage")).alias("event"), text("btn_nm").alias("btn_nm"), number("lat").alias("user_lat"), number("lon").alias("user_lon"))
        click = mapped(F.col("btn_nm"), c.get("btn_action_mapping") or {}, F.lit(c.get("default_click_action", "click")))
        action = F.when(F.col("event") == c.get("impression_event", "showPage"), "impression").when(F.col("event") == c.get("click_event", "Click"), click).otherwise(F.lower("event"))
        return rows.withColumn("action", action).where("user_id is not null and user_id <> '' and item_id is not null and item_id <> '' and timestamp is not null")

    def load_users(self) -> DataFrame:
        return self.get_interactions().select("user_id").distinct()


class _Trades(Source):
    """Parquet tables of trades. config: trades_path, and a path for the descriptions of items."""

    actions: tuple[str, ...] = ("buy", "use")
    described_by = "template_path"
    described_key = "template_id"
    item_column = "coupon_id"

    def _trades(self) -> DataFrame:
        self.need("trades_path")
        return self.spark.read.parquet(self.config["trades_path"])

    def load_items(self) -> DataFrame:
        df = self._trades()
        keep = [c for c in (self.described_key,) if c in df.columns]
        items = df.select(F.col(self.item_column).cast("string").alias("item_id"), *keep).where("item_id is not null").dropDuplicates(["item_id"])
        if self.config.get(self.described_by) and keep:
            items = items.join(self.spark.read.parquet(self.config[self.described_by]).dropDuplicates([self.described_key]), self.described_key, "left")
        return items

    def load_interactions(self) -> DataFrame:
        return self._trades().where(F.col("action").isin(*self.actions)).withColumn("item_id", F.col(self.item_column).cast("string")).withColumn("user_id", F.col("user_id").cast("string"))

    def load_users(self) -> DataFrame:
        return self.get_interactions().select("user_id").where("user_id is not null").distinct()

    def load_co_occurrence(self) -> DataFrame | None:
        """Flat pairs with their frequency, if a path is given."""
        path = self.config.get("co_occurrence_path")
        return self.spark.read.parquet(path) if path else None


@register("trade_coupons")
class TradeCoupons(_Trades):
    pass


@register("own_coupons")
class OwnCoupons(_Trades):
    described_by, described_key = "merchant_path", "merchant_id"


@register("local_payments")
class LocalPayments(_Trades):
    """Payments in stores: the store is the item, as store-<id>."""

    def load_interactions(self) -> DataFrame:
        df = self._trades().where("store_id is not null")
        return df.withColumn("item_id", F.concat(F.lit("store-"), F.col("store_id").cast("string"))).withColumn("action", F.lit("pay")).withColumn("user_id", F.col("user_id").cast("string"))

    def load_items(self) -> DataFrame:
        return self.get_interactions().select("item_id", "store_id").dropDuplicates(["item_id"])


@register("external_coupons")
class ExternalCoupons(_Trades):
    """Coupons of others: without a link to users the tables are empty but typed."""

    def load_interactions(self) -> DataFrame:
        if not self.config.get("trades_path"):
            return self.spark.createDataFrame([], "user_id string, item_id string, timestamp long, action string")
        return super().load_interactions()

    def load_items(self) -> DataFrame:
        if not self.config.get("trades_path"):
            return self.spark.createDataFrame([], "item_id string, item_title string")
        return super().load_items()


def old_as_new(df: DataFrame) -> DataFrame:
    """Reviews of the old form in the new form's columns: ms, 'true' / 'false', no votes, the product as its own parent."""
    return df.select(
        F.col("overall").alias("rating"), F.col("summary").alias("title"), F.col("reviewText").alias("text"), F.lit(None).cast("string").alias("images"), "asin", F.col("asin").alias("parent_asin"),
        F.col("reviewerID").alias("user_id"), (F.col("unixReviewTime").cast("long") * 1000).alias("timestamp"), F.lit(0).alias("helpful_vote"),
        F.when(F.lower(F.col("verified").cast("string")) == "true", "true").otherwise("false").alias("verified_purchase"),
    )


def legacy_names(df: DataFrame) -> DataFrame:
    """Reviews of either form under the legacy cleaner's names: product_id, user_id, rating, review_text, review_title, timestamp in seconds."""
    new = df if "parent_asin" in df.columns else old_as_new(df)
    out = new.withColumnsRenamed({"text": "review_text", "title": "review_title"}).withColumn("product_id", F.coalesce("parent_asin", "asin"))
    return out.withColumn("timestamp", to_seconds(F.col("timestamp"))).drop("parent_asin", "asin", "images")
