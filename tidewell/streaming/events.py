"""Fresh features from a stream of user events: deduplicated history and per-user counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENT = "event_id string, user_id string, item_id string, action string, timestamp long, content_type string, store_id string, amount double"


def kafka(spark: SparkSession, servers: str, topic: str, start: str = "latest", group: str | None = None) -> DataFrame:
    """Events from a topic of JSON messages."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", start)
    if group:
        reader = reader.option("kafka.group.id", group)
    return parse(reader.load().select(F.col("value").cast("string").alias("value")))


def parse(messages: DataFrame) -> DataFrame:
    """JSON messages (value) as events; what can't be read or lacks user or item is dropped."""
    return messages.select(F.from_json("value", EVENT).alias("e")).select("e.*").where("user_id is not null and item_id is not null and timestamp is not null")


def files(spark: SparkSession, folder: str, per_batch: int = 100) -> DataFrame:
    """Events from JSON files that appear in a folder."""
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", per_batch).json(folder)


def dedup(events: DataFrame, keys: tuple[str, ...] = ("event_id",), late: str = "1 hour") -> DataFrame:
    """Events once each. The watermark bounds the state: a repeat that comes later than `late` is let through."""
    timed = events.withColumn("event_time", F.timestamp_seconds("timestamp"))
    return timed.withWatermark("event_time", late).dropDuplicatesWithinWatermark(list(keys)).drop("event_time")


def windowed_counts(events: DataFrame, width: str = "5 minutes", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """(window_start, window_end, item_id, n, users) by event time; late events within the watermark still count."""
    timed = events.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", late)
    w = F.window("event_time", width, slide) if slide else F.window("event_time", width)
    return timed.groupBy(w.alias("w"), "item_id").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("user_id").alias("users")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "item_id", "n", "users")


def stream_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, session_start, session_end, n) by session windows; the state of a user is its open sessions."""
    timed = events.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", late)
    return timed.groupBy(F.session_window("event_time", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


class FeatureSink:
    """foreachBatch writer: appends the history and merges the counters, each batch once.

    History is written below a folder of the batch's number, counters below one of the version and the part of the users (a hash) that the batch touches,
    so a batch that is run again after a failure overwrites its own files and parts without news are not written at all. A
    reader takes, for each part, the latest version with a _SUCCESS mark: version n of a part holds the part's version before merged with batch n. Empty batches write nothing.
    The number of parts is fixed with the table.
    """

    def __init__(self, folder: str, keep: int = 3, parts: int = 64):
        if keep < 2:
            raise ValueError("a batch that is run again needs the version before: keep is at least 2")
        self.folder, self.keep, self.parts = folder.rstrip("/"), keep, parts

    def _fs(self, spark: SparkSession):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, spark: SparkSession) -> list[int]:
        return list(self.contents(spark))

    def contents(self, spark: SparkSession) -> dict[int, list[int]]:
        """The parts of each finished version; bounded by parts * (keep + 1)."""
        path, fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, self._fs(spark)
        base = path(f"{self.folder}/features")
        if not fs.exists(base):
            return {}
        found = {}
        for name in (s.getPath().getName() for s in fs.listStatus(base)):
            if name.startswith("v=") and fs.exists(path(f"{self.folder}/features/{name}/_SUCCESS")):
                inner = (s.getPath().getName() for s in fs.listStatus(path(f"{self.folder}/features/{name}")))
                found[int(name[2:])] = sorted(int(n[5:]) for n in inner if n.startswith("part="))
        return dict(sorted(found.items()))

    def features(self, spark: SparkSession, before: int | None = None, parts: list[int] | None = None) -> DataFrame | None:
        """The latest counters (before a version; of some parts)."""
        latest = {p: v for v, ps in self.contents(spark).items() if before is None or v < before for p in ps if parts is None or p in parts}
        paths = [f"{self.folder}/features/v={v}/part={p}" for p, v in latest.items()]
        return spark.read.parquet(*paths) if paths else None

    def history(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/history/*")

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            part = F.pmod(F.xxhash64("user_id"), F.lit(self.parts)).cast("int")
            touched = [r[0] for r in batch.select(part.alias("p")).distinct().collect()]  # at most `parts`
            if not touched:
                return
            batch.write.mode("overwrite").parquet(f"{self.folder}/history/batch={number}")
            fresh = batch.groupBy("user_id").agg(F.count(F.lit(1)).alias("interaction_count"), F.max("timestamp").alias("last_seen"), F.min("timestamp").alias("first_seen"))
            old = self.features(spark, number, touched)
            merged = fresh if old is None else old.unionByName(fresh).groupBy("user_id").agg(F.sum("interaction_count").alias("interaction_count"), F.max("last_seen").alias("last_seen"), F.min("first_seen").alias("first_seen"))
            merged.withColumn("part", part).write.mode("overwrite").partitionBy("part").parquet(f"{self.folder}/features/v={number}")
            self._forget(spark, number)
        finally:
            batch.unpersist()

    def _forget(self, spark: SparkSession, number: int) -> None:
        """Remove what `keep` later versions of a part supersede."""
        path, fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, self._fs(spark)
        newer: dict[int, int] = {}
        for v, ps in sorted(self.contents(spark).items(), reverse=True):
            if v > number:
                continue
            old = [p for p in ps if newer.get(p, 0) >= self.keep]
            for p in old:
                fs.delete(path(f"{self.folder}/features/v={v}/part={p}"), True)
            if ps and len(old) == len(ps):
                fs.delete(path(f"{self.folder}/features/v={v}"), True)
            for p in ps:
                newer[p] = newer.get(p, 0) + 1


def start(events: DataFrame, folder: str, checkpoint: str, minutes: int | None = 3, keys: tuple[str, ...] = ("event_id",), late: str = "1 hour") -> StreamingQuery:
    """Run the stream into a FeatureSink every so many minutes (1 to 10); None takes what is there and ends."""
    if minutes is not None and not 1 <= minutes <= 10:
        raise ValueError("the trigger is 1 to 10 minutes")
    writer = dedup(events, keys, late).writeStream.foreachBatch(FeatureSink(folder)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if minutes is None else writer.trigger(processingTime=f"{minutes} minutes")).start()
