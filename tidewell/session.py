"""Session settings and the shared scratch folder.

Operators never build a session; they take the one of the DataFrame they get.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from itertools import count

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_fallback: dict[str, str] = {}
#: Scans of at most so many bytes are spread over the cores by a shuffle; larger ones never.
SMALL_SCAN = 8 << 20


def local_session(cores: str = "*", partitions: int = 8, app: str = "tidewell") -> SparkSession:
    """A session for tests and the benchmark on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Only where everything runs on one machine may it be unset; a temporary folder then serves.

    On a cluster without the setting an error: each executor would write to a folder of its own machine, and what is read back would be incomplete.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = "file://" + tempfile.mkdtemp(prefix="tidewell-")
    return _fallback[app]


def cut(df: DataFrame, label: str, instead_of: DataFrame | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    Cuts the lineage so that several branches read one result, and survives lost
    executors, as the files belong to none of them. The files go at the session's end. instead_of: an earlier cut
    that nothing reads any more once df is written (the round before); its files go at once.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    if instead_of is not None:
        drop_cut(instead_of)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one; it goes at the session's end."""
    path = f"{shared_dir(spark)}/tidewell-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    _made.append((spark, path))
    return path


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """A scan's rows over enough tasks for work that is heavy a row.

    A table of more than SMALL_SCAN bytes is read as its splits lie, whatever the number of cores: texts are never shuffled to fill a cluster
    (set spark.sql.files.maxPartitionBytes for finer splits). A smaller one is often a single row group, which one task would
    read alone; its few bytes are spread by a hash of the columns. The size is that of the files as Catalyst knows it, so no job runs here.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, *columns) if size <= SMALL_SCAN else df


def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone already
        pass


def drop_cut(df: DataFrame) -> None:
    """Remove the table of one cut(); a frame that is none stays as it is."""
    path = df.__dict__.get("_cut_path")
    if path is not None:
        _made[:] = [(s, p) for s, p in _made if p != path]
        _delete(df.sparkSession, path)


def drop_cuts() -> None:
    """Remove every table that cut() wrote."""
    while _made:
        _delete(*_made.pop())


atexit.register(drop_cuts)


def rounds_of(most: int | None, what: str) -> Iterator[int]:
    """Rounds for a loop that breaks off when its state is final; past `most` of them an error, never an unfinished state."""
    for k in count():
        if most is not None and k >= most:
            raise RuntimeError(f"{what} isn't final after {most} rounds")
        yield k


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
