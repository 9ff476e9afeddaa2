"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the operators count on: AQE turns a shuffled join into a broadcast one
# only once it has measured the small side, splits skewed join partitions, and
# merges small ones.  No operator hints a broadcast itself.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def builder(app: str = "longitab", **conf: str) -> SparkSession.Builder:
    b = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        b = b.config(key, value)
    return b


_OWN: dict[str, str] = {}


def staging_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors reach.

    Where it is unset, as in tests, a local master gets one folder of its own;
    any other master must name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="longitab-")
    return _OWN[context.applicationId]


def staged_root(spark: SparkSession) -> str:
    """Where this application stages its frames."""
    return f"{staging_dir(spark)}/longitab-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession) -> str:
    """A new path below ``staged_root``."""
    return f"{staged_root(spark)}/{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once as parquet and read it back.

    For a frame that several later branches scan.  The files survive the loss
    of executors, and each branch still gets column pruning and pushed filters.
    ``unstage`` removes them, ``clear_staged`` those of the whole application.
    """
    spark = df.sparkSession
    path = fresh_path(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path in whatever file system it names; absent is fine."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def unstage(*frames: DataFrame) -> None:
    """Delete the files of staged frames that no later action will read."""
    for df in frames:
        if path := getattr(df, "staged_path", None):
            remove(df.sparkSession, path)


def clear_staged(spark: SparkSession) -> None:
    """Delete everything this application has staged."""
    remove(spark, staged_root(spark))
