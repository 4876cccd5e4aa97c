"""Session settings, the shared working folder, tables written to cut lineage, and the size of what may be broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "merkato", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> None:
    """Apply the adaptive-execution settings to a session built elsewhere."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive."):
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; on a cluster an
    unset folder is an error, because a machine-local one would not survive the
    loss of that machine.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = _LOCAL_FOLDERS.get(context.applicationId)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="merkato-")
        _LOCAL_FOLDERS[context.applicationId] = named
    return named.rstrip("/")


_LOCAL_FOLDERS: dict[str, str] = {}


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/merkato/{app}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the plan restarts from files."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The most rows of a join's side that the driver may collect and send to every executor.
BROADCAST_ROWS = 100_000


def beside_facts(side: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """``side`` of a join, sort-merged where it has too many rows to broadcast.

    Spark decides by the size of files, and a million keys may fill a megabyte of Parquet but 100 MB of the driver. With
    ``counted``, a frame of at least as many rows that costs less, that one is counted.
    """
    rows = (side if counted is None else counted).select(F.lit(1)).limit(BROADCAST_ROWS + 1).count()
    return side.hint("merge") if rows > BROADCAST_ROWS else side
