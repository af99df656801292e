"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cpus: str | int = "*", name: str = "formloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the submitted configuration rules."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(conf.pop("shuffle", 8)))
        .config("spark.driver.memory", conf.pop("memory", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    safe_unions(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Most rows of a reference table that is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 20_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it has no more than `rows` rows (counted), else df as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; a temporary one only where none is set and the master is local."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="formloom-")
        spark.conf.set(CHECKPOINT_KEY, named)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(named)
    return named


_CUTS: list[str] = []


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df into the shared folder and read it back: a cut lineage that outlives executors."""
    spark = df.sparkSession
    safe_unions(spark)
    path = f"{shared_dir(spark).rstrip('/')}/formloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _CUTS:
        atexit.register(_drop_at_exit)
    _CUTS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def _drop_at_exit() -> None:
    """What was cut and not dropped goes with the driver, if the session still stands then."""
    spark = SparkSession.getActiveSession()
    if spark is not None and _CUTS:
        try:
            drop_cuts(spark)
        except Exception:  # the JVM went first
            pass


def drop_cuts(spark: SparkSession) -> int:
    """Deletes the tables `cut` wrote in this session, once nothing reads them any more; returns how many."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    n = 0
    while _CUTS:
        p = fs_path(_CUTS.pop())
        n += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return n


def safe_unions(spark: SparkSession) -> None:
    """Spark 4.1 takes a union to be partitioned like its children, also where AQE coalesces these differently at
    run time; a group above the union then comes out in two rows. A union is not to be trusted with that."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    safe_unions(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))
