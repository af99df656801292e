"""Streams: the per-document operators are stateless, so batch and stream share them; the best value
of a cell across micro-batches is kept by merging each batch into a table by key.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formloom.session import shared_dir


def run_available(source: DataFrame, transform, path: str) -> None:
    """Runs everything a stream offers now through `transform(batch, batch_id)`; offsets live beside the result."""
    q = source.writeStream.foreachBatch(transform).option("checkpointLocation", f"{path}-offsets").trigger(availableNow=True).start()
    q.awaitTermination()


def _generations(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the whole generations of a table, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(path)]
    whole = [n for n in names if n.startswith("gen-") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS"))]
    return sorted(int(n[4:]) for n in whole)


def _drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def best_value_stream(
    spark: SparkSession, folder: str, schema: T.StructType, keys: list[str], rank: list, keep: list[str], files_per_batch: int = 4, glob: str = "*.parquet", root: str | None = None, parts: int = 16,
) -> DataFrame:
    """The best row per key over a stream of files.

    The table lies in `root` (a folder of its own in the shared folder where none is given), with the
    stream's offsets beside it: a run that starts again with the same root goes on where the last one
    stopped, from the last whole generation. Keys are parted by hash; a batch reads and rewrites only the
    parts its keys are in and refers to the others where they are. A batch run twice gives the same table.
    """
    root = root or f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    cols = [f.name for f in schema.fields]
    typed = spark.createDataFrame([], schema)

    def reduce(df: DataFrame) -> DataFrame:
        best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*rank))
        return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(best.alias("r")).select("r.*")

    def part(df: DataFrame) -> DataFrame:
        return df.withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))

    def current(before: int | None = None) -> dict[int, str]:
        """Which folder holds each part now: the newest generation that has it."""
        out: dict[int, str] = {}
        for g in _generations(spark, root):
            if before is None or g < before:
                for r in spark.read.text(f"{root}/gen-{g}/parts").collect() if _exists(spark, f"{root}/gen-{g}/parts") else []:
                    out[int(r[0])] = f"{root}/gen-{g}/rows/_part={r[0]}"
        return out

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = part(reduce(batch)).persist()
        touched = sorted(r[0] for r in rows.select("_part").distinct().collect())  # at most `parts`
        have = current(batch_id)
        old = [have[p] for p in touched if p in have]
        new = rows.select(*cols)
        if old:
            new = reduce(new.unionByName(spark.read.schema(typed.schema).parquet(*old)))
        target = f"{root}/gen-{batch_id}"
        _drop(spark, target)
        part(new).write.partitionBy("_part").parquet(f"{target}/rows")
        spark.createDataFrame([(str(p),) for p in touched], "p string").coalesce(1).write.text(f"{target}/parts")
        spark.range(1).select(F.lit("ok").alias("v")).coalesce(1).write.mode("append").text(target)  # the mark of a whole generation
        rows.unpersist()

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", glob).parquet(folder)
    run_available(source, merge, root)
    now = current()
    if not now:
        return typed.select(*keys, *keep)
    live = {p.split("/gen-")[1].split("/")[0] for p in now.values()}
    for g in _generations(spark, root):
        if str(g) not in live:
            _drop(spark, f"{root}/gen-{g}")  # nothing refers to it any more
    return spark.read.schema(typed.schema).parquet(*sorted(now.values())).select(*keys, *keep)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def windowed_counts(source: DataFrame, ts: str, by: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums per window with a watermark; works on batch and stream alike."""
    df = source.withWatermark(ts, late) if source.isStreaming else source
    return df.groupBy(F.window(ts, window).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), by, "n", "total")


def table_folder(sf_dir: str, table: str) -> tuple[str, str]:
    """(folder, glob) by which a stream reads one table, whether a file or a folder."""
    path = os.path.join(sf_dir, f"{table}.parquet")
    return (path, "*.parquet") if os.path.isdir(path) else (sf_dir, f"{table}.parquet")
