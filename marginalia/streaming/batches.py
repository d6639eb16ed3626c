"""Batches that arrive over time: the same gates on every micro-batch, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from marginalia.operators.references import repeated_keys


def epochs(spark: SparkSession, path: str, before: int) -> list[int]:
    """The epochs below ``before`` that the table at ``path`` holds; none if there is no table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return [n for n in (int(x.removeprefix("epoch=")) for x in names if x.startswith("epoch=")) if n < before]


def gated_append(stream: DataFrame, path: str, rejected: str, checkpoint: str, key: str = "ref") -> DataStreamWriter:
    """A writer that appends rows with new, unique keys to the table at ``path`` and the others to ``rejected``.

    A batch that is run again after a failure replaces its own files, so each row is written once.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        twice = repeated_keys(batch, key).select(key)
        # no table yet is the only case without old keys; what can't be read stops the batch
        bad = twice
        if epochs(spark, path, epoch):
            old = spark.read.parquet(path).where(F.col("epoch") < epoch).select(key)  # one column of the epochs before
            bad = bad.union(old.join(batch.select(key).distinct(), key, "left_semi"))
        bad = bad.distinct()
        good, rest = batch.join(bad, key, "left_anti"), batch.join(bad, key, "left_semi")
        good.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        rest.write.mode("overwrite").parquet(f"{rejected}/epoch={epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def windowed_counts(events: DataFrame, ts: str, kind: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, kind, n): events per window, those up to ``late`` behind the newest counted too. For streams and tables alike."""
    src = events.withWatermark(ts, late) if events.isStreaming else events
    return src.groupBy(F.window(ts, window).alias("w"), F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "kind", "n")
