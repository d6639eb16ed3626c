"""Session helpers: table access, spreading of expensive work and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: The application that this process has shipped the package to.
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that its Python functions can be read there."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="marginalia-")) / "marginalia.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, Path(here.name) / f.relative_to(here))
    spark.sparkContext.addPyFile(str(target))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory (a file or a folder of part files)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least one partition a core, for expensive Python work; input planned in enough partitions is left where it lies.

    Counts the partitions that the scan is planned in, so large files that split by row groups are not moved. For scans
    and what is computed from them row by row.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(2 * cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one of our own where that is unset on a single machine.

    On a cluster without the setting this raises: a folder of one machine would lose data with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = spark.conf.get("marginalia.checkpoint.dir", None)
    if own is None:
        own = os.path.join(tempfile.gettempdir(), f"marginalia-{uuid.uuid4().hex}")
        spark.conf.set("marginalia.checkpoint.dir", own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: the lineage ends there, and sizes are known from then on."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cut-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what :func:`cut` wrote for ``df``, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._cut_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
