"""What every job needs from the session: its tables, its code on the executors, and a place for checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    file = Path(tempfile.mkdtemp(prefix="ledgerloom-"), f"{root.name}.zip")
    with zipfile.ZipFile(file, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(file))
    atexit.register(shutil.rmtree, file.parent, True)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share: what the cluster names, or one of our own where it names none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.split("[")[0] == "local":
            raise ValueError("a cluster must name a shared folder in spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="ledgerloom-"))
    return context.getCheckpointDir()


def spread(df: DataFrame) -> DataFrame:
    """``df`` for work in Python: a table of fewer partitions than the cluster has cores is dealt out, a larger one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """A copy of ``df`` in reliable storage, without its lineage."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder, for wide rows of which later steps read some columns.

    The tables are removed when the driver ends.
    """
    spark = df.sparkSession
    path = f"{_checkpoint_dir(spark)}/table-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001, the context has ended before
        return
