"""Session helpers: a local session for tests, the shared work folder, materialised tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that the library expects of any session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caretlake")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and the master is local (tests on one machine) a temporary folder is made and set; on a
    cluster executors would write to disks of their own, so an unset folder is an error there.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="caretlake-")
    spark.conf.set("spark.checkpoint.dir", own)
    spark.sparkContext.setCheckpointDir(own)
    return own


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written within deletes its shuffle files when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there and survives lost executors."""
    path = fresh_dir(df.sparkSession, name)
    with own_shuffles(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def spread(df: DataFrame) -> DataFrame:
    """``df`` in enough partitions for all cores, for work that costs far more than moving its rows.

    Only a plain scan of fewer partitions than the cluster has cores is moved: a small table in few files. Large tables
    have enough splits and stay where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().executedPlan().nodeName() == "AdaptiveSparkPlan" or df._jdf.rdd().getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores)


def discard(df: DataFrame) -> None:
    """Delete what ``materialise`` wrote for ``df``; nothing that is still to be computed may read it."""
    path = getattr(df, "_written_at", None)
    if path:
        delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
