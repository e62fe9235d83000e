"""Session helpers: building a local session, reading tables, cutting lineage safely."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, name: str = "millrace") -> SparkSession:
    """A session for tests and benches. A cluster brings its own session and settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder, a Parquet file or a folder of them."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the cluster names in ``spark.checkpoint.dir``. Where it is unset: a temporary folder in local mode; a cluster has to name one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        told = spark.conf.get("spark.checkpoint.dir", None)
        if not told and not sc.master.startswith("local-cluster") and sc.master.startswith("local"):
            told = tempfile.mkdtemp(prefix="millrace-checkpoint-")
        if not told:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(told)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    import uuid

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts lineage and survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back: written once, its columns pruned by each reader.

    The folder goes away with ``discard``, at the latest when the driver's Python ends; executors may come and go meanwhile."""
    import atexit

    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    atexit.register(discard, out)
    return out


def discard(df: DataFrame) -> None:
    """Deletes the table of a staged frame that nothing reads any more."""
    try:
        p, fs = _file_system(df.sparkSession, df._staged)
        fs.delete(p, True)
    except Exception:  # noqa: BLE001  the session may be gone
        pass
