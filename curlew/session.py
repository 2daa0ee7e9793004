"""Sessions, table reading and the shared folder that cuts lineage.

Intermediate tables are Parquet in the folder named by ``spark.checkpoint.dir``,
which every executor shares, so a lost executor costs at most a re-read. Only a
local session may fall back to a folder of its own.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "curlew", **conf: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    base = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="curlew-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    folder = f"file://{own}"
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _folder(spark: SparkSession) -> str:
    """The application's own part of the shared folder."""
    return f"{shared_dir(spark)}/curlew/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written.

    The scan has known size and no lineage, so joins on it can be re-planned
    (broadcast, skew splitting) and a lost executor re-runs no earlier stage.
    """
    spark = df.sparkSession
    importable(spark)
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call it when no result that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, whatever folder the session was started in.

    A cluster whose executors don't share that folder gets the package by ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
