"""Session settings and scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even if a later operator then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings this package relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, app: str = "fieldlab") -> SparkSession:
    """A local session for tests and the bench; on a cluster pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_FOLDERS: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a ``local[..]`` master, whose tasks run in the driver's process, may go without that setting: it gets one temporary
    folder per application. On a cluster a machine-local folder would be lost with its executor, so that is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    if context.applicationId not in _FOLDERS:
        _FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="fieldlab-")
    return _FOLDERS[context.applicationId]


def fresh_path(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    return f"{scratch_dir(spark)}/fieldlab/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For results that several passes need and that are costly to compute. The files outlive lost
    executors; clearing the folder is up to whoever owns it, but for what a ``Workbench`` removes.
    """
    return _written(df, fresh_path(df.sparkSession))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Workbench:
    """Written tables of one computation, removed at its end.

    For steps whose result has been written itself, so that nothing reads the tables afterwards.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Workbench:
        return self

    def written(self, df: DataFrame) -> DataFrame:
        self.paths.append(fresh_path(self.spark))
        return _written(df, self.paths[-1])

    def __exit__(self, *_) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for name in self.paths:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
