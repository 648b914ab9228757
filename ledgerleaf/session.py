"""Session helpers: where shared scratch lives and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: dict[str, str] = {}
_own_folder: dict[str, str] = {}


def build_session(name: str = "ledgerleaf", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach.

    ``spark.checkpoint.dir`` names it on a cluster. Only a local master, where
    driver and executors share one machine, falls back to a fresh folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = tempfile.mkdtemp(prefix="ledgerleaf-")
    return _local_base[app]


def session_folder(spark: SparkSession) -> str:
    """This application's folder below the shared base; it goes when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        folder = f"{shared_base(spark)}/ledgerleaf-{app}-{uuid.uuid4().hex[:8]}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _own_folder[app] = folder
    return _own_folder[app]


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder that every executor can reach, for tables that this session needs."""
    return f"{session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that it survives lost executors."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_base(spark))
    return df.checkpoint(eager=True)
