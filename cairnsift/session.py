"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings; each can also be given on the command line, and none is
# tied to local mode. Shuffle partitions are left to the cluster: AQE coalesces.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "cairnsift") -> SparkSession:
    """A session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for intermediate tables. Only local mode, where driver and executors are one
    process, may go without and gets a folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not hasattr(spark.sparkContext, "_own_folder"):
        spark.sparkContext._own_folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return spark.sparkContext._own_folder


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared place."""
    return f"{shared_folder(spark)}/part-{uuid.uuid4().hex}"


# Whether an execution's shuffle files go when it ends, and not when the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(frame: DataFrame) -> DataFrame:
    """A frame written once as a table in the shared folder and read back by its columns. The shuffle files of the write
    go with its end: nothing reads them again, so that a plan of several stored steps holds those of one step only."""
    spark = frame.sparkSession
    path = scratch(spark)
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(RELEASE, before)
    return spark.read.schema(frame.schema).parquet(path)


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Materialise a frame in the shared checkpoint folder, so that lost executors
    cost a read and not a replay of every earlier round."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint(eager=True)
