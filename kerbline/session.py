"""Session helpers shared by tests, the bench and the query bindings."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "kerbline", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A small local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared ``spark.checkpoint.dir``.

    Without the setting a local session, as in tests, takes a temp folder; a cluster gets an
    error, since its executors would each write to a disk of their own.
    """
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None):
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
        return
    if context.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="kerbline-checkpoint-"))


def settle(df: DataFrame) -> DataFrame:
    """Write a result to the shared checkpoint folder and read it back.

    Cuts the plan before it is used several times or in a loop. Unlike a cached or local
    copy the table survives the loss of executors; unlike ``checkpoint()`` it is written in
    one pass and read by column.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unsettle(*settled: DataFrame) -> None:
    """Delete what :func:`settle` wrote for these, once nothing that is still to run reads it.

    Spark removes the shuffle files of finished jobs when the driver's JVM collects its garbage,
    which a driver with little to do rarely does by itself; it is asked to here.
    """
    for df in settled:
        context = df.sparkSession.sparkContext
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("settled-"):
                path = context._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    for context in {df.sparkSession.sparkContext for df in settled}:
        context._jvm.System.gc()
