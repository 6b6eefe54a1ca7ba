"""Session helpers: a tuned local session for tests, and the shared folder rules for clusters."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle: int = 8) -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FERROLEX_DRIVER_MEMORY", "8g"))
    )
    return builder.getOrCreate()


def is_local(master: str | None) -> bool:
    """Whether all executors run in one process on this machine, so that its temporary folder is shared by all."""
    return bool(master) and (master == "local" or master.startswith("local["))


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    Where none is named a temporary one is set in a local session (tests); on a cluster that is an error, as a folder of
    one machine would be lost with it. The setting is read from the session, the context's own folder is left as it is.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not is_local(spark.conf.get("spark.master", None)):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="ferrolex-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    at = shared_folder(spark)
    context = getattr(spark, "_sc", None)  # none with Spark Connect, where the server has the folder of its own setting
    if context is not None and context.getCheckpointDir() is None:
        context.setCheckpointDir(at)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores where a table comes in fewer partitions than there are, before work that costs more than moving
    them; tables in many files are left as they are. For scans and narrow steps on them."""
    context = getattr(df.sparkSession, "_sc", None)
    if context is None or df.rdd.getNumPartitions() >= context.defaultParallelism:
        return df
    return df.repartition(context.defaultParallelism)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written in the shared folder: smaller than a checkpoint and read by column.

    Tables stay in the folder `tables` there, as checkpoints do; it can be emptied when the queries have ended.
    """
    at = f"{shared_folder(df.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
