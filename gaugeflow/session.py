"""Session set-up, scratch folders and lineage cuts."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app="gaugeflow", master=None, conf=None):
    """A session with the settings the operators rely on; `conf` overrides any of them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.enabled": "false",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark):
    """Every text time in this library is zone-less UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark):
    """The folder all executors can reach: `spark.checkpoint.dir` from the session.

    Only a local-mode session without that setting (tests, a laptop) gets a
    temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="gaugeflow-")
    # Nobody else knows this folder; it goes with the process.
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def scratch_path(spark, label):
    """A fresh path under the shared folder; nothing exists there yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder, so later stages restart from files."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label) -> DataFrame:
    """`df` written to the shared folder and read back, for rows that are read
    more than once by different columns."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
