"""Session settings and the shared scratch folder."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins on a hot symbol or document are split at run time, even where the
    # split costs one more exchange further down.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name="tidegrid", master=None, **settings):
    """A session with the settings above; keyword settings use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_path(spark, name):
    """A new path below the folder that the cluster shares between machines.

    The folder is `spark.checkpoint.dir`. Only a local session may fall back to
    a temporary folder, since there driver and executors are one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidegrid-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_folder(spark, path):
    """The folder a path means on the plain file system that the machines share; None if it is in another store."""
    plain = re.fullmatch("(file:(?://)?)?(/(?!/).*)", path)
    if not plain:
        return None
    # A path without a scheme is in the default store of the session.
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    return plain[2] if plain[1] or default.startswith("file:") else None


def store(frame, name):
    """The frame as a table in the shared folder.

    For what is costly to make and read more than once: it is made once, and a
    lost executor does not make it again.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


# Joins on a key and more columns are shuffled by all of these, or left as they are where both sides are dealt by the key.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def store_by(frame, name, key, pieces):
    """The frame as a table in the shared folder, in buckets of a key, for joins and windows that all hold the key.

    Such steps then need no shuffle, and where the frame is already dealt over
    as many pieces by the key, a bucket is one file. The rows of such a table
    take far less space as files than in memory, so the size of the files does
    not make a join broadcast it.
    """
    spark = frame.sparkSession
    spark.conf.set(ALL_KEYS, "false")
    table = f"{name}_{uuid.uuid4().hex}"
    frame.write.bucketBy(pieces, key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table).hint("merge")
