"""Tables written once and read back, where lineage must end or a round must not be computed again."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDERS = ("spark.checkpoint.dir", "quillwave.shared.dir")  #: settings that name a folder which the driver and all executors share


def shared_path(spark: SparkSession) -> str:
    """A new path below the folder that the first of ``FOLDERS`` names; in a local session without them, below the system's temporary one."""
    root = next(filter(None, (spark.conf.get(s, None) for s in FOLDERS)), None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set one of {', '.join(FOLDERS)} to a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/quillwave-{os.getpid()}-{spark.sparkContext.applicationId}"
    return f"{root.rstrip('/')}/quillwave-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: a lost executor costs its running tasks alone."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
