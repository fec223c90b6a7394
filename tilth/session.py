"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: days are UTC days, and partition
    overwrites replace only the partitions being written."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for a job's own files, below the cluster's shared
    ``spark.checkpoint.dir``. Only a local master (a laptop, a test) may go
    without that setting and gets a folder of its own; elsewhere executors
    would not see one another's files, so the job stops."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder when the master is {master!r}")
    return tempfile.mkdtemp(prefix=f"run-{label}-", dir="/tmp")
