"""Tables written once and read by several views."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Only a local session may leave that
    unset, as in tests: it gets a temporary folder."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = "file://" + os.path.join(tempfile.gettempdir(), "docweave")
    return f"{top.rstrip('/')}/docweave-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows as Parquet files that outlive executors: what reads them neither makes them again nor loses them."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
