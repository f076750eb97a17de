"""New documents of a folder as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docweave.sources.package import entries


def stream_entries(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Entries of packages as they arrive; stateless, so any sink and trigger fit."""
    files = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "*.[hH][wW][pP][xX]").option("maxFilesPerTrigger", files_per_trigger).load(folder)
    )
    return entries(files)
