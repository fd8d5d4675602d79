"""Text scans of submission files (one row per line, column ``value``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Submission files are ``*.txt`` anywhere below the root.
SUBMISSION_GLOB = "*.txt"


def read_lines(spark: SparkSession, root: str, glob: str = SUBMISSION_GLOB,
               recursive: bool = True) -> DataFrame:
    """All lines of the files below ``root`` whose names match ``glob``.

    The scan splits files across tasks, so it scales with the number and
    size of files.
    """
    reader = spark.read.format("text").option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(root)


def write_lines(lines: DataFrame, path: str, value: str = "value") -> None:
    """Write a one-column string DataFrame as ``part-*.txt`` text files."""
    (lines.select(value).write.mode("overwrite")
     .option("compression", "none").text(path))
