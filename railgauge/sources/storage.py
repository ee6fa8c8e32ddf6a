"""Files behind the writers: removing folders and counting what was written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


class WriteValidationError(RuntimeError):
    """The files hold another number of rows than the job wrote."""


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as its own kind of object."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def names_below(spark: SparkSession, pattern: str) -> list[str]:
    """The full paths that a pattern names, in order."""
    files, hadoop_path = file_system(spark, pattern)
    found = files.globStatus(hadoop_path)
    return sorted(path.toString() for path in spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)) if found else []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written, on whatever file system holds it."""
    files, hadoop_path = file_system(spark, path)
    files.delete(hadoop_path, True)


def validate_count(
    spark: SparkSession, path: str, expected: int, written: DataFrame, where: Column | None = None
) -> None:
    """Recount from the files (no column is read, only row counts); ``where`` names the folders written."""
    rows = spark.read.schema(written.schema).parquet(path)
    found = (rows if where is None else rows.filter(where)).count()
    if found != expected:
        raise WriteValidationError(f"{path}: wrote {expected} rows but the files hold {found}")
