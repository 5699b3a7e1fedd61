"""Names and removal of stored folders, on whatever file system a path is of. Contents are read and written by Spark."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as tasks open it, if it is on a file system of the machine or a mounted one; else None."""
    system, place = _at(spark, path)
    return place.toUri().getPath() if system.getUri().getScheme() == "file" else None


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly below a folder; nothing if it is not there."""
    system, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def numbered(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers n of the `key=n` folders below a folder, ascending."""
    found = [name.split("=", 1)[1] for name in names(spark, path) if name.startswith(f"{key}=")]
    return sorted(int(number) for number in found)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job that wrote the folder came to its end."""
    return "_SUCCESS" in names(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder; one that is not there is no error."""
    system, place = _at(spark, path)
    system.delete(place, True)
