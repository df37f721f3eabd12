"""Names and small files in the shared storage, through the file system that Spark reads and writes with."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def matching(spark: SparkSession, pattern: str, levels: int = 1) -> list[str]:
    """The last ``levels`` names of the paths that match ``pattern``, joined by ``/`` and in order."""
    files, place = _at(spark, pattern)
    found = files.globStatus(place) or []
    return sorted("/".join(str(f.getPath().toString()).split("/")[-levels:]) for f in found)


def create_once(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a small file; false if it is there already. Of several writers one succeeds, where the storage creates files
    exclusively."""
    files, place = _at(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception.getClass()):
            raise
        return False
    try:
        if text:
            out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def content(spark: SparkSession, path: str) -> str:
    files, place = _at(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing happens where there is none."""
    files, place = _at(spark, path)
    files.delete(place, True)
