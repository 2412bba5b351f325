"""Small-file helpers on Spark's own file system client, so that they work on any storage Spark can read."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The client of the storage a path lies on, and the path for it."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = file_system(spark, path)
    return fs.exists(location)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, sorted; none when it does not exist."""
    fs, location = file_system(spark, path)
    if not fs.exists(location):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory())


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern matches, in one listing."""
    fs, location = file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(location) or [])


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path``; none when it does not exist."""
    fs, location = file_system(spark, path)
    return fs.getContentSummary(location).getLength() if fs.exists(location) else 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, location = file_system(spark, path)
    if not fs.exists(location):
        raise FileNotFoundError(path)
    stream = fs.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old text, if there was one, or the new text, and never none.

    The file system's own replacing rename does that; where it has none, the error says so.
    """
    fs, location = file_system(spark, path)
    _, part = file_system(spark, f"{path}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    context, options = _replacing(spark, location)
    context.rename(part, location, options)


def _replacing(spark: SparkSession, location):
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(location.toUri(), conf), options


def delete_partition(spark: SparkSession, folder: str, column: str, value: str) -> None:
    """Remove a partition's folder, whose name Spark escapes."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    delete(spark, f"{folder}/{column}={escape(value)}")


def delete(spark: SparkSession, path: str) -> None:
    fs, location = file_system(spark, path)
    fs.delete(location, True)
