"""Path checks on the cluster's file system (through Hadoop's FileSystem API).

Metadata operations (existence, completion markers, listing names, delete of a whole
folder) and small text files such as manifests. Data always moves through Spark
readers and writers.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

SUCCESS_MARKER = "_SUCCESS"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_complete(spark: SparkSession, path: str) -> bool:
    """A folder written by a Spark job that committed (has ``_SUCCESS``)."""
    return exists(spark, f"{path.rstrip('/')}/{SUCCESS_MARKER}")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path`` (empty when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if it does."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path`` (metadata only)."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def modification_time(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())
