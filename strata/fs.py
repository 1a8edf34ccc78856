"""File-system probes through the session's Hadoop configuration (any scheme:
local, HDFS, object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete (used only for a commit folder that was never published)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def count_data_files(spark: SparkSession, path: str) -> int:
    """Number of visible (not ``_``/``.``-prefixed) files directly under ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return 0
    return sum(1 for st in fs.listStatus(hpath)
               if st.isFile() and not st.getPath().getName().startswith(("_", ".")))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly under ``path`` (none if it is not there)."""
    hpath, fs = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(hpath)] if fs.exists(hpath) else []


def data_bytes(spark: SparkSession, path: str) -> int:
    """Size of the visible files directly under ``path``."""
    return sum(file_bytes(spark, path))


def file_bytes(spark: SparkSession, path: str) -> list[int]:
    """Size of each visible file directly under ``path``."""
    hpath, fs = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return [st.getLen() for st in fs.listStatus(hpath)
            if st.isFile() and not st.getPath().getName().startswith(("_", "."))]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with ``text``; False if it already exists (the
    create is exclusive, so two writers cannot both take the same name)."""
    hpath, fs = _fs(spark, path)
    try:
        out = fs.create(hpath, False)
    except Exception as exc:  # noqa: BLE001 - py4j wraps FileAlreadyExistsException
        if "AlreadyExists" in str(exc) or fs.exists(hpath):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    """Set a file's modification time (milliseconds since 1970)."""
    hpath, fs = _fs(spark, path)
    fs.setTimes(hpath, millis, -1)
