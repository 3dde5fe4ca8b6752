"""Folder checks through Hadoop's FileSystem, so they work on any store Spark
can write to (local, HDFS, object stores)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def child_values(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values v of sub-folders named `key=v` under `path`."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(key + "="):
            out.append(name[len(key) + 1:])
    return out


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders under `path`; none if it isn't there."""
    fs, p = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")  # noqa: SLF001
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole, by a rename."""
    fs, p = _fs(spark, path)
    own = p.getParent().suffix(f"/.{p.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(own, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(own, p):
        fs.delete(own, False)
        raise FileExistsError(path)


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def partition_folder(spark: SparkSession, root: str, **columns) -> str:
    """The folder that `partitionBy` makes for these values, names escaped as Spark escapes them."""
    return "/".join([root.rstrip("/"), *(f"{k}={escaped(spark, str(v))}" for k, v in columns.items())])


def _names(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils  # noqa: SLF001


def escaped(spark: SparkSession, name: str) -> str:
    return _names(spark).escapePathName(name)


def unescaped(spark: SparkSession, name: str) -> str:
    return _names(spark).unescapePathName(name)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def replace(spark: SparkSession, source: str, path: str) -> None:
    """Put the folder `source` in the place of `path`, by a rename on the same store."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    fs.delete(p, True)
    if not fs.rename(_fs(spark, source)[1], p):
        raise FileExistsError(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a full URI, as Spark's file system resolves it."""
    fs, p = _fs(spark, path)
    uri = str(fs.makeQualified(p).toString())
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
