"""Folders of the shared store, through Hadoop's file system (any URI Spark reads)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def _children(spark: SparkSession, path: str, want_folders: bool) -> list[str]:
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() == want_folders)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, sorted; none when it is absent."""
    return _children(spark, path, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path``, sorted; none when it is absent."""
    return _children(spark, path, False)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) below ``path``."""
    fs, p = _at(spark, path)
    found = fs.getContentSummary(p)
    return found.getFileCount(), found.getLength()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a new name whose parent is made where it is missing."""
    fs, p = _at(spark, target)
    fs.mkdirs(p.getParent())
    if fs.exists(p) or not fs.rename(_at(spark, source)[1], p):
        raise OSError(f"cannot rename {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def claim(spark: SparkSession, source: str, target: str) -> bool:
    """Give the file ``source`` the name ``target``, unless that name is taken: one step, one winner.

    HDFS and stores like it rename without overwriting. A local file system's rename would overwrite, so
    there the name is a hard link, which fails where one exists. A store without atomic
    renames (plain S3) needs a committer of its own in this place.
    """
    fs, p = _at(spark, target)
    fs.mkdirs(p.getParent())
    if fs.getUri().getScheme() == "file":
        path = spark._jvm.java.io.File
        try:
            spark._jvm.java.nio.file.Files.createLink(
                path(p.toUri().getPath()).toPath(),
                path(_at(spark, source)[1].toUri().getPath()).toPath())
        except Exception as exc:
            if "FileAlreadyExistsException" in str(exc):
                return False
            raise
        delete(spark, source)
        return True
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        p.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(_at(spark, source)[1], p, spark.sparkContext._gateway.new_array(rename, 0))
    except Exception as exc:
        if "FileAlreadyExistsException" in str(exc):
            return False
        raise
    return True
