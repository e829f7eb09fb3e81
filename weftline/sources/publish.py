"""Small files that readers see whole or not at all: written beside their place, then renamed over it."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, or None where there is no such file."""
    files, at = _files(spark, path), _path(spark, path)
    if not files.exists(at):
        return None
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap_text(spark: SparkSession, path: str, text: str) -> None:
    """Puts text in the place of path by one rename: a reader gets the old text or the new one."""
    jvm, fresh = spark._jvm, f"{path}.{uuid.uuid4().hex}"
    stream = _files(spark, path).create(_path(spark, fresh))
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_files(spark, path).getUri(), spark._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(_path(spark, fresh), _path(spark, path), options)


def delete(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder."""
    files, at = _files(spark, path), _path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def fingerprint(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, size, time of change) of a file or of the files in a folder: changes when the data do."""
    files = _files(spark, path)
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in files.listStatus(_path(spark, path)))
