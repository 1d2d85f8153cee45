"""Small files and renames on whatever file system a path names (HDFS, object store, local).

Everything goes through Hadoop's file system API, as Spark's own reads and writes do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder (nothing happens if there is none)."""
    _system(spark, path).delete(_path(spark, path), True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted."""
    return sorted(s.getPath().getName() for s in _system(spark, folder).listStatus(_path(spark, folder)))


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another: readers see the old or the new one, never part of one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = _system(spark, target)
    target = str(system.makeQualified(_path(spark, target)).toString())
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    modes = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    modes[0] = hadoop.Options.Rename.OVERWRITE
    context.mkdir(_path(spark, target).getParent(), hadoop.permission.FsPermission.getDirDefault(), True)
    context.rename(_path(spark, source), _path(spark, target), modes)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and renamed, so it is there whole or not at all."""
    staged = f"{path}.{uuid.uuid4().hex}"
    out = _system(spark, path).create(_path(spark, staged))
    out.write(bytearray(text.encode()))
    out.close()
    replace(spark, staged, path)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
