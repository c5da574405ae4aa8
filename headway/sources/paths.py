"""Folder listings and small file operations through the session's own file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _status(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder?  Any other failure (permissions, network) is raised."""
    fs, p = _status(spark, path)
    return bool(fs.exists(p))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none if it does not exist."""
    fs, p = _status(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _status(spark, path)
    fs.delete(p, True)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Changes when the files of a table do: the names, sizes and times of what lies directly under ``path``."""
    fs, p = _status(spark, path)
    if not fs.exists(p):
        return ""
    found = [fs.getFileStatus(p), *fs.listStatus(p)]
    return ";".join(sorted(f"{s.getPath().getName()},{s.getLen()},{s.getModificationTime()}" for s in found))


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, p = _status(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file whole: under another name first, then renamed over the old one."""
    parent, _, name = path.rpartition("/")
    part = f"{parent}/_{name}-{uuid.uuid4().hex}"
    fs, p = _status(spark, part)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    _rename(spark, part, path, overwrite=True)


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; an existing ``target`` is an error."""
    _rename(spark, source, target, overwrite=False)


def _rename(spark: SparkSession, source: str, target: str, overwrite: bool) -> None:
    sc = spark.sparkContext
    fs, a = _status(spark, source)
    _, b = _status(spark, target)
    option = sc._jvm.org.apache.hadoop.fs.Options.Rename
    options = sc._gateway.new_array(option, int(overwrite))
    if overwrite:
        options[0] = option.OVERWRITE
    a, b = fs.makeQualified(a), fs.makeQualified(b)
    sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(a.toUri(), sc._jsc.hadoopConfiguration()).rename(a, b, options)
