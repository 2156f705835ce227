"""Path checks on whichever file system holds a path."""

from __future__ import annotations

import uuid
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolved(spark: SparkSession, path: str):
    """A path's Hadoop file system and Hadoop form."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists."""
    files, hadoop_path = _resolved(spark, path)
    return files.exists(hadoop_path)


def has_content(spark: SparkSession, path: str) -> bool:
    """Whether a directory exists and holds anything; lists no further than its first entry."""
    files, hadoop_path = _resolved(spark, path)
    return files.exists(hadoop_path) and files.listStatusIterator(hadoop_path).hasNext()


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system spelled out."""
    files, hadoop_path = _resolved(spark, path)
    return files.makeQualified(hadoop_path).toString()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory and all below it."""
    files, hadoop_path = _resolved(spark, path)
    files.delete(hadoop_path, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory; none if it does not exist."""
    files, hadoop_path = _resolved(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(hadoop_path)] if files.exists(hadoop_path) else []


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file below a directory; 0 if there is none."""
    files, hadoop_path = _resolved(spark, path)
    listed, most = files.listFiles(hadoop_path, True), 0
    while listed.hasNext():
        most = max(most, listed.next().getLen())
    return most


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a directory to a path that does not exist."""
    files, hadoop_path = _resolved(spark, path)
    if not files.rename(hadoop_path, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be moved to {to}")


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """A file with a text, unless there is one of that name: whole or not at all, and by one of several writers only.

    The file is written under a name of its own and moved. Local files, where a
    move would replace another, are linked instead. On an object store, whose
    moves are copies, it holds as far as the store refuses to overwrite.
    """
    files, target = _resolved(spark, path)
    target = files.makeQualified(target)
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent().toString()}/.{uuid.uuid4().hex}")
    stream = files.create(own, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    try:
        if target.toUri().getScheme() == "file":
            local = [spark._jvm.java.nio.file.Paths.get(p.toUri()) for p in (target, own)]
            spark._jvm.java.nio.file.Files.createLink(*local)
        else:
            rename = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri(), files.getConf()).rename(own, target, rename)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        files.delete(own, False)
    return True


def first_lines(spark: SparkSession, paths: list[str], threads: int = 16) -> list[str]:
    """The first line of each file, packed ones unpacked; nothing else of a file is asked for."""
    java = spark._jvm
    codecs = java.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsparkSession.sessionState().newHadoopConf())

    def line(path: str) -> str:
        files, hadoop_path = _resolved(spark, path)
        stream, codec = files.open(hadoop_path), codecs.getCodec(hadoop_path)
        try:
            text = java.java.io.DataInputStream(codec.createInputStream(stream) if codec else stream).readLine()
        finally:
            stream.close()
        return (text or "").encode("latin-1").decode("utf-8-sig")  # one character a byte

    with ThreadPool(threads) as pool:
        return pool.map(line, paths)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; none if it does not exist."""
    if not exists(spark, path):
        return None
    return spark.read.text(path, wholetext=True).first().value
