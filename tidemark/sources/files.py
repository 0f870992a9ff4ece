"""Operations on single files, which readers and writers of frames do not have."""

from __future__ import annotations

import os
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession


def _opened(spark: SparkSession, path):
    """The Hadoop path and its file system, as the cluster resolves them."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _on_disk(target, system) -> str | None:
    """The path of a file system that is mounted here, or None for a remote one."""
    return target.toUri().getPath() if system.getUri().getScheme() == "file" else None


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all of its text, or leave an existing one alone and return False.

    The text is written beside it under a hidden name and then given its own name in one step
    that fails if the name is taken: of two writers one wins, and no reader sees half a file.
    """
    target, system = _opened(spark, path)
    local = _on_disk(target, system)
    hidden = f".{target.getName()}.{uuid.uuid4().hex}"
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        beside = os.path.join(os.path.dirname(local), hidden)
        with open(beside, "w", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(beside, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(beside)
        return True
    jvm = spark.sparkContext._jvm
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), hidden)
    stream = system.create(beside, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
        context.rename(context.makeQualified(beside), context.makeQualified(target), none)
    except Exception:
        system.delete(beside, False)
        if system.exists(target):
            return False
        raise
    return True


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    target, system = _opened(spark, folder)
    local = _on_disk(target, system)
    if local is not None:
        return sorted(os.listdir(local)) if os.path.isdir(local) else []
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def text_of(spark: SparkSession, path: str) -> str:
    target, system = _opened(spark, path)
    local = _on_disk(target, system)
    if local is None:
        return spark.read.text(path, wholetext=True).first().value
    with open(local, encoding="utf-8") as f:
        return f.read()


def bytes_read(df: DataFrame) -> int:
    """Size of the files below a frame, each counted once; 0 if it reads none. Runs no job."""
    uri = df.sparkSession.sparkContext._jvm.java.net.URI  # the names of input files are encoded
    total = 0
    for name in set(df.inputFiles()):
        target, system = _opened(df.sparkSession, uri(name))
        total += system.getFileStatus(target).getLen()
    return total


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all in it; one that is gone already is no error."""
    target, system = _opened(spark, path)
    local = _on_disk(target, system)
    if local is None:
        system.delete(target, True)
    elif os.path.isdir(local):
        shutil.rmtree(local, ignore_errors=True)
    elif os.path.exists(local):
        os.unlink(local)
        checksum = os.path.join(os.path.dirname(local), f".{os.path.basename(local)}.crc")
        if os.path.exists(checksum):
            os.unlink(checksum)
