"""The few file-system questions Spark's readers do not answer, asked of Hadoop."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, files = _resolve(spark, path)
    return files.exists(jvm_path)


def is_directory(spark: SparkSession, path: str) -> bool:
    jvm_path, files = _resolve(spark, path)
    return files.getFileStatus(jvm_path).isDirectory()


def matching_parents(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the directories that hold files matching a pattern."""
    jvm_path, files = _resolve(spark, pattern)
    return [found.getPath().getParent().getName() for found in files.globStatus(jvm_path) or []]


def matching_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and directories that match a pattern."""
    jvm_path, files = _resolve(spark, pattern)
    return [found.getPath().getName() for found in files.globStatus(jvm_path) or []]


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Full names of the files and directories that match a pattern."""
    jvm_path, files = _resolve(spark, pattern)
    return [found.getPath().toString() for found in files.globStatus(jvm_path) or []]


def delete(spark: SparkSession, path: str) -> None:
    jvm_path, files = _resolve(spark, path)
    files.delete(jvm_path, True)


def make_directory(spark: SparkSession, path: str) -> None:
    jvm_path, files = _resolve(spark, path)
    files.mkdirs(jvm_path)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a directory holds; none if it is not there."""
    jvm_path, files = _resolve(spark, path)
    return [s.getPath().getName() for s in files.listStatus(jvm_path)] if files.exists(jvm_path) else []


def modified(spark: SparkSession, path: str) -> dict[str, int]:
    """Names of what a directory holds, with the milliseconds of their last change."""
    jvm_path, files = _resolve(spark, path)
    found = files.listStatus(jvm_path) if files.exists(jvm_path) else []
    return {s.getPath().getName(): s.getModificationTime() for s in found}


def read_text(spark: SparkSession, path: str) -> str:
    jvm_path, files = _resolve(spark, path)
    stream = files.open(jvm_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file that is there as a whole or not at all; False if one is there already."""
    jvm_path, files = _resolve(spark, path)
    if files.exists(jvm_path):
        return False
    draft, _ = _resolve(spark, f"{path.rsplit('/', 1)[0]}/_draft-{uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    done = files.rename(draft, jvm_path)
    if not done:
        files.delete(draft, False)
    return done


def move_into(spark: SparkSession, source: str, target: str) -> None:
    """Move a directory, or what is left of it after a move that was cut off."""
    jvm_source, files = _resolve(spark, source)
    jvm_target, _ = _resolve(spark, target)
    if not files.exists(jvm_source):
        return
    if not files.exists(jvm_target):
        files.mkdirs(jvm_target.getParent())
        moved = files.rename(jvm_source, jvm_target)
    else:
        moved = True
        for name in names_in(spark, source):
            there, _ = _resolve(spark, f"{target}/{name}")
            if files.exists(there):  # the copy before it was deleted at its source
                files.delete(there, False)
            moved &= files.rename(_resolve(spark, f"{source}/{name}")[0], there)
        files.delete(jvm_source, True)
    if not moved:
        raise RuntimeError(f"{source} could not be moved to {target}")
