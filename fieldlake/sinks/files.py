"""Small text files and listings on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def file_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes and files below a path, and when the path last changed."""
    target, fs = _resolve(spark, path)
    summary = fs.getContentSummary(target)
    modified = fs.getFileStatus(target).getModificationTime()
    return summary.getLength(), summary.getFileCount(), modified


def child_names(spark: SparkSession, path: str) -> list[str]:
    target, fs = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str | None:
    """First line of a small file, None if there is no such file or it is empty."""
    target, fs = _resolve(spark, path)
    line = spark.read.text(path).first() if fs.exists(target) else None
    return line[0] if line else None


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a one-line file."""
    target, fs = _resolve(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file that this library wrote; nothing happens if it is gone."""
    target, fs = _resolve(spark, path)
    fs.delete(target, True)


def create_empty(spark: SparkSession, path: str) -> None:
    """Create an empty file that was not there."""
    target, fs = _resolve(spark, path)
    fs.create(target, False).close()


def next_pointer(spark: SparkSession, folder: str, value: str) -> None:
    """Make `value` the newest pointer of a folder.

    A pointer is an empty file whose name holds a number and the value. Creating
    it is the switch: it exists or not, nothing is ever rewritten, and a writer
    that finds its number taken uses the next one.
    """
    number = max([n for n, _ in pointers(spark, folder)], default=0)
    while True:
        number += 1
        target, fs = _resolve(spark, f"{folder}/{number:012d}-{value}")
        if number in {n for n, _ in pointers(spark, folder)}:
            continue
        create_empty(spark, f"{folder}/{number:012d}-{value}")
        if [v for n, v in pointers(spark, folder) if n == number] == [value]:
            return
        # Two writers took one number: this one moves on and is the newer.
        fs.delete(target, False)


def pointers(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """Numbers and values of a folder's pointers, oldest first."""
    named = [name.partition("-") for name in child_names(spark, folder)]
    return sorted((int(number), value) for number, _, value in named if number.isdigit() and value)
