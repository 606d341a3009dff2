"""Tables that are replaced while others read them.

Every version is a folder of its own, ``v-<number>-<note>``, and counts from the moment its marker file exists. A reader
asks once which version is current and reads that one only. Two versions are kept, so readers of the one before are not
cut off. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_MARKER = "_COMPLETE"
KEPT = 2


def files(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and a constructor of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def listed(spark: SparkSession, pattern: str) -> list[str]:
    fs, make = files(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in fs.globStatus(make(pattern)) or [])


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table, to tell whether it has been replaced."""
    fs, make = files(spark, path)
    return tuple(sorted((str(s.getPath().toString()), s.getLen(), s.getModificationTime()) for s in fs.listStatus(make(path))))


def remove(spark: SparkSession, path: str) -> None:
    fs, make = files(spark, path)
    fs.delete(make(path), True)


def begin(spark: SparkSession, path: str, note: str = "0") -> str:
    """The folder to write the next version to."""
    taken = [int(p.rsplit("/", 1)[1].split("-")[1]) for p in listed(spark, f"{path}/v-*")]
    return f"{path}/v-{max(taken, default=0) + 1:012d}-{note}"


def publish(spark: SparkSession, version: str) -> None:
    """Make a written version the current one and remove those that are too old."""
    fs, make = files(spark, version)
    fs.create(make(f"{version}/{_MARKER}"), True).close()
    path = version.rsplit("/", 1)[0]
    for old in listed(spark, f"{path}/v-*/{_MARKER}")[:-KEPT]:
        fs.delete(make(old.rsplit("/", 1)[0]), True)


def published(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Folder and note of every version that counts, the current one last."""
    folders = [p.rsplit("/", 1)[0] for p in listed(spark, f"{path}/v-*/{_MARKER}")]
    return [(folder, folder.rsplit("-", 1)[1]) for folder in folders]


def current(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """Folder and note of the current version."""
    found = published(spark, path)
    return found[-1] if found else None
