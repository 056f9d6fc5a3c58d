"""Small metadata calls on the file system that Spark itself uses."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: metadata calls that are under way at a time
THREADS = 16


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_folder: bool
    length: int
    modified: int = 0


def literal(path: str) -> str:
    """A path that Spark reads as it stands, although its name holds glob signs."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def _file_system(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    fs, path = _file_system(spark, location)
    return fs.exists(path)


def is_folder(spark: SparkSession, location: str) -> bool:
    fs, path = _file_system(spark, location)
    return fs.exists(path) and fs.getFileStatus(path).isDirectory()


def listing(spark: SparkSession, location: str) -> list[Entry]:
    """Everything directly below a folder, files without content included; of a file, the file itself."""
    fs, path = _file_system(spark, location)
    if not fs.exists(path):
        raise FileNotFoundError(location)
    found = []
    for status in fs.listStatus(path):
        at = status.getPath()
        found.append(Entry(at.toString(), at.getName(), status.isDirectory(), status.getLen(), status.getModificationTime()))
    return found


def entries(spark: SparkSession, location: str) -> list[tuple[str, bool]]:
    """(name, is_folder) of everything directly below ``location``."""
    return [(e.name, e.is_folder) for e in listing(spark, location)]


def replace_folders(spark: SparkSession, source: str, target: str, folders: Iterable[str]) -> None:
    """Put each of the relative ``folders`` of ``source`` in the place of its namesake in ``target``.

    One that ``source`` lacks is taken away. Every folder changes by a removal and a move, which is not
    one step, and other folders may be done before one fails; doing it all again makes it right.
    """
    fs, _ = _file_system(spark, target)
    at = spark._jvm.org.apache.hadoop.fs.Path

    def swap(folder: str) -> None:
        new, old = at(f"{source}/{folder}"), at(f"{target}/{folder}")
        if fs.exists(old):
            fs.delete(old, True)
        if fs.exists(new):
            fs.mkdirs(old.getParent())
            if not fs.rename(new, old):
                raise OSError(f"could not move {new.toString()} to {old.toString()}")

    with ThreadPoolExecutor(THREADS) as pool:
        for _ in pool.map(swap, folders):
            pass


def remove(spark: SparkSession, location: str) -> None:
    fs, path = _file_system(spark, location)
    fs.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, path = _file_system(spark, source)
    if not fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not move {source} to {target}")


def create_empty(spark: SparkSession, location: str) -> None:
    """A file of zero bytes."""
    fs, path = _file_system(spark, location)
    fs.create(path, True).close()


def create_once(spark: SparkSession, location: str, text: str) -> bool:
    """Write a small file unless there is one; whether it was written. One call of the file system."""
    fs, path = _file_system(spark, location)
    try:
        out = fs.create(path, False)
    except Py4JJavaError as error:
        if not fs.exists(path):
            raise OSError(f"could not create {location}") from error
        return False
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, location: str) -> tuple[str, float] | None:
    """The text of a small file and its time in seconds; None where there is none any more."""
    fs, path = _file_system(spark, location)
    try:
        at = fs.getFileStatus(path).getModificationTime() / 1000
        stream = fs.open(path)
        try:
            return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode(), at
        finally:
            stream.close()
    except Py4JJavaError:
        return None


def move_into(spark: SparkSession, source: str, target: str) -> None:
    """``move`` to a place whose folder may not be there yet."""
    fs, path = _file_system(spark, target)
    fs.mkdirs(path.getParent())
    move(spark, source, target)


def make_folder(spark: SparkSession, location: str) -> None:
    fs, path = _file_system(spark, location)
    fs.mkdirs(path)


def partition_value(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it into a folder name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
