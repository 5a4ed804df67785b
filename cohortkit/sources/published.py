"""Tables that are replaced as a whole: staged first, then put in place or recorded.

``replace_folder`` puts a folder written elsewhere in the place of the old one. ``publish``
keeps versions side by side; a reader follows the latest commit record, so it sees the
old version or the new one and never a part of either.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_COMMITS = "_commits"
_FORMER = "_former-"


class _Files:
    """The file system of a path, whichever it is."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        parent = self._path(new).getParent()
        if parent is not None:
            self.fs.mkdirs(parent)
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self._path(folder)))

    def create(self, path: str, text: str) -> bool:
        """Write a file that must not be there yet; False if it is."""
        try:
            out = self.fs.create(self._path(path), False)
        except Py4JJavaError as error:
            if self.exists(path):
                return False
            raise error
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()


def _write(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str) -> None:
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(path)


def _beside(target: str, prefix: str, name: str | None = None) -> str:
    """A folder in the one that holds ``target``, named after it or as given."""
    parent, slash, own = target.rstrip("/").rpartition("/")
    return f"{parent}{slash}{prefix}{name or own}"


def recover(spark: SparkSession, target: str) -> None:
    """Finish or take back an exchange of folders that was interrupted."""
    files, former = _Files(spark, target), _beside(target, _FORMER)
    if files.exists(former):
        if files.exists(target):
            files.delete(former)
        else:
            files.rename(former, target)


def replace_folder(spark: SparkSession, target: str, write: Callable[[str], None]) -> None:
    """Put what ``write(path)`` writes in the place of the folder ``target``.

    It is written beside the old folder first. A write that fails half-way leaves the old
    folder as it was; an exchange that is interrupted is mended by the next one, or by
    ``recover``.
    """
    files = _Files(spark, target)
    staged, former = _beside(target, "_staged-", uuid.uuid4().hex), _beside(target, _FORMER)
    try:
        write(staged)
    except BaseException:
        files.delete(staged)
        raise
    recover(spark, target)
    if files.exists(target):
        files.rename(target, former)
    files.rename(staged, target)
    files.delete(former)


def commits(spark: SparkSession, path: str, name: str) -> list[dict]:
    """The commit records of a published table, oldest first."""
    folder = f"{path.rstrip('/')}/{name}/{_COMMITS}"
    files = _Files(spark, path)
    found = []
    for file in files.names(folder):
        text = files.read(f"{folder}/{file}") if file.endswith(".json") else ""
        if text:  # an empty record is one that is being written
            found.append(json.loads(text))
    return found


def publish(
    df: DataFrame, path: str, name: str, partition_by: Sequence[str] = ("split",), fmt: str = "parquet", note: str = ""
) -> int:
    """Write a new version of the table and commit it; returns its number.

    The version's files are written first, to a folder no reader looks at. The commit is one
    small file that must not exist yet, so of two writers one takes the next number.
    """
    spark = df.sparkSession
    base, files = f"{path.rstrip('/')}/{name}", _Files(spark, path)
    folder = f"_version-{uuid.uuid4().hex}"
    try:
        _write(df, f"{base}/{folder}", partition_by, fmt)
    except BaseException:
        files.delete(f"{base}/{folder}")
        raise
    version = max((c["version"] for c in commits(spark, path, name)), default=0)
    while True:
        version += 1
        record = {"version": version, "folder": folder, "fmt": fmt, "schema": df.schema.json(), "note": note}
        if files.create(f"{base}/{_COMMITS}/{version:09d}.json", json.dumps(record)):
            return version


def read_published(spark: SparkSession, path: str, name: str, version: int | None = None) -> DataFrame:
    """The latest committed version of a table, or the given one."""
    found = [c for c in commits(spark, path, name) if version in (None, c["version"])]
    if not found:
        raise ValueError(f"no {'' if version is None else f'version {version} of '}published table '{name}' in {path}")
    record = found[-1]
    reader = spark.read.schema(T.StructType.fromJson(json.loads(record["schema"]))).option("header", True)
    return reader.format(record["fmt"]).load(f"{path.rstrip('/')}/{name}/{record['folder']}")


def vacuum(spark: SparkSession, path: str, name: str, keep: int = 2) -> list[str]:
    """Delete version folders but those of the last ``keep`` commits; returns their names.

    A version that is still being written has no commit yet and would go too: call it when
    no writer is at work.
    """
    if keep < 1:
        raise ValueError("at least one version must stay")
    base, files = f"{path.rstrip('/')}/{name}", _Files(spark, path)
    held = commits(spark, path, name)
    stay = {c["folder"] for c in held[-keep:]}
    gone = [f for f in files.names(base) if f.startswith("_version-") and f not in stay]
    for c in held[:-keep]:
        files.delete(f"{base}/{_COMMITS}/{c['version']:09d}.json")
    for f in gone:
        files.delete(f"{base}/{f}")
    return gone
