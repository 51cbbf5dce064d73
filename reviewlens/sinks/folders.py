"""Folders put in place whole: written aside, then renamed, never copied."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType


class Folders:
    """The file system of a path, through which folders are looked up, renamed and removed."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names of what lies in a folder; none if it is not there."""
        return [s.getPath().getName() for s in self._system.listStatus(self._path(path))] if self.exists(path) else []

    def remove(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        self._system.mkdirs(self._path(target).getParent())
        if not self._system.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} could not be renamed to {target}")


def _aside(path: str, kind: str) -> str:
    """A sibling that readers of the parent folder skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{kind}"


def current(spark: SparkSession, path: str) -> str:
    """Where the newest whole version of a folder lies: at ``path``, or beside it if the last replacement
    was cut off between its two renames."""
    folders, previous = Folders(spark, path), _aside(path, "previous")
    return previous if not folders.exists(path) and folders.exists(previous) else path


def put_in_place(spark: SparkSession, attempt: str, path: str) -> None:
    """Make the folder ``attempt`` the new version of ``path``.

    The old version is renamed away and the new one into its place; then the old one is removed. Cut off at
    any point, one of the two is whole at ``path`` or where ``current`` finds it.
    """
    folders, previous = Folders(spark, path), _aside(path, "previous")
    if folders.exists(path):
        if folders.exists(previous):
            folders.remove(previous)
        folders.move(path, previous)
    folders.move(attempt, path)
    folders.remove(previous)


def replace(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> None:
    """Write a new version of a folder once, aside, and put it in place. A write that fails changes nothing."""
    attempt = _aside(path, f"attempt-{uuid.uuid4().hex}")
    try:
        write(df, attempt)
    except Exception:
        Folders(df.sparkSession, path).remove(attempt)
        raise
    put_in_place(df.sparkSession, attempt, path)


def write_parts(
    lines: DataFrame, targets: Mapping[str, str], compression: str | None = None
) -> dict[str, int]:
    """Rows (part, line) as text files, each part at its own target, by one job over one scan.

    Returns the number of lines of each part; a part without lines leaves its target as it is.
    """
    spark = lines.sparkSession
    seen = Observation("parts")
    watched = lines.observe(seen, *[F.count_if(F.col("part") == name).alias(name) for name in targets])
    attempt = _aside(next(iter(targets.values())), f"parts-{uuid.uuid4().hex}")
    writer = watched.select("part", "line").write.partitionBy("part")
    if compression:
        writer = writer.option("compression", compression)
    folders = Folders(spark, attempt)
    try:
        writer.text(attempt)
        counts = {name: seen.get[name] for name in targets}
        for name, target in targets.items():
            if counts[name]:
                put_in_place(spark, f"{attempt}/part={name}", target)
    finally:
        folders.remove(attempt)
    return counts


def unfit(df: DataFrame) -> Column:
    """Why a row has no JSON form: the names of its columns that hold text that is not UTF-8; else null."""

    def broken(value: Column, kind) -> Column | None:
        if isinstance(kind, StringType):
            return ~F.is_valid_utf8(value)
        if isinstance(kind, ArrayType) and broken(value, kind.elementType) is not None:
            return F.exists(value, lambda x: F.coalesce(broken(x, kind.elementType), F.lit(False)))
        if isinstance(kind, MapType):
            keys = broken(F.map_keys(value), ArrayType(kind.keyType))
            values = broken(F.map_values(value), ArrayType(kind.valueType))
            found = [F.coalesce(test, F.lit(False)) for test in (keys, values) if test is not None]
            return found[0] | found[-1] if found else None
        if isinstance(kind, StructType):
            found = [broken(value[f.name], f.dataType) for f in kind.fields]
            found = [F.coalesce(test, F.lit(False)) for test in found if test is not None]
            return F.array_contains(F.array(*found), True) if found else None
        return None

    tests = {f.name: broken(F.col(f.name), f.dataType) for f in df.schema.fields}
    names = [F.when(test, F.lit(name)) for name, test in tests.items() if test is not None]
    return F.nullif(F.concat_ws(", ", *names), F.lit("")) if names else F.lit(None).cast("string")
