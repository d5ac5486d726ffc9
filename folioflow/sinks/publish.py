"""Published tables: staged, verified, then swapped in by one pointer, so readers see the whole old or the whole new.

A publication's tables are written into the run's own folder. What is verified is read back from there. The swap is
the creation of the next pointer (NAME/pointers/00000007), which exists only once: a run that began from an older
version than the latest finds it taken and is refused, with nothing of it left. Readers take the greatest pointer that
is whole. Only after a swap are runs of older pointers cleaned up, beyond those kept; staged runs of others aren't touched.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..filesystem import reached
from ..operators.check import Policy, gate
from .deliver import Run

DIGITS = 8


class Overtaken(RuntimeError):
    """Another run was published since this one began."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def _create_new(spark: SparkSession, path: str, content: bytes) -> bool:
    """Create a file if it isn't there, as one step; False if it is. Hadoop's local file system tests first and creates
    then, so local files are opened exclusively instead."""
    fs, at = _fs(spark, path)
    if fs.getScheme() == "file":
        _, inner, _ = reached(path)
        fs.mkdirs(at.getParent())
        try:
            with open(inner, "xb") as out:
                out.write(content)
        except FileExistsError:
            return False
        return True
    try:
        stream = fs.create(at, False)
    except Exception:  # noqa: BLE001  the file system's own class of error; whether it is there tells the reason
        if fs.exists(at):
            return False
        raise
    stream.write(bytearray(content))
    stream.close()
    return True


def pointers(spark: SparkSession, base: str, name: str) -> dict[int, dict | None]:
    """Version -> what its pointer says; None for one that isn't whole (its writer was lost: the number is used up)."""
    fs, at = _fs(spark, f"{base.rstrip('/')}/{name}/pointers")
    if not fs.exists(at):
        return {}
    out: dict[int, dict | None] = {}
    for status in fs.listStatus(at):
        label = status.getPath().getName()
        if not label.isdigit():
            continue
        stream = fs.open(status.getPath())
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            out[int(label)] = json.loads(text)
        except ValueError:
            out[int(label)] = None
    return out


def version(spark: SparkSession, base: str, name: str) -> int:
    """The greatest version number that was ever taken; 0 before any."""
    return max(pointers(spark, base, name), default=0)


def read(spark: SparkSession, base: str, name: str, table: str, at: int | None = None) -> DataFrame:
    """A table as published last, or at a version that is still kept."""
    whole = {v: p for v, p in pointers(spark, base, name).items() if p}
    if not whole or (at is not None and at not in whole):
        raise LookupError(f"{name} has no version {'yet' if at is None else at}")
    return spark.read.parquet(f"{base.rstrip('/')}/{name}/{whole[max(whole) if at is None else at]['run']}/{table}")


class Publication:
    """One attempt to publish: its base version is the latest when it is made."""

    def __init__(self, spark: SparkSession, base: str, name: str, **params: str):
        self.spark, self.base, self.name = spark, base.rstrip("/"), name
        self.run = Run(spark, base, name, **params)
        self.version = version(spark, self.base, name)
        self.tables: dict[str, DataFrame] = {}

    def stage(self, outputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write the outputs into the run's folder; they come back as read from there."""
        self.run.record("started")
        for table, df in outputs.items():
            df.write.mode("errorifexists").parquet(self.run.path(table))
            self.tables[table] = self.spark.read.schema(df.schema).parquet(self.run.path(table))
        return self.tables

    def drop(self, state: str) -> None:
        """Leave nothing of this attempt but its entry in the ledger."""
        _delete(self.spark, self.run.path("").rstrip("/"))
        self.run.record(state)

    def swap(self, keep: int = 2) -> int:
        """Publish what was staged; the version. Overtaken if another run was published since this one began."""
        new = self.version + 1
        path = f"{self.base}/{self.name}/pointers/{new:0{DIGITS}d}"
        said = json.dumps({"run": self.run.id, "tables": sorted(self.tables)}).encode()
        if not _create_new(self.spark, path, said):
            self.drop("overtaken")
            raise Overtaken(f"{self.name}: version {new} is taken")
        self.run.record("done")
        self._clean(new, keep)
        return new

    def _clean(self, new: int, keep: int) -> None:
        found = pointers(self.spark, self.base, self.name)
        whole = sorted((v for v in found if found[v] and v <= new), reverse=True)
        for v in whole[keep:]:
            _delete(self.spark, f"{self.base}/{self.name}/{found[v]['run']}")
            _delete(self.spark, f"{self.base}/{self.name}/pointers/{v:0{DIGITS}d}")


def publish(spark: SparkSession, base: str, name: str, outputs: dict[str, DataFrame], verify: Callable[[dict[str, DataFrame]], DataFrame], policy: Policy = Policy.ABORT, keep: int = 2, **params: str) -> int:
    """Stage, verify, swap, clean up; the version. verify gives findings of the staged tables, which the policy judges.

    Outputs that fail it, and runs that are overtaken, leave the published version as it was.
    """
    new = Publication(spark, base, name, **params)
    try:
        gate(verify(new.stage(outputs)), policy)
    except Exception:
        new.drop("failed")
        raise
    return new.swap(keep)
