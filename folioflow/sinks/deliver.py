"""Delivery: a run writes into its own folder, checks come before it, earlier outputs are archived and not overwritten."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.check import Policy, gate
from ..schemas import SCHEMAS
from . import committed


class Run:
    """One run of a pipeline: its id, its folder and its entries in the ledger."""

    def __init__(self, spark: SparkSession, base: str, pipeline: str, dry: bool = False, **params: str):
        self.spark, self.base, self.pipeline, self.dry = spark, base.rstrip("/"), pipeline, dry
        self.id = uuid.uuid4().hex
        self.started, self.params = datetime.now(UTC).replace(tzinfo=None), {k: str(v) for k, v in params.items()}

    def path(self, name: str) -> str:
        return f"{self.base}/{self.pipeline}/{self.id}/{name}"

    def record(self, state: str) -> None:
        """An entry in the ledger; a dry run leaves none. A run without the state done is no result."""
        if not self.dry:
            row = [(self.id, self.pipeline, self.started, state, self.params)]
            self.spark.createDataFrame(row, SCHEMAS["ledger"]).write.mode("append").parquet(f"{self.base}/ledger")

    def deliver(self, outputs: dict[str, DataFrame], found: DataFrame, policy: Policy, form: str = "parquet", order: dict[str, list[str]] | None = None, by: dict[str, list[str]] | None = None) -> int:
        """Gate first, then write every output into this run's folder; the number of findings. A dry run only gates.

        order: columns that an output is sorted by, such as the source's own order; by: columns whose values get a
        folder each (sorted by order inside), so that a reader of one of them touches no other.
        """
        self.record("started")
        n = gate(found, policy)
        if not self.dry:
            for name, df in outputs.items():
                keys, sort = (by or {}).get(name, []), (order or {}).get(name, [])
                if keys:  # dealt by key and order, so a large key's folder is written by several tasks
                    df = df.repartitionByRange(*keys, *sort).sortWithinPartitions(*keys, *sort)
                elif sort:
                    df = df.orderBy(*sort)
                writer = df.write.mode("errorifexists")
                writer = writer.partitionBy(*keys) if keys else writer
                (writer.option("header", "true").csv if form == "csv" else writer.json if form == "json" else writer.parquet)(self.path(name))
            found.write.mode("errorifexists").json(self.path("findings"))
            self.record("done")
        return n


def done_runs(spark: SparkSession, base: str, pipeline: str) -> DataFrame:
    """Finished runs of a pipeline, from the ledger."""
    ledger = spark.read.schema(SCHEMAS["ledger"]).parquet(f"{base.rstrip('/')}/ledger")
    return ledger.filter((F.col("pipeline") == pipeline) & (F.col("state") == "done"))


def archive(spark: SparkSession, path: str, archive_dir: str) -> str | None:
    """Move an earlier output into the archive before new work begins; nothing if there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old = jvm.org.apache.hadoop.fs.Path(path)
    fs = old.getFileSystem(conf)
    if not fs.exists(old):
        return None
    folder = jvm.org.apache.hadoop.fs.Path(archive_dir)
    fs.mkdirs(folder)
    new = jvm.org.apache.hadoop.fs.Path(folder, f"{old.getName()}-{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}")
    if not fs.rename(old, new):
        raise OSError(f"{path} can't be archived")
    return new.toString()


def pending_lines(found: DataFrame) -> DataFrame:
    """Findings as lines of text for a pending list."""
    return found.select(F.concat_ws(" | ", "stage", "severity", "entity", "code", "reason").alias("value"))


def source_records(fields: DataFrame) -> DataFrame:
    """A JSON record for each case: every field with value, source and basis."""
    item = F.struct("entity", "ordinal", "field", "value", "source", "basis", "status")
    return fields.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("entity", "ordinal", "field", F.to_json(item).alias("json")))).alias("r")).select(
        "case_id", F.concat(F.lit("["), F.array_join(F.transform("r", lambda x: x["json"]), ","), F.lit("]")).alias("record")
    )


def batch_record(batch: DataFrame) -> DataFrame:
    """batch_id and the batch as one JSON object."""
    return batch.select("batch_id", F.to_json(F.struct(*SCHEMAS["batch"].fieldNames()), {"dateFormat": "yyyy-MM-dd"}).alias("record"))


def manifest(outputs: list[str]) -> str:
    """A delivery list as JSON."""
    return json.dumps({"files": sorted(outputs)}, ensure_ascii=False)


def zip_folder(spark: SparkSession, folder: str, target: str, archive: str = "delivery.zip") -> list[str]:
    """One ZIP of the files of a folder, delivered into the folder target by a task; the names in it, sorted. Contents don't
    pass through the driver, which sees names only."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    top = f"{folder.rstrip('/').rsplit('/', 1)[-1]}/"
    own = found.select(F.lit(archive).alias("archive"), F.substring_index("path", top, -1).alias("name"), "content")
    committed.zips(own, target)
    return sorted(r["name"] for r in own.select("name").collect())
