"""Datasets of a lake folder: ``curated/<name>`` first, then ``derived/<name>``."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("curated", "derived")


@dataclass(frozen=True)
class Lake:
    """Finds, scans and writes datasets through Spark's file systems, so any store it reads will do."""

    spark: SparkSession
    root: str

    def _has(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p))

    def find(self, name: str) -> str | None:
        return next((p for layer in LAYERS if self._has(p := f"{self.root}/{layer}/{name}")), None)

    def optional(self, name: str) -> DataFrame | None:
        """The dataset with columns united by name, or None."""
        path = self.find(name)
        return None if path is None else self.scan(path)

    def require(self, name: str) -> DataFrame:
        df = self.optional(name)
        if df is None:
            raise FileNotFoundError(f"{name} is neither in {' nor in '.join(LAYERS)} of {self.root}")
        return df

    def scan(self, path: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)

    def manifest(self, name: str) -> DataFrame:
        """Path, bytes and SHA-256 of each file of a dataset; the set's digest is over them in path order."""
        path = self.find(name)
        if path is None:
            return self.spark.createDataFrame([], "path string, length long, sha256 string")
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
        return files.select("path", "length", F.sha2("content", 256).alias("sha256"))

    def write(self, df: DataFrame, name: str, layer: str = "derived", by: str | None = None, rows_per_file: int = 0) -> str:
        path = f"{self.root}/{layer}/{name}"
        w = df.write.mode("overwrite")
        if rows_per_file:
            w = w.option("maxRecordsPerFile", rows_per_file)
        (w.partitionBy(by) if by else w).parquet(path)
        return path

    def write_report(self, df: DataFrame, name: str) -> str:
        path = f"{self.root}/reports/{name}"
        df.coalesce(1).write.mode("overwrite").json(path)
        return path

    def read_report(self, name: str) -> DataFrame:
        return self.spark.read.json(f"{self.root}/reports/{name}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes an intermediate table into the folder that the cluster shares (``spark.checkpoint.dir``) and reads it back.

    Only a session without that setting (a local one) gets a temporary folder.
    """
    path = _place(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, label: str) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared}/{label}-{uuid.uuid4().hex}"


def bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """Stores a table in that many buckets by a key: joins, windows and unions by it need no exchange afterwards."""
    path = _place(df.sparkSession, label)
    name = path.rpartition("/")[2].replace("-", "_")
    df.repartition(buckets, key).sortWithinPartitions(key).write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def dataset_digest(manifest: DataFrame) -> DataFrame:
    """One digest of a dataset's files, in path order (one row per file reaches the aggregate)."""
    lines = F.array_sort(F.collect_list(F.concat_ws("|", "path", F.col("length").cast("string"), "sha256")))
    return manifest.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.sha2(F.array_join(lines, "\n"), 256).alias("digest"))


def date_chunks(spark: SparkSession, start: dt.date, end: dt.date, days: int) -> DataFrame:
    """Consecutive [chunk_start, chunk_end] of at most ``days`` days; one chunk if days is 0 or less."""
    whole = spark.createDataFrame([(start, end)], "s date, e date").where("s <= e")
    if days <= 0:
        return whole.select(F.col("s").alias("chunk_start"), F.col("e").alias("chunk_end"))
    starts = whole.select(F.explode(F.sequence("s", "e", F.make_dt_interval(days=F.lit(days)))).alias("chunk_start"), "e")
    return starts.select("chunk_start", F.least(F.date_add("chunk_start", days - 1), F.col("e")).alias("chunk_end"))


def bisect_on_failure(fetch, start: dt.date, end: dt.date) -> list:
    """fetch(start, end) for the range, halving it where that raises; a single failing day raises."""
    try:
        return [fetch(start, end)]
    except Exception:
        if start >= end:
            raise
        half = start + (end - start) // 2
        return bisect_on_failure(fetch, start, half) + bisect_on_failure(fetch, half + dt.timedelta(days=1), end)
