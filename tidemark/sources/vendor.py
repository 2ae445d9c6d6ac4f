"""Pulls from a vendor: retries, cursors, pages, month-end snapshots, shards and jobs.

A caller brings the function that talks to the vendor; it runs on the executors, one shard of
securities per task.  A security that fails to the end gives a row with the error, so nothing is
lost without a trace.
"""

from __future__ import annotations

import functools
import subprocess
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.sources import Lake


class VendorError(RuntimeError):
    """The vendor answered with an error code."""


@dataclass(frozen=True)
class Retry:
    """``tries`` in all; before the k-th repetition a pause of ``k * pause`` seconds."""

    tries: int = 3
    pause: float = 1.5
    sleep: Callable[[float], None] = time.sleep

    def __call__(self, call: Callable, *args):
        for k in range(1, self.tries):
            try:
                return call(*args)
            except Exception:
                self.sleep(k * self.pause)
        return call(*args)


def cursor_rows(answer) -> Iterator[dict]:
    """Rows of a result set with ``fields``, ``next()``, ``get_row_data()`` and an ``error_code`` that is '0' while all is well."""

    def check() -> None:
        if str(answer.error_code) != "0":
            raise VendorError(f"{answer.error_code}: {getattr(answer, 'error_msg', '')}")

    check()
    while answer.next():
        yield dict(zip(answer.fields, answer.get_row_data(), strict=True))
        check()
    check()


def paged(fetch: Callable[[int], tuple[Iterable[dict], int]]) -> Iterator[dict]:
    """Rows of pages 1, 2, ...; ``fetch`` gives a page and how many there are.

    Ends with the last page even if the vendor would go on answering, and with an empty page even if
    it claims that there are more.
    """
    page, pages = 1, 1
    while page <= pages:
        rows, pages = fetch(page)
        rows = list(rows)
        if not rows:
            return
        yield from rows
        page += 1


def _pull(batches: Iterator[pa.RecordBatch], fetch: Callable, retry: Retry, schema: pa.Schema, key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for code in batch[key].to_pylist():
            try:
                rows = [{**row, key: code, "pull_error": None} for row in retry(lambda c: list(fetch(c)), code)]
            except Exception as error:
                rows = [{key: code, "pull_error": f"{type(error).__name__}: {error}"}]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def pull(securities: DataFrame, fetch: Callable[[str], Iterable[dict]], schema: StructType, key: str = "code", shards: int = 4, retry: Retry = Retry()) -> DataFrame:
    """Rows of each distinct security, and one row with ``pull_error`` for each that failed to the end; a shard is a task.

    Securities without code are not asked for; one without rows gives none.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    whole = StructType([*schema.fields]).add("pull_error", StringType())
    asked = securities.select(key).where(F.col(key).isNotNull()).distinct().repartition(shards, key)
    return asked.mapInArrow(functools.partial(_pull, fetch=fetch, retry=retry, schema=to_arrow_schema(whole), key=key), whole)


def month_end_snapshots(rows: DataFrame, date: str) -> DataFrame:
    """The rows of the last date of each month that has any."""
    last = Window.partitionBy(F.trunc(date, "month"))
    dates = rows.select(date).distinct().withColumn("_last", F.max(date).over(last)).where(F.col(date) == F.col("_last"))
    return rows.join(F.broadcast(dates.select(date)), date, "left_semi")  # a date a month


def flush_shards(lake: Lake, rows: DataFrame, name: str, key: str, date: str, shards: int, rows_per_file: int) -> tuple[DataFrame, DataFrame]:
    """Writes rows by shard of the key in files of bounded length; audit of each shard and digests of all files.

    The audit is of what was written: rows, keys, first and last date, and duplicates of key and date.
    """
    shard = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(shards)).cast("int")
    path = lake.write(rows.withColumn("shard", F.coalesce(shard, F.lit(0))).repartition(shards, "shard"), name, by="shard", rows_per_file=rows_per_file)
    told = lake.spark.read.parquet(path)
    per_key = told.groupBy("shard", key, date).agg(F.count("*").alias("n"))
    audit = per_key.groupBy("shard").agg(
        F.sum("n").alias("rows"), F.count_distinct(key).alias("keys"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        F.sum(F.col("n") - 1).alias("duplicates"),
    )
    return audit, lake.manifest(name)


@dataclass(frozen=True)
class Job:
    """A command of a backfill; a required one that fails ends the run."""

    name: str
    command: tuple[str, ...]
    required: bool = True
    timeout: float = 7200.0


def run_jobs(jobs: Iterable[Job]) -> list[dict]:
    """Runs jobs in order: name, required, return code (None: timed out or not found), seconds and the end of the output."""
    done = []
    for job in jobs:
        start = time.monotonic()
        try:
            out = subprocess.run(job.command, capture_output=True, text=True, timeout=job.timeout, check=False)
            code, tail = out.returncode, (out.stdout + out.stderr)[-2000:]
        except (subprocess.TimeoutExpired, OSError) as error:
            code, tail = None, str(error)
        done.append({"name": job.name, "required": job.required, "code": code, "seconds": round(time.monotonic() - start, 3), "tail": tail})
        if code != 0 and job.required:
            break
    return done


def bootstrap_passed(done: list[dict], rows: dict[str, int], critical: Iterable[str]) -> bool:
    """All required jobs ended well and every critical dataset has rows."""
    return all(d["code"] == 0 for d in done if d["required"]) and all(rows.get(name, 0) > 0 for name in critical)
