"""What the operators of this package share: table reading, shared storage, Arrow helpers."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a session without that setting (a local test) gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(named)
    return named


def stored(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Writes a table into the shared folder and reads it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Lets finished queries drop their shuffle files now rather than at some later collection."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


#: Bytes of an Arrow batch on its way to a Python worker, beside Spark's limit of rows, where the session names none.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, so that long texts don't make large batches."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Returns this worker's free memory to the system; Spark's Python workers live on from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


@functools.cache
def thrifty() -> None:
    """From now on this process maps large arrays apart, so that each goes back to the system when it is freed.

    Else the C library raises its limit with each array freed, and later ones stay in its heap between small objects.
    """
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    except (OSError, AttributeError):  # another C library
        pass


def lean(f: Callable) -> Callable:
    """A function from batches to batches that gives its memory back when its task ends."""

    @functools.wraps(f)
    def run(batches: Iterator[pa.RecordBatch], *args, **kwargs) -> Iterator[pa.RecordBatch]:
        yield from f(batches, *args, **kwargs)
        give_back()

    return run


def filtered(df: DataFrame, keeps: Callable) -> DataFrame:
    """The rows for which ``keeps(texts)`` is true, with all their columns; each row travels once.

    ``keeps`` gets an iterator of lists of texts and yields a list of booleans for each.
    """
    small_batches(df.sparkSession)
    at = [c.lower() for c in df.columns].index("text")
    return df.mapInArrow(functools.partial(_filtered, keeps=keeps, at=at), df.schema)


@lean
def _filtered(batches: Iterator[pa.RecordBatch], keeps: Callable, at: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def texts() -> Iterator[list[str | None]]:
        for b in batches:
            held.append(b)
            yield b.column(at).to_pylist()

    for stay in keeps(texts()):
        yield held.pop().filter(pa.array(stay, pa.bool_()))


#: Keys that are joined by broadcast because very many rows have them, at most.
HEAVY = 10_000


def spread_join(rows: DataFrame, table: DataFrame, key: str, weight: str, least: int = 1000) -> DataFrame:
    """rows joined with a stored table of one row per key; no task gets all rows of a frequent key.

    ``weight`` counts a key's rows.  Keys above one part in ``HEAVY`` of all are fewer than ``HEAVY``:
    they are broadcast, the others joined by a shuffle.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) > max(least, total // HEAVY)
    few = rows.join(F.broadcast(table.where(heavy).select(key)), key, "left_anti").join(table.where(~heavy), key)
    return few.unionByName(rows.join(F.broadcast(table.where(heavy)), key).select(few.columns))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores behind it as long as the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null texts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows in tables of about ``most`` bytes of ``text``, in order; a longer text is a table of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        lengths = pc.fill_null(pc.binary_length(b["text"]), 0).to_pylist()
        first = 0
        for i, n in enumerate(lengths):
            if size and size + n > most:
                held.append(b.slice(first, i - first))
                yield pa.Table.from_batches([x for x in held if x.num_rows])
                held, size, first = [], 0, i
            size += n + 64
        held.append(b.slice(first))
    held = [x for x in held if x.num_rows]
    if held:
        yield pa.Table.from_batches(held)


def crc_mod(doc_id: str, n: int):
    """crc32 of the id written as text, modulo n."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(n)
