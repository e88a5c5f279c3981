"""What the document operators share: the table, defined texts, staging, and sizes derived from the data."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens.session import delete_path, new_folder

SPACE = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


ROOT = Path(__file__).parents[2]


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Make the package importable in the Python workers, unless their search path holds it already.

    Workers then import it once and keep its word caches between tasks. Batches sent to them are kept small in bytes,
    since some texts are very long.
    """
    context = spark.sparkContext
    if int(spark.conf.get(ARROW_BYTES).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))
    on_path = str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if (on_path and context.master.startswith("local")) or getattr(context, "_matchlens_shipped", False):
        return
    # Executors fetch the archive from the driver when their first task starts, so it stays until the end.
    folder = tempfile.mkdtemp(prefix="matchlens-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(ROOT / "matchlens", f"{folder}/copy/matchlens", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/matchlens", "zip", f"{folder}/copy"))
    context._matchlens_shipped = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """A text in which null means empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def spread(rows: int, per_group: int) -> int:
    """How many groups of about ``per_group`` rows hold ``rows`` rows."""
    return max(1, -(-rows // per_group))


def give_back() -> None:
    """Return to the system what this Python worker no longer uses; workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work`` for mapInArrow that leaves a small worker behind when the task ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


SIEVE_BITS = 1 << 25


def sieve(keys: DataFrame, column: str) -> DataFrame:
    """A bitmap of the hashes of ``column``: at most 1,024 rows of 4 KB, whatever the number of keys."""
    slot = F.pmod(F.xxhash64(column), F.lit(SIEVE_BITS))
    bits = keys.groupBy(F.bitmap_bucket_number(slot).alias("__bucket"))
    return bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("__bits"))


def maybe_in(df: DataFrame, column: str, bitmap: DataFrame) -> DataFrame:
    """``df`` with ``__maybe``: false only where no key of the ``sieve`` equals ``column``.

    Its bounded size allows the broadcast, and rows that are surely not wanted need no shuffle. With far more keys than
    bits everything may be in, and the exact join that follows does all the work.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(SIEVE_BITS))
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.expr("substring(__bits, CAST(__place div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("shiftright(__byte, CAST(__place % 8 AS INT)) & 1") == 1
    tried = df.withColumn("__bucket", F.bitmap_bucket_number(slot)).withColumn("__place", place)
    tried = tried.join(F.broadcast(bitmap), "__bucket", "left").withColumn("__byte", byte)
    return tried.withColumn("__maybe", F.coalesce(bit, F.lit(False))).drop("__bucket", "__place", "__bits", "__byte")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a scan of it.

    The shuffle files of the write are deleted with it, so a job of many steps needs the disk of one.
    """
    spark = df.sparkSession
    path, before = new_folder(spark, label), spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def drop(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        delete_path(df.sparkSession, df._staged_at)


__all__ = [
    "BLANKS", "SPACE", "documents", "drop", "give_back", "id_crc", "lean", "maybe_in", "ship", "sieve", "spread", "stage", "text_of",
]
