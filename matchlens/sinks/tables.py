"""Keyed tables as Parquet: append per micro-batch, upsert per partition, and small snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlens import schema as S
from matchlens.operators.keyed import newest_rows
from matchlens.session import delete_path, folder_names, path_exists, stage

# Written by streams: every micro-batch adds its own folder and readers take the newest row per key.
STREAM_TABLES = ("hero_win_rate", "region_num_of_players", "player_match", "daily_player")
# Stream tables number the folder of micro-batch n as n times this. Compaction uses the numbers between: one each time, and
# only once a newer micro-batch has come or when an interrupted run is repeated.
BATCH_STEP = 1000
# The newest micro-batch in a folder; merged folders count as the newest one they hold.
MICRO_BATCH = f"batch div {BATCH_STEP} * {BATCH_STEP}"
# Tables keyed by it get a Parquet bloom filter on it, for lookups of one key over all days.
BLOOM_COLUMN = "account_id"


class Tables:
    """The keyed tables under one root folder.

    Two layouts give the same meaning, "a later row replaces an earlier one of its key":

    * Stream tables keep one ``batch=`` folder per micro-batch below the date folders. Writing a
      batch touches no earlier file, and a repeated batch overwrites its own folder only.
    * Batch tables hold one row per key. An upsert merges the touched partitions in a staged copy
      and then replaces just those partitions.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, where: Column | None = None) -> DataFrame:
        """One row per key, optionally filtered; filters on date columns prune partitions.

        ``where`` may only use partition or key columns: it is applied before the newest row of each
        key is chosen.
        """
        table = S.TABLES[name]
        rows = self._scan(name)
        if where is not None:
            rows = rows.where(where)
        if name in STREAM_TABLES:
            rows = newest_rows(rows, table.key, ["batch"])
        return rows.select(*table.schema.fieldNames())

    def dates(self, name: str) -> DataFrame:
        """Distinct dates present in a table partitioned by day."""
        return self._scan(name).select("year", "month", "day").distinct()

    def newest_batches(self, name: str) -> DataFrame:
        """Dates present in a stream table with the newest micro-batch of each, as numbered folder; no data column is read.

        Compacted folders count as the newest micro-batch they hold: merging brings no newer rows.
        """
        return self._scan(name).groupBy("year", "month", "day").agg(F.max(F.expr(MICRO_BATCH)).alias("batch"))

    def read_batches(self, name: str, where: Column) -> DataFrame:
        """The rows of a stream table as they came, replaced ones included, with the number of their folder (``batch``)."""
        return self._scan(name).where(where)

    def _scan(self, name: str) -> DataFrame:
        table = S.TABLES[name]
        schema = table.schema
        if name in STREAM_TABLES:
            schema = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        if not path_exists(self.spark, self.path(name)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def append(self, name: str, rows: DataFrame, batch_id: int) -> None:
        """Add a micro-batch, holding at most one row per key, to a stream table."""
        table = S.TABLES[name]
        typed = _conform(rows, table).withColumn("batch", F.lit(batch_id * BATCH_STEP).cast("bigint"))
        self._write(typed, name, (*table.partition_by, "batch"))

    def compact(self, name: str, where: Column) -> None:
        """Merge the micro-batch folders of each selected day of a stream table into one.

        The merged rows go to a new folder that ranks just above the newest one read; only then are the
        folders that were read deleted. A reader that lists the folders meanwhile finds all rows; one that has listed
        them before must list them again. Micro-batches may be appended meanwhile. ``where`` may only use date columns.
        """
        table = S.TABLES[name]
        date = list(table.partition_by)
        rows = self._scan(name).where(where)
        # Folder names only: days times micro-batches since the last compaction.
        by_day: dict[tuple, list[int]] = {}
        for *day, batch in rows.select(*date, "batch").distinct().collect():
            by_day.setdefault(tuple(day), []).append(batch)
        by_day = {day: batches for day, batches in by_day.items() if len(batches) > 1}
        if not by_day:
            return
        targets = self.spark.createDataFrame(
            [(*day, max(batches) + 1) for day, batches in by_day.items()],
            T.StructType([*[table.schema[c] for c in date], T.StructField("target", T.LongType())]),
        )
        # One row per calendar day, hence small enough to broadcast; newer batches stay out.
        read = rows.join(F.broadcast(targets), date).where(F.col("batch") < F.col("target"))
        merged = newest_rows(read, table.key, ["batch"]).withColumn("batch", F.col("target"))
        self._write(merged.select(*table.schema.fieldNames(), "batch"), name, (*date, "batch"))
        for day, batches in by_day.items():
            parent = "/".join(f"{c}={v}" for c, v in zip(date, day))
            for batch in batches:
                delete_path(self.spark, f"{self.path(name)}/{parent}/batch={batch}")

    def upsert(self, name: str, rows: DataFrame) -> None:
        """Insert or replace rows by key in a batch table; one writer at a time.

        The merged partitions are staged first and then replace the old ones. If a run stops during
        the replacement, the finished copy is still there, below the root, and the next upsert of any
        session repeats it first, so no old row is lost. Of several incoming rows of one key the one with the
        greatest values stays. ``rows`` is evaluated once.
        """
        table = S.TABLES[name]
        self.finish_upsert(name)
        folder = f"{self.root}/_incoming/{uuid.uuid4().hex}"
        try:
            incoming = stage(_conform(rows, table), name, folder)
            existing = self._touched(name, incoming).withColumn("_new", F.lit(0))
            both = existing.unionByName(incoming.withColumn("_new", F.lit(1)))
            values = [c for c in table.schema.fieldNames() if c not in table.key]
            merged = newest_rows(both, table.key, ["_new", *values]).drop("_new")
            merged.write.mode("overwrite").parquet(self._staged(name))
        finally:
            delete_path(self.spark, folder)
        self.finish_upsert(name)

    def _staged(self, name: str) -> str:
        return f"{self.root}/_upserts/{name}"

    def finish_upsert(self, name: str) -> None:
        """Replace partitions from a finished staged copy, if there is one."""
        table, staged = S.TABLES[name], self._staged(name)
        if path_exists(self.spark, f"{staged}/_SUCCESS"):
            self._write(self.spark.read.schema(table.schema).parquet(staged), name, table.partition_by)
            # The marker goes first: a half-deleted copy must not count as finished.
            delete_path(self.spark, f"{staged}/_SUCCESS")
            delete_path(self.spark, staged)

    def _touched(self, name: str, incoming: DataFrame) -> DataFrame:
        """Existing rows of the partitions that ``incoming`` falls into.

        The first and last partition, one row for the driver, prune folders; a semi-join finds the exact ones.
        """
        columns = list(S.TABLES[name].partition_by)
        place = F.struct(*columns)
        ends = incoming.agg(F.min(place).alias("first"), F.max(place).alias("last")).first()
        if ends["first"] is None:
            return self._scan(name).where(F.lit(False))
        first, last = (F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, ends[end])]) for end in ("first", "last"))
        rows = self._scan(name).where((place >= first) & (place <= last))
        return rows.join(incoming.select(*columns).distinct(), columns, "left_semi").select(*rows.columns)

    def _write(self, rows: DataFrame, name: str, partition_by: tuple[str, ...]) -> None:
        """Replace the partitions present in ``rows``.

        Rows are range-partitioned on partition and key columns: a large partition is spread over
        many tasks and files, and each file covers a narrow key range, which later key lookups skip by
        footer statistics.
        """
        table = S.TABLES[name]
        order = list(dict.fromkeys([*partition_by, *table.key]))
        writer = rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
        if BLOOM_COLUMN in table.key:
            # Footer ranges of one account's neighbours overlap between days; the filter tells files without it apart.
            writer = writer.option(f"parquet.bloom.filter.enabled#{BLOOM_COLUMN}", "true")
            writer = writer.option(f"parquet.bloom.filter.adaptive.enabled#{BLOOM_COLUMN}", "true")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(self.path(name))


def _conform(rows: DataFrame, table: S.Table) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])


class Snapshots:
    """A small keyed result that each micro-batch replaces as a whole, one folder per micro-batch.

    Batch ``n`` reads the folder of batch ``n - 1``, which stays until batch ``n + 1`` has been
    written, so a repeated batch finds its input untouched.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema

    def _folder(self, batch_id: int) -> str:
        return f"{self.root}/batch={batch_id}"

    def _finished(self, batch_id: int) -> bool:
        return path_exists(self.spark, f"{self._folder(batch_id)}/_SUCCESS")

    def _read(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(batch_id))

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def before(self, batch_id: int) -> DataFrame:
        """The state that batch ``batch_id`` starts from; empty for the first batch."""
        if batch_id == 0:
            return self._empty()
        if not self._finished(batch_id - 1):
            raise RuntimeError(f"no snapshot of batch {batch_id - 1} in {self.root}")
        return self._read(batch_id - 1)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self._folder(batch_id))
        delete_path(self.spark, self._folder(batch_id - 2))

    def latest(self) -> DataFrame:
        """The newest finished snapshot."""
        numbers = [int(name.removeprefix("batch=")) for name in folder_names(self.spark, self.root)]
        finished = [n for n in numbers if self._finished(n)]
        return self._read(max(finished)) if finished else self._empty()
