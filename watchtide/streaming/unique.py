"""Every finding copy once, however often and however late it is delivered again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from watchtide.functions.times import utc_day
from watchtide.sources.table import FINDINGS, micros
from watchtide.storage import child_names, remove_folder, rows_on_disk
from watchtide.streaming.commits import CommitLog

KEY = ("Id", "TimeGenerated")
_DAY = "KeyDate"
#: Batches whose keys lie in folders of their own, before they are merged with those of all batches before.
_OPEN_BATCHES = 16


def _day():
    return F.coalesce(utc_day(F.col("TimeGenerated")).cast("string"), F.lit("none"))


class UniqueStore:
    """Copies that are no redeliveries, below one folder, and the keys that tell.

    A redelivery has the same id and update time as its first copy. Keys are kept for good, in folders by UTC day of
    the update time, so a micro-batch is compared with the days that it holds and with no others. A day's keys are in
    one folder per batch (``batch=n``), and after every 16 batches in one of all batches up to that (``upto=n``): so
    there are no more folders to open after many batches than after few. There is no watermark: a copy is either kept
    or known already, and none is lost for being late.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.log = CommitLog(self.path)

    def _known(self, spark: SparkSession, days: list[str]) -> DataFrame | None:
        """Keys of the given days, of committed batches only."""
        committed, paths = set(self.log.batches(spark)), []
        for day in days:
            folder = f"{self.path}/keys/{_DAY}={day}"
            found = [(kind, int(n)) for kind, _, n in (name.partition("=") for name in child_names(spark, folder)) if n.isdigit()]
            last = max((n for kind, n in found if kind == "upto" and n in committed), default=-1)
            later = sorted(n for kind, n in found if kind == "batch" and n in committed and n > last)
            paths += [f"{folder}/upto={last}"] * (last >= 0) + [f"{folder}/batch={n}" for n in later]
        if not paths:
            return None
        schema = ", ".join(f"{c} {FINDINGS[c].dataType.simpleString()}" for c in KEY)
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def _write_keys(self, keys: DataFrame, kind: str, batch_id: int) -> None:
        """A folder per day, in as few files as its keys need."""
        dealt = keys.select(*KEY, _day().alias(_DAY), F.lit(batch_id).alias(kind)).hint("rebalance", F.col(_DAY))
        writer = micros(dealt).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(_DAY, kind).parquet(f"{self.path}/keys")

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Keeps the new copies of a micro-batch; a batch that is committed is left as it is.

        Rows become one per key and task before they meet, so a finding that is sent over and over does not pile up.
        They are mapped once and kept on disk, for their days and for the write.
        """
        spark = batch.sparkSession
        if self.log.has(spark, batch_id):
            return
        with rows_on_disk(batch.select(*FINDINGS.names)) as mapped:
            known = self._known(spark, [r[0] for r in mapped.select(_day().alias(_DAY)).distinct().collect()])
            once = new = mapped.dropDuplicates(list(KEY))
            if known is not None:
                same = [once[c].eqNullSafe(known[c]) for c in KEY]
                new = once.join(known, same[0] & same[1], "left_anti")
            rows = f"rows/batch={batch_id}"
            micros(new).write.mode("overwrite").parquet(f"{self.path}/{rows}")
        fresh = spark.read.schema(FINDINGS).parquet(f"{self.path}/{rows}").select(*KEY)
        self._write_keys(fresh, "batch", batch_id)
        merged = (batch_id + 1) % _OPEN_BATCHES == 0
        if merged:
            known = self._known(spark, self._days(spark))
            self._write_keys(fresh if known is None else known.unionByName(fresh), "upto", batch_id)
        self.log.add(spark, batch_id, [rows])
        if merged:
            self._forget(spark, batch_id)

    def _days(self, spark: SparkSession) -> list[str]:
        return [n.partition("=")[2] for n in child_names(spark, f"{self.path}/keys") if n.startswith(f"{_DAY}=")]

    def _forget(self, spark: SparkSession, batch_id: int) -> None:
        """Removes the folders of keys that ``upto=batch_id`` holds."""
        for day in self._days(spark):
            folder = f"{self.path}/keys/{_DAY}={day}"
            for name in child_names(spark, folder):
                kind, _, n = name.partition("=")
                if n.isdigit() and (int(n) <= batch_id if kind == "batch" else kind == "upto" and int(n) < batch_id):
                    remove_folder(spark, f"{folder}/{name}")

    def read(self, spark: SparkSession) -> DataFrame:
        """The unique copies of all committed batches."""
        paths = [f"{self.path}/{f}" for n in self.log.batches(spark) for f in self.log.folders(spark, n)]
        if not paths:
            return spark.createDataFrame([], FINDINGS)
        return spark.read.schema(FINDINGS).option("recursiveFileLookup", "true").parquet(*paths)


def start_unique(table_stream: DataFrame, store: UniqueStore, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (
        table_stream.writeStream.foreachBatch(store.add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
