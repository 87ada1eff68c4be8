"""Line de-duplication against levelled sorted runs of line hashes.

Documents come in batches of ascending ids. The index of all lines seen so far is a few *runs*: tables of line hashes
with the document that owns each, bucketed and sorted by hash. A batch is reduced to its distinct hashes, merged with
the runs to find those that are new, and adds these as a run of the lowest level. ``fan_in`` runs of a level are merged
into one of the next. No hash is in two runs, so a look-up joins few tables, none of which has to be shuffled again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchtide.storage import stored, work_folder

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class LineRule:
    """Keys shorter than ``shortest`` code points are never dropped; batches of one call; runs merged at once."""

    shortest: int = 10
    batches: int = 4
    fan_in: int = 3


def line_key(line: Column) -> Column:
    """The line without blanks at either end, A-Z lower-cased and nothing else."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


class LineRuns:
    """The levelled index: for every line hash seen, the id of the document that owns it."""

    def __init__(self, spark: SparkSession, fan_in: int = 3) -> None:
        self.spark = spark
        self.fan_in = fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    def _run(self, rows: DataFrame) -> DataFrame:
        """``rows`` as a table, bucketed and sorted by ``key``: one file a bucket, in the shared folder."""
        name = f"line_run_{uuid.uuid4().hex}"
        dealt = rows.repartition(self.buckets, "key")
        dealt.write.bucketBy(self.buckets, "key").sortBy("key").option("path", work_folder(self.spark, name)).saveAsTable(name)
        return self.spark.table(name)

    def add(self, lines: DataFrame) -> DataFrame:
        """Takes a batch ``(key, id)`` and returns ``(key, owner)`` of the hashes that it has lines to lose of.

        A hash that is in a run stays with its owner; a new one goes to the least id of the batch that has it.
        """
        keys = lines.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        owner = F.lit(None).cast(keys.schema["least"].dataType)
        for i, run in enumerate(r for level in self.levels for r in level):
            keys = keys.join(run.withColumnRenamed("owner", f"owner{i}"), "key", "left")
            owner = F.coalesce(owner, F.col(f"owner{i}"))
        judged = stored(keys.select("key", "most", F.coalesce(owner, "least").alias("owner"), owner.isNull().alias("fresh")), "judged")
        self._push(0, self._run(judged.filter("fresh").select("key", "owner")))
        return judged.filter("owner < most").select("key", "owner")

    def _push(self, level: int, run: DataFrame) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        runs = self.levels[level]
        runs.append(run)
        if len(runs) == self.fan_in:
            merged = runs[0]
            for other in runs[1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._push(level + 1, self._run(merged))


def _batches(lines: DataFrame, rule: LineRule) -> list[DataFrame]:
    """The lines in batches of ascending ids and about equal size."""
    shares = [(i + 1) / rule.batches for i in range(rule.batches - 1)]
    cuts = lines.agg(F.percentile_approx("id", shares, 1000).alias("cuts")).first().cuts if shares else []
    cuts = sorted(set(cuts or []))
    parts = []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = lines if low is None else lines.filter(F.col("id") > low)
        parts.append(part if high is None else part.filter(F.col("id") <= high))
    return parts


def dedup_lines(docs: DataFrame, rule: LineRule = LineRule(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``; columns of those names give way.

    Lines end at ``\\n``; a null or empty text is one empty line. A key that two or more ids have keeps its lines, all
    of them, in the least id only. Ids are numbers. Rows that share an id are one document, whatever their texts. Rows
    without an id lose nothing and take nothing from others. An empty table gives no rows.
    """
    rows = docs.drop("n_lines", "n_dropped", "kept_text")
    split = F.split(F.coalesce(rows[text], F.lit("")), "\n", -1)
    spread = rows.filter(rows[id].isNotNull()).select(rows[id].alias("id"), F.xxhash64(rows[text]).alias("version"), F.posexplode(split).alias("at", "line"))
    keyed = spread.select("id", "version", "at", line_key(F.col("line")).alias("key")).filter(F.length("key") >= rule.shortest)
    lines = stored(keyed.withColumn("key", F.unhex(F.md5(F.col("key").cast("binary")))), "lines")
    runs = LineRuns(docs.sparkSession, rule.fan_in)
    lost = None
    for batch in _batches(lines, rule):
        shared = runs.add(batch.select("key", "id"))
        here = batch.join(shared, "key").filter("id > owner").select("id", "version", "at")
        lost = here if lost is None else lost.unionByName(here)
    # One byte per line up to the last lost one: 0 for lost. Bytes are reached by number, whatever their count.
    places = lost.groupBy("id", "version").agg(F.array_sort(F.collect_set("at")).alias("_lost"))
    runs_kept = F.transform("_lost", lambda at, i: F.concat(F.repeat(F.lit("1"), at - F.when(i > 0, F.element_at("_lost", F.when(i > 0, i).otherwise(1))).otherwise(-1) - 1), F.lit("0")))
    places = places.select(F.col("id").alias("_id"), F.col("version").alias("_version"), F.size("_lost").cast("bigint").alias("_dropped"), F.concat_ws("", runs_kept).cast("binary").alias("_marks"))
    joined = rows.join(places, (rows[id] == F.col("_id")) & (F.xxhash64(rows[text]) == F.col("_version")), "left")
    kept = F.array_join(F.filter(split, lambda line, i: F.substring("_marks", i + 1, F.lit(1)) != F.lit(b"0")), "\n")
    return joined.select(
        *[rows[c] for c in rows.columns],
        F.size(split).cast("bigint").alias("n_lines"),
        F.coalesce("_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("_marks").isNull(), F.coalesce(rows[text], F.lit(""))).otherwise(kept).alias("kept_text"),
    )
