"""Spark side of the derived data: export lines, stored tables and the second log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from driver_checks.derived import AS_OF, FINDING, attributes_sql, json_sql
from watchtide.operators.base import stored_base
from watchtide.operators.geo import GeoRanges
from watchtide.sources.exports import explode_batches, read_findings, unwrap_events
from watchtide.sources.table import findings, to_findings_table, write_findings
from watchtide.storage import work_folder

_STORED: dict[tuple[str, str], str] = {}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A task makes so many copies; of a streamed export, which is read a file or two per trigger, up to LONGEST_FILE once it
# has as many files as STREAMED.
TASK_LINES, LONGEST_FILE, STREAMED = 50_000, 250_000, 24


def events(spark: SparkSession, sf_dir: str, least: int = 1, streamed: bool = False) -> DataFrame:
    """Events with a UTC timestamp, in at least so many tasks, of 50,000 events each where there are more.

    The given file is one split, or a few: they are dealt while they are narrow, before a copy is made of each.
    """
    rows = given(spark, sf_dir, "events")
    narrow = rows.select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    return narrow.repartition(task_count(rows.count(), least, streamed))


def task_count(rows: int, least: int = 1, streamed: bool = False) -> int:
    """Tasks for so many events, each of which writes a file of an export."""
    tasks = rows // TASK_LINES
    return max(least, max(min(tasks, STREAMED), rows // LONGEST_FILE) if streamed else tasks)


def attributes(spark: SparkSession, sf_dir: str, least: int = 1, streamed: bool = False) -> DataFrame:
    return spark.sql(attributes_sql("{source}"), source=events(spark, sf_dir, least, streamed))


def finding_lines(spark: SparkSession, sf_dir: str, least: int = 1, streamed: bool = False) -> DataFrame:
    """Every copy as one JSON line: ``(e, raw)``."""
    return attributes(spark, sf_dir, least, streamed).select("e", F.expr(json_sql(FINDING)).alias("raw"))


def export_lines(spark: SparkSession, sf_dir: str, least: int = 1, streamed: bool = False) -> DataFrame:
    """The copies as an export would bring them: bare, enveloped, batched, and with lines that break the contract.

    By event number modulo 12: 0 an event envelope, 1 an envelope of another sender, 2 a batch of one, 3 an empty
    batch, 4 a batch with a member that is no object, 5 a line cut short, 6 an envelope without a detail object,
    7 no known form, others bare.
    """
    raw = F.col("raw")

    def enveloped(source: str, detail) -> F.Column:
        head = (
            '{"version":"0","id":"ev-1","detail-type":"GuardDuty Finding","source":"' + source + '",'
            '"account":"123456789012","time":"2024-01-01T00:00:00Z","region":"us-east-1","resources":["a"],"detail":'
        )
        return F.concat(F.lit(head), detail, F.lit("}"))

    form = F.col("e") % 12
    line = (
        F.when(form == 0, enveloped("aws.guardduty", raw))
        .when(form == 1, enveloped("other.sender", raw))
        .when(form == 2, F.concat(F.lit('{"findings":['), raw, F.lit(","), raw, F.lit("]}")))
        .when(form == 3, F.lit('{"findings":[]}'))
        .when(form == 4, F.concat(F.lit('{"findings":['), raw, F.lit(',"x"]}')))
        .when(form == 5, F.expr("substring(raw, 1, length(raw) - 1)"))
        .when(form == 6, enveloped("aws.guardduty", F.lit("[]")))
        .when(form == 7, F.lit('{"source":"aws.guardduty"}'))
        .otherwise(raw)
    )
    return finding_lines(spark, sf_dir, least, streamed).select("e", line.alias("raw"))


def _kept(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Folder of a derived dataset, written once per session and scale."""
    key = (f"{spark.sparkContext.applicationId}/{name}", sf_dir)
    if key not in _STORED:
        path = work_folder(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def _write_lines(lines: DataFrame, path: str) -> None:
    """A gzip file per task of ``lines``: the text is written where it is made, and none of it is shuffled.

    It is read a few times at most, so it is packed at the fastest level.
    """
    lines.select("raw").write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def finding_export(spark: SparkSession, sf_dir: str) -> str:
    """Folder of gzip JSON Lines with every copy as a bare finding. Streams read it a few files per trigger."""
    return _kept(spark, sf_dir, "finding-export", lambda path: _write_lines(finding_lines(spark, sf_dir, 8, streamed=True), path))


def mixed_export(spark: SparkSession, sf_dir: str) -> str:
    """Folder of gzip JSON Lines with the forms of ``export_lines``."""
    return _kept(spark, sf_dir, "mixed-export", lambda path: _write_lines(export_lines(spark, sf_dir, 4, streamed=True), path))


def unwrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy read, parsed and unwrapped, without the contract check: what a vendor connector would store."""
    return unwrap_events(explode_batches(read_findings(spark, finding_export(spark, sf_dir))))


def table_path(spark: SparkSession, sf_dir: str) -> str:
    return _kept(
        spark, sf_dir, "findings", lambda path: write_findings(to_findings_table(unwrapped(spark, sf_dir)), path)
    )


def table(spark: SparkSession, sf_dir: str, lookback=None) -> DataFrame:
    return findings(spark, table_path(spark, sf_dir), lookback, AS_OF)


def base(spark: SparkSession, sf_dir: str, lookback="30d", reads=()) -> DataFrame:
    return stored_base(spark, table_path(spark, sf_dir), lookback, AS_OF, reads=reads)


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address ranges named after nations: one /16 and one narrower range inside another block per nation."""
    nation = given(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n"), "n_name")
    wide_start, narrow_start = F.lit(203 << 24) + F.col("n") * 512, F.lit((203 << 24) + (100 << 8)) + F.col("n") * 256
    wide = nation.select(
        wide_start.alias("start"),
        (wide_start + 511).alias("end"),
        F.col("n_name").alias("country"),
        F.lit("wide").alias("state"),
        F.concat(F.lit("City "), F.col("n").cast("string")).alias("city"),
        F.col("n").cast("double").alias("latitude"),
        (F.col("n") * -1).cast("double").alias("longitude"),
    )
    narrow = nation.select(
        narrow_start.alias("start"),
        (narrow_start + 99).alias("end"),
        F.col("n_name").alias("country"),
        F.lit("narrow").alias("state"),
        F.lit(None).cast("string").alias("city"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
    )
    block = F.lit((198 << 24) + (51 << 16))
    documentation = nation.filter(F.col("n") == 0).select(
        block.cast("long").alias("start"),
        (block + 65535).cast("long").alias("end"),
        F.lit("Testland").alias("country"),
        F.lit("block").alias("state"),
        F.lit("Testville").alias("city"),
        F.lit(1.5).alias("latitude"),
        F.lit(-2.5).alias("longitude"),
    )
    return wide.unionByName(narrow).unionByName(documentation)


def geo_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IPv6 networks named after nations: one /48 and its upper half per nation."""
    nation = given(spark, sf_dir, "nation")
    group = F.lower(F.hex("n_nationkey"))
    parts = [(F.concat(F.lit("2001:db8:"), group, F.lit(end)), part) for end, part in (("::/48", "whole"), (":8000::/49", "upper"))]
    made = [
        nation.select(
            network.alias("network"),
            F.col("n_name").alias("country"),
            F.lit(part).alias("state"),
            F.lit(None).cast("string").alias("city"),
            F.col("n_nationkey").cast("double").alias("latitude"),
            F.lit(None).cast("double").alias("longitude"),
        )
        for network, part in parts
    ]
    return made[0].unionByName(made[1])


def geo(spark: SparkSession, sf_dir: str) -> GeoRanges:
    return GeoRanges(geo_ranges(spark, sf_dir))


def firewall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second log: every order is one connection, at a time inside the findings' month."""
    order = F.col("o_orderkey")
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (order % 43200).cast("int"))
    return given(spark, sf_dir, "orders").select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + minutes).alias("TimeGenerated"),
        F.concat(F.lit("10.9."), (F.col("o_custkey") % 250).cast("string"), F.lit(".1")).alias("SourceIP"),
        F.concat(
            F.lit("203.0."), (F.col("o_custkey") % 200).cast("string"), F.lit("."), (order % 250).cast("string")
        ).alias("DestinationIP"),
        F.col("o_orderstatus").alias("Activity"),
    )
