"""The base view: newest copy of each finding, gated, typed and banded."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchtide.functions.severity import severity_level
from watchtide.functions.text import json_bag, not_empty, points, starts_with, text
from watchtide.functions.times import at, instant
from watchtide.functions.variant import Read, member
from watchtide.operators.newest import newest_per_key
from watchtide.settings import DEFAULTS, Settings
from watchtide.sources.table import findings

# Source stamp, supported schema versions, points per filled field and the score a row must reach.
RECORD_SOURCE = "AWSGuardDuty_Main"
VERSION_PREFIX = "2."
FIELD_POINTS = 20
PASSING_SCORE = 60

BASE_READS = (
    Read("DetectorId", "service", ".detectorId"),
    Read("ServiceName", "service", ".serviceName"),
    Read("ResourceType", "resource", ".resourceType"),
    Read("ActionType", "service", ".action.actionType"),
)
SOURCE_COLUMN = {"resource": "ResourceDetails", "service": "ServiceDetails"}

BASE_COLUMNS = (
    "TimeGenerated",
    "EventTime",
    "UpdatedTime",
    "ParsingTimestamp",
    "FindingId",
    "FindingType",
    "DetectorId",
    "Severity",
    "SeverityLevel",
    "Title",
    "Description",
    "AwsAccountId",
    "AwsRegion",
    "Partition",
    "ServiceName",
    "ResourceType",
    "ActionType",
    "DataQualityScore",
    "SchemaVersion",
    "ParserVersion",
    "RecordSource",
    "RawJson",
    "resource",
    "service",
)


def recent(table: DataFrame, lookback=None, as_of: datetime | None = None, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows inside the lookback; a plain comparison that reaches the Parquet scan."""
    return table.filter(F.col("TimeGenerated") >= at(as_of, settings.lookback(lookback)))


def finding_json() -> Column:
    """The finding rebuilt from the table columns as JSON text."""
    return json_bag(
        F.col("AccountId").alias("accountId"),
        F.col("Arn").alias("arn"),
        F.col("TimeCreated").alias("createdAt"),
        F.col("Description").alias("description"),
        F.col("Id").alias("id"),
        F.col("Partition").alias("partition"),
        F.col("Region").alias("region"),
        F.col("ResourceDetails").alias("resource"),
        F.col("SchemaVersion").alias("schemaVersion"),
        F.col("ServiceDetails").alias("service"),
        F.col("Severity").cast("double").alias("severity"),
        F.col("Title").alias("title"),
        F.col("ActivityType").alias("type"),
        F.col("TimeGenerated").alias("updatedAt"),
    )


def quality_score() -> Column:
    """20 points for each of id, type, positive severity, account and region."""
    filled = [not_empty(F.col(c)) for c in ("FindingId", "FindingType", "AwsAccountId", "AwsRegion")]
    return points(*[(condition, FIELD_POINTS) for condition in [*filled, F.col("Severity") > 0]])


def base_findings(
    table: DataFrame,
    lookback=None,
    as_of: datetime | None = None,
    settings: Settings = DEFAULTS,
    reads: tuple[Read, ...] = (),
) -> DataFrame:
    """Newest copy of every finding inside the lookback, with the gates and bands of the base view.

    The newest copy is chosen before any gate, so an invalid newest copy hides an older valid one. ``reads`` are the
    members of ``resource`` and ``service`` that a specialist view needs. They are taken right above the scan, where
    they become Parquet columns, and travel through the one shuffle in place of the whole documents, which Catalyst
    drops unless ``RawJson``, ``resource`` or ``service`` is selected.
    """
    typed = recent(table, lookback, as_of, settings).withColumns(
        {r.name: member(F.col(SOURCE_COLUMN[r.root]), r.path, r.kind) for r in (*BASE_READS, *reads)}
    )
    newest = newest_per_key(typed)
    version, score = text(F.col("SchemaVersion")), F.col("Severity").cast("double")
    if settings.data_validation:
        newest = newest.filter(starts_with(version, VERSION_PREFIX))
    in_range = score.between(F.lit(settings.min_severity), F.lit(settings.max_severity))
    base = newest.select(
        "TimeGenerated",
        F.coalesce("TimeCreated", "TimeGenerated").alias("EventTime"),
        F.col("TimeGenerated").alias("UpdatedTime"),
        F.lit(instant(as_of)).alias("ParsingTimestamp"),
        F.col("Id").alias("FindingId"),
        text(F.col("ActivityType")).alias("FindingType"),
        "DetectorId",
        F.when(in_range, score).otherwise(F.lit(0.0)).alias("Severity"),
        text(F.col("Title")).alias("Title"),
        text(F.col("Description")).alias("Description"),
        text(F.col("AccountId")).alias("AwsAccountId"),
        text(F.col("Region")).alias("AwsRegion"),
        text(F.col("Partition")).alias("Partition"),
        "ServiceName",
        "ResourceType",
        "ActionType",
        version.alias("SchemaVersion"),
        F.lit(settings.parser_version).alias("ParserVersion"),
        F.lit(RECORD_SOURCE).alias("RecordSource"),
        finding_json().alias("RawJson"),
        F.col("ResourceDetails").alias("resource"),
        F.col("ServiceDetails").alias("service"),
        *[r.name for r in reads],
    )
    scored = base.withColumn("DataQualityScore", quality_score())
    if settings.data_validation:
        scored = scored.filter(F.col("DataQualityScore") >= PASSING_SCORE)
    banded = scored.withColumn("SeverityLevel", severity_level(F.col("Severity")))
    return banded.select(*BASE_COLUMNS, *[r.name for r in reads])


def stored_base(
    spark: SparkSession,
    path: str,
    lookback=None,
    as_of: datetime | None = None,
    settings: Settings = DEFAULTS,
    reads: tuple[Read, ...] = (),
) -> DataFrame:
    """The base view of the table at ``path``: one lookback for the day folders and for the rows inside them.

    Equal-time copies that differ in documents alone are told apart by the stored hash of their content.
    """
    table = findings(spark, path, settings.lookback(lookback), as_of, with_hash=True)
    return base_findings(table, lookback, as_of, settings, reads)
