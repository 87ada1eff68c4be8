"""Run settings and the settings table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from watchtide.functions.times import clamp_lookback, timespan

# Setting, value, what it controls.
SETTINGS_ROWS = (
    ("TableName", "AWSGuardDuty", "Name of the findings table in reports"),
    ("InputContract", "Microsoft-AWSGuardDuty", "Contract the findings table follows"),
    ("DefaultLookback", "7d", "Time range of a view when none is given"),
    ("MaxLookback", "90d", "Longest time range a view accepts"),
    ("QueryTimeout", "300", "Informational timeout in seconds"),
    ("MinSeverityScore", "0.0", "Lowest severity score taken as valid"),
    ("MaxSeverityScore", "10.0", "Highest severity score taken as valid"),
    ("RequiredFields", "id,type,severity,accountId,region", "Fields a usable finding carries"),
    ("ParserVersion", "1.5.0", "Version stamped on every view row"),
    ("SchemaVersion", "2.0", "Finding schema version the views expect"),
    ("LastUpdated", "2026-07-23", "Date of the last rule change"),
    ("EnableGeoEnrichment", "true", "Look up remote addresses in the supplied geo ranges"),
    ("EnableASIMNormalization", "true", "Network session normalisation is available"),
    ("EnableDataValidation", "true", "Drop rows that fail the version and quality gates"),
    ("EnablePerformanceLogging", "false", "Informational diagnostics flag"),
)
_VALUES = {name: value for name, value, _ in SETTINGS_ROWS}
SETTINGS_SCHEMA = "Setting STRING, Value STRING, Description STRING, DefaultValue STRING"


@dataclass(frozen=True)
class Settings:
    """Values the views read. They are plain Python values, so Catalyst folds the branches they switch off."""

    default_lookback: timedelta = timespan(_VALUES["DefaultLookback"])
    max_lookback: timedelta = timespan(_VALUES["MaxLookback"])
    min_severity: float = float(_VALUES["MinSeverityScore"])
    max_severity: float = float(_VALUES["MaxSeverityScore"])
    parser_version: str = _VALUES["ParserVersion"]
    table_name: str = _VALUES["TableName"]
    geo_enrichment: bool = _VALUES["EnableGeoEnrichment"] == "true"
    data_validation: bool = _VALUES["EnableDataValidation"] == "true"

    def lookback(self, asked=None) -> timedelta:
        return clamp_lookback(asked, self.default_lookback, self.max_lookback)


DEFAULTS = Settings()


def settings_table(spark: SparkSession, overrides: dict[str, str] | None = None) -> DataFrame:
    """One row per setting: current value, description and default."""
    changed = overrides or {}
    unknown = set(changed) - set(_VALUES)
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    rows = [(name, changed.get(name, value), note, value) for name, value, note in SETTINGS_ROWS]
    return spark.createDataFrame(rows, SETTINGS_SCHEMA)
