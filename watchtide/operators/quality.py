"""Quality category of every raw table row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from watchtide.functions.text import first_match, is_empty, starts_with
from watchtide.functions.variant import canonical_json
from watchtide.operators.base import VERSION_PREFIX, recent
from watchtide.settings import DEFAULTS, Settings


def quality_categories(
    table: DataFrame, lookback=None, as_of: datetime | None = None, settings: Settings = DEFAULTS
) -> DataFrame:
    """First failing check of each copy, ``Valid`` when none fails. Copies are not collapsed here."""
    severity = F.col("Severity")

    def lacks_content(name: str, *usual: str):
        """Null or ``{}``. A usual member settles it; only documents without one are rendered to find out."""
        document = F.col(name)
        settled = F.lit(False)
        for path in usual:
            settled = settled | F.try_variant_get(document, "$" + path, "string").isNotNull()
        rendered = document.isNull() | canonical_json(document).isin("null", "{}")
        return F.when(settled, F.lit(False)).otherwise(rendered)

    # Categories in the order they are tested.
    checks = [
        (is_empty(F.col("Id")), "Missing FindingId"),
        (is_empty(F.col("ActivityType")), "Missing FindingType"),
        (severity.isNull() | ~severity.between(0, 10), "Invalid Severity"),
        (is_empty(F.col("AccountId")), "Missing AccountId"),
        (is_empty(F.col("Region")), "Missing Region"),
        (F.col("TimeCreated").isNull() | F.col("TimeGenerated").isNull(), "Missing Timestamp"),
        (lacks_content("ResourceDetails", ".resourceType"), "Missing ResourceDetails"),
        (lacks_content("ServiceDetails", ".serviceName", ".detectorId"), "Missing ServiceDetails"),
        (is_empty(F.col("SchemaVersion")), "Missing Schema Version"),
        (~starts_with(F.col("SchemaVersion"), VERSION_PREFIX), "Unsupported Schema Version"),
    ]
    return recent(table, lookback, as_of, settings).select(
        "TimeGenerated",
        "Id",
        "ActivityType",
        first_match(checks, "Valid").alias("QualityCategory"),
        "SchemaVersion",
        "AccountId",
        "Region",
    )
