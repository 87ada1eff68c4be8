"""Comparing the findings that were sent with the table they should have reached."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from watchtide.functions.times import at
from watchtide.operators.newest import newest_per_key

SENT_TIES = ("AccountId", "Type", "Region", "Severity")
# Fields that must agree, as (table column, sent column).
COMPARED = (("AccountId", "AccountId"), ("ActivityType", "Type"), ("Region", "Region"), ("Severity", "Severity"))


def _arrived(sent: DataFrame, table: DataFrame, started_at: datetime | None) -> DataFrame:
    """Stored copies of the ids that were sent, from ``started_at`` on; older ones belong to an earlier delivery."""
    stored = table if started_at is None else table.filter(F.col("TimeGenerated") >= at(started_at))
    return stored.join(sent.select("Id").distinct(), "Id", "left_semi")


def missing_ids(sent: DataFrame, table: DataFrame, started_at: datetime | None = None) -> DataFrame:
    """Ids that were sent and are not in the table from ``started_at`` on. Only distinct ids meet."""
    return sent.select("Id").distinct().join(_arrived(sent, table, started_at).select("Id").distinct(), "Id", "left_anti")


def parity_mismatches(sent: DataFrame, table: DataFrame, started_at: datetime | None = None) -> DataFrame:
    """``(Id, field, expected, actual)`` for every compared field in which a finding that was sent differs as stored.

    ``sent`` has ``Id, AccountId, Type, Region, Severity`` and may have ``UpdatedAt``. Copies of an id count as its
    newest copy on both sides, and the table is reduced to the ids that were sent before its newest copies are found.
    An id that has not arrived differs in every field; stored findings that were not sent are no concern.
    """
    newest_sent = newest_per_key(sent, "Id", "UpdatedAt", SENT_TIES) if "UpdatedAt" in sent.columns else (
        newest_per_key(sent, "Id", "Severity", SENT_TIES)
    )
    whole_severity = F.col("Severity").cast("double").try_cast("int").cast("string")
    expected = newest_sent.select(
        "Id",
        *[
            (whole_severity if theirs == "Severity" else F.col(theirs)).alias(f"expected_{ours}")
            for ours, theirs in COMPARED
        ],
    )
    actual = newest_per_key(_arrived(sent, table, started_at)).select(
        "Id", *[F.col(ours).cast("string").alias(f"actual_{ours}") for ours, _ in COMPARED]
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(ours).alias("field"),
                F.col(f"expected_{ours}").alias("expected"),
                F.col(f"actual_{ours}").alias("actual"),
            )
            for ours, _ in COMPARED
        ]
    )
    return (
        expected.join(actual, "Id", "left")
        .select("Id", F.explode(pairs).alias("pair"))
        .select("Id", "pair.field", "pair.expected", "pair.actual")
        .filter(~F.col("expected").eqNullSafe(F.col("actual")))
    )
